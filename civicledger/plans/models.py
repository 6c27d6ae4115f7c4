"""The warehouse models, one function each, used both for audit slices and publishing.

``run_date=None`` builds the full history (first build); a date builds the
slice of trades *reported* on that date (the incremental axis, which absorbs
late trades without watermarks).  The slice predicate sits directly on the
source scan, so on a ``report_date``-partitioned table it prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.keyed import latest_per_key, semi_join
from ..operators.quality import ModelTests

# ---------------------------------------------------------------------------
# Source table layouts
# ---------------------------------------------------------------------------
TRADES_SOURCE_COLUMNS = [
    "amendment_number", "amount", "chamber", "disclosure_url", "committees", "display_name",
    "district", "headshot", "member_record_id", "leadership_positions", "member_id",
    "member_name", "party", "state", "member_updated", "website", "trade_record_id",
    "notification_date", "ownership", "report_date", "report_id", "security_name",
    "security_ticker", "security_type", "transaction_date", "transaction_id",
    "transaction_type", "record_updated",
]
MARKET_SOURCE_COLUMNS = [
    "status", "date_recorded", "symbol", "open", "high", "low", "close", "stock_volume",
    "after_hours", "pre_market",
]
TICKER_COLUMNS = [
    "active", "base_currency_name", "base_currency_symbol", "currency_name", "currency_symbol",
    "last_updated_utc", "locale", "market", "name", "ticker",
]
TICKER_SOURCE_COLUMNS = TICKER_COLUMNS + ["row_hash", "watermark_timestamp"]

# ---------------------------------------------------------------------------
# src layer: projections only
# ---------------------------------------------------------------------------
SRC_TRADES_PASSTHROUGH = [
    "amount", "chamber", "committees", "district", "member_record_id", "leadership_positions",
    "member_id", "member_name", "party", "state", "member_updated", "trade_record_id",
    "notification_date", "report_date", "report_id", "security_name", "transaction_date",
    "transaction_id", "transaction_type", "record_updated",
]
SRC_TRADES_BLANKABLE = ["ownership", "security_ticker", "security_type"]


def src_trades(raw: DataFrame) -> DataFrame:
    """Drop non-analytical columns (amendment, URLs, display name, headshot); '' -> NULL."""
    return raw.select(*SRC_TRADES_PASSTHROUGH,
                      *[X.blank_to_null(c).alias(c) for c in SRC_TRADES_BLANKABLE])


def src_market(raw: DataFrame) -> DataFrame:
    return raw.select(
        "date_recorded",
        F.col("symbol").alias("ticker"),
        F.col("open").alias("stock_open"),
        F.col("high").alias("stock_high"),
        F.col("low").alias("stock_low"),
        F.col("close").alias("stock_close"),
        "stock_volume", "after_hours", "pre_market",
    )


def src_tickers(raw: DataFrame) -> DataFrame:
    """Tickers without the row hash."""
    return raw.select(*TICKER_COLUMNS, "watermark_timestamp")


def report_slice(df: DataFrame, run_date=None, col: str = "report_date") -> DataFrame:
    """Rows reported on ``run_date``; the whole table when ``run_date`` is None."""
    if run_date is None:
        return df
    return df.where(F.col(col) == F.lit(run_date).cast("date"))


# ---------------------------------------------------------------------------
# int layer
# ---------------------------------------------------------------------------
OFFICIAL_COLUMNS = [
    "member_id", "chamber", "member_name", "party", "state", "state_iso_format", "district",
    "committees", "leadership_positions", "member_updated_utc",
]
# deterministic tie-break among rows of one member with equal update time
OFFICIAL_TIEBREAK = ["transaction_id"]


def officials(src: DataFrame, states: DataFrame, run_date=None,
              order_by=("member_updated",)) -> DataFrame:
    """Current officials: latest row per member, decoded, state looked up.

    The reference orders by ``member_updated DESC`` with NULL ranked first and
    no tie-break; ties are settled here by the greatest ``transaction_id``.
    The latest row is picked *before* the lookup join so that only one row
    per member reaches it.
    """
    extra = [c for c in order_by if c != "member_updated"]
    rows = report_slice(src, run_date).select(
        "member_id", "member_name", "district", "committees", "leadership_positions", "chamber",
        "party", "state", "member_updated", *extra, *OFFICIAL_TIEBREAK)
    latest = latest_per_key(rows, "member_id", list(order_by), OFFICIAL_TIEBREAK)
    # no broadcast hint: the planner broadcasts the lookup only after checking its
    # size (file statistics against autoBroadcastJoinThreshold, then AQE on the
    # measured size) and falls back to a shuffle join beyond the threshold
    st = states.select(F.col("state_abbrev").alias("_abbrev"), "state_name", "state_iso_format")
    j = latest.join(st, latest["state"] == st["_abbrev"], "left")
    return j.select(
        "member_id",
        X.decode_chamber("chamber").alias("chamber"),
        "member_name",
        X.decode_party("party").alias("party"),
        F.coalesce(F.col("state_name"), F.lit(X.UNKNOWN)).alias("state"),
        F.coalesce(F.col("state_iso_format"), F.lit(X.UNKNOWN)).alias("state_iso_format"),
        "district", "committees", "leadership_positions",
        X.epoch_to_ts("member_updated").alias("member_updated_utc"),
    )


TRADE_COLUMNS = [
    "trade_record_id", "notification_date", "ownership", "report_date", "security_name",
    "security_ticker", "security_type", "amount_value_bucket", "transaction_date",
    "transaction_id", "member_id", "report_id", "minimum_value", "maximum_value", "median_value",
    "transaction_type", "is_purchase", "is_sale", "record_upated_utc",
]


def official_trades(src: DataFrame, run_date=None) -> DataFrame:
    """Normalised trades with a ticker: dollar bucket parsed, type decoded, flags."""
    rows = report_slice(src, run_date).where(F.col("security_ticker").isNotNull())
    lo = X.dollar_bound("amount", 1)
    hi = X.dollar_bound("amount", 2)
    return rows.select(
        "trade_record_id", "notification_date", "ownership", "report_date", "security_name",
        "security_ticker", "security_type",
        F.col("amount").alias("amount_value_bucket"),
        "transaction_date", "transaction_id", "member_id",
        F.col("report_id").cast("string").alias("report_id"),
        lo.alias("minimum_value"),
        hi.alias("maximum_value"),
        X.range_midpoint(lo, hi).alias("median_value"),
        X.decode_trade_type("transaction_type").alias("transaction_type"),
        X.is_purchase("transaction_type").alias("is_purchase"),
        X.is_sale("transaction_type").alias("is_sale"),
        X.epoch_to_ts("record_updated").alias("record_upated_utc"),   # name kept as published
    )


MARKET_COLUMNS = [
    "date_recorded", "ticker", "stock_open", "stock_high", "stock_low", "stock_close",
    "stock_volume", "stock_median",
]


def market(src_mkt: DataFrame, src: DataFrame, run_date=None) -> DataFrame:
    """Day prices of traded (ticker, date) pairs only -- a semi join, no pre-DISTINCT needed."""
    pairs = report_slice(src, run_date).select("security_ticker", "transaction_date")
    kept = semi_join(src_mkt, pairs, [("ticker", "security_ticker"),
                                      ("date_recorded", "transaction_date")])
    return kept.select(
        "date_recorded", "ticker", "stock_open", "stock_high", "stock_low", "stock_close",
        "stock_volume", X.price_midpoint("stock_high", "stock_low").alias("stock_median"))


def price_worklist(raw: DataFrame, run_date) -> DataFrame:
    """DISTINCT (ticker, trade date) of trades reported on ``run_date`` with a non-empty ticker."""
    return (report_slice(raw, run_date).where(X.non_empty("security_ticker"))
            .select("security_ticker", "transaction_date").distinct())


# ---------------------------------------------------------------------------
# mart
# ---------------------------------------------------------------------------
FACT_COLUMNS = [
    "member_id", "chamber", "member_name", "party", "state", "district", "committees",
    "transaction_id", "report_date", "notification_date", "transaction_date", "transaction_type",
    "security_ticker", "security_name", "transaction_bucket", "transaction_miminum_value",
    "transaction_median_value", "transaction_maximum_value", "stock_open", "stock_high",
    "stock_median", "stock_low", "stock_close", "stock_volume", "is_purchase", "is_sale",
    "state_iso_format",
]


def fact_trades(officials_df: DataFrame, trades_df: DataFrame, market_df: DataFrame) -> DataFrame:
    """Trade LEFT JOIN official LEFT JOIN day price; 27 columns.

    ``member_id`` comes from the official side (NULL for a trade whose member
    is unknown), as published.  Both joins shuffle on their keys; AQE turns a
    side into a broadcast only if it measures small at runtime and splits
    skewed trade partitions (a hot member or ticker-day) on the trade side.
    """
    t = trades_df.alias("t")
    g = officials_df.alias("g")
    m = market_df.alias("m")
    j = (t.join(g, F.col("t.member_id") == F.col("g.member_id"), "left")
          .join(m, (F.col("t.transaction_date") == F.col("m.date_recorded"))
                & (F.col("t.security_ticker") == F.col("m.ticker")), "left"))
    return j.select(
        F.col("g.member_id"), "g.chamber", "g.member_name", "g.party", "g.state", "g.district",
        "g.committees", "t.transaction_id", "t.report_date", "t.notification_date",
        "t.transaction_date", "t.transaction_type", "t.security_ticker", "t.security_name",
        F.col("t.amount_value_bucket").alias("transaction_bucket"),
        F.col("t.minimum_value").alias("transaction_miminum_value"),   # name kept as published
        F.col("t.median_value").alias("transaction_median_value"),
        F.col("t.maximum_value").alias("transaction_maximum_value"),
        "m.stock_open", "m.stock_high", "m.stock_median", "m.stock_low", "m.stock_close",
        "m.stock_volume", "t.is_purchase", "t.is_sale", "g.state_iso_format",
    )


# ---------------------------------------------------------------------------
# Declared tests (the project's yml, as data)
# ---------------------------------------------------------------------------
AUDIT_TESTS = [
    ModelTests(
        "int_gov_official_trades_audit",
        not_null=["trade_record_id", "report_date", "security_name", "security_ticker",
                  "amount_value_bucket", "minimum_value", "maximum_value", "median_value",
                  "transaction_date", "transaction_id", "is_purchase", "is_sale",
                  "record_upated_utc", "member_id"],
        unique=["trade_record_id", "transaction_id"],
        relationships=[("member_id", "int_gov_officials_audit", "member_id")],
    ),
    ModelTests(
        "int_gov_officials_audit",
        not_null=["member_id", "chamber", "member_name", "party", "state", "state_iso_format",
                  "member_updated_utc"],
        unique=["member_id"],
    ),
    ModelTests(
        "int_market_audit",
        not_null=["date_recorded", "ticker"],
        unique_combos=[["date_recorded", "ticker"]],
    ),
]

PUBLISHED_TESTS = [
    ModelTests("int_gov_official_trades", not_null=["trade_record_id", "transaction_id"],
               unique=["trade_record_id", "transaction_id"]),
    ModelTests("int_gov_officials", not_null=["member_id"], unique=["member_id"]),
]

FACT_TESTS = [
    ModelTests(
        "fct_government_official_trades",
        not_null=["member_id", "chamber", "member_name", "party", "state", "transaction_id",
                  "report_date", "notification_date", "transaction_date", "transaction_type",
                  "security_ticker", "security_name", "transaction_bucket",
                  "transaction_miminum_value", "transaction_median_value",
                  "transaction_maximum_value", "is_purchase", "is_sale", "state_iso_format"],
        unique=["transaction_id"],
    ),
]
