"""Domain tables derived from the driver's TPC-H-like test data (Spark side).

The warehouse's real inputs are landed JSON feeds; the driver's test data is
a star schema.  These functions derive, with Spark, tables shaped like the
warehouse's source tables so that every registered query runs the real
operators over the whole test tables (its work grows with them).  The DuckDB
oracle in ``oracle.py`` derives the same tables independently in SQL.

Mapping (k = o_orderkey, c = customer, p = p_partkey):

* ``trades_raw``   orders JOIN customer -> 28-column government-trades table
* ``market_raw``   lineitem -> day prices per ('TK' || l_partkey % 50, l_shipdate);
                   prices depend on (date, symbol) only, so exact duplicates arise
* ``market``       market_raw with duplicates collapsed (what the daily dedup leaves)
* ``states``       nation with n_nationkey < 20 (five state codes stay unknown)
* ``tickers_*``    part -> staged tickers and a previous mirror of them
* ``officials_v*`` customer as two versions of the officials dimension (SCD2)

Every derivation reads its whole source table.  Key arithmetic (``k % 5``,
``c_custkey % 13``, ...) only assigns rows to the roles a scenario needs --
amount bucket, blank ticker, a key that is new in a version, changed, or
gone -- it never thins the data to make a check cheaper.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import scd2
from ..operators.keyed import latest_per_key

# Fixed parameters of the driver queries
RUN_DATE = "1997-05-01"
BACKFILL_START = "1997-01-01"
BACKFILL_END = "1997-12-31"
DEDUP_AS_OF = "2001-09-01"
FRESHNESS_AS_OF = "2024-01-31 12:00:00"
STAGING_LOADED_AT = "2024-07-01 06:00:00"
TARGET_LOADED_AT = "2024-06-01 06:00:00"
SCD_RUN_TS = "2024-03-01 00:00:00"
TICKER_EPOCH0 = 1704067200  # 2024-01-01 00:00:00 UTC
LOAD_ERROR_MAX_RATIO = 0.10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _tk(num: Column) -> Column:
    return F.concat(F.lit("TK"), _s(num))


def _case(pairs, default=None) -> Column:
    out = None
    for cond, val in pairs:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# ---------------------------------------------------------------------------
# trades, states, market
# ---------------------------------------------------------------------------
def trades_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k = F.col("o_orderkey")
    ck = F.col("c_custkey")
    tdate = F.to_date("o_orderdate")
    rdate = F.trunc(tdate, "month")
    epoch = F.unix_timestamp(F.col("o_orderdate"))
    return j.select(
        F.lit(0).cast("int").alias("amendment_number"),
        _case([(k % 61 == 0, None),
               (k % 5 == 0, "$1,001 - $15,000"),
               (k % 5 == 1, "$15,001 - $50,000"),
               (k % 5 == 2, "$50,001 - $100,000"),
               (k % 5 == 3, "$1,000,001 - $5,000,000")], "Over $50,000,000").cast("string").alias("amount"),
        _case([(ck % 3 == 0, "House"), (ck % 3 == 1, "Senate")], "Assembly").alias("chamber"),
        F.concat(F.lit("https://disclosures.invalid/"), _s(k)).alias("disclosure_url"),
        F.concat(F.lit('{"Committee '), _s(ck % 4), F.lit('": ["Subcommittee '), _s(ck % 3),
                 F.lit('"]}')).alias("committees"),
        F.col("c_name").alias("display_name"),
        _s(ck % 12).alias("district"),
        F.concat(F.lit("h"), _s(ck), F.lit(".jpg")).alias("headshot"),
        F.concat(F.lit("M"), _s(ck)).alias("member_record_id"),
        _case([(ck % 11 == 0, '["Whip"]')], "[]").alias("leadership_positions"),
        _s(F.col("o_custkey")).alias("member_id"),
        F.col("c_name").alias("member_name"),
        _case([(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), "R"),
               (F.col("c_mktsegment").isin("AUTOMOBILE", "FURNITURE"), "D")], "I").alias("party"),
        F.concat(F.lit("S"), _s(F.col("c_nationkey"))).alias("state"),
        _case([(k % 7 == 0, F.lit(None).cast("bigint"))], epoch).alias("member_updated"),
        F.concat(F.lit("https://member.invalid/"), _s(ck)).alias("website"),
        F.concat(F.lit("R"), _s(k)).alias("trade_record_id"),
        F.date_add(tdate, 2).alias("notification_date"),
        _case([(F.col("o_orderpriority") == "1-URGENT", "Self"),
               (F.col("o_orderpriority") == "2-HIGH", "Spouse"),
               (F.col("o_orderpriority") == "3-MEDIUM", "Joint")], "").alias("ownership"),
        rdate.alias("report_date"),
        F.concat(F.lit("P"), _s(ck), F.lit("-"), _s(rdate)).alias("report_id"),
        F.concat(F.lit("Security "), _s(k % 50)).alias("security_name"),
        _case([(k % 10 == 0, "")], _tk(k % 50)).alias("security_ticker"),
        _case([(k % 3 == 0, "Stock"), (k % 3 == 1, "ETF")], "").alias("security_type"),
        tdate.alias("transaction_date"),
        _s(k).alias("transaction_id"),
        _case([(k % 50 == 7, "E"), (k % 50 == 13, F.lit(None).cast("string")),
               (F.col("o_orderstatus") == "F", "P"), (F.col("o_orderstatus") == "O", "S"),
               (F.col("o_orderstatus") == "P", "S (Partial)")],
              F.lit(None).cast("string")).alias("transaction_type"),
        (epoch + k % 1000).cast("bigint").alias("record_updated"),
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").where(F.col("n_nationkey") < 20)
    return n.select(
        F.concat(F.lit("S"), _s(F.col("n_nationkey"))).alias("state_abbrev"),
        F.col("n_name").alias("state_name"),
        F.concat(F.lit("US-S"), _s(F.col("n_nationkey"))).alias("state_iso_format"),
    )


def _dec(c: Column) -> Column:
    return c.cast("decimal(20,4)")


def _prices(day_symbol: DataFrame) -> DataFrame:
    """Price rows from (d, sym) pairs: every price is a function of the pair alone."""
    d = F.col("d")
    sym = F.col("sym")
    base = _dec(_dec(sym * 10 + F.dayofyear(d) % 37) + F.lit(0.25).cast("decimal(3,2)"))
    close = _dec(base + F.lit(0.5).cast("decimal(3,2)"))
    return day_symbol.select(
        F.lit("OK").alias("status"),
        d.alias("date_recorded"),
        _tk(sym).alias("symbol"),
        base.alias("open"),
        _dec(base + F.lit(1.5).cast("decimal(3,2)")).alias("high"),
        _dec(base - F.lit(0.75).cast("decimal(3,2)")).alias("low"),
        close.alias("close"),
        (sym * 1000 + F.month(d)).cast("bigint").alias("stock_volume"),
        _case([(sym % 9 == 0, F.lit(None).cast("decimal(20,4)"))],
              _dec(close + F.lit(0.1).cast("decimal(3,2)"))).alias("after_hours"),
        _dec(base - F.lit(0.1).cast("decimal(3,2)")).alias("pre_market"),
    )


def _day_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.to_date("l_shipdate").alias("d"), (F.col("l_partkey") % 50).alias("sym"))


def market_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price row per lineitem: (date, symbol) pairs repeat, so exact duplicates arise."""
    return _prices(_day_symbol(spark, sf_dir))


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``market_raw`` without duplicates.  As prices depend on (date, symbol) only,
    DISTINCT on that narrow pair gives the same rows as DISTINCT on all ten columns."""
    return _prices(_day_symbol(spark, sf_dir).distinct())


# ---------------------------------------------------------------------------
# tickers
# ---------------------------------------------------------------------------
TICKER_HASH_COLUMNS = ["active", "base_currency_name", "base_currency_symbol", "currency_name",
                       "currency_symbol", "last_updated_utc", "locale", "market", "name", "ticker"]


def _with_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("row_hash", X.row_hash_hex(*TICKER_HASH_COLUMNS))


def tickers_staging(spark: SparkSession, sf_dir: str, with_num: bool = False) -> DataFrame:
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey")
    num = F.floor(n / 3)            # three rows a ticker; the keys grow with the table
    df = p.select(
        (F.col("p_size") % 2 == 0).alias("active"),
        _case([(F.col("p_size") % 5 == 0, F.lit(None).cast("string"))],
              "United States Dollar").alias("base_currency_name"),
        F.lit("USD").alias("base_currency_symbol"),
        F.lit("usd").alias("currency_name"),
        F.lit("$").alias("currency_symbol"),
        F.timestamp_seconds(F.lit(TICKER_EPOCH0) + F.col("p_size") * 86400 + (n % 7) * 3600)
         .cast("timestamp_ntz").alias("last_updated_utc"),
        F.lit("us").alias("locale"),
        F.lower(F.col("p_type")).alias("market"),
        F.col("p_name").alias("name"),
        _case([(n % 97 == 5, F.lit(None).cast("string"))], _tk(num)).alias("ticker"),
        num.alias("_num"),
    )
    df = _with_hash(df).withColumn("watermark_timestamp", _ts(STAGING_LOADED_AT))
    return df if with_num else df.drop("_num")


def tickers_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A previous mirror: 3/4 of the staged keys (some renamed, some with a NULL hash), plus gone keys."""
    staged = tickers_staging(spark, sf_dir, with_num=True).where(F.col("ticker").isNotNull())
    latest = latest_per_key(staged, "ticker", ["last_updated_utc"], ["row_hash"])
    num = F.col("_num")
    kept = (latest.where(num % 4 != 3)
                  .withColumn("name", _case([(num % 5 == 0, F.concat(F.col("name"), F.lit(" (old)")))],
                                            F.col("name"))))
    kept = _with_hash(kept).withColumn(
        "row_hash", _case([(num % 7 == 1, F.lit(None).cast("string"))], F.col("row_hash")))
    gone = _with_hash(latest.where(num % 15 == 0).withColumn("ticker", F.concat(F.lit("ZZ"), _s(num))))
    out = kept.unionByName(gone).withColumn("watermark_timestamp", _ts(TARGET_LOADED_AT))
    return out.select(*TICKER_HASH_COLUMNS, "row_hash", "watermark_timestamp")


# ---------------------------------------------------------------------------
# officials dimension in two versions (SCD2)
# ---------------------------------------------------------------------------
SCD_COLUMNS = ["member_id", "member_name", "party", "state", "member_updated_utc"]


def _party(seg: Column) -> Column:
    return _case([(seg.isin("BUILDING", "HOUSEHOLD"), "Republican"),
                  (seg.isin("AUTOMOBILE", "FURNITURE"), "Democrat")], "UNKNOWN")


def officials_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 10 != 9)
    return c.select(_s(F.col("c_custkey")).alias("member_id"), F.col("c_name").alias("member_name"),
                    _party(F.col("c_mktsegment")).alias("party"),
                    F.concat(F.lit("S"), _s(F.col("c_nationkey"))).alias("state"),
                    _ts("2024-01-01 00:00:00").alias("member_updated_utc"))


def officials_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 13 != 0)
    ck = F.col("c_custkey")
    return c.select(
        _s(ck).alias("member_id"),
        _case([(ck % 4 == 0, F.concat(F.col("c_name"), F.lit(" Jr.")))], F.col("c_name")).alias("member_name"),
        _case([(ck % 17 == 5, F.lit("Independent"))], _party(F.col("c_mktsegment"))).alias("party"),
        F.concat(F.lit("S"), _s(F.col("c_nationkey"))).alias("state"),
        _case([(ck % 4 == 0, _ts("2024-02-01 00:00:00")), (ck % 17 == 5, _ts("2023-12-01 00:00:00"))],
              _ts("2024-01-01 00:00:00")).alias("member_updated_utc"),
    )


def officials_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension before the run: closed history for every 6th member, open rows of v1."""
    c = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 6 == 0)
    ck = F.col("c_custkey")
    hist_src = c.select(_s(ck).alias("member_id"),
                        F.concat(F.col("c_name"), F.lit(" Sr.")).alias("member_name"),
                        _party(F.col("c_mktsegment")).alias("party"),
                        F.concat(F.lit("S"), _s(F.col("c_nationkey"))).alias("state"),
                        _ts("2023-06-01 00:00:00").alias("member_updated_utc"),
                        _case([(ck % 10 == 9, _ts("2023-09-01 00:00:00"))],
                              _ts("2024-01-01 00:00:00")).alias("_closed_at"))
    hist = (scd2.initial(hist_src, "member_id", "member_updated_utc")
            .withColumn(scd2.VALID_TO, F.col("_closed_at")).drop("_closed_at"))
    open_v1 = scd2.initial(officials_v1(spark, sf_dir), "member_id", "member_updated_utc")
    return reduce(DataFrame.unionByName, [hist, open_v1])


# ---------------------------------------------------------------------------
# feeds shaped like the landed JSON (for the end-to-end pipeline benchmark)
# ---------------------------------------------------------------------------
def trades_feed(spark: SparkSession, sf_dir: str, json_objects: bool = True) -> DataFrame:
    """``trades_raw`` nested back into the trades feed layout (filer_info, security).

    ``json_objects`` turns the two schemaless fields into a map / array (so a
    JSON writer emits objects); otherwise they stay the JSON text a reader
    with the declared schema would give.
    """
    r = trades_raw(spark, sf_dir)
    committees = (F.from_json("committees", "map<string,array<string>>") if json_objects
                  else F.col("committees"))
    positions = (F.from_json("leadership_positions", "array<string>") if json_objects
                 else F.col("leadership_positions"))
    filer = F.struct(
        committees.alias("committees"),
        F.col("display_name"), F.col("district"), F.col("headshot"),
        F.col("member_record_id").alias("id"),
        positions.alias("leadership_positions"),
        F.col("member_id"), F.col("member_name"), F.col("party"), F.col("state"),
        F.col("member_updated").alias("updated"), F.col("website"))
    security = F.struct(F.col("security_name").alias("name"), F.col("security_ticker").alias("ticker"),
                        F.col("security_type").alias("type"))
    return r.select(
        "amendment_number", "amount", "chamber", "disclosure_url", filer.alias("filer_info"),
        F.col("trade_record_id").alias("id"), "notification_date", "ownership", "report_date",
        "report_id", security.alias("security"), "transaction_date", "transaction_id",
        "transaction_type", F.col("record_updated").alias("updated"))


def market_feed(spark: SparkSession, sf_dir: str, as_of) -> DataFrame:
    """Prices in the feed layout as a warehouse holds them at ``as_of``.

    Rows older than the dedup window were collapsed by earlier daily runs
    (each day's prices are deduplicated while recent); rows inside the window
    keep their exact duplicates for the run to collapse.
    """
    raw = market_raw(spark, sf_dir)
    recent = F.col("date_recorded") >= F.date_sub(F.lit(as_of).cast("date"), X.DEDUP_WINDOW_DAYS)
    m = raw.where(~recent).dropDuplicates().unionByName(raw.where(recent))
    return m.select("status", F.col("date_recorded").alias("from"), "symbol", "open", "high", "low",
                    "close", F.col("stock_volume").cast("double").alias("volume"),
                    F.col("after_hours").alias("afterHours"), F.col("pre_market").alias("preMarket"))


def tickers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tickers_staging(spark, sf_dir)
    return t.select(*[F.date_format("last_updated_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(c)
                      if c == "last_updated_utc" else F.col(c) for c in TICKER_HASH_COLUMNS])
