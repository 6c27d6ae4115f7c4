"""Registered queries: every operator of the warehouse run over the driver's test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
whole test tables through ``proxies`` and the library's real operators.
``edge`` casts the result to the oracle's plain types at the very end
(DECIMAL -> double, TIMESTAMP -> timestamp without zone, small ints ->
bigint), after all the work is done.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..operators import keyed, merge, quality, scd2
from . import models as M
from . import proxies as P
from .backfill import backfill_officials


def edge(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.BinaryType):
            c = F.lower(F.hex(c))
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------------------
# shared derivations
# ---------------------------------------------------------------------------
def _src(spark, d):
    return M.src_trades(P.trades_raw(spark, d))


def _src_mkt(spark, d, raw: bool = False):
    return M.src_market(P.market_raw(spark, d) if raw else P.market(spark, d))


def _outside(df: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """All rows but those reported from ``start`` to ``end``: what the table holds before the merge."""
    inside = F.col("report_date").between(F.lit(start).cast("date"), F.lit(end or start).cast("date"))
    return df.where(~F.coalesce(inside, F.lit(False)))


def _audit_frames(spark, d) -> dict[str, DataFrame]:
    src = _src(spark, d)
    return {
        "int_gov_official_trades_audit": M.official_trades(src, P.RUN_DATE),
        "int_gov_officials_audit": M.officials(src, P.states(spark, d), P.RUN_DATE),
        "int_market_audit": M.market(_src_mkt(spark, d), src, P.RUN_DATE),
    }


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------
def src_trades(spark, d):
    return _src(spark, d)


def market_extract(spark, d):
    """Price records as landed JSON (half with the lower-case extended-hours spelling),
    parsed once into the feed's types and extracted into ``market_close_by_day``."""
    from ..sources.landing import parse_market
    m = P.market_raw(spark, d)
    record = F.to_json(F.struct(
        "status", F.col("date_recorded").alias("from"), "symbol", "open", "high", "low", "close",
        F.col("stock_volume").cast("double").alias("volume"),
        F.col("after_hours").alias("afterHours"), F.col("pre_market").alias("preMarket")))
    lower = F.replace(F.replace(record, F.lit('"afterHours"'), F.lit('"afterhours"')),
                      F.lit('"preMarket"'), F.lit('"premarket"'))
    text = F.when(F.col("stock_volume") % 2 == 0, record).otherwise(lower)
    return parse_market(m.select(text.alias("record")), "record")


def trades_extract(spark, d):
    """The feed's nested records (filer_info.*, security.*) flattened to the 28-column table."""
    from ..sources.landing import extract_trades
    return extract_trades(P.trades_feed(spark, d, json_objects=False))


def src_market(spark, d):
    return _src_mkt(spark, d, raw=True)


def src_tickers(spark, d):
    return M.src_tickers(P.tickers_target(spark, d))


def trades_normalised(spark, d):
    return M.official_trades(_src(spark, d))


def amount_bucket_parse(spark, d):
    buckets = P.trades_raw(spark, d).groupBy("amount").agg(F.count(F.lit(1)).alias("n_trades"))
    lo, hi = X.dollar_bound("amount", 1), X.dollar_bound("amount", 2)
    return buckets.select("amount", "n_trades", lo.alias("minimum_value"),
                          hi.alias("maximum_value"), X.range_midpoint(lo, hi).alias("median_value"))


def trades_audit_slice(spark, d):
    return M.official_trades(_src(spark, d), P.RUN_DATE)


def latest_per_key(spark, d):
    rows = _src(spark, d).select("member_id", "member_updated", "transaction_id")
    return keyed.latest_per_key(rows, "member_id", ["member_updated"], ["transaction_id"])


def officials_current(spark, d):
    return M.officials(_src(spark, d), P.states(spark, d))


def officials_audit_slice(spark, d):
    return M.officials(_src(spark, d), P.states(spark, d), P.RUN_DATE)


def market_for_traded(spark, d):
    return M.market(_src_mkt(spark, d), _src(spark, d))


def market_audit_slice(spark, d):
    return M.market(_src_mkt(spark, d), _src(spark, d), P.RUN_DATE)


def price_worklist(spark, d):
    return M.price_worklist(P.trades_raw(spark, d), P.RUN_DATE)


def fact_trades(spark, d):
    src = _src(spark, d)
    return M.fact_trades(M.officials(src, P.states(spark, d)), M.official_trades(src),
                         M.market(_src_mkt(spark, d), src))


def ticker_row_hash(spark, d):
    return P.tickers_staging(spark, d).select("ticker", "last_updated_utc", "row_hash")


def mirror_sync(spark, d):
    return merge.mirror_sync(P.tickers_target(spark, d), P.tickers_staging(spark, d), "ticker",
                             "row_hash", "last_updated_utc", tiebreak=["row_hash"])


def mirror_deleted_keys(spark, d):
    return merge.mirror_deleted_keys(P.tickers_target(spark, d), P.tickers_staging(spark, d), "ticker")


def upsert_trades(spark, d):
    src = _src(spark, d)
    stale = (M.official_trades(src, P.RUN_DATE)
             .withColumn("security_name", F.lit("stale"))
             .withColumn("ownership", F.lit(None).cast("string")))
    target = M.official_trades(_outside(src, P.RUN_DATE)).unionByName(stale)
    return merge.upsert(target, M.official_trades(src, P.RUN_DATE), "transaction_id")


def upsert_officials(spark, d):
    src, st = _src(spark, d), P.states(spark, d)
    return merge.upsert(M.officials(_outside(src, P.RUN_DATE), st),
                        M.officials(src, st, P.RUN_DATE), "member_id")


def upsert_market(spark, d):
    src, mkt = _src(spark, d), _src_mkt(spark, d)
    return merge.upsert(M.market(mkt, _outside(src, P.RUN_DATE)), M.market(mkt, src, P.RUN_DATE),
                        ["date_recorded", "ticker"])


def dup_rows_report(spark, d):
    return keyed.duplicate_report(P.market_raw(spark, d), "date_recorded", P.DEDUP_AS_OF)


def collapse_duplicates(spark, d):
    return keyed.collapse_duplicates(P.market_raw(spark, d), "date_recorded", P.DEDUP_AS_OF)


def backfill_officials_q(spark, d):
    src, st = _src(spark, d), P.states(spark, d)
    published = M.officials(_outside(src, P.BACKFILL_START, P.BACKFILL_END), st)
    return backfill_officials(published, src, st, P.BACKFILL_START, P.BACKFILL_END)


def _scd_next(spark, d):
    return scd2.apply(P.officials_snapshot(spark, d), P.officials_v2(spark, d), "member_id",
                      "member_updated_utc", P.SCD_RUN_TS)


def scd2_apply(spark, d):
    return _scd_next(spark, d)


def scd2_hard_deletes(spark, d):
    return scd2.hard_deleted(P.officials_snapshot(spark, d), P.officials_v2(spark, d), "member_id")


def scd2_current(spark, d):
    return scd2.current(_scd_next(spark, d))


def scd2_tickers(spark, d):
    """Ticker dimension: the previous mirror as the snapshot, advanced by the synced mirror."""
    cols = M.TICKER_COLUMNS + ["watermark_timestamp"]
    target = P.tickers_target(spark, d)
    synced = merge.mirror_sync(target, P.tickers_staging(spark, d), "ticker", "row_hash",
                               "last_updated_utc", tiebreak=["row_hash"])
    snapshot = scd2.initial(M.src_tickers(target).select(*cols), "ticker", "last_updated_utc")
    return scd2.apply(snapshot, M.src_tickers(synced).select(*cols), "ticker", "last_updated_utc",
                      P.SCD_RUN_TS)


TRADES_AUDIT = "int_gov_official_trades_audit"


def check_not_null(spark, d):
    f = _audit_frames(spark, d)
    return quality.check_not_null(f[TRADES_AUDIT], TRADES_AUDIT, M.AUDIT_TESTS[0].not_null)


def check_unique(spark, d):
    f = _audit_frames(spark, d)
    return reduce(DataFrame.unionByName, [
        quality.check_unique(f[TRADES_AUDIT], TRADES_AUDIT, "trade_record_id"),
        quality.check_unique(f[TRADES_AUDIT], TRADES_AUDIT, "transaction_id"),
        quality.check_unique(f["int_gov_officials_audit"], "int_gov_officials_audit", "member_id"),
    ])


def check_unique_combo(spark, d):
    # run on prices before the duplicate collapse, so the check has something to find
    audit = M.market(_src_mkt(spark, d, raw=True), _src(spark, d), P.RUN_DATE)
    return quality.check_unique_combo(audit, "int_market_audit", ["date_recorded", "ticker"])


def check_relationships(spark, d):
    f = _audit_frames(spark, d)
    return quality.check_relationships(f[TRADES_AUDIT], f["int_gov_officials_audit"], TRADES_AUDIT,
                                       "member_id", "member_id")


def dq_report(spark, d):
    return quality.run_tests(_audit_frames(spark, d), M.AUDIT_TESTS)


def check_fact(spark, d):
    """The fact's declared tests (19 not_null, unique transaction_id) over the whole fact."""
    return quality.run_tests({"fct_government_official_trades": fact_trades(spark, d)}, M.FACT_TESTS)


def source_freshness(spark, d):
    return quality.source_freshness({
        "events": (P.table(spark, d, "events"), "ts"),
        "orders": (P.table(spark, d, "orders"), "o_orderdate"),
        "lineitem": (P.table(spark, d, "lineitem"), "l_shipdate"),
    }, P.FRESHNESS_AS_OF)


def json_path_extract(spark, d):
    from ..sources.landing import extract_paths
    ev = P.table(spark, d, "events")
    return extract_paths(ev.select(F.parse_json("props").alias("r"), "event_id", "event_type", "value"),
                         [("k", "$.k", "bigint")], keep=["event_id", "event_type", "value"])


def epoch_to_ts(spark, d):
    ev = P.table(spark, d, "events").select("event_id", F.unix_timestamp("ts").alias("epoch_s"))
    return ev.select("event_id", "epoch_s", X.epoch_to_ts("epoch_s").alias("ts_utc"))


def closest_monday(spark, d):
    ev = P.table(spark, d, "events")
    return ev.select("event_id", F.to_date("ts").alias("event_date"),
                     X.closest_past_monday("ts").alias("monday"))


def load_error_ratio(spark, d):
    from ..sources.landing import error_ratio
    docs = P.table(spark, d, "documents")
    bad = (F.col("text").isNull() | F.col("n_chars").isNull()
           | (F.col("n_chars") != F.length("text")) | (F.length("text") < 50))
    return error_ratio(docs.withColumnRenamed("source", "file_name"), "file_name", bad,
                       P.LOAD_ERROR_MAX_RATIO)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "src_trades": src_trades,
    "trades_extract": trades_extract,
    "market_extract": market_extract,
    "src_market": src_market,
    "src_tickers": src_tickers,
    "trades_normalised": trades_normalised,
    "amount_bucket_parse": amount_bucket_parse,
    "trades_audit_slice": trades_audit_slice,
    "latest_per_key": latest_per_key,
    "officials_current": officials_current,
    "officials_audit_slice": officials_audit_slice,
    "market_for_traded": market_for_traded,
    "market_audit_slice": market_audit_slice,
    "price_worklist": price_worklist,
    "fact_trades": fact_trades,
    "ticker_row_hash": ticker_row_hash,
    "mirror_sync": mirror_sync,
    "mirror_deleted_keys": mirror_deleted_keys,
    "upsert_trades": upsert_trades,
    "upsert_officials": upsert_officials,
    "upsert_market": upsert_market,
    "dup_rows_report": dup_rows_report,
    "collapse_duplicates": collapse_duplicates,
    "backfill_officials": backfill_officials_q,
    "scd2_apply": scd2_apply,
    "scd2_hard_deletes": scd2_hard_deletes,
    "scd2_current": scd2_current,
    "scd2_tickers": scd2_tickers,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_unique_combo": check_unique_combo,
    "check_relationships": check_relationships,
    "dq_report": dq_report,
    "check_fact": check_fact,
    "source_freshness": source_freshness,
    "json_path_extract": json_path_extract,
    "epoch_to_ts": epoch_to_ts,
    "closest_monday": closest_monday,
    "load_error_ratio": load_error_ratio,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries wrapped so their output carries the oracle's plain types."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the warehouse is defined in UTC: epoch <-> timestamp conversions of
            # zone-less test timestamps must not depend on the caller's session.
            # The zone is bound into the plan when it is analysed, so the caller's
            # setting is restored right after.
            key = "spark.sql.session.timeZone"
            previous = spark.conf.get(key)
            spark.conf.set(key, "UTC")
            try:
                return edge(fn(spark, sf_dir))
            finally:
                spark.conf.set(key, previous)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {name: wrap(fn) for name, fn in QUERIES.items()}
