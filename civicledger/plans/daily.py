"""The daily run and the backfill run over a warehouse root.

    load (exactly once) -> availability gate -> ticker mirror -> price dedup
      -> audit slices -> tests -> publish (merge) -> tests -> SCD2 snapshot -> fact

Every step writes its result to shared storage before the next reads it,
so lineage is cut at each step.  Small tables (officials, tickers, audit
slices, SCD2 dimensions) are replaced as whole versions that publish
atomically; the large facts (trades, prices) replace only the date
partitions a run touches.  Re-running a day is idempotent: the loads add
nothing and the merges replace rows with themselves.  Only small reports
(one row per check), batch ids and lists of touched dates reach the driver.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import keyed, merge, quality, scd2
from ..sources import landing, ledger, schemas, seeds
from ..sources.colocated import Colocated
from ..sources.keyindex import KeyIndex
from ..sources.store import HIVE_NULL_PARTITION, Catalog, PartitionedTable, PublishConflict, Snapshots
from . import backfill as BF
from . import models as M

OFFICIAL_SCD_COLUMNS = ["member_id", "chamber", "member_name", "party", "state", "district",
                        "committees", "leadership_positions", "member_updated_utc"]
TICKER_SCD_COLUMNS = M.TICKER_COLUMNS + ["watermark_timestamp"]


# SCD2 dimensions: open rows in the NULL partition, rows closed by a run in that run's day
CLOSED_IN_RUN = "dbt_closed_in_run"

# large tables changed partition by partition
TRADES, PRICE_LOADS = "source/government_trades", "raw/market_close"
PARTITIONED = {TRADES: ("report_date", ["transaction_id"]),
               PRICE_LOADS: ("date_recorded", ["symbol"]),
               "int_gov_official_trades": ("report_date", ["transaction_id"]),
               "int_market": ("date_recorded", ["ticker"]),
               "market_close_by_day": ("date_recorded", ["symbol"]),
               "dim_scd_gov_officials": (CLOSED_IN_RUN, ["member_id"]),
               "scd_tickers": (CLOSED_IN_RUN, ["ticker"])}


# the ticker files that the mirror was last built from
TICKER_FILES = "ledger_stock_tickers"


def default_run_date(today: dt.date | None = None) -> dt.date:
    """Yesterday (UTC, like every time of the run), when no run date is supplied."""
    return (today or dt.datetime.now(dt.timezone.utc).date()) - dt.timedelta(days=1)


@dataclass
class RunResult:
    run_date: str
    status: str                      # "published" | "skipped"
    steps: dict = field(default_factory=dict)


class Warehouse:
    """Table locations of one warehouse: landed feeds in, versioned tables out."""

    def __init__(self, spark: SparkSession, root: str, landing_root: str, layout: str = "array",
                 name_globs: bool = True, on_error: str = "abort"):
        """``layout``: landed files are JSON arrays (the feeds' format), JSON lines or pages of the API;
        ``name_globs``: select files by the feed name patterns (off for Spark-written
        part files, whose folder already names the feed); ``on_error``: ``abort`` a load at a bad
        value, or ``skip_file``: keep files with too many bad records out and load the rest."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.landing = landing_root.rstrip("/")
        self.layout = layout
        self.globs = name_globs
        self.on_error = on_error
        self.catalog = Catalog(spark, self.root, partitioned=PARTITIONED)

    # loaded files: rows carry the file that brought them
    @property
    def trades_path(self) -> str:
        return f"{self.root}/{TRADES}"

    @property
    def market_loads_path(self) -> str:
        return f"{self.root}/{PRICE_LOADS}"

    def _exists(self, path: str) -> bool:
        from ..sources.store import _FS
        return _FS(self.spark, path).exists(path)

    def trades_source(self, dates=None) -> DataFrame:
        """The loaded trades, or only those of the report dates ``dates`` (no other folder is listed)."""
        t = self.catalog.table(TRADES)
        return (t.read() if dates is None else t.read_partitions(dates)).drop(ledger.FILE)

    def prices(self, dates=None) -> DataFrame:
        """The price source (all of it, or only ``dates``); empty before the first load."""
        t = self.catalog.table("market_close_by_day")
        if dates is not None:
            return t.read_partitions(dates, schema=schemas.MARKET_SOURCE)
        return t.read() if t.exists() else self.spark.createDataFrame([], schemas.MARKET_SOURCE)

    def states(self) -> DataFrame:
        t = self.catalog.table("states")
        if not t.exists():
            seeds.load_seed(self.spark, t)
        return t.read()


def _empty(spark: SparkSession, like: DataFrame) -> DataFrame:
    return spark.createDataFrame([], like.schema)


# ---------------------------------------------------------------------------
# steps
# ---------------------------------------------------------------------------
def _load(wh: Warehouse, feed: str, table: str, schema: T.StructType, extract, name_glob: str,
          reader: SparkSession | None = None) -> ledger.Loaded | None:
    """New and corrected files of a feed into its table; None if the feed has no folder."""
    path = f"{wh.landing}/{feed}"
    if not wh._exists(path):
        return None
    name_glob = name_glob if wh.globs else None
    landing.require_matching_files(wh.spark, path, name_glob)
    return ledger.load_files(wh.spark, path, wh.catalog.table(table), schema,
                             lambda raw: extract(raw, keep=[ledger.FILE]), name_glob, wh.layout, wh.on_error, reader=reader)


def load_trades(wh: Warehouse) -> list[int]:
    """The table's new state, or nothing if every landed file was loaded as it is."""
    done = _load(wh, "government_trades", TRADES, schemas.GOVERNMENT_TRADES, landing.extract_trades, landing.TRADES_GLOB)
    return [] if done is None or done.state is None else [done.state]


def quarantine(wh: Warehouse) -> DataFrame:
    """Files that the error policy kept out of the trades and prices."""
    parts = [ledger.quarantined(wh.spark, wh.catalog.table(t)).withColumn("table_name", F.lit(t)) for t in (TRADES, PRICE_LOADS)]
    return parts[0].unionByName(parts[1])


def landed_on() -> Column:
    """The run date in a landed file's name or folder; without one, the day of its modification."""
    name = F.regexp_extract("file", r"(\d{4}-\d{2}-\d{2})[^/]*(?:/[^/]*)?$", 1)
    return F.coalesce(F.try_to_date(F.nullif(name, F.lit("")), "yyyy-MM-dd"), F.to_date("modified"))


def sync_tickers(wh: Warehouse, as_of, refuse_empty: bool = False,
                 retention_days: int | None = None, until=None) -> int | None:
    """Truncate-and-load staging from every landed ticker file, then mirror it into the source.

    Expiring landed files is the storage's lifecycle rule, not the reader's; a
    caller may still leave out files older than ``retention_days`` (by
    modification time).  As in the source warehouse, an empty staging empties
    the mirror; ``refuse_empty=True`` refuses to publish an empty staging or
    mirror instead (the daily run's setting).  ``until`` leaves out files of later
    run dates, which gives the mirror as of that date.
    """
    path = f"{wh.landing}/stock_tickers"
    if not wh._exists(path):
        return None
    landing.require_matching_files(wh.spark, path, landing.TICKERS_GLOB if wh.globs else None)
    modified_after = None
    if retention_days is not None:
        cutoff = dt.datetime.fromisoformat(str(as_of)) - dt.timedelta(days=retention_days)
        modified_after = cutoff.strftime("%Y-%m-%dT%H:%M:%S")
    files = ledger.listing(wh.spark, path, landing.TICKERS_GLOB if wh.globs else None)
    if modified_after:
        files = files.where(F.col("modified") > F.lit(modified_after).cast("timestamp"))
    if until is not None:
        files = files.where(landed_on() <= F.lit(str(until)).cast("date"))
    paths = [r[0] for r in files.select("path").collect()]      # the reader needs them
    raw = (ledger.read_records(wh.spark, paths, text_schema(schemas.TICKERS), wh.layout, "FAILFAST") if paths
           else wh.spark.createDataFrame([], text_schema(schemas.TICKERS)))
    staged = landing.extract_tickers(raw, as_of)
    staging = wh.catalog.table("staging_stock_tickers")
    staging.write(staged, refuse_empty=refuse_empty)
    staged = staging.read()
    wh.catalog.table(TICKER_FILES).write(files.drop("path"))
    target_t = wh.catalog.table("stock_tickers")
    target = target_t.read() if target_t.exists() else _empty(wh.spark, staged)
    nxt = merge.mirror_sync(target, staged, "ticker", "row_hash", "last_updated_utc",
                            tiebreak=["row_hash"])
    return target_t.write(nxt, refuse_empty=refuse_empty)


def text_schema(schema):
    """Ticker feed schema with ``last_updated_utc`` kept as text (hashed as landed)."""
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, T.StringType() if f.name == "last_updated_utc"
                                       else f.dataType, True) for f in schema.fields])


MERGED_THROUGH = "merged_through"          # property of the price table: the last state of the loads in it
ANY_AGE = 1_000_000                        # days


def load_and_dedup_market(wh: Warehouse, as_of) -> list | None:
    """Load new price files, then collapse recent exact duplicates; return the dates rewritten.

    Only the dates whose loaded rows changed are read and rewritten: every
    earlier run already collapsed the dates it touched, so no other recent
    date can hold a duplicate.  This equals re-scanning the whole 70-day
    window each day, at the cost of the new data only.  A date that lost rows
    (a corrected file) is made anew from all its loaded rows, each row once.

    Recovery: the table remembers the state of the loads that was merged into it,
    published in the same step as the rows.  A run merges what the loads changed
    since that state, so prices loaded by a run that died before this step are
    merged by the next, and nothing is merged twice.
    """
    _load(wh, "market_close", PRICE_LOADS, schemas.MARKET_CLOSE, landing.extract_market_rows, landing.MARKET_GLOB,
          landing.case_sensitive(wh.spark))
    loads = wh.catalog.table(PRICE_LOADS)
    now = loads.current_version()
    t = wh.catalog.table("market_close_by_day")
    since = t.properties().get(MERGED_THROUGH)
    if now is None or since == now:
        return None
    as_of_date = F.lit(as_of).cast("date") if as_of is not None else F.current_date()
    collapsed = lambda rows, **how: keyed.collapse_duplicates(rows, "date_recorded", as_of_date, **how)
    columns, done = schemas.MARKET_SOURCE.fieldNames(), {MERGED_THROUGH: now}
    change = loads.changed_partitions(since) if t.exists() else None
    if change is None:
        t.current_state()
        t.write(collapsed(loads.read().select(*columns)), properties=done, pack=True)
        return ["all"]
    added, rewritten = change
    touched = [*added, *rewritten]
    current = t.read_partitions(touched, schema=schemas.MARKET_SOURCE)
    if not touched:
        t.annotate(done)
        return None
    parts = []
    if added:
        new_rows = loads.read_folders(added, loads.schema()).select(*columns)
        parts.append(collapsed(t.read_partitions(list(added)).select(*columns).unionByName(new_rows)))
    if rewritten:
        parts.append(collapsed(loads.read_partitions(rewritten).select(*columns), days=ANY_AGE))
    t.replace_partitions(reduce(DataFrame.unionByName, parts).select(*current.columns), touched, properties=done)
    return touched


def build_audit(wh: Warehouse, run_date) -> dict[str, DataFrame]:
    src = M.src_trades(wh.trades_source([run_date]))
    # prices are needed only on the trade dates reported today: read just those
    # date partitions (a few) instead of listing the whole price history
    trade_dates = [r[0] for r in M.report_slice(src, run_date).select("transaction_date")
                   .distinct().collect()]
    mkt = M.src_market(wh.prices(trade_dates))
    frames = {
        "int_gov_official_trades_audit": M.official_trades(src, run_date),
        "int_gov_officials_audit": M.officials(src, wh.states(), run_date),
        "int_market_audit": M.market(mkt, src, run_date),
    }
    out = {}
    for name, df in frames.items():          # audit tables are rebuilt in full each run
        t = wh.catalog.table(name)
        t.write(df)
        out[name] = t.read()
    return out


def publish(wh: Warehouse, audit: dict[str, DataFrame]) -> dict[str, int]:
    """Merge each audited slice into its published model (full build the first time)."""
    specs = [
        ("int_gov_official_trades", "int_gov_official_trades_audit", ["transaction_id"],
         lambda: M.official_trades(M.src_trades(wh.trades_source()))),
        ("int_gov_officials", "int_gov_officials_audit", ["member_id"],
         lambda: M.officials(M.src_trades(wh.trades_source()), wh.states())),
        ("int_market", "int_market_audit", ["date_recorded", "ticker"],
         lambda: M.market(M.src_market(wh.prices()), M.src_trades(wh.trades_source()))),
    ]
    versions = {}
    for name, audit_name, keys, full_build in specs:
        started = time.perf_counter()
        t = wh.catalog.table(name)
        if t.exists():
            source = audit[audit_name]
            merge.assert_unique_keys(source, keys, f"{audit_name} -> {name}")
            if name in PARTITIONED:
                versions[name] = merge.upsert_partitions(t, source, keys)
                versions[f"{name}_seconds"] = round(time.perf_counter() - started, 3)
                continue
            nxt = merge.upsert(t.read(), source, keys)
            versions[name] = t.write(nxt)
        else:
            how = {"pack": True} if name in PARTITIONED else {}
            versions[name] = t.write(full_build(), validate=lambda written, keys=keys, name=name:
                                     merge.assert_unique_keys(written, keys, f"first build of {name}"), **how)
        versions[f"{name}_seconds"] = round(time.perf_counter() - started, 3)
    return versions


def _snapshot(wh: Warehouse, name: str, src: DataFrame, key: str, updated_at: str, run_ts) -> list:
    """Advance an SCD2 dimension by one run, touching only open rows and today's closings.

    Layout: open rows live in the partition ``dbt_closed_in_run = NULL``; rows a
    run closes go to the partition of that run's day and are never rewritten
    by later runs.  A run reads the open partition (plus today's, if the day
    is re-run), applies the change, and publishes both partitions in one step --
    its cost follows the current dimension, not the history.  A run that dies
    before that step changed nothing; one repeated after it, at whatever time,
    finds the rows it closed no longer open.
    """
    t = dimension_table(wh, name, key)
    if not t.exists():
        t.write(scd2.initial(src, key, updated_at)
                .withColumn(CLOSED_IN_RUN, F.lit(None).cast("date")))
        return [None]
    run_day = dt.date.fromisoformat(str(run_ts)[:10])
    open_rows = t.read_partitions([None]).drop(CLOSED_IN_RUN)
    closed_today = t.read_partitions([run_day]).drop(CLOSED_IN_RUN)
    step = scd2.apply(open_rows, src, key, updated_at, run_ts)
    nxt = step.withColumn(CLOSED_IN_RUN, F.when(F.col(scd2.VALID_TO).isNotNull(), F.lit(run_day))).unionByName(
        closed_today.withColumn(CLOSED_IN_RUN, F.lit(run_day)))
    t.replace_partitions(nxt, [run_day, None])
    return [run_day, None]


def snapshot_officials(wh: Warehouse, run_ts) -> list:
    src = wh.catalog.read("int_gov_officials").select(*OFFICIAL_SCD_COLUMNS)
    return _snapshot(wh, "dim_scd_gov_officials", src, "member_id", "member_updated_utc", run_ts)


def snapshot_tickers(wh: Warehouse, run_ts) -> list | None:
    if not wh.catalog.exists("stock_tickers"):
        return None
    src = M.src_tickers(wh.catalog.read("stock_tickers")).select(*TICKER_SCD_COLUMNS)
    return _snapshot(wh, "scd_tickers", src, "ticker", "last_updated_utc", run_ts)


def dimension_table(wh: Warehouse, name: str, key: str | None = None) -> PartitionedTable:
    """The storage of an SCD2 dimension (the two known ones, or any other name)."""
    t = wh.catalog.table(name)
    if isinstance(t, PartitionedTable):
        return t
    return PartitionedTable(wh.spark, f"{wh.root}/{name}", CLOSED_IN_RUN, [key] if key else [])


def dimension(wh: Warehouse, name: str) -> DataFrame:
    """An SCD2 dimension with its published columns (the storage partition column dropped)."""
    return dimension_table(wh, name).read().drop(CLOSED_IN_RUN)


def source_freshness(wh: Warehouse, as_of) -> DataFrame:
    """Freshness of the three source tables from their ledgers: when the newest file in each was landed.

    A run that finds no new file does not make a table fresh.  Reads the ledgers
    only (a row a file), so it costs the same at any table size.
    """
    tables = {"government_trades": (ledger.newest_file(wh.spark, wh.catalog.table(TRADES)), "loaded_at"),
              "market_close_by_day": (ledger.newest_file(wh.spark, wh.catalog.table(PRICE_LOADS)), "loaded_at")}
    files = wh.catalog.table(TICKER_FILES)
    listed = files.read() if files.exists() else wh.spark.createDataFrame([], "modified timestamp")
    tables["stock_tickers"] = (listed.select(F.col("modified").cast("timestamp_ntz").alias("loaded_at")), "loaded_at")
    return quality.source_freshness(tables, as_of)


PUBLISHED = ("int_gov_officials", "int_gov_official_trades", "int_market")


def record_state(wh: Warehouse) -> dict[str, int]:
    """Note the published models' present states as belonging together; readers of the fact see these."""
    state = {n: wh.catalog.table(n).current_version() for n in PUBLISHED if wh.catalog.exists(n)}
    Snapshots(wh.spark, wh.root).record(state)
    return state


def colocated(wh: Warehouse) -> Colocated:
    """Published trades and prices in buckets of (day, ticker), the key that the fact joins them on."""
    keys = {"int_gov_official_trades": ["transaction_date", "security_ticker"], "int_market": ["date_recorded", "ticker"]}
    return Colocated(wh.spark, f"{wh.root}/_colocated", {n: wh.catalog.table(n) for n in keys}, keys)


def colocate(wh: Warehouse) -> int | None:
    """Bring the co-bucketed layout to the recorded state; None if it stands for that or another run is at it."""
    try:
        return colocated(wh).refresh(Snapshots(wh.spark, wh.root).current())
    except PublishConflict:
        return None


def published_models(wh: Warehouse) -> dict[str, DataFrame]:
    """The published models that exist, in one common state; trades and prices in buckets where these are laid out for it."""
    state = Snapshots(wh.spark, wh.root).current()
    frames = {n: wh.catalog.table(n).read(state.get(n)) for n in PUBLISHED if wh.catalog.exists(n)}
    layout = colocated(wh)
    return frames | ((layout.read(state) or {}) if layout.exists() else {})


def fact(wh: Warehouse) -> DataFrame:
    """The published fact, as a view over the published models (as in the source warehouse).

    The three models are read in the states that one run left, also while another run publishes.
    Materialising it (``run_daily(materialize_fact=True)``) rewrites the whole
    fact each day; as a view, readers pay the two joins instead. With the co-bucketed layout
    (``colocate``) the join of trades and prices shuffles neither, and the officials are broadcast
    where the planner finds them small.
    """
    frames = published_models(wh)
    return M.fact_trades(*(frames[n] for n in PUBLISHED))


def register_views(wh: Warehouse) -> list[str]:
    """Temporary views of the session over one common state: the published models, the fact and the dimensions.

    Plain SQL over them stays on that state until this is called again.
    """
    frames = published_models(wh)
    if len(frames) == len(PUBLISHED):
        frames["fct_government_official_trades"] = M.fact_trades(*(frames[n] for n in PUBLISHED))
    for n in ("dim_scd_gov_officials", "scd_tickers"):
        if wh.catalog.exists(n):
            frames[n] = dimension(wh, n)
    if wh.catalog.exists("stock_tickers"):
        frames["stock_tickers"] = wh.catalog.read("stock_tickers")
    for n, df in frames.items():
        df.createOrReplaceTempView(n)
    return list(frames)


# ---------------------------------------------------------------------------
# runs
# ---------------------------------------------------------------------------
def _check(report: DataFrame, severity: str) -> list[dict]:
    """``error``: raise on any failure (the warehouse's setting); ``warn``: record and go on."""
    if severity == "error":
        return quality.gate(report)
    if severity != "warn":
        raise ValueError("severity must be 'error' or 'warn'")
    return [r.asDict() for r in report.where("failures > 0").collect()]


def post_publish_report(wh: Warehouse, audit: dict[str, DataFrame], mode: str = "incremental") -> DataFrame:
    """The published models' tests after the merge.

    ``full`` tests the whole published tables, as the source project does.
    ``incremental`` gives the same verdict at the cost of the day's slice:
    not_null holds for the untouched rows since the last run and for the
    merged rows by the audit; uniqueness can only break for the slice's own
    values, which are looked up in the table (``check_unique_against``).  The
    small officials table is always tested in full.
    """
    trades = wh.catalog.read("int_gov_official_trades")
    officials = wh.catalog.read("int_gov_officials")
    if mode == "full":
        return quality.run_tests({"int_gov_official_trades": trades, "int_gov_officials": officials},
                                 M.PUBLISHED_TESTS)
    if mode != "incremental":
        raise ValueError("mode must be 'full' or 'incremental'")
    name = "int_gov_official_trades"
    spec = next(t for t in M.PUBLISHED_TESTS if t.model == name)
    today = audit["int_gov_official_trades_audit"]
    parts = [quality.check_not_null(today, name, spec.not_null)]
    parts += [quality.check_unique_against(trades, today, name, c) for c in spec.unique]
    parts.append(quality.run_tests({"int_gov_officials": officials},
                                   [t for t in M.PUBLISHED_TESTS if t.model == "int_gov_officials"]))
    return reduce(DataFrame.unionByName, parts)


PASSED = "_TESTED/passed_in_full"


def passed_in_full(wh: Warehouse) -> bool:
    """Whether the published models passed whole-table tests and every later change passed its own."""
    return wh._exists(f"{wh.root}/{PASSED}")


def mark_passed(wh: Warehouse) -> None:
    from ..sources.store import _FS
    if not passed_in_full(wh):
        _FS(wh.spark, wh.root).write_text(f"{wh.root}/{PASSED}", "")


def clear_passed(wh: Warehouse) -> None:
    """Before tables change: until their tests pass again, the next run tests them in full."""
    from ..sources.store import _FS
    if passed_in_full(wh):
        _FS(wh.spark, wh.root).delete(f"{wh.root}/{PASSED}")


VERSIONED_TABLES = ("staging_stock_tickers", TICKER_FILES, "stock_tickers", "int_gov_official_trades_audit",
                    "int_gov_officials_audit", "int_market_audit", "int_gov_officials",
                    "fct_government_official_trades")


def compact(wh: Warehouse, from_folders: int | None = None) -> dict[str, int]:
    """Pack the date folders of the large tables where they are many; {table: new state}."""
    from ..sources.store import COMPACT_FROM
    out = {}
    for name in (TRADES, PRICE_LOADS, "int_gov_official_trades", "int_market", "market_close_by_day"):
        t = wh.catalog.table(name)
        if name == PRICE_LOADS and wh.catalog.table("market_close_by_day").properties().get(MERGED_THROUGH) != t.current_version():
            continue                                    # what is not merged yet is known by its folders
        try:
            state = t.compact(from_folders or COMPACT_FROM) if t.exists() else None
        except PublishConflict:
            continue
        if state is not None:
            out[name] = state
            if name == PRICE_LOADS:                     # the same rows: all of them are merged
                wh.catalog.table("market_close_by_day").annotate({MERGED_THROUGH: state})
    return out


def vacuum(wh: Warehouse, keep: int) -> dict[str, list[int]]:
    """Drop all but the newest ``keep`` versions of every table (never the current or the recorded one)."""
    out, state = {}, Snapshots(wh.spark, wh.root).current()
    for name in (*VERSIONED_TABLES, *PARTITIONED):
        t = wh.catalog.table(name)
        if not t.exists():
            continue
        spare = [state[name]] if name in state else []
        if name in (TRADES, PRICE_LOADS):
            merged = wh.catalog.table("market_close_by_day").properties().get(MERGED_THROUGH)
            out[name] = ledger.vacuum(wh.spark, t, keep, spare=[merged] if name == PRICE_LOADS else [])
        else:
            out[name] = t.vacuum(keep, spare=spare)
            if name == "int_gov_official_trades":
                KeyIndex(t, ["transaction_id"]).vacuum(keep)
    if (layout := colocated(wh)).exists():
        layout.vacuum(keep)
    return out


def run_daily(wh: Warehouse, run_date=None, as_of=None, materialize_fact: bool = False,
              snapshot_ticker_dim: bool = False, severity: str = "error",
              post_tests: str = "incremental", keep_versions: int | None = 7,
              refuse_empty_tickers: bool = True, ticker_retention_days: int | None = None,
              colocate_fact: bool = False) -> RunResult:
    """One report date, end to end.

    ``post_tests="incremental"`` tests the day's slice after publishing where the
    whole tables passed before; a first build, and any run after one whose
    failures were only recorded, tests the whole tables. ``colocate_fact`` lays trades
    and prices out in buckets for the fact's join; later runs keep an existing layout up.
    """
    run_date = str(run_date or default_run_date())
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    res = RunResult(run_date, "published")
    timings = res.steps.setdefault("seconds", {})
    clock = [time.perf_counter()]

    def lap(name):
        now = time.perf_counter()
        timings[name] = round(now - clock[0], 3)
        clock[0] = now

    res.steps["trades_batches"] = load_trades(wh)
    lap("load_trades")
    # availability gate: nothing reported for the run date -> skip, tables unchanged
    if not wh.catalog.exists(TRADES) or M.report_slice(wh.trades_source([run_date]), run_date).isEmpty():
        res.status = "skipped"
        return res
    lap("availability_gate")
    res.steps["stock_tickers"] = sync_tickers(wh, as_of, refuse_empty_tickers, ticker_retention_days)
    lap("ticker_mirror")
    res.steps["market_close_by_day"] = load_and_dedup_market(wh, as_of)
    lap("price_load_dedup")
    audit = build_audit(wh, run_date)
    lap("audit_build")
    res.steps["audit_report"] = _check(quality.run_tests(audit, M.AUDIT_TESTS), severity)
    lap("audit_tests")
    mode = post_tests if passed_in_full(wh) else "full"
    clear_passed(wh)
    res.steps["published"] = publish(wh, audit)
    record_state(wh)
    lap("publish")
    report = _check(post_publish_report(wh, audit, mode), severity)
    res.steps["published_report"], res.steps["post_tests"] = report, mode
    if not report and not res.steps["audit_report"]:
        mark_passed(wh)
    lap("published_tests")
    res.steps["dim_scd_gov_officials"] = snapshot_officials(wh, as_of)
    lap("scd2_officials")
    if snapshot_ticker_dim:
        res.steps["scd_tickers"] = snapshot_tickers(wh, as_of)
        lap("scd2_tickers")
    if colocate_fact or colocated(wh).exists():
        res.steps["colocated"] = colocate(wh)
        lap("colocate")
    if materialize_fact:
        res.steps["fct_government_official_trades"] = wh.catalog.table(
            "fct_government_official_trades").write(fact(wh))
        lap("fact")
    res.steps["compacted"] = compact(wh)
    lap("compact")
    if keep_versions:
        res.steps["vacuumed"] = vacuum(wh, keep_versions)
        lap("vacuum")
    return res


MERGE_KEYS = {"int_gov_official_trades_audit": ["transaction_id"], "int_gov_officials_audit": ["member_id"],
              "int_market_audit": ["date_recorded", "ticker"]}


def run_backfill(wh: Warehouse, start, end, as_of=None, today: dt.date | None = None, severity: str = "error",
                 load: bool = True, window_days: int | None = None, snapshot_ticker_dim: bool = False) -> dict:
    """Replay report dates [start, end]; equal to running the days one by one, gate included.

    New trade and price files are loaded first (exactly once, as in a daily run).
    The range is worked off in windows of ``window_days`` (all at once if None).  A
    window's audit slices are built and tested, date by date, before anything of it is
    published, so a date that the daily run would stop at stops the window and leaves the
    tables as the windows before it made them.  Then trades and prices are merged in one
    job each, and after these facts the small officials table, its dimension and the ticker
    mirror advance date by date, as the dimensions keep every version in between.  The
    published models are tested in full at the end.  Only a range that ends before today is
    accepted (today's reports may still be arriving).

    A finished window is recorded under the warehouse root; the same range run again
    after a stop goes on behind it.  Repeating a window that was stopped halfway changes
    nothing that it had published.
    """
    today = today or dt.datetime.now(dt.timezone.utc).date()
    start_d, end_d = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    if start_d > end_d:
        raise ValueError(f"backfill start {start_d} is after its end {end_d}")
    if end_d >= today:
        raise ValueError(f"backfill must end before today ({today}), not on {end_d}")
    if window_days is not None and window_days < 1:
        raise ValueError("window_days must be at least 1")
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    if load:
        load_trades(wh)
        load_and_dedup_market(wh, as_of)
    out: dict = {"dates": [], "audit_report": [], "windows": []}
    if not wh.catalog.exists(TRADES):
        return out
    loaded = wh.catalog.table(TRADES).manifest()["partitions"]
    dates = sorted(d for d in (dt.date.fromisoformat(v) for v in loaded if v != HIVE_NULL_PARTITION) if start_d <= d <= end_d)
    record = BF.Progress(wh.spark, wh.root, start_d, end_d)
    for first, last in BF.windows(start_d, end_d, window_days):
        if record.done_through is not None and last <= record.done_through:
            continue
        days = [d for d in dates if first <= d <= last]
        out["dates"] += [str(d) for d in days]
        if days:
            _backfill_window(wh, days, as_of, severity, snapshot_ticker_dim, out)
        record.finished(last)
        out["windows"].append([str(first), str(last)])
    if out["dates"]:
        # the windows are through: readers move on to what they published
        out["published_report"] = _check(post_publish_report(wh, {}, "full"), severity)
        if not out["published_report"] and not out["audit_report"]:
            mark_passed(wh)
        record_state(wh)
        if colocated(wh).exists():
            out["colocated"] = colocate(wh)
    record.close()
    return out


def _backfill_window(wh: Warehouse, dates: list[dt.date], as_of, severity: str, snapshot_ticker_dim: bool, out: dict) -> None:
    src = M.src_trades(wh.trades_source(dates))
    states = wh.states()
    for d in dates:
        audit = build_audit(wh, str(d))
        out["audit_report"] += _check(quality.run_tests(audit, M.AUDIT_TESTS), severity)
        for name, keys in MERGE_KEYS.items():
            merge.assert_unique_keys(audit[name], keys, f"{name} of {d}")
    clear_passed(wh)
    trades = wh.catalog.table("int_gov_official_trades")
    latest = BF.last_report_per_trade(M.official_trades(src))
    if trades.exists():
        out["int_gov_official_trades"] = merge.upsert_partitions(trades, latest, "transaction_id")
    else:
        trades.write(latest, pack=True)
        out["int_gov_official_trades"] = "built"
    mkt = wh.catalog.table("int_market")
    trade_dates = [r[0] for r in src.select("transaction_date").distinct().collect()]
    prices = M.market(M.src_market(wh.prices(trade_dates)), src)
    if mkt.exists():
        out["int_market"] = merge.upsert_partitions(mkt, prices, ["date_recorded", "ticker"])
    else:
        mkt.write(prices, pack=True)
        out["int_market"] = "built"
    for d in dates:
        off = wh.catalog.table("int_gov_officials")
        published = off.read() if off.exists() else M.officials(src.limit(0), states)
        out["int_gov_officials"] = off.write(BF.backfill_officials(published, src, states, d, d))
        snapshot_officials(wh, as_of)
        if _tickers_behind(wh, d):
            out["stock_tickers"] = sync_tickers(wh, as_of, refuse_empty=True, until=d)
            if snapshot_ticker_dim:
                snapshot_tickers(wh, as_of)


def _tickers_behind(wh: Warehouse, day: dt.date) -> bool:
    """Whether files of run dates up to ``day`` are landed that the mirror was not built from (nor from later ones)."""
    path = f"{wh.landing}/stock_tickers"
    if not wh._exists(path):
        return False
    glob = landing.TICKERS_GLOB if wh.globs else None
    newest = lambda files: files.agg(F.max(landed_on())).first()[0]
    landed = newest(ledger.listing(wh.spark, path, glob).where(landed_on() <= F.lit(str(day)).cast("date")))
    files = wh.catalog.table(TICKER_FILES)
    mirrored = newest(files.read()) if files.exists() else None
    return landed is not None and (mirrored is None or mirrored < landed)
