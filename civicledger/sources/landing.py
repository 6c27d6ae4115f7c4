"""Landing files: gzip JSON feeds in, typed source tables out.

* ``read_landed``      one JSON array per file (or JSON lines), schema on read,
                       file-name glob, FAILFAST by default
* ``read_pages``       landed API pages: explode ``results`` / ``data`` of each page
* ``write_landing``    one folder per feed and run date, gzip, overwritten on re-run
* ``extract_*``        the three COPY projections into source-table layouts
* ``error_ratio`` / ``read_with_error_policy``
                       skip a file when more than a share of its rows fail to cast

Scale: a multi-line JSON file is not splittable, so read parallelism equals
the file count; ``read_landed(..., partitions=n)`` repartitions after the
scan when a few large files would otherwise feed few tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from . import schemas

# file-name patterns of the three feeds (glob on the file name)
TRADES_GLOB = "*government_trades*"
MARKET_GLOB = "*market_close*"
TICKERS_GLOB = "*tickers*"
# page fields that hold the records of one API response page
PAGE_FIELDS = ("results", "data")
# documented alternative error policy: skip a file when more than 10 % of its rows fail
SKIP_FILE_RATIO = 0.10


def reader(spark: SparkSession, schema, layout: str, name_glob: str | None, mode: str,
            modified_after: str | None = None):
    r = spark.read.schema(schema).option("mode", mode).option("recursiveFileLookup", "true")
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    if layout == "array":
        r = r.option("multiLine", "true")
    elif layout != "lines":
        raise ValueError(f"layout must be 'array' or 'lines', not {layout!r}")
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    return r


def case_sensitive(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose column names tell ``afterHours`` from ``afterhours``."""
    other = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions",
                "spark.sql.parquet.compression.codec"):
        other.conf.set(key, spark.conf.get(key))
    other.conf.set("spark.sql.caseSensitive", "true")
    return other


def read_landed(spark: SparkSession, path: str, schema: T.StructType, name_glob: str | None = None,
                layout: str = "array", mode: str = "FAILFAST", partitions: int | None = None,
                modified_after: str | None = None) -> DataFrame:
    """Rows of every landed file under ``path`` (one row per array element).

    ``modified_after`` ('YYYY-MM-DDTHH:MM:SS') ignores files older than that,
    which is how a retention window over the landing area is applied.
    """
    df = reader(spark, schema, layout, name_glob, mode, modified_after).json(path)
    return df.repartition(partitions) if partitions else df


def read_pages(spark: SparkSession, path: str, item_schema: T.StructType, field: str = "results",
               name_glob: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Records of landed response pages: each file is one page ``{field: [...], ...}``."""
    if field not in PAGE_FIELDS:
        raise ValueError(f"page field must be one of {PAGE_FIELDS}")
    page = T.StructType([T.StructField(field, T.ArrayType(item_schema), True)])
    pages = reader(spark, page, "array", name_glob, mode).json(path)
    return pages.select(F.explode(field).alias("r")).select("r.*")


def write_landing(df: DataFrame, path: str, ds, layout: str = "lines", feed: str | None = None,
                  rows_per_file: int = 20_000) -> None:
    """Land a feed for run date ``ds`` under ``path/ds=<ds>``, replacing a re-run.

    ``lines``: gzip JSON lines, one file per task.  ``array``: every file holds one
    JSON array of about ``rows_per_file`` records, written in parallel; records
    are dealt by hash, so no file gathers a hot key.  Files are written beside
    their place and renamed to ``<ds>_<feed>_<n>.json.gz`` (``feed``: the folder's
    name unless given), the names that the feeds' readers look for by default.
    """
    from .store import _FS
    if layout not in ("lines", "array"):
        raise ValueError(f"layout must be 'array' or 'lines', not {layout!r}")
    path = path.rstrip("/")
    feed = feed or path.rsplit("/", 1)[-1].replace("-", "_")
    own = f"{path}/_landing-{uuid.uuid4().hex}"                     # readers pass over names that begin so
    if layout == "lines":
        df.write.option("compression", "gzip").json(own)
    else:
        text = df.select(F.to_json(F.struct(*df.columns)).alias("r"))
        files = max(1, -(-text.count() // rows_per_file))
        arrays = (text.groupBy(F.pmod(F.xxhash64("r", F.monotonically_increasing_id()), F.lit(files)).alias("file"))
                  .agg(F.concat(F.lit("["), F.array_join(F.collect_list("r"), ",\n"), F.lit("]")).alias("value")))
        # one row, and so one array, per file
        arrays.select("value").write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(own)
    spark = df.sparkSession
    fs, target = _FS(spark, path), f"{path}/ds={ds}"
    fs.mkdirs(target)
    # file by file over the old ones, then the old ones beyond them: the day is never without files
    written = [f"{ds}_{feed}_{n:05d}.json.gz" for n in range(len([x for x in fs.list_files(own) if x.startswith("part-")]))]
    for source, name in zip(sorted(x for x in fs.list_files(own) if x.startswith("part-")), written, strict=True):
        fs.move(f"{own}/{source}", f"{target}/{name}")
    for name in fs.list_files(target):
        if name not in written:
            fs.delete(f"{target}/{name}")
    fs.delete(own)


def require_matching_files(spark: SparkSession, path: str, name_glob: str | None) -> None:
    """Raise if ``path`` holds files but none is named as the feed's files are: nothing would load, silently."""
    if not name_glob:
        return
    files = lambda glob: (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                          .option("pathGlobFilter", glob).load(path).select("path").limit(1))
    if files(name_glob).isEmpty() and not files("*").isEmpty():
        raise FileNotFoundError(f"{path}: no file matches {name_glob!r}, though the folder holds files; "
                                "read it without a name pattern if its folder names the feed")


# ---------------------------------------------------------------------------
# extracts (COPY projections)
# ---------------------------------------------------------------------------
def extract_trades(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten a trades feed to the 28-column source table; ``keep`` names further columns to carry along."""
    fi, se = "filer_info", "security"
    return raw.select(
        "amendment_number", "amount", "chamber", "disclosure_url",
        F.col(f"{fi}.committees").alias("committees"),
        F.col(f"{fi}.display_name").alias("display_name"),
        F.col(f"{fi}.district").alias("district"),
        F.col(f"{fi}.headshot").alias("headshot"),
        F.col(f"{fi}.id").alias("member_record_id"),
        F.col(f"{fi}.leadership_positions").alias("leadership_positions"),
        F.col(f"{fi}.member_id").alias("member_id"),
        F.col(f"{fi}.member_name").alias("member_name"),
        F.col(f"{fi}.party").alias("party"),
        F.col(f"{fi}.state").alias("state"),
        F.col(f"{fi}.updated").alias("member_updated"),
        F.col(f"{fi}.website").alias("website"),
        F.col("id").alias("trade_record_id"),
        "notification_date", "ownership", "report_date", "report_id",
        F.col(f"{se}.name").alias("security_name"),
        F.col(f"{se}.ticker").alias("security_ticker"),
        F.col(f"{se}.type").alias("security_type"),
        "transaction_date", "transaction_id", "transaction_type",
        F.col("updated").alias("record_updated"), *keep,
    )


def read_records(spark: SparkSession, path: str, name_glob: str | None = None,
                 layout: str = "array", mode: str = "FAILFAST") -> DataFrame:
    """Schemaless read: one row per landed record, column ``r`` of type VARIANT."""
    r = (spark.read.option("singleVariantColumn", "v").option("mode", mode)
         .option("recursiveFileLookup", "true"))
    if layout == "array":
        r = r.option("multiLine", "true")
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    return records_of(r.json(path), layout)


def records_of(files: DataFrame, layout: str = "array") -> DataFrame:
    """Rows holding one VARIANT per file (array layout) or per line -> one row per record."""
    if layout == "array":
        return files.select(F.explode(F.col("v").cast("array<variant>")).alias("r"))
    return files.select(F.col("v").alias("r"))


def extract_paths(records: DataFrame, paths, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from a VARIANT record by JSON path (case-sensitive).

    ``strict`` casts with ``variant_get`` (a value that does not cast aborts the
    load, the active policy); otherwise ``try_variant_get`` gives NULL.
    """
    get = F.variant_get if strict else F.try_variant_get
    return records.select(*[get(F.col("r"), p, t).alias(c) for c, p, t in paths], *keep)


def extract_market(records: DataFrame, strict: bool = True) -> DataFrame:
    """Market-close records to ``market_close_by_day``; both extended-hours spellings accepted."""
    raw = extract_paths(records, schemas.MARKET_PATHS, strict)
    return raw.select(
        "status", "date_recorded", "symbol", "open", "high", "low", "close",
        X.to_whole_long("volume").alias("stock_volume"),
        F.coalesce(F.col("after_hours_camel"), F.col("after_hours_lower")).alias("after_hours"),
        F.coalesce(F.col("pre_market_camel"), F.col("pre_market_lower")).alias("pre_market"),
    )


def extract_market_rows(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows read as ``schemas.MARKET_CLOSE`` (by a case-sensitive session) to ``market_close_by_day``."""
    return raw.select(
        "status", F.col("from").alias("date_recorded"), "symbol", "open", "high", "low", "close",
        X.to_whole_long("volume").alias("stock_volume"),
        F.coalesce(F.col("afterHours"), F.col("afterhours")).alias("after_hours"),
        F.coalesce(F.col("preMarket"), F.col("premarket")).alias("pre_market"), *keep,
    )


def parse_market(records: DataFrame, text: str) -> DataFrame:
    """Market-close records held as JSON text to ``market_close_by_day``, with one typed parse a record.

    A bad value aborts.  Both spellings of a name are fields of the parsed record; they get names of
    their own by place, so a session need not tell them apart.
    """
    parsed = records.select(F.from_json(F.col(text), schemas.MARKET_CLOSE, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    (status, day, symbol, o, h, lo, c, volume, after, pre, after_lower, pre_lower) = named = [
        f"_{i}" for i in range(len(schemas.MARKET_CLOSE.fields))]
    raw = parsed.toDF(*named)
    return raw.select(
        F.col(status).alias("status"), F.col(day).alias("date_recorded"), F.col(symbol).alias("symbol"), F.col(o).alias("open"),
        F.col(h).alias("high"), F.col(lo).alias("low"), F.col(c).alias("close"), X.to_whole_long(volume).alias("stock_volume"),
        F.coalesce(after, after_lower).alias("after_hours"), F.coalesce(pre, pre_lower).alias("pre_market"))


def extract_tickers(raw: DataFrame, loaded_at=None) -> DataFrame:
    """Tickers feed to the staging layout: typed columns, SHA-256 row hash, load time.

    The hash is over the ten fields' *text* as landed (read as STRING), so it
    is computed before ``last_updated_utc`` is parsed.
    """
    text_cols = [c for c in schemas.TICKERS.fieldNames()]
    loaded = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return raw.select(
        *[F.col(c) for c in text_cols if c != "last_updated_utc"],
        F.to_timestamp("last_updated_utc").alias("last_updated_utc"),
        X.row_hash(*[F.col(c) for c in text_cols]).alias("row_hash"),
        loaded.alias("watermark_timestamp"),
    ).select(*text_cols, "row_hash", "watermark_timestamp")


# ---------------------------------------------------------------------------
# load error policy
# ---------------------------------------------------------------------------
def error_ratio(df: DataFrame, file_col: str, bad: Column, max_ratio: float = SKIP_FILE_RATIO) -> DataFrame:
    """Per file: rows, failing rows, their share, and whether the file is skipped (> max_ratio)."""
    per_file = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.count_if(bad).alias("n_bad"))
    ratio = F.col("n_bad").cast("double") / F.col("n_rows")
    return per_file.select(F.col(file_col), "n_rows", "n_bad", ratio.alias("bad_ratio"),
                           (ratio > F.lit(max_ratio)).alias("skipped"))


def path_failures(paths) -> Column:
    """TRUE when a present (non-NULL) path value of record ``r`` fails to cast to its type."""
    out = F.lit(False)
    for _c, p, t in paths:
        present = F.try_variant_get(F.col("r"), p, "variant").isNotNull() & \
            ~F.is_variant_null(F.try_variant_get(F.col("r"), p, "variant"))
        out = out | (present & F.try_variant_get(F.col("r"), p, t).isNull())
    return out


def _text_schema(paths) -> T.StructType:
    """The fields that ``paths`` name, nested as in the feed, every leaf as text."""
    tree: dict = {}
    for _c, path, _t in paths:
        at = tree
        *outer, leaf = path[2:].split(".")
        for name in outer:
            at = at.setdefault(name, {})
        at.setdefault(leaf, None)

    def build(node):
        return T.StructType([T.StructField(k, T.StringType() if v is None else build(v)) for k, v in node.items()])
    return build(tree)


def read_with_error_policy(spark: SparkSession, path: str, paths, name_glob: str | None = None,
                           max_ratio: float = SKIP_FILE_RATIO, layout: str = "array"):
    """Records of files whose failing-record share is at most ``max_ratio``; returns (records, report).

    Files are read with every field as text, record by record, so a file may
    have any size; a record fails when a present value does not cast to its
    path's type.  A file that cannot be parsed at all counts as ratio 1.
    Failing records of a kept file are left out, the rest load.  ``records``
    has a VARIANT column ``r`` of the fields that ``paths`` name; extract it
    with the feed's extractor.
    """
    fields = _text_schema(paths)
    schema = T.StructType([*fields.fields, T.StructField("_corrupt_record", T.StringType())])
    raw = (reader(case_sensitive(spark), schema, layout, name_glob, "PERMISSIVE").json(path)
           .withColumn("_file", F.col("_metadata.file_path")))
    recs = raw.select("_file", F.col("_corrupt_record").isNotNull().alias("_unparsed"),
                      F.parse_json(F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in fields.fields]))).alias("r"))
    recs = recs.withColumn("_bad", F.col("_unparsed") | path_failures(paths))
    report = error_ratio(recs, "_file", F.col("_bad"), max_ratio)
    keep = report.where(~F.col("skipped")).select("_file")
    kept = recs.where(~F.col("_bad")).join(keep, "_file", "left_semi").select("r")
    return kept, report
