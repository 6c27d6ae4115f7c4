"""Loading landed files by content, exactly once, corrections included.

The ledger of a table holds one row per landed file: path, length, modification time,
digest of the content, the partitions its rows went to, and what became of it. A load

1. lists the landed files and looks for those whose path, length or time the ledger does
   not hold; only these are read;
2. compares digests: an unchanged file (landed again, or touched) adds nothing, a changed
   one replaces the rows of its earlier load, a new one is added;
3. drops the rows of files that vanished from a day's folder (``ds=...``) which was landed
   again; files that expire by a lifecycle rule keep their rows;
4. writes the new rows, and the partitions that lose rows anew, to one folder, writes the
   next ledger beside it, and publishes both in one step (``PartitionedTable.append``). A
   load that dies before that step changed nothing, and of two loads at the same time one
   fails (``PublishConflict``).

Error policy: ``abort`` stops at the first bad value; ``skip_file`` takes two passes over
the new files. A record is bad if it does not parse or a present value does not cast to its
declared type. A file with more than ``max_ratio`` bad records is kept out and listed with
its figures (``quarantined``); of the others the good records load, and the bad ones are
written to the table's ``_rejects`` folder.

The driver holds one row per file that is new or changed, as the reader needs their paths.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import landing
from .store import _FS, HIVE_NULL_PARTITION, LEASE_SECONDS, PartitionedTable

#: Column of a loaded table that names the file a row came from.
FILE = "_file"
LEDGER = "ledger"                      # property of the table: the folder of its current ledger
LOADED, QUARANTINED = "loaded", "quarantined"
ENTRY = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType()),
    T.StructField("digest", T.StringType()), T.StructField("status", T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("n_bad", T.LongType()), T.StructField("partitions", T.ArrayType(T.StringType())),
    T.StructField("loaded_at", T.TimestampType())])
BAD, CORRUPT = "_bad", "_corrupt_record"


@dataclass
class Loaded:
    """What a load did: files by kind, and the table's state afterwards (None: nothing was published)."""

    new: list[str] = field(default_factory=list)
    changed: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    quarantined: list[dict] = field(default_factory=list)
    state: int | None = None


def listing(spark: SparkSession, path: str, name_glob: str | None = None) -> DataFrame:
    """path, file (as rows name it), length and modified of every landed file; no content is read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    return r.load(path).select("path", F.col("_metadata.file_path").alias("file"), "length",
                               F.col("modificationTime").alias("modified"))


def digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, digest: the number of pieces between closing braces and two independent sums of their hashes.

    A file is never held as one value, whatever its size; the order of records does not matter.
    """
    pieces = spark.read.option("lineSep", "}").text(paths)
    return pieces.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.concat_ws(
        ":", F.count(F.lit(1)), F.sum(F.xxhash64("value").cast("decimal(38,0)")),
        F.hex(F.bit_xor(F.xxhash64(F.lit(1), "value")))).alias("digest"))


def entries(spark: SparkSession, table: PartitionedTable) -> DataFrame:
    """The current ledger of ``table`` (empty before its first load)."""
    name = table.properties().get(LEDGER)
    if name is None:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(f"{table.root}/_ledger/l={name}")


def quarantined(spark: SparkSession, table: PartitionedTable) -> DataFrame:
    """Files kept out by the error policy, with their figures."""
    return (entries(spark, table).where(F.col("status") == QUARANTINED)
            .select("file", "n_rows", "n_bad", (F.col("n_bad") / F.col("n_rows")).alias("bad_ratio"), "loaded_at"))


def newest_file(spark: SparkSession, table: PartitionedTable) -> DataFrame:
    """One row: when the newest loaded file was landed."""
    return entries(spark, table).where(F.col("status") == LOADED).agg(F.max("modified").cast("timestamp_ntz").alias("loaded_at"))


# -- typed records out of text leaves (skip_file) --------------------------------------------------
def text_leaves(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, text_leaves(f.dataType) if isinstance(f.dataType, T.StructType)
                                       else T.StringType()) for f in schema.fields])


def typed(schema: T.StructType, outer: str = "") -> list[Column]:
    """The fields of ``schema`` from their text; what does not cast is null."""
    out = []
    for f in schema.fields:
        at = F.col(f"{outer}`{f.name}`")
        if isinstance(f.dataType, T.StructType):
            out.append(F.when(at.isNotNull(), F.struct(*typed(f.dataType, f"{outer}`{f.name}`."))).alias(f.name))
        else:
            out.append(at.try_cast(f.dataType).alias(f.name))
    return out


def cast_failures(schema: T.StructType, outer: str = "") -> Column:
    """TRUE where a present leaf does not cast to its type."""
    out = F.lit(False)
    for f in schema.fields:
        at = F.col(f"{outer}`{f.name}`")
        out = out | (cast_failures(f.dataType, f"{outer}`{f.name}`.") if isinstance(f.dataType, T.StructType)
                     else at.isNotNull() & at.try_cast(f.dataType).isNull())
    return out


# -- reading ----------------------------------------------------------------------------------------
def read_records(spark: SparkSession, paths: list[str], schema: T.StructType, layout: str, mode: str) -> DataFrame:
    """The records of the files with the file each came from."""
    named = F.col("_metadata.file_path").alias(FILE)
    if layout == "pages":
        page = T.StructType([T.StructField(p, T.ArrayType(schema)) for p in landing.PAGE_FIELDS])
        if mode == "PERMISSIVE":
            page = page.add(CORRUPT, T.StringType())
        raw = landing.reader(spark, page, "array", None, mode).json(paths)
        rest = [CORRUPT] if mode == "PERMISSIVE" else []
        held = F.coalesce(*[F.col(p) for p in landing.PAGE_FIELDS])
        if not rest:
            return raw.select(F.explode(held), named).select("col.*", FILE)
        # a page that does not parse stays as one row
        every = raw.select(F.explode_outer(held), CORRUPT, named)
        return every.where(F.col("col").isNotNull() | F.col(CORRUPT).isNotNull()).select("col.*", CORRUPT, FILE)
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return landing.reader(spark, schema, layout, None, mode).json(paths).select(*[f"`{f}`" for f in schema.fieldNames()], named)


def _checked(spark: SparkSession, paths: list[str], schema: T.StructType, layout: str) -> DataFrame:
    """All records as text leaves with whether they are bad."""
    raw = read_records(spark, paths, text_leaves(schema), layout, "PERMISSIVE")
    return raw.withColumn(BAD, F.col(CORRUPT).isNotNull() | cast_failures(schema))


def load_files(spark: SparkSession, path: str, table: PartitionedTable, schema: T.StructType,
               transform: Callable[[DataFrame], DataFrame], name_glob: str | None = None, layout: str = "array",
               policy: str = "abort", max_ratio: float = landing.SKIP_FILE_RATIO, reader: SparkSession | None = None,
               loaded_at: dt.datetime | None = None) -> Loaded:
    """Bring ``table`` up to date with the landed files under ``path``.

    ``transform`` makes the table's rows out of the feed's records and keeps the column ``_file``. ``reader`` is
    the session that parses (a case-sensitive one, for a feed that needs it).
    """
    if policy not in ("abort", "skip_file"):
        raise ValueError(f"policy must be 'abort' or 'skip_file', not {policy!r}")
    reader = reader or spark
    at = F.lit(loaded_at or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    table.current_state()                               # the state that this load is computed from
    known = entries(spark, table)
    files = listing(spark, path, name_glob)
    held = known.select("file", F.col("length").alias("_l"), F.col("modified").alias("_m"), F.col("digest").alias("_d"))
    fresh = [r.asDict() for r in files.join(held, "file", "left")
             .where(~(F.col("length").eqNullSafe(F.col("_l")) & F.col("modified").eqNullSafe(F.col("_m")))).collect()]
    if not fresh:
        return Loaded()
    content = {r["file"]: r["digest"] for r in digests(spark, [r["path"] for r in fresh]).collect()}
    for r in fresh:
        r["digest"] = content.get(r["file"], "0")
    new = [r for r in fresh if r["_d"] is None]
    changed = [r for r in fresh if r["_d"] not in (None, r["digest"])]
    coming = new + changed
    days = sorted({r["file"].rsplit("/", 1)[0] for r in coming if r["file"].rsplit("/", 2)[-2].startswith("ds=")})
    gone = [] if not days else [r[0] for r in known.join(files, "file", "left_anti")
                                .where(F.regexp_replace("file", "/[^/]*$", "").isin(days)).select("file").collect()]
    out = Loaded(sorted(r["file"] for r in new), sorted(r["file"] for r in changed), sorted(gone))

    # the ledger's rows of the files looked at, before what their load adds to them
    seen = spark.createDataFrame([(r["file"], r["length"], r["modified"], r["digest"]) for r in fresh],
                                 "file string, length long, modified timestamp, digest string")
    names = lambda rows: spark.createDataFrame([(f,) for f in rows], "file string")
    same = [r["file"] for r in fresh if r["_d"] == r["digest"]]
    rest = known.join(names([r["file"] for r in coming] + gone), "file", "left_anti")
    rest = (rest.join(seen.join(names(same), "file").select("file", F.col("length").alias("_l"), F.col("modified").alias("_m")),
                      "file", "left")
            .withColumn("length", F.coalesce("_l", "length")).withColumn("modified", F.coalesce("_m", "modified")).drop("_l", "_m"))
    if not coming and not gone:
        out.state = table.annotate({LEDGER: _write_ledger(spark, table, rest)})
        return out

    bad = {}
    paths = [r["path"] for r in coming]
    if policy == "abort":
        rows = read_records(reader, paths, schema, layout, "FAILFAST")
    else:
        checked = _checked(reader, paths, schema, layout)
        ratios = landing.error_ratio(checked, FILE, F.col(BAD), max_ratio).collect()
        bad = {r[FILE]: r.asDict() for r in ratios if r["n_bad"]}
        kept_out = [f for f, r in bad.items() if r["skipped"]]
        out.quarantined = [{"file": f, "n_rows": bad[f]["n_rows"], "n_bad": bad[f]["n_bad"], "bad_ratio": bad[f]["bad_ratio"]}
                           for f in sorted(kept_out)]
        checked = checked.where(~F.col(FILE).isin(kept_out)) if kept_out else checked
        if len(bad) > len(kept_out):
            (checked.where(BAD).select(FILE, F.to_json(F.struct(*[f"`{f}`" for f in schema.fieldNames()])).alias("record"), CORRUPT)
             .write.json(f"{table.root}/_rejects/{uuid.uuid4().hex}", compression="gzip"))
        rows = checked.where(~F.col(BAD)).select(*typed(schema), FILE)
    rows = transform(rows)
    pcol = table.partition_col

    lost = out.changed + out.removed
    affected: list[str] = []
    if lost:
        affected = [r[0] for r in known.join(names(lost), "file", "left_semi")
                    .select(F.explode("partitions")).distinct().collect()]
        if affected:
            kept = table.read_partitions(affected)
            rows = rows.unionByName(kept.join(names(lost), kept[FILE] == F.col("file"), "left_anti"))

    def ledgered(folder: str) -> dict:
        written = spark.read.schema(rows.schema).parquet(folder).groupBy(F.col(FILE).alias("file")).agg(
            F.count(F.lit(1)).alias("n_good"),
            F.collect_set(F.coalesce(F.col(pcol).cast("string"), F.lit(HIVE_NULL_PARTITION))).alias("partitions"))
        figures = spark.createDataFrame([(f, r["n_rows"], r["n_bad"], r["skipped"]) for f, r in bad.items()],
                                        "file string, n_all long, n_bad long, skipped boolean")
        loaded = (seen.join(names([r["file"] for r in coming]), "file").join(written, "file", "left").join(figures, "file", "left")
                  .select("file", "length", "modified", "digest",
                          F.when(F.col("skipped"), QUARANTINED).otherwise(LOADED).alias("status"),
                          F.coalesce("n_all", "n_good", F.lit(0)).alias("n_rows"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"),
                          F.coalesce("partitions", F.array().cast("array<string>")).alias("partitions"), at.alias("loaded_at")))
        return {LEDGER: _write_ledger(spark, table, rest.unionByName(loaded))}

    # a first load is a table's history: many dates, packed
    out.state = table.append(rows, rewritten=affected, properties=ledgered, pack=not table.exists())
    return out


def _write_ledger(spark: SparkSession, table: PartitionedTable, rows: DataFrame) -> str:
    name = uuid.uuid4().hex
    rows.select(*ENTRY.fieldNames()).write.parquet(f"{table.root}/_ledger/l={name}")
    return name


def vacuum(spark: SparkSession, table: PartitionedTable, keep: int, spare=(), lease_seconds: float = LEASE_SECONDS) -> list[str]:
    """``PartitionedTable.vacuum``, and the ledgers that no kept state names."""
    dropped = table.vacuum(keep, spare, lease_seconds)
    fs = _FS(spark, table.root)
    named = {s["properties"].get(LEDGER) for s in table.states()}
    for d in fs.list_dirs(f"{table.root}/_ledger"):
        written = fs.modified(f"{table.root}/_ledger/{d}")
        if d[2:] not in named and time.time() - written >= lease_seconds:
            fs.delete(f"{table.root}/_ledger/{d}")
    return dropped
