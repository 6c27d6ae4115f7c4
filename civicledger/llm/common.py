"""Shared helpers: scratch tables in the cluster's shared folder, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where unset, the warehouse (a temp folder in local mode)."""
    found = checkpoint_dir(spark)
    if not found:
        master = spark.sparkContext.master
        if master.startswith("local") and not master.startswith("local-cluster"):
            found = tempfile.mkdtemp(prefix="civicledger-llm-")
        else:
            found = spark.conf.get("spark.sql.warehouse.dir") + "/_llm_scratch"
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def unused(columns, stem: str) -> str:
    """A column name that none of ``columns`` has, compared without case."""
    taken = {c.lower() for c in columns}
    return next(name for name in (f"_{stem}" + "_" * k for k in range(len(taken) + 1)) if name not in taken)


class Scratch:
    """Written tables in the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/llm-{what}-{uuid.uuid4().hex}"
        self.names: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back (schema given, nothing is inferred)."""
        self.names.add(name)
        with shuffles_removed(self.spark):
            df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        self.names.discard(name)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """A query that is made and run in here leaves no shuffle files on the executors' disks when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and those of all steps add up.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def lean(run):
    """A function over batches whose worker gives memory back when the task ends.

    Workers are reused: what allocators and memos keep from one stage would add to what the next one needs.
    """
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _STATE.clear()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):       # another C library
                pass
    return wrapped


def worker_state(key, make):
    """One object per Python worker and key; kept between tasks of a reused worker."""
    if key not in _STATE:
        _STATE[key] = make()
    return _STATE[key]


_STATE: dict = {}


def connected_components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """Smallest id reachable from each id: ``edges`` (src, dst) -> (id, component).

    Alternating large-star and small-star rounds over a table of edges; each
    round is two grouped minima and joins, written to the shared folder.  Only
    a changed/unchanged sum comes to the driver.  A hub keeps linear work: its
    rows are pre-aggregated for the minimum and AQE splits its side of the join.
    Null ids and self loops are dropped; ids without an edge do not appear.
    """
    cur = scratch.stage(
        edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct(), f"{name}-0")
    before, i = None, 0
    while True:
        i += 1
        # large star: every larger neighbour of u points to the least of u and its neighbours
        both = cur.unionByName(cur.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        large = (both.where("dst > src").join(least, "src")
                 .select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct())
        # small star: u's smaller neighbours and u itself point to the least of them
        least2 = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (large.join(least2, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
                 .unionByName(least2.select("src", F.col("m").alias("dst"))).where("src <> dst").distinct())
        nxt = scratch.stage(small, f"{name}-{i}")
        now = tuple(nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())
        scratch.drop(f"{name}-{i - 1}")
        cur = nxt
        if now == before:
            break
        before = now
    roots = cur.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    return cur.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(roots)
