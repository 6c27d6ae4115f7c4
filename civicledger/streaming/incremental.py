"""Exactly-once loading of landed files (the warehouse's COPY with load history).

A Structured Streaming file source remembers in its checkpoint which files
it has read; ``trigger(availableNow=True)`` reads every file not yet loaded,
in one or more micro-batches, and stops.  Re-running loads 0 rows; a new
file adds only its rows.  Each micro-batch is written by ``foreachBatch`` to
the partition ``_batch=<batch id>`` with dynamic partition overwrite, so a
batch that is replayed after a failure (same id, same files) replaces its
own output instead of duplicating it.

The checkpoint lives under the warehouse root (shared storage), never on a
machine-local disk.  Pin: a changed file must arrive under a new name -- the
file source does not re-read a path it has already loaded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL = "_batch"


def load_new_files(spark: SparkSession, landing_path: str, schema: T.StructType | None, table_path: str,
                   checkpoint_location: str, name_glob: str | None = None,
                   transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                   partition_by: Sequence[str] = (), layout: str = "array",
                   max_files_per_trigger: int | None = None,
                   spread: bool = False, cluster_by: Sequence[str] = ()) -> list[int]:
    """Append every not-yet-loaded landed file to ``table_path``; return the batch ids written.

    ``schema=None`` reads schemaless: each file (array layout) or line arrives
    as one VARIANT in column ``v`` for ``transform`` to explode and extract.

    A gzip or multi-line JSON file is read by one task, so one file holding a
    third of a feed is one big task.  ``spread=True`` redistributes each batch
    after the extract so the write runs on many tasks: range-partitioned on
    (partition columns, ``cluster_by``) for a partitioned table, so each date
    lands in a few files, and round-robin otherwise.
    """
    reader = spark.readStream.option("mode", "FAILFAST").option("recursiveFileLookup", "true")
    if schema is None:
        reader = reader.schema("v variant").option("singleVariantColumn", "v")
    else:
        reader = reader.schema(schema)
    if layout == "array":
        reader = reader.option("multiLine", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.json(landing_path)
    written: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch).withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))
        if spread and partition_by:
            out = out.repartitionByRange(*[F.col(c) for c in (*partition_by, *cluster_by)])
        elif spread:
            out = out.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by, BATCH_COL).parquet(table_path))
        written.append(batch_id)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"load of {landing_path} failed: {q.exception()}")
    return written


def read_loaded(spark: SparkSession, table_path: str, batches: Sequence[int] | None = None) -> DataFrame:
    """The loaded table (all batches, or only ``batches``; the filter prunes partitions)."""
    df = spark.read.parquet(table_path)
    if batches is not None:
        df = df.where(F.col(BATCH_COL).isin(list(batches)))
    return df
