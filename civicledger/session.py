"""SparkSession helpers: UTC, ANSI, AQE; checkpoint directory taken from the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job of the warehouse relies on.  Time zone UTC keeps epoch
# conversions and date truncation identical on every executor; AQE re-plans
# joins from runtime sizes (broadcast only what is measured small) and splits
# skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "civicledger", master: str | None = None,
                shuffle_partitions: int | None = None,
                fallback_checkpoint_dir: str | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark, fallback_checkpoint_dir)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or None)."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Use the cluster's checkpoint folder; only set ``fallback`` where none is configured (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    target = configured or fallback
    if target:
        sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def cluster_conf(total_cores: int, largest_shuffle_bytes: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large cluster, sized from the cores and the largest shuffle.

    The initial shuffle width gives every shuffle partition about
    ``target_partition_bytes`` of the largest stage (so it fits in executor
    memory without spilling much) and at least 3 partitions per core; AQE
    then coalesces small stages down and splits skewed partitions.  Scans
    read 256 MB splits.
    """
    by_size = -(-largest_shuffle_bytes // target_partition_bytes)
    partitions = max(3 * total_cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
