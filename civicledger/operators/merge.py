"""Table-maintenance merges as pure ``(target, source) -> next target`` functions.

Spark's Parquet tables have no MERGE/DELETE, so each merge computes the next
state of the table as a DataFrame; ``sources.store`` publishes it as a new
version (readers keep the old one until it is published), or, for a large
date-partitioned table, replaces only the touched partitions
(``upsert_partitions``).  With a lakehouse table format the same functions
could feed a MERGE.

All merges are keyed joins: both sides are shuffled on the key once; no
side is broadcast unless AQE measures it small at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.keyindex import KeyIndex
from .keyed import latest_per_key


class DuplicateKeyError(ValueError):
    """A merge source holds the same key more than once (the warehouse merge fails)."""


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Non-NULL keys that occur more than once (partial count map-side)."""
    keys = _names(keys)
    not_null = None
    for k in keys:
        e = F.col(k).isNotNull()
        not_null = e if not_null is None else not_null & e
    return (df.where(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def assert_unique_keys(df: DataFrame, keys, what: str = "merge source") -> None:
    """Raise ``DuplicateKeyError`` if a key repeats; reads at most one offending key."""
    bad = duplicate_keys(df, keys).limit(1).collect()
    if bad:
        raise DuplicateKeyError(f"{what}: duplicate key {bad[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Keyed merge: matched target rows are replaced by the source row, the rest inserted.

    Never deletes.  ``keys`` may be composite.  A NULL key never matches, so a
    NULL-key source row is inserted and a NULL-key target row is kept.
    Callers check source-key uniqueness first (``assert_unique_keys``).
    """
    keys = _names(keys)
    cols = target.columns
    has_null = None
    for k in keys:
        e = F.col(k).isNull()
        has_null = e if has_null is None else has_null | e
    # NULL-key rows can never match: they bypass the join instead of all hashing
    # into one shuffle partition (a NULL key may be the hot key)
    null_keyed = target.where(has_null)
    keyed = target.where(~has_null)
    src_keys = source.select(*keys)
    cond = None
    for k in keys:
        e = keyed[k] == src_keys[k]
        cond = e if cond is None else cond & e
    kept = keyed.join(src_keys, cond, "left_anti")
    return kept.unionByName(null_keyed).unionByName(source.select(*cols))


def mirror_sync(target: DataFrame, staging: DataFrame, key: str, hash_col: str,
                updated_col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Hash-gated upsert followed by delete of absent keys, in one pass.

    * staging is first reduced to its latest row per key (``updated_col`` DESC,
      NULL first, then ``tiebreak``);
    * matched key, hashes differ   -> the staged row (with its new load time);
    * matched key, same or NULL hash -> the target row, old load time included;
    * key only in staging          -> inserted;
    * key only in target, or NULL  -> gone (the merge inserts NULL keys, the
      follow-up delete removes them again).

    The result's keys equal the staging keys exactly.
    """
    latest = latest_per_key(staging.where(F.col(key).isNotNull()), key, [updated_col], tiebreak)
    cols = target.columns
    t = target.where(F.col(key).isNotNull()).select(
        *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_matched"))
    joined = latest.join(t, latest[key] == t[f"_t_{key}"], "left")
    differs = F.coalesce(F.col(hash_col) != F.col(f"_t_{hash_col}"), F.lit(False))
    keep_old = F.col("_matched").isNotNull() & ~differs
    return joined.select(*[F.when(keep_old, F.col(f"_t_{c}")).otherwise(F.col(c)).alias(c)
                           for c in cols])


def mirror_deleted_keys(target: DataFrame, staging: DataFrame, key: str) -> DataFrame:
    """Target keys with no staged row (NOT EXISTS); a NULL target key is always listed."""
    staged = staging.select(F.col(key).alias("_k")).distinct()     # repeated staged keys collapse map-side
    keyed = target.where(F.col(key).isNotNull())
    gone = keyed.join(staged, keyed[key] == staged["_k"], "left_anti").select(key)
    return gone.unionByName(target.where(F.col(key).isNull()).select(key))   # NULL keys bypass the join


def affected_partitions(target: DataFrame, source: DataFrame, keys, partition_col: str) -> DataFrame:
    """Partition values of ``target`` that hold a key present in ``source``.

    Lets an incremental merge rewrite only those partitions (plus the new
    one) with dynamic partition overwrite instead of the whole table.
    """
    keys = _names(keys)
    return (target.select(partition_col, *keys)
                  .join(source.select(*keys), keys, "left_semi")
                  .select(partition_col).distinct())


def upsert_partitions(table, source: DataFrame, keys) -> list:
    """Keyed merge into a ``PartitionedTable``, rewriting only the touched partitions.

    Touched = partitions of the target that hold a source key (a key may move
    between partitions) plus the partitions the source rows fall into.  Only
    those are read and rewritten; where keys are is looked up in a key index
    beside the table (``sources.keyindex``), made by the first such merge.  The list of touched
    partition values -- a few dates -- is the only thing that reaches the
    driver.  Returns it.
    """
    keys = _names(keys)
    pcol = table.partition_col
    if pcol in keys:
        # the partition value is part of the key: a key cannot live anywhere else, so
        # the touched partitions are the source's own -- the target is neither
        # scanned nor even listed beyond those partitions
        touched = [r[0] for r in source.select(pcol).distinct().collect()]
        if not touched:
            return []
        part_rows = table.read_partitions(touched, schema=source.schema)
    else:
        # a key may have moved: its old partition is found in the key index, without one in a scan of (partition, key)
        index = KeyIndex(table, keys)
        known = index.exists()
        at = F.col(pcol).cast("string").alias("at")
        held = (index.partitions_of(source) if known else
                affected_partitions(table.read(), source, keys, pcol).select(at))
        touched = [r[0] for r in held.unionByName(source.select(at)).distinct().collect()]
        if not touched:
            return []
        part_rows = table.read_partitions(touched)
        nxt = upsert(part_rows, source.select(*part_rows.columns), keys)
        table.replace_partitions(nxt, touched, properties=index.moved(source) if known else None)
        if not known:
            index.build()
        kind = part_rows.schema[pcol].dataType
        return [r[0] for r in table.spark.createDataFrame([(t,) for t in touched], "at string")
                .select(F.col("at").cast(kind)).collect()]
    table.replace_partitions(upsert(part_rows, source.select(*part_rows.columns), keys), touched)
    return touched
