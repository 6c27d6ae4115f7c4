"""Slowly changing dimension, type 2, timestamp strategy.

``apply`` takes the current snapshot table and the current source (one row
per key) and returns the next snapshot:

* key new (no open row)                   -> open row, valid_from = updated_at
* source updated_at > open row updated_at -> close the open row at the source
  updated_at, open a new row
* updated_at equal or older               -> nothing changes
* open row whose key left the source      -> closed at the run time (hard delete)
* a key that returns after a hard delete  -> a new open row

Only open rows take part in the join; closed history is passed through by
a union, so the shuffle is the size of the current dimension, not of its
history.  The snapshot columns are named as the source system exposes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCD_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
SCD_COLUMNS = (SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO)


def scd_id(key: str, updated_at: str) -> Column:
    """md5 of ``key|updated_at`` as text (NULL as '')."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")),
                             F.coalesce(F.col(updated_at).cast("string"), F.lit(""))))


def initial(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """First snapshot: every source row open from its own updated_at."""
    return source.select(
        *source.columns,
        scd_id(key, updated_at).alias(SCD_ID),
        F.col(updated_at).alias(UPDATED_AT),
        F.col(updated_at).alias(VALID_FROM),
        F.lit(None).cast(source.schema[updated_at].dataType).alias(VALID_TO),
    )


def apply(snapshot: DataFrame, source: DataFrame, key: str, updated_at: str, run_ts,
          columns: Sequence[str] | None = None, invalidate_hard_deletes: bool = True) -> DataFrame:
    """Next snapshot version (see module doc).  ``run_ts`` closes hard-deleted rows."""
    columns = list(columns or source.columns)
    src = source.select(*columns)
    ts_type = source.schema[updated_at].dataType
    run_ts_col = F.lit(run_ts).cast(ts_type)
    snap_cols = columns + list(SCD_COLUMNS)

    closed = snapshot.where(F.col(VALID_TO).isNotNull())
    open_rows = snapshot.where(F.col(VALID_TO).isNull())

    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in columns])
    j = open_rows.join(s, open_rows[key] == s[f"_s_{key}"], "full_outer")
    has_open = F.col(SCD_ID).isNotNull()
    has_src = F.col(f"_s_{key}").isNotNull()
    newer = has_open & has_src & (F.col(f"_s_{updated_at}") > F.col(UPDATED_AT))

    # open rows: closed by a newer version, closed by a hard delete, or kept
    if invalidate_hard_deletes:
        valid_to = (F.when(newer, F.col(f"_s_{updated_at}"))
                     .when(has_open & ~has_src, run_ts_col)
                     .otherwise(F.lit(None).cast(ts_type)))
    else:
        valid_to = F.when(newer, F.col(f"_s_{updated_at}")).otherwise(F.lit(None).cast(ts_type))
    old_side = j.where(has_open).select(
        *[F.col(c) for c in columns], F.col(SCD_ID), F.col(UPDATED_AT), F.col(VALID_FROM),
        valid_to.alias(VALID_TO))

    # new open rows: key has no open row, or the source is newer
    opened = j.where(has_src & (~has_open | newer)).select(
        *[F.col(f"_s_{c}").alias(c) for c in columns])
    opened = initial(opened, key, updated_at)

    return closed.select(*snap_cols).unionByName(old_side.select(*snap_cols)).unionByName(
        opened.select(*snap_cols))


def hard_deleted(snapshot: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Open rows whose key is gone from the source (closed at run time by ``apply``)."""
    open_rows = snapshot.where(F.col(VALID_TO).isNull())
    keys = source.select(F.col(key).alias("_k"))
    return open_rows.join(keys, open_rows[key] == keys["_k"], "left_anti")


def current(snapshot: DataFrame) -> DataFrame:
    """Current rows: those not yet closed."""
    return snapshot.where(F.col(VALID_TO).isNull())
