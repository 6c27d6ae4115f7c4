"""Keyed operators: latest row per key, distinct pairs, exact-duplicate handling.

Scale notes
-----------
* ``latest_per_key`` is ``row_number() = 1``: Spark's WindowGroupLimit keeps one
  row per key and map task before the shuffle, so a key that holds a third of
  all rows leaves each map task as ONE row.
* ``duplicate_report`` / ``collapse_duplicates`` group on all columns; the
  partial count / distinct collapses hot duplicate groups map-side as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import DEDUP_WINDOW_DAYS


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest_per_key(df: DataFrame, keys, order_by: Sequence[str], tiebreak: Sequence[str] = (),
                   nulls_first: bool = True) -> DataFrame:
    """Keep one row per key: the greatest ``order_by`` (DESC), then greatest ``tiebreak``.

    Same result as ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_by DESC
    NULLS FIRST, tiebreak DESC) = 1``.  ``nulls_first`` makes a NULL ordering
    value rank first (the source warehouse sorts NULL highest); tie-break
    columns rank NULL last.  The chosen row is deterministic when the
    tie-break columns are unique within a key.
    """
    keys = _names(keys)
    order: list[Column] = [F.col(c).desc_nulls_first() if nulls_first else F.col(c).desc_nulls_last() for c in order_by]
    order += [F.col(c).desc_nulls_last() for c in tiebreak]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", first).where(F.col("_rank") == 1).select(*df.columns)


def semi_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of ``left`` with at least one match in ``right`` on (left_col, right_col) pairs.

    Equal to an inner join against DISTINCT right keys that keeps only left
    columns: left duplicates are kept, NULL keys never match.

    The right keys are made DISTINCT first on purpose: the partial aggregate
    collapses repeated keys map-side, so a key holding a third of the right
    rows (one ticker-day traded all the time) reaches the shuffle as one row
    per map task.  AQE can split only the left side of a semi join, so the
    right side has to be de-skewed this way.
    """
    keys = right.select(*[F.col(rc).alias(f"_k{i}") for i, (_, rc) in enumerate(pairs)]).distinct()
    cond = None
    for i, (lc, _) in enumerate(pairs):
        e = left[lc] == keys[f"_k{i}"]
        cond = e if cond is None else cond & e
    return left.join(keys, cond, "left_semi")


def recent_predicate(date_col: str, as_of, days: int = DEDUP_WINDOW_DAYS) -> Column:
    """``date_col >= as_of - days`` (NULL dates are not recent)."""
    return F.col(date_col) >= F.date_sub(F.lit(as_of).cast("date"), days)


def duplicate_report(df: DataFrame, date_col: str, as_of, days: int = DEDUP_WINDOW_DAYS,
                     count_col: str = "n_copies") -> DataFrame:
    """Rows duplicated in full (GROUP BY every column HAVING COUNT(*) > 1), recent rows only."""
    cols = df.columns
    return (df.where(recent_predicate(date_col, as_of, days))
              .groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


def collapse_duplicates(df: DataFrame, date_col: str, as_of, days: int = DEDUP_WINDOW_DAYS,
                        ignore: Sequence[str] = ()) -> DataFrame:
    """Collapse full duplicates among recent rows to one copy; older and NULL-dated rows untouched.

    Exactly the source system's delete-then-reinsert:

    1. duplicate groups = recent rows grouped on every column, count > 1;
    2. delete every row that equals a group when all columns are compared as
       text with NULL taken as '' (so a NULL-valued row is also removed by a
       group holding '' in that column);
    3. insert one copy of each group.

    Without ''/NULL pairs this equals ``dropDuplicates`` on the recent rows.
    Only recent rows can match (the date is part of the comparison and the
    groups hold recent, non-NULL dates).

    Skew: everything after the first aggregate runs on *distinct* rows with
    their counts, so a duplicate group holding a third of all rows is one row
    from the map side on.  A row that survives the delete always had count 1
    (a repeated row is a group and matches itself), so nothing is re-expanded.

    ``ignore`` names bookkeeping columns (e.g. the load batch) left out of the
    comparison; a collapsed group keeps their greatest value.
    """
    cols = [c for c in df.columns if c not in ignore]
    recent = recent_predicate(date_col, as_of, days)
    rest = df.where(~recent | recent.isNull())
    counted = (df.where(recent).groupBy(*cols)
                 .agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in ignore]))
    groups = counted.where(F.col("_n") > 1).drop("_n")
    singles = counted.where(F.col("_n") == 1).drop("_n")
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_k{i}") for i, c in enumerate(cols)]
    group_keys = groups.select(*text).distinct()
    keyed_singles = singles.select(*cols, *ignore, *text)
    cond = None
    for i in range(len(cols)):
        e = keyed_singles[f"_k{i}"] == group_keys[f"_k{i}"]
        cond = e if cond is None else cond & e
    survivors = keyed_singles.join(group_keys, cond, "left_anti").select(*cols, *ignore)
    return survivors.unionByName(groups).unionByName(rest).select(*df.columns)
