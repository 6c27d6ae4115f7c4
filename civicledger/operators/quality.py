"""Data-quality checks as DataFrames, and the write-audit-publish gate.

Every check returns rows ``(model, test_name, column_name, failures)``; a check passes
when ``failures = 0``.  All checks are aggregates (one pass per model for
not_null, one partial-aggregated group-by per unique test, one anti join per
relationship), so they scale with the table like any other query.  Only the
tiny report -- one row per check -- reaches the driver when the gate decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import FRESHNESS_ERROR_DAYS, FRESHNESS_WARN_DAYS

REPORT_COLUMNS = ("model", "test_name", "column_name", "failures")


def _report(df: DataFrame, model: str, check: str, column: str) -> DataFrame:
    return df.select(F.lit(model).alias("model"), F.lit(check).alias("test_name"),
                     F.lit(column).alias("column_name"),
                     F.col("failures").cast("bigint").alias("failures"))


def check_not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Count NULLs of every listed column in ONE scan, then unpivot to one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])
    tidy = counts.unpivot([], list(columns), "column_name", "failures")
    return tidy.select(F.lit(model).alias("model"), F.lit("not_null").alias("test_name"),
                       F.col("column_name"), F.col("failures").cast("bigint").alias("failures"))


def check_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dups = (df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1))
    return _report(dups.agg(F.count(F.lit(1)).alias("failures")), model, "unique", column)


def check_unique_combo(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Number of column combinations (NULLs included) that occur more than once."""
    dups = df.groupBy(*columns).count().where(F.col("count") > 1)
    return _report(dups.agg(F.count(F.lit(1)).alias("failures")), model,
                   "unique_combination_of_columns", ",".join(columns))


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    p = parent.select(F.col(parent_col).alias("_p")).distinct()
    return (child.where(F.col(child_col).isNotNull())
                 .join(p, child[child_col] == p["_p"], "left_anti"))


def check_relationships(child: DataFrame, parent: DataFrame, model: str, child_col: str,
                        parent_col: str) -> DataFrame:
    failures = orphans(child, parent, child_col, parent_col).agg(F.count(F.lit(1)).alias("failures"))
    return _report(failures, model, "relationships", child_col)


def check_unique_against(table: DataFrame, new_rows: DataFrame, model: str, column: str) -> DataFrame:
    """``unique`` for a table that passed before and just received ``new_rows``.

    Only a value carried by a new row can now repeat, so the table is read
    for those values alone (a semi join on one column) instead of grouping
    the whole table.  Same verdict as ``check_unique`` on the merged table
    whenever the table was unique before the merge.
    """
    values = new_rows.where(F.col(column).isNotNull()).select(column).distinct()
    dups = (table.join(values, column, "left_semi").groupBy(column).count()
                 .where(F.col("count") > 1))
    return _report(dups.agg(F.count(F.lit(1)).alias("failures")), model, "unique", column)


@dataclass
class ModelTests:
    """Declared tests of one model (the yml of the source project, as data)."""

    model: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    unique_combos: Sequence[Sequence[str]] = ()
    relationships: Sequence[tuple[str, str, str]] = field(default_factory=tuple)  # (col, parent model, parent col)


def check_not_null_and_unique(df: DataFrame, model: str, columns: Sequence[str], key: str) -> DataFrame:
    """``not_null`` on ``columns`` and ``unique`` on ``key`` in ONE pass over ``df``.

    One group-by on the key carries per-group NULL counts; a global aggregate
    then sums them and counts the repeated keys.  The model is read (or
    computed) once instead of twice, and the partial aggregate still
    collapses a hot key map-side.
    """
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(columns)])
    totals = per_key.agg(
        *[F.coalesce(F.sum(f"_null{i}"), F.lit(0)).cast("bigint").alias(c) for i, c in enumerate(columns)],
        F.count_if((F.col("_rows") > 1) & F.col(key).isNotNull()).cast("bigint").alias("_unique"))
    # one unpivot of the single totals row (a union of two selects would
    # compute the model twice)
    tidy = totals.unpivot([], list(columns) + ["_unique"], "_col", "failures")
    is_unique = F.col("_col") == F.lit("_unique")
    return tidy.select(
        F.lit(model).alias("model"),
        F.when(is_unique, F.lit("unique")).otherwise(F.lit("not_null")).alias("test_name"),
        F.when(is_unique, F.lit(key)).otherwise(F.col("_col")).alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"))


def run_tests(frames: dict[str, DataFrame], specs: Sequence[ModelTests]) -> DataFrame:
    """All declared checks of all models as one tidy report DataFrame.

    A model's not_null checks ride along with its first unique check (one
    pass); further unique columns, combinations and relationships each add
    one aggregate or anti join.
    """
    parts: list[DataFrame] = []
    for spec in specs:
        df = frames[spec.model]
        unique = list(spec.unique)
        if spec.not_null and unique:
            parts.append(check_not_null_and_unique(df, spec.model, spec.not_null, unique.pop(0)))
        elif spec.not_null:
            parts.append(check_not_null(df, spec.model, spec.not_null))
        parts.extend(check_unique(df, spec.model, c) for c in unique)
        parts.extend(check_unique_combo(df, spec.model, list(cs)) for cs in spec.unique_combos)
        parts.extend(check_relationships(df, frames[pm], spec.model, c, pc)
                     for c, pm, pc in spec.relationships)
    return reduce(DataFrame.unionByName, parts)


class AuditFailed(RuntimeError):
    def __init__(self, failures: list[dict]):
        self.failures = failures
        lines = ", ".join(f"{f['model']}.{f['column_name']} {f['test_name']}={f['failures']}"
                          for f in failures)
        super().__init__(f"audit failed: {lines}")


def gate(report: DataFrame) -> list[dict]:
    """Raise ``AuditFailed`` when any check failed; return the (small) report otherwise."""
    rows = [r.asDict() for r in report.collect()]   # one row per declared check
    bad = [r for r in rows if r["failures"]]
    if bad:
        raise AuditFailed(bad)
    return rows


def source_freshness(tables: dict[str, tuple[DataFrame, str]], as_of,
                     warn_days: int = FRESHNESS_WARN_DAYS,
                     error_days: int = FRESHNESS_ERROR_DAYS) -> DataFrame:
    """Per table: latest load time, its age in seconds at ``as_of``, and pass / warn / error."""
    as_of_ts = F.lit(as_of).cast("timestamp_ntz")
    parts = []
    for name, (df, ts_col) in tables.items():
        parts.append(df.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("max_loaded_at"))
                       .select(F.lit(name).alias("table_name"), "max_loaded_at"))
    latest = reduce(DataFrame.unionByName, parts)
    age = (F.unix_timestamp(as_of_ts) - F.unix_timestamp(F.col("max_loaded_at"))).cast("bigint")
    status = (F.when(F.col("age_seconds").isNull(), F.lit("error"))
               .when(F.col("age_seconds") > error_days * 86400, F.lit("error"))
               .when(F.col("age_seconds") > warn_days * 86400, F.lit("warn"))
               .otherwise(F.lit("pass")))
    return latest.withColumn("age_seconds", age).withColumn("status", status)
