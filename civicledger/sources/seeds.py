"""The states seed: a CSV with a header, read with its own declared schema.

Fixed values: the 50 US states with their two-letter codes and ISO 3166-2
codes (``seed_data/states.csv``).  DC and the territories are absent on
purpose, so their officials decode to UNKNOWN, as in the source warehouse.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .schemas import STATES

DEFAULT_STATES_CSV = os.path.join(os.path.dirname(os.path.abspath(__file__)), "seed_data", "states.csv")


def read_seed(spark: SparkSession, path: str = DEFAULT_STATES_CSV, schema=STATES) -> DataFrame:
    """Header CSV with a declared schema (the header only names columns, case-insensitively)."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)


def seed_rows(path: str = DEFAULT_STATES_CSV) -> list[tuple]:
    """The packaged seed's rows (a fixed, bounded list of constants)."""
    import csv
    with open(path, newline="", encoding="utf-8") as f:
        rows = list(csv.reader(f))
    return [tuple(r) for r in rows[1:] if r]


def load_seed(spark: SparkSession, table, path: str = DEFAULT_STATES_CSV) -> int:
    """Load the packaged seed into a versioned table on shared storage.

    Executors then read the seed from the warehouse, never from a path that
    exists only on the driver's disk.
    """
    df = spark.createDataFrame(seed_rows(path), STATES)
    return table.write(df.coalesce(1), refuse_empty=True)
