"""Backfill over a range of report dates as ONE Spark job.

Replaying the daily job date by date leaves, per key, the row of the latest
report date on which the key appeared (each daily merge replaces
unconditionally), and within that date the daily latest-row rule.  So the
whole range is one aggregate ordered by (report_date, then the daily order)
followed by one merge -- instead of N sequential jobs each rewriting the
table.  The result equals the day-by-day replay.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import latest_per_key
from ..operators.merge import upsert
from ..sources.store import _FS
from . import models as M


def windows(start: dt.date, end: dt.date, days: int | None) -> Iterator[tuple[dt.date, dt.date]]:
    """The range [start, end] in consecutive windows of ``days`` days (one window if None)."""
    while start <= end:
        last = end if days is None else min(end, start + dt.timedelta(days=days - 1))
        yield start, last
        start = last + dt.timedelta(days=1)


class Progress:
    """How far a backfill of one range has come, kept in a file under the warehouse root until it is through."""

    def __init__(self, spark: SparkSession, root: str, start: dt.date, end: dt.date):
        self._fs = _FS(spark, root)
        self.path = f"{root}/_backfill/{start}_{end}.json"
        held = json.loads(self._fs.read_text(self.path)) if self._fs.exists(self.path) else {}
        self.done_through = dt.date.fromisoformat(held["done_through"]) if held else None

    def finished(self, last: dt.date) -> None:
        self.done_through = last
        self._fs.write_text(self.path, json.dumps({"done_through": str(last)}))

    def close(self) -> None:
        self._fs.delete(self.path)


def report_range(df: DataFrame, start, end, col: str = "report_date") -> DataFrame:
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def backfill_officials(published: DataFrame, src: DataFrame, states: DataFrame, start, end) -> DataFrame:
    """Officials after replaying every report date in [start, end] onto ``published``."""
    latest = M.officials(report_range(src, start, end), states,
                         order_by=("report_date", "member_updated"))
    return upsert(published, latest, "member_id")


def last_report_per_trade(trades: DataFrame) -> DataFrame:
    """One row per transaction: the one of its latest report date (later merges replace earlier)."""
    return latest_per_key(trades, "transaction_id", ["report_date"], ["trade_record_id"],
                          nulls_first=False)
