"""Where the keys of a partitioned table are: a bucketed table of key hashes beside it.

A merge must know which partitions hold the keys of its source. Without an index that takes a
scan of the whole key column. The index holds a row (two 64-bit hashes of the key, partition) for
every row of the table whose key has no null, partitioned by a bucket of the first hash: a merge
reads the buckets of its source's keys, at most one a key, whatever the size of the table.

The index is a ``PartitionedTable`` with states of its own. The table's manifest names the state
that describes its rows, so both change in one step: a merge publishes the next index first and
then the table with that state's number. After a stop in between, the table still names the
older state, and the next merge retracts what is newer. Changes of the table that don't come with
an index state leave it without one; the next merge scans once and builds it anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import KEY_INDEX, PartitionedTable

#: Keys of a bucket, about, when an index is built; and the fewest and most buckets.
KEYS_PER_BUCKET, FEWEST, MOST = 250_000, 16, 65_536


class KeyIndex:
    def __init__(self, table: PartitionedTable, keys: Sequence[str]):
        self.table = table
        self.keys = list(keys)
        self.rows = PartitionedTable(table.spark, f"{table.root}/_keys", "bucket", ["h1"])

    def _named(self) -> dict | None:
        """{state, buckets, keys} as the table names it, if it is an index of these keys."""
        found = self.table.key_index()
        return found if found and found["keys"] == self.keys else None

    def exists(self) -> bool:
        return self._named() is not None

    def _hashed(self, df: DataFrame, buckets: int, *extra: Column) -> DataFrame:
        """h1, h2 and bucket of the rows of ``df`` whose key has no null."""
        whole = F.lit(True)
        for k in self.keys:
            whole = whole & F.col(k).isNotNull()
        h1, h2 = F.xxhash64(*self.keys), F.xxhash64(F.lit(1), *reversed(self.keys))
        return df.where(whole).select(h1.alias("h1"), h2.alias("h2"), *extra, F.pmod(h1, F.lit(buckets)).cast("int").alias("bucket"))

    def _located(self, df: DataFrame, buckets: int) -> DataFrame:
        where = F.col(self.table.partition_col).cast("string").alias("at")
        return self._hashed(df, buckets, where).select("h1", "h2", "at", "bucket")

    def _of(self, source: DataFrame, named: dict) -> tuple[list[int], DataFrame]:
        """The buckets of the source's keys, and the index rows in them."""
        wanted = [r[0] for r in self._hashed(source, named["buckets"]).select("bucket").distinct().collect()]
        parts = self.rows.manifest(named["state"])["partitions"]
        held = {str(b): parts[str(b)] for b in wanted if str(b) in parts}
        return wanted, self.rows.read_folders(held, self.rows.manifest_schema(named["state"]))

    def partitions_of(self, source: DataFrame) -> DataFrame:
        """The partitions (as text, column ``at``) that hold a key of ``source``; reads those keys' buckets only."""
        named = self._named()
        _, rows = self._of(source, named)
        keys = self._hashed(source, named["buckets"]).select("h1", "h2").distinct()
        return rows.join(keys, ["h1", "h2"], "left_semi").select("at").distinct()

    def moved(self, source: DataFrame) -> dict:
        """The next index, with the keys of ``source`` where its rows are; the property that the table's next state takes."""
        named = self._named()
        while self.rows.current_version() != named["state"]:       # left by a merge that stopped before it published
            self.rows.rollback()
        buckets, rows = self._of(source, named)
        self.rows.current_state()
        new = self._located(source, named["buckets"])
        kept = rows.join(new.select("h1", "h2").distinct(), ["h1", "h2"], "left_anti").select("h1", "h2", "at", "bucket")
        return {KEY_INDEX: named | {"state": self.rows.replace_partitions(kept.unionByName(new), buckets)}}

    def build(self) -> None:
        """An index of the table's current state, made by one scan of its keys."""
        state = self.table.current_state()
        rows = self.table.read(state)
        n = rows.count()
        buckets = FEWEST
        while buckets < MOST and n / buckets > KEYS_PER_BUCKET:
            buckets *= 2
        self.rows.current_state()
        built = self.rows.write(self._located(rows, buckets))
        self.table.current_state()
        if self.table.current_version() == state:                   # else another change came first
            self.table.annotate({KEY_INDEX: {"state": built, "buckets": buckets, "keys": self.keys}})

    def vacuum(self, keep: int) -> list[str]:
        named = self._named()
        return self.rows.vacuum(keep, spare=[named["state"]] if named else []) if self.rows.exists() else []
