"""Published tables laid out once more in buckets of their join keys, so that joining them needs no shuffle.

    <root>/data/w=<id>/colocated_table=<table>/...parquet     rows of some partitions, in buckets of the keys
    <root>/_manifests/m=00000007.json                         which folder stands for which partition, of which states

A refresh compares the partitions of the states it follows with those of the states it stands for and
writes only the changed ones, to a folder of its own; older folders keep their files, and a reader
leaves the partitions out that a newer folder holds.  Once there are ``LAYERS`` folders, or the number of
buckets no longer fits the tables, everything is written anew.  One entry of the log names the states of all
tables, so a reader gets buckets of exactly these states or ``None``, and then joins the tables themselves.

A key that fills one bucket would be one task of the join, which adaptive execution cannot split without
a shuffle: ``read`` measures the buckets' files and also gives ``None`` where one is too large.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import PACKED, PartitionedTable

#: Folders from which a refresh writes everything anew.
LAYERS = 16
#: Bytes of a bucket that a (re)build aims at; never fewer than shuffle partitions.
BUCKET_BYTES = 128 * 1024 * 1024
#: Files at most that a bucket of one folder is written by, so that a hot key is not one writer's.
SPREAD = 4
#: A bucket of more than SKEW_FACTOR times the median and more than SKEW_BYTES is left to shuffled, split joins.
SKEW_FACTOR, SKEW_BYTES = 5, 256 * 1024 * 1024
#: Folder levels of the layout, read as partition columns beside the tables' own.
WRITE, TABLE = "w", "colocated_table"
MANAGED = "spark.sql.hive.manageFilesourcePartitions"
BUCKET_RE = re.compile(r"_(\d+)(?:\..*)?$")


class Colocated:
    """Co-bucketed layout of several ``PartitionedTable``s; ``keys`` names the bucket columns of each, in join order."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, PartitionedTable],
                 keys: dict[str, Sequence[str]]):
        self.spark = spark
        self.tables = tables
        self.keys = {n: list(k) for n, k in keys.items()}          # no table may have columns named WRITE or TABLE
        self._log = PartitionedTable(spark, root, "none")

    def exists(self) -> bool:
        return self._log.exists()

    def vacuum(self, keep: int = 3) -> list[str]:
        return self._log.vacuum(keep)

    # -- writing ----------------------------------------------------------------
    def refresh(self, state: dict[str, int], buckets: int | None = None) -> int | None:
        """Lay ``state`` (table -> version) out; the new entry, or None where the layout stands for it already.

        A refresh computed beside another one fails with ``PublishConflict``, like any change of a table.
        """
        m = self._log.manifest(self._log.current_state())
        after = self._log._after()
        state = {n: state[n] for n in self.tables}
        noted = {"tables": {}, "buckets": None} if m is None else m["properties"]
        if noted["tables"] == state and buckets in (None, noted["buckets"]):
            return None
        now = {n: t.manifest(state[n])["partitions"] for n, t in self.tables.items()}
        old = None if m is None else self._followed(noted["tables"])
        count = buckets or self._count(now)
        if buckets is None and old is not None and count < 4 * noted["buckets"] and noted["buckets"] < 4 * count:
            count = noted["buckets"]
        if old is None or count != noted["buckets"] or len(self._folders(m["partitions"])) >= LAYERS:
            old = {n: {} for n in self.tables}
        name, _ = self._log._begin()
        parts = {}
        for n, table in self.tables.items():
            changed = {v: ws for v, ws in now[n].items() if old[n].get(v) != ws}
            parts |= {f"{n}/{v}": m["partitions"][f"{n}/{v}"] for v in now[n] if v not in changed}
            if changed:
                rows = table.read_folders(changed, table.manifest_schema(state[n]))
                self._write(rows, self.keys[n], self._folder(name, n), count)
                self._log._fs.write_text(f"{self._folder(name, n)}/_values.json", json.dumps(sorted(changed)))
                parts |= {f"{n}/{v}": [name] for v in changed}
        return self._log._publish(T.StructType(), parts, {"tables": state, "buckets": count}, after, name)

    def _followed(self, state: dict[str, int]) -> dict[str, dict] | None:
        """The partitions of the states that the layout stands for; None if one of them was vacuumed."""
        if any(state.get(n) not in t._log()[0] for n, t in self.tables.items()):
            return None
        return {n: t.manifest(state[n])["partitions"] for n, t in self.tables.items()}

    @staticmethod
    def _folders(parts: dict[str, list[str]]) -> set[str]:
        return {w for ws in parts.values() for w in ws}

    def _count(self, now: dict[str, dict]) -> int:
        fs = self._log._fs
        sizes = [sum(fs.size(f"{t.data_path}/w={w}") for w in {w.removeprefix(PACKED) for w in self._folders(now[n])})
                 for n, t in self.tables.items()]
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-max(sizes) // BUCKET_BYTES))

    def _write(self, rows: DataFrame, keys: list[str], folder: str, buckets: int) -> None:
        salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD))
        name = f"colocated_{uuid.uuid4().hex}"
        (rows.repartition(*keys, salt).write.mode("error").format("parquet").bucketBy(buckets, *keys)
         .option("path", folder).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")            # an external table: its files stay
        self._log._committed(folder)

    # -- reading ----------------------------------------------------------------
    def read(self, state: dict[str, int]) -> dict[str, DataFrame] | None:
        """The tables in ``state``, in buckets; None where the layout does not stand for it or a bucket is too large."""
        m = self._log.manifest()
        if m is None or m["properties"]["tables"] != {n: state.get(n) for n in self.tables}:
            return None
        out = {}
        for n, table in self.tables.items():
            held: dict[str, set[str]] = {}
            for at, ws in m["partitions"].items():
                if at.startswith(f"{n}/"):
                    held.setdefault(ws[0], set()).add(at[len(n) + 1:])
            schema = table.manifest_schema(state[n])
            if not held:
                out[n] = self.spark.createDataFrame([], schema)
                continue
            if self._skewed([self._folder(w, n) for w in held], m["properties"]["buckets"]):
                return None
            rows = self._bucketed(schema, self.keys[n], m["properties"]["buckets"]).where(
                (F.col(TABLE) == n) & F.col(WRITE).isin(sorted(held)))
            for w, values in held.items():
                gone = set(json.loads(self._log._fs.read_text(f"{self._folder(w, n)}/_values.json"))) - values
                if gone:
                    past = table._one_of(sorted(gone), schema[table.partition_col].dataType)
                    rows = rows.where((F.col(WRITE) != w) | ~F.coalesce(past, F.lit(False)))
            out[n] = rows.drop(WRITE, TABLE)
        return out

    def _folder(self, w: str, n: str) -> str:
        return f"{self._log.data_path}/{WRITE}={w}/{TABLE}={n}"

    def _skewed(self, folders, buckets: int) -> bool:
        size = [0] * buckets
        for folder in folders:
            for name, length in self._log._fs.files(folder):
                if found := BUCKET_RE.search(name):
                    size[int(found.group(1))] += length
        return max(size) > max(SKEW_BYTES, SKEW_FACTOR * sorted(size)[buckets // 2])

    def _bucketed(self, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
        """All folders as one table in buckets, which only this frame knows; its partitions are folders, not catalog entries."""
        name = f"colocated_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{k}`" for k in keys)
        at = self._log.data_path.replace("'", "\\'")
        managed = self.spark.conf.get(MANAGED)
        self.spark.conf.set(MANAGED, "false")
        try:
            self.spark.sql(f"CREATE TABLE {name} ({columns}, `{WRITE}` string, `{TABLE}` string) USING parquet "
                           f"PARTITIONED BY (`{WRITE}`, `{TABLE}`) CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{at}'")
            rows = self.spark.table(name)
            self.spark.sql(f"DROP TABLE {name}")
        finally:
            self.spark.conf.set(MANAGED, managed)
        return rows
