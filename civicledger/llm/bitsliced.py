"""Exact top-k inner products over a bit-sliced index.

The index holds blocks of quantised vectors. For each component a block keeps
one bitmap per binary place (a slice), a bit per vector. A query's scores are
sums of slices: a slice of place b is added at place b + e for every binary
place e of the query's component (complemented slices where the component is
negative, which shifts all scores of the block by the same number). Carry-save
adders on whole bitmaps leave one bitmap per place of the score. The top rows
are selected from the highest place downward: rows with the bit set are surely
in, or the only ones still in question. Rows tied at the boundary go by the
smaller id, and the scores of the rows taken are computed exactly.

A block holds about ``block_rows`` vectors (fewer where they are long), stored
as bundles of bounded size, and meets the queries in chunks of fixed size; each
pair of block and chunk gives k rows a query, which a last ranking merges.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part, nor do rows with a null id; a query meets only vectors
of its own dimension; rows that repeat a query's id are not its candidates;
repeated candidate rows are ranked each; components of 2^62 and more after
scaling, and results whose score is no 64-bit number, raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, lean

LARGEST = 1 << 62
#: Components in a bundle (a row of the index) and in a block (what a task searches), at most about so many.
BUNDLE_COMPONENTS, BLOCK_COMPONENTS = 1 << 17, 1 << 22


def usable(vector: Column) -> Column:
    """Not null, not empty, every component a finite number."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))), F.lit(False))


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def pack(bits: np.ndarray) -> np.ndarray:
    """A boolean array as words of 64 bits."""
    out = np.packbits(bits, bitorder="little")
    return np.pad(out, (0, -len(out) % 8)).view(np.uint64)


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little")[:n])


class Slices:
    """The bit slices of a block of whole-number vectors (rows x components)."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.values = values
        low = values.min(axis=0)
        rise = (values - low).T
        self.all = pack(np.ones(self.n, bool))
        self.places = [max(1, int(r.max()).bit_length()) for r in rise]
        self.plain = [[pack((r >> b) & 1 > 0) for b in range(p)] for r, p in zip(rise, self.places, strict=True)]
        self.turned = [[x ^ self.all for x in some] for some in self.plain]

    def score_slices(self, query: np.ndarray) -> list[np.ndarray]:
        """Bitmaps of the scores' binary places, lowest first; all scores are shifted by one number."""
        heaps: list[list[np.ndarray]] = []
        for d, q in enumerate(query.tolist()):
            some = self.plain[d] if q > 0 else self.turned[d]
            q, e = abs(q), 0
            while q:
                if q & 1:
                    while len(heaps) < e + len(some):
                        heaps.append([])
                    for b, x in enumerate(some):
                        heaps[e + b].append(x)
                q >>= 1
                e += 1
        out, w = [], 0
        while w < len(heaps):
            heap = heaps[w]
            if len(heap) > 1 and w + 1 == len(heaps):
                heaps.append([])
            carries = heaps[w + 1] if w + 1 < len(heaps) else []
            while len(heap) > 2:
                a, b, c = heap.pop(), heap.pop(), heap.pop()
                x = a ^ b
                carries.append((a & b) | (x & c))
                heap.append(x ^ c)
            if len(heap) == 2:
                a, b = heap
                carries.append(a & b)
                heap = [a ^ b]
            out.append(heap[0] if heap else np.zeros_like(self.all))
            w += 1
        return out

    def top(self, query: np.ndarray, k: int, candidates: np.ndarray) -> np.ndarray:
        """Places of the k best of ``candidates`` (a bitmap); ties go to the earlier place."""
        sure, open_ = np.zeros_like(self.all), candidates
        if int(np.bitwise_count(open_).sum()) <= k:
            return unpack(open_, self.n)
        have = 0
        for s in reversed(self.score_slices(query)):
            more = open_ & s
            n = int(np.bitwise_count(more).sum())
            if have + n > k:
                open_ = more
            else:
                sure, have = sure | more, have + n
                open_ = open_ & ~s
                if have == k:
                    break
        return np.concatenate([unpack(sure, self.n), unpack(open_, self.n)[:k - have]])


def products(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of rows with ``query``, by whole numbers of any size where 64 bits might not do."""
    if not len(values) or np.abs(values).max() * float(np.abs(query).astype(float).sum()) < LARGEST:
        return values @ query
    found = [sum(a * b for a, b in zip(row, query.tolist(), strict=True)) for row in values.tolist()]
    if any(not -(1 << 63) <= x < 1 << 63 for x in found):
        raise ValueError("a score is too large for a 64-bit number")
    return np.array(found, np.int64)


ROW = "block bigint, part int, kind int, dim int, place bigint, ids binary, vectors binary"


def _bundle(kind: int, most: int):
    """Rows (block, id, v), sorted by block, dimension and id -> bundles of at most ``most`` vectors and bounded size.

    ``place`` is the order of a block's bundles.
    """

    def emit(block, ids, values, place):
        ids, values = np.concatenate(ids), np.concatenate(values)
        narrow = values.astype(np.int32)
        if values.max() >= LARGEST or values.min() <= -LARGEST:
            raise ValueError("a component is too large for the index")
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([0], pa.int32()), pa.array([kind], pa.int32()),
             pa.array([values.shape[1]], pa.int32()), pa.array([place], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
             pa.array([(narrow if (narrow == values).all() else values).tobytes()], pa.binary())],
            ["block", "part", "kind", "dim", "place", "ids", "vectors"])

    def run(batches):
        now, ids, values, n, place = None, [], [], 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            block, every, flat = (b.column("block").to_numpy(), b.column("id").to_numpy(),
                                  b.column("v").flatten().to_numpy(zero_copy_only=False))
            dim = pc.list_value_length(b.column("v")).to_numpy()
            ends = np.cumsum(dim, dtype=np.int64)
            runs = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (dim[1:] != dim[:-1]), [True]]))
            for lo, hi in zip(runs[:-1].tolist(), runs[1:].tolist(), strict=True):
                key, d = (int(block[lo]), int(dim[lo])), int(dim[lo])
                if n and key != now:
                    yield emit(now[0], ids, values, place)
                    ids, values, n, place = [], [], 0, place + 1
                now, room = key, min(most, max(1, BUNDLE_COMPONENTS // d))
                while lo < hi:
                    to = min(hi, lo + room - n)
                    # copies: a batch is freed when it is read
                    ids.append(every[lo:to].copy())
                    values.append(flat[ends[lo] - d:ends[to - 1]].reshape(-1, d).copy())
                    n, lo = n + to - lo, to
                    if n == room:
                        yield emit(now[0], ids, values, place)
                        ids, values, n, place = [], [], 0, place + 1
        if n:
            yield emit(now[0], ids, values, place)
    return run


def _search(k: int, most: int):
    """Rows of a (block, part), the block's bundles first -> k rows for each query of the chunks behind them.

    Bundles of a dimension make slices of up to about ``most`` vectors.
    """

    def run(batches):
        now, slices, held, n = None, [], [], 0
        for b in batches:
            cols = [b.column(c) for c in ("block", "part", "kind", "dim", "ids", "vectors")]
            for i in range(b.num_rows):
                key = (cols[0][i].as_py(), cols[1][i].as_py())
                dim = cols[3][i].as_py()
                ids = np.frombuffer(cols[4][i].as_buffer(), np.int64)
                # components take 4 bytes where all of a bundle fit
                raw = cols[5][i].as_buffer()
                v = np.frombuffer(raw, np.int32 if raw.size == 4 * dim * len(ids) else np.int64)
                v = v.reshape(-1, dim).astype(np.int64)
                if key != now:
                    now, slices, held, n = key, [], [], 0
                index = cols[2][i].as_py() == 0
                if held and (not index or held[0][1].shape[1] != dim or n + len(ids) > most):
                    have = np.concatenate([x[0] for x in held])
                    slices.append((held[0][1].shape[1], have, Slices(np.concatenate([x[1] for x in held]))))
                    held, n = [], 0
                if index:
                    held.append((ids.copy(), v))
                    n += len(ids)
                    continue
                out = []
                for d, have, s in slices:
                    if d != dim:
                        continue
                    for qid, q in zip(ids.tolist(), v, strict=True):
                        own = pack(have == qid)
                        at = s.top(q, k, s.all & ~own)
                        out.append((np.full(len(at), qid), have[at], products(s.values[at], q)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[j] for o in out]).astype(np.int64))
                                                      for j in range(3)], ["query_id", "vec_id", "score"])
    return run


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64,
          id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 32768, chunk: int = 64,
          chunks_per_part: int = 8) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of every query, ties to the smaller id."""
    scratch = Scratch(spark, "bitsliced")
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = scratch.stage(rows, "quantised")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q"), F.max(F.size("v")).alias("dim")).first()
    if not size["n"] or not size["q"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    block_rows = min(block_rows, max(64, BLOCK_COMPONENTS // size["dim"]))
    blocks, chunks = -(-size["n"] // block_rows), -(-size["q"] // chunk)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a part has a copy of each block: no more parts than it takes to have a task for every partition
    parts = min(-(-chunks // chunks_per_part), max(1, -(-spread // blocks)))

    def bundles(df, count, kind, most):
        # dealt by id and a row's own number: repeated ids do not meet in one block
        dealt = df.select(F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(count)).alias("block"), "id", "v")
        return (dealt.repartition(max(1, min(count, spread)), "block")
                .sortWithinPartitions("block", F.size("v"), "id").mapInArrow(lean(_bundle(kind, most)), ROW))

    index = scratch.stage(bundles(rows, blocks, 0, 2 * block_rows), "index")
    asked = scratch.stage(bundles(rows.where("q"), chunks, 1, 2 * chunk), "queries")
    scratch.drop("quantised")
    every = lambda n, t: F.explode(F.sequence(F.lit(0).cast(t), F.lit(n - 1).cast(t)))
    # the stated queries meet all blocks: each part has its share of the chunks and a copy of one block
    work = index.select("block", every(parts, "int").alias("part"), "kind", "dim", "place", "ids", "vectors").unionByName(
        asked.select(every(blocks, "long").alias("block"), F.pmod("block", F.lit(parts)).cast("int").alias("part"),
                     "kind", "dim", "place", "ids", "vectors"))
    found = (work.repartition(blocks * parts, "block", "part")
             .sortWithinPartitions("block", "part", "kind", "dim", "place")
             .mapInArrow(lean(_search(k, 2 * block_rows)), "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
