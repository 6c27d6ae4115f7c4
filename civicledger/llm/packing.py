"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens; full pieces are
sequences of their own. The others are dealt into problems of bounded size.
Every problem is evolved on several islands: an individual is a whole grouping
of pieces into bins; crossover injects whole well-filled bins of one parent
into another, drops the bins that hold duplicates and best-fits the displaced
pieces. Between epochs each island's elite migrates to the next island. The
least filled bins of all problems are dissolved and packed again together,
level by level, until one problem is left. A problem is bounded by its pieces
but holds several bins' tokens, and every level has at most half the problems
of the one before, so small pieces cannot keep the levels going.

Every random choice is seeded by level, problem, island and epoch, and each
step's result is written to shared storage, so a lost executor changes nothing.

Defined cases: a null or empty text is one piece of one token (the end mark);
null or repeated ids keep one piece list per row; an empty table packs to an
empty result; extra input columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import encoder, load_spec, text_blocks

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of each document: its ids and the end mark, cut only where longer than ``capacity``."""
    shared = spark.sparkContext.broadcast(load_spec(tokenizer_path))
    end = int(end_id).to_bytes(4, "little")

    def cut(batches):
        enc = encoder(shared.value)
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for first, block in text_blocks(b, "text"):
                out = []
                for k, raw in enumerate(enc.encode(block)):
                    raw += end
                    n = len(raw) // 4
                    for piece, start in enumerate(range(0, n, capacity)):
                        stop = min(start + capacity, n)
                        out.append((ids[first + k], piece, start, stop - start,
                                    zlib.crc32(raw[4 * start:4 * stop])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(),
                                                                pa.int64(), pa.int64()), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(cut, PIECES)


# --- one island -----------------------------------------------------------------------------

def best_fit(lengths: np.ndarray, order, bins: np.ndarray, free: list[int], capacity: int) -> None:
    """Puts the pieces of ``order`` into the fullest bin that holds them, or a new bin. In place."""
    tight = sorted((f << 20) | i for i, f in enumerate(free) if f > 0)
    for item in order:
        size = int(lengths[item])
        k = bisect.bisect_left(tight, size << 20)
        if k < len(tight):
            code = tight.pop(k)
            i, left = code & 0xFFFFF, (code >> 20) - size
        else:
            i, left = len(free), capacity - size
            free.append(left)
        free[i] = left
        bins[item] = i
        if left:
            bisect.insort(tight, (left << 20) | i)


def compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewest bins first, then bins as unevenly filled as can be (mean square fill)."""
    fill = np.bincount(bins, weights=lengths)
    return -len(fill), float(np.mean((fill / capacity) ** 2))


def rebuild(lengths: np.ndarray, bins: np.ndarray, displaced: np.ndarray, capacity: int) -> np.ndarray:
    """``displaced`` (a mask) leave their bins and are best-fitted, longest first."""
    out = bins.copy()
    items = np.flatnonzero(displaced)
    kept = np.flatnonzero(~displaced)
    out[kept] = compact(bins[kept]) if len(kept) else bins[kept]
    fill = np.bincount(out[kept], weights=lengths[kept]) if len(kept) else np.empty(0)
    free = (capacity - fill).astype(np.int64).tolist()
    best_fit(lengths, items[np.argsort(-lengths[items], kind="stable")], out, free, capacity)
    return out


def crossover(lengths, a, b, capacity, rng) -> np.ndarray:
    """Whole well-filled bins of ``b`` go into ``a``; bins of ``a`` that share a piece with them dissolve."""
    fill = np.bincount(b, weights=lengths)
    good = fill >= np.median(fill)
    chosen = good & (rng.random(len(fill)) < 0.3)
    injected = chosen[b]
    hit = np.zeros(a.max() + 1, bool)
    hit[a[injected]] = True
    child = a.astype(np.int64)
    child[injected] = a.max() + 1 + b[injected]
    displaced = hit[a] & ~injected
    return rebuild(lengths, child, displaced, capacity)


def mutate(lengths, a, capacity, rng) -> np.ndarray:
    """The least filled bins and some others dissolve."""
    fill = np.bincount(a, weights=lengths)
    out = rng.random(len(fill)) < 0.03
    out[np.argsort(fill, kind="stable")[: max(1, len(fill) // 50)]] = True
    return rebuild(lengths, a, out[a], capacity)


def first_population(lengths: np.ndarray, capacity: int, size: int, rng) -> list[np.ndarray]:
    people = []
    for k in range(size):
        noise = 1 + (0.25 * rng.random(len(lengths)) if k else 0)
        bins = np.zeros(len(lengths), np.int64)
        best_fit(lengths, np.argsort(-lengths * noise, kind="stable"), bins, [], capacity)
        people.append(bins.astype(np.int32))
    return people


def starters(lengths: np.ndarray, capacity: int, size: int, rng) -> list[np.ndarray]:
    """The first population, or plain best fit alone where that needs the fewest bins."""
    first = first_population(lengths, capacity, 1, rng)
    if first[0].max() + 1 <= -(-int(lengths.sum()) // capacity):
        return first
    return first_population(lengths, capacity, size, rng)


def evolve(lengths: np.ndarray, people: list[np.ndarray], capacity: int, generations: int, rng) -> list[np.ndarray]:
    """Steady state: a child of two parents, mutated now and then, replaces the worst when it is better.

    Ends where the fewest bins that the tokens need are reached, or after ``generations``
    generations in a row that have not saved a bin.
    """
    scored = sorted(((fitness(lengths, p, capacity), k, p) for k, p in enumerate(people)), key=lambda x: (x[0], -x[1]),
                    reverse=True)
    least = -(-int(lengths.sum()) // capacity)
    g = saved = 0
    while -scored[0][0][0] > least and g - saved < generations * len(scored):
        fewest, g = scored[0][0][0], g + 1
        i, j = (int(x) for x in rng.choice(len(scored), 2, replace=False)) if len(scored) > 1 else (0, 0)
        child = crossover(lengths, scored[i][2], scored[j][2], capacity, rng)
        if rng.random() < 0.4:
            child = mutate(lengths, child, capacity, rng)
        f = fitness(lengths, child, capacity)
        if f > scored[-1][0]:
            scored[-1] = (f, g + len(people), child)
            scored.sort(key=lambda x: (x[0], -x[1]), reverse=True)
        if scored[0][0][0] > fewest:
            saved = g
    return [p for _, _, p in scored]


# --- problems, islands and levels on Spark ---------------------------------------------------

ISLAND = "problem bigint, island int, lengths array<int>, people array<array<int>>"


def _epoch(level: int, epoch: int, capacity: int, size: int, generations: int):
    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                problem, island = b.column("problem")[row].as_py(), b.column("island")[row].as_py()
                lengths = np.asarray(b.column("lengths")[row].values.to_numpy(), np.int64)
                rng = np.random.default_rng([level, epoch, problem, island])
                given = [np.asarray(p.values.to_numpy()) for p in b.column("people")[row]]
                people = given or starters(lengths, capacity, size, rng)
                people = evolve(lengths, people, capacity, generations, rng)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([problem], pa.int64()), pa.array([island], pa.int32()),
                     pa.array([lengths.tolist()], pa.list_(pa.int32())),
                     pa.array([[p.tolist() for p in people]], pa.list_(pa.list_(pa.int32())))],
                    ["problem", "island", "lengths", "people"])
    return run


def _settle(capacity: int, last: bool, least_part: float):
    """Of a problem's islands the best grouping; its least filled bins are left open unless ``last``."""
    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                lengths = np.asarray(b.column("lengths")[row].values.to_numpy(), np.int64)
                ids = np.asarray(b.column("ids")[row].values.to_numpy())
                bins = max((np.asarray(p.values.to_numpy()) for p in b.column("elites")[row]),
                           key=lambda p: fitness(lengths, p, capacity))
                fill = np.bincount(bins, weights=lengths).astype(np.int64)
                opened = np.zeros(len(fill), bool)
                if not last:
                    opened[np.argsort(fill, kind="stable")[: int(np.ceil(len(fill) * least_part))]] = True
                    opened &= fill < capacity
                order = np.lexsort((ids, bins))
                before = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
                first = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
                offset = before - np.maximum.accumulate(np.where(first, before, 0))
                n = len(order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[order], pa.int64()), pa.array(lengths[order], pa.int32()),
                     pa.array(np.full(n, b.column("problem")[row].as_py()), pa.int64()),
                     pa.array(bins[order], pa.int32()), pa.array(offset, pa.int64()), pa.array(opened[bins[order]])],
                    ["id", "length", "problem", "bin", "offset", "open"])
    return run


#: Bins that the tokens of a problem fill at least, on average.
LEAST_BINS = 8


def problem_count(pieces: int, tokens: int, capacity: int, problem_size: int, before: int | None) -> int:
    """Problems of a level: bounded by pieces, several bins each, and at most half of those ``before``."""
    n = min(-(-pieces // problem_size), tokens // (LEAST_BINS * capacity))
    return max(1, n if before is None else min(n, before // 2))


def pack(spark: SparkSession, items: DataFrame, capacity: int, problem_size: int = 1536, islands: int = 2,
         population: int = 16, epochs: int = 4, generations: int = 16, least_part: float = 0.1,
         scratch: Scratch | None = None) -> DataFrame:
    """Groups ``items`` (id unique, length from 1 to capacity) -> (id, level, problem, bin, offset)."""
    scratch = scratch or Scratch(spark, "pack")
    islands_of = F.explode(F.sequence(F.lit(0), F.lit(islands - 1)))
    done, level, problems = [], 0, None
    left = items.select(F.col("id").cast("long").alias("id"), F.col("length").cast("int").alias("length"))
    while True:
        size = left.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).first()
        problems = problem_count(size["n"], size["tokens"], capacity, problem_size, problems)
        sets = scratch.stage(
            left.groupBy(F.pmod(F.xxhash64("id", F.lit(level)), F.lit(problems)).alias("problem"))
            .agg(F.array_sort(F.collect_list(F.struct("id", "length"))).alias("m"))
            .select("problem", F.col("m.id").alias("ids"), F.col("m.length").alias("lengths"))
            .repartition(max(1, min(problems, _width(spark))), "problem"), f"problems-{level}")
        state = sets.select("problem", islands_of.alias("island"), "lengths",
                            F.array().cast("array<array<int>>").alias("people"))
        for epoch in range(epochs):
            ran = state.repartition(max(1, min(problems * islands, _width(spark))), "problem", "island").mapInArrow(
                _epoch(level, epoch, capacity, population, generations), ISLAND)
            state = scratch.stage(ran, f"epoch-{level}-{epoch}")
            if epoch + 1 < epochs:
                elite = state.select("problem", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                                     F.col("people")[0].alias("elite"))
                # the newcomer takes the place of the last individual
                state = state.join(elite, ["problem", "island"]).select(
                    "problem", "island", "lengths",
                    F.concat(F.array("elite"), F.slice("people", F.lit(1), F.size("people") - 1)).alias("people"))
        last = problems == 1
        elites = state.groupBy("problem").agg(F.array_sort(F.collect_list(F.struct(
            "island", F.col("people")[0].alias("p")))).alias("e")).select("problem", F.col("e.p").alias("elites"))
        settled = scratch.stage(
            sets.join(elites, "problem").mapInArrow(
                _settle(capacity, last, least_part),
                "id bigint, length int, problem bigint, bin int, offset bigint, open boolean"), f"settled-{level}")
        done.append(settled.where("not open").select("id", F.lit(level).alias("level"), "problem", "bin", "offset"))
        if last:
            break
        left = settled.where("open").select("id", "length")
        level += 1
        if left.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece of every document."""
    scratch = Scratch(spark, "packing")
    keyed = scratch.stage(token_pieces(spark, docs, tokenizer_path, capacity, end_id, id_col, text_col)
                          .withColumn("id", F.monotonically_increasing_id()), "pieces")
    full = keyed.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("id")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    rest = keyed.where(F.col("length") < capacity)
    placed = pack(spark, rest.select("id", "length"), capacity, scratch=scratch)
    # level, problem and bin in one number: bins stay below 2^20 (problem size), levels below 2^6
    number = F.shiftleft(F.col("problem"), 26) + F.shiftleft(F.col("level").cast("long"), 20) + F.col("bin")
    packed = rest.join(placed.select("id", number.alias("sequence_id"), "offset"), "id").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return full.unionByName(packed).withColumnRenamed("doc_id", id_col)
