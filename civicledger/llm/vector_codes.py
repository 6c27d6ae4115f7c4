"""Compressed vector codes (product quantisation), nearest entries by slice-and-intersect bitmasks.

A vector of whole numbers is cut into equal parts; a part's code is the number of
the nearest entry of its codebook. To find it, every dimension of a codebook keeps
its entries' coordinates sorted, and for every place in that order a bitmask of the
entries before it. For a part x and a radius r the entries with a coordinate in
[x - r, x + r] are the difference of two such prefix masks; ANDed over all
dimensions, the masks leave the entries within r in every dimension. Every entry
within the (Euclidean) distance r is among them, so a nearest one found within r is
exact. The initial radius comes from the distances between the entries; where the
nearest candidate lies farther away than r, its distance is the next radius, and
where there is none, r doubles.

Codebooks are learned in rounds over all rows: each task assigns its rows and sums
them up by entry, Spark adds up the tasks' sums, and the driver divides them (only
parts x entries x positions numbers reach it). Sums travel as 32-bit limbs, so they are exact at
any size.

Defined cases: vectors that are null, empty or hold null or non-finite components
are dropped, as are vectors of another dimension than that of the smallest kept id
whose dimension the number of parts divides; rows that repeat an id are vectors of
their own, in the order of their components; a null id comes last and its row is
coded like any other; with fewer rows than entries the codebooks are smaller; an
error beyond a 64-bit number is given as the largest one; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bitsliced import quantised, usable
from .common import Scratch

#: Whole numbers below this are worked on in 64 bits; vectors with larger ones in numbers of any size.
SMALL = 1 << 28
#: Entries in one word of a mask.
WORD = 64
LONGEST = (1 << 63) - 1
LIMB = 32


def whole_numbers(vector: np.ndarray, scale: int) -> list[int]:
    """floor(scale * x) of every component, of any size (Python's floor of a double is exact)."""
    return [int(np.floor(x)) for x in np.asarray(vector, np.float64) * scale]


class SlicedEntries:
    """The entries (entries x dimensions, int64) of one part, ready to be searched."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        self.words = -(-n // WORD)
        # prefix[d, k]: the entries whose coordinate in d is among the k smallest
        bits = np.zeros((dims, n + 1, self.words), np.uint64)
        for d in range(dims):
            for k in range(n):
                bits[d, k + 1] = bits[d, k]
                e = int(order[k, d])
                bits[d, k + 1, e // WORD] |= np.uint64(1 << (e % WORD))
        self.prefix = bits
        # half the median distance from an entry to its nearest other one
        radius = 1.0
        if n > 1:
            apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2).astype(np.float64)
            np.fill_diagonal(apart, np.inf)
            radius = max(1.0, float(np.median(np.sqrt(apart.min(axis=1)))) / 2)
        self.radius = int(np.ceil(radius))

    def candidates(self, x: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Masks (rows x words) of the entries within ``r`` of the row in every dimension."""
        mask = None
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - r, "left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + r, "right")
            inside = self.prefix[d, high] ^ self.prefix[d, low]
            mask = inside if mask is None else mask & inside
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every row; ties go to the lower entry."""
        best = np.zeros(len(x), np.int64)
        least = np.full(len(x), LONGEST, np.int64)
        if x.shape[1] == 0:
            return best, np.zeros(len(x), np.int64)
        left, r = np.arange(len(x)), np.full(len(x), self.radius, np.int64)
        while len(left):
            mask = self.candidates(x[left], r)
            held = np.unpackbits(mask.view(np.uint8).reshape(len(left), -1), axis=1, bitorder="little")
            row, entry = np.nonzero(held[:, :len(self.entries)])
            far = ((x[left[row]] - self.entries[entry]) ** 2).sum(axis=1)
            # rows come in order and entries ascend within a row: the first least one is the lowest entry
            found = np.full(len(left), LONGEST, np.int64)
            np.minimum.at(found, row, far)
            first = far == found[row]
            at, k = np.unique(row[first], return_index=True)
            best[left[at]], least[left[at]] = entry[first][k], far[first][k]
            seen = found < LONGEST
            inside = seen & (found <= r * r)
            # nothing beyond the distance of the nearest candidate can be nearer
            root = np.ceil(np.sqrt(np.where(seen, found, 0).astype(np.float64))).astype(np.int64) + 1
            r = np.where(seen, root, r * 2)[~inside]
            left = left[~inside]
        return best, least


def nearest_any_size(x: list[int], entries: list[list[int]]) -> tuple[int, int]:
    """The same for one part of numbers of any size."""
    far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in entries]
    least = min(far)
    return far.index(least), least


class Codebooks:
    """One list of entries (lists of whole numbers) for every part."""

    def __init__(self, entries: list[list[list[int]]]):
        self.entries = entries

    @property
    def small(self) -> bool:
        return all(abs(v) < SMALL for part in self.entries for e in part for v in e)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for part in self.entries for e in part for v in e).encode()).hexdigest()

    def assign(self, vectors: list[list[int]] | np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """Entries (rows x parts) and squared distances of the parts of every vector."""
        parts = len(self.entries)
        out = np.zeros((len(vectors), parts), np.int64)
        if isinstance(vectors, np.ndarray) and self.small:
            cut = vectors.reshape(len(vectors), parts, -1)
            far = np.zeros((len(vectors), parts), np.int64)
            for p in range(parts):
                out[:, p], far[:, p] = SlicedEntries(np.array(self.entries[p], np.int64)).nearest(cut[:, p])
            return out, far.tolist()
        far = []
        for i, v in enumerate(vectors):
            v = [int(c) for c in v]
            width = len(v) // parts
            found = [nearest_any_size(v[p * width:(p + 1) * width], self.entries[p]) for p in range(parts)]
            out[i] = [e for e, _ in found]
            far.append([d for _, d in found])
        return out, far


def _by_size(column: pa.ListArray, scale: int):
    """Rows of a batch as (numbers of rows, vectors): small ones as an array, others as lists."""
    n = len(column)
    if not n:
        return
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)
    scaled = np.floor(flat * scale)
    small = (np.abs(scaled) < SMALL).all(axis=1)
    if small.any():
        yield np.flatnonzero(small), scaled[small].astype(np.int64)
    if not small.all():
        yield np.flatnonzero(~small), [whole_numbers(v, scale) for v in flat[~small]]


def _limbs(number: int) -> list[int]:
    """``number`` as the sum of limbs[k] * 2**(LIMB * k); every limb has the number's sign."""
    out, sign, number = [], -1 if number < 0 else 1, abs(number)
    while number:
        out.append(sign * (number & ((1 << LIMB) - 1)))
        number >>= LIMB
    return out


SUMS = "part int, entry int, place int, limb int, amount long"
#: Place of the number of rows in a table of sums.
ROWS = -1


def _sums(books: Codebooks, scale: int):
    """A task's sums and counts of the rows of each entry; a few thousand numbers, however many rows it has."""
    def run(batches):
        total: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for _, vectors in _by_size(batch.column(0), scale):
                found, _ = books.assign(vectors)
                for p in range(found.shape[1]):
                    if isinstance(vectors, np.ndarray):
                        cut = vectors.reshape(len(vectors), found.shape[1], -1)[:, p]
                        k = int(found[:, p].max()) + 1
                        count = np.bincount(found[:, p], minlength=k)
                        added = np.zeros((k, cut.shape[1]), np.int64)
                        np.add.at(added, found[:, p], cut)
                        rows = [(e, int(count[e]), added[e].tolist()) for e in np.flatnonzero(count).tolist()]
                    else:
                        width = len(vectors[0]) // found.shape[1]
                        rows = [(int(e), 1, v[p * width:(p + 1) * width])
                                for e, v in zip(found[:, p], vectors, strict=True)]
                    for e, n, s in rows:
                        held = total.setdefault((p, e), [0] * (len(s) + 1))
                        held[0] += n
                        for j, v in enumerate(s):
                            held[j + 1] += int(v)
        out = [(p, e, j - 1, k, limb) for (p, e), held in total.items() for j, v in enumerate(held)
               for k, limb in enumerate(_limbs(v))]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(),) * 4 + (pa.int64(),), strict=True)],
                              names=["part", "entry", "place", "limb", "amount"])
    return run


def next_codebooks(books: Codebooks, rows: list) -> Codebooks:
    """Every used entry moves to floor(sum / count) of its rows; unused entries stay."""
    total: dict[tuple[int, int, int], int] = {}
    for part, entry, place, limb, amount in rows:
        total[part, entry, place] = total.get((part, entry, place), 0) + (int(amount) << (LIMB * limb))
    return Codebooks([[[total.get((p, e, j), 0) // total[p, e, ROWS] for j in range(len(old))]
                       if (p, e, ROWS) in total else old for e, old in enumerate(part)]
                      for p, part in enumerate(books.entries)])


def prepared(scratch: Scratch, vectors: DataFrame, parts: int, id_column: str, vector_column: str,
             keep: tuple[str, ...]) -> tuple[DataFrame, int]:
    """Usable rows of one dimension as a written table (id, vector in doubles, kept columns), and the dimension (0: none)."""
    found = vectors.where(usable(F.col(vector_column))).select(
        F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"),
        F.struct(*[F.col(c) for c in keep]).alias("own"))
    first = (found.where(F.size("v") % parts == 0).select("id", F.size("v").alias("n"))
             .orderBy(F.col("id").asc_nulls_last(), "n").limit(1).collect())
    width = first[0]["n"] if first else 0
    return scratch.stage(found.where(F.size("v") == width), "vectors"), width


def encode(spark: SparkSession, vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6,
           scale: int = 4096, id_column: str = "vec_id", vector_column: str = "embedding",
           keep: tuple[str, ...] = ()) -> tuple[DataFrame, Codebooks]:
    """Codes of every usable vector, and the codebooks.

    Returns the ``keep`` columns with ``code`` (two hex digits a part) and ``error`` (squared distances,
    summed over the parts); name them so that they don't clash with these two.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    if not keep:
        keep = (id_column,)
    scratch = Scratch(spark, "codes")
    table, width = prepared(scratch, vectors, parts, id_column, vector_column, keep)
    starts = table.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    first = [whole_numbers(np.array(r["v"]), scale) for r in starts]
    size = width // parts
    books = Codebooks([[v[p * size:(p + 1) * size] for v in first] for p in range(parts)])
    for _ in range(rounds if first else 0):
        sums = (table.select("v").mapInArrow(_sums(books, scale), SUMS)
                .groupBy("part", "entry", "place", "limb").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount")))
        books = next_codebooks(books, sums.collect())

    def code(batches):
        for batch in batches:
            codes, errors = np.empty(batch.num_rows, object), np.zeros(batch.num_rows, object)
            for at, found in _by_size(batch.column(1), scale):
                e, far = books.assign(found)
                codes[at] = [bytes(r).hex() for r in e.astype(np.uint8)]
                errors[at] = [min(LONGEST, sum(d)) for d in far]
            yield pa.record_batch([batch.column(0), pa.array(codes, pa.string()), pa.array(errors.tolist(), pa.int64())],
                                  names=["own", "code", "error"])

    out = T.StructType([table.schema["own"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = scratch.stage(table.select("own", "v").mapInArrow(code, out), "codes")
    return coded.select("own.*", "code", "error"), books


def with_label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``label_error``: the errors of all rows of an equal label, nulls together, added up.

    Labels are pre-aggregated before the shuffle and joined back, so a label that holds most rows is not gathered anywhere.
    """
    total = coded.groupBy(F.col(label).alias("_of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(total, F.col(label).eqNullSafe(F.col("_of")), "left").drop("_of")
