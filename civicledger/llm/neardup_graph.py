"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors of a label are one point. The points of a label are dealt into
overlapping shards: the two nearest of centroids that k-means finds on a bounded
sample, again and again until a shard is small. Each shard's task builds a flat
graph (nearest candidates and some far ones, robustly pruned, edges in both
directions) and runs a greedy search for every point from the shard's medoid; a
search that has found points in range goes on expanding them until none is new.
The adjacency lists of all shards are united, and in rounds every point visits
the other shards of the nearest points it knows and of those it got linked with,
until there is none new; a visit compares it with the whole shard. Links, verified
in double precision, connect points into components, and inside a component
every pair is verified exactly. A recall audit compares a sample of points,
stratified by the size of their component, with a brute-force scan of all rows;
below the floor the graph is built again with twice the overlap, and after the
last attempt every point visits every shard of its label; a recall that is then
still below the floor raises an error.

Vectors and lists travel as bytes (floats stay floats, arithmetic is in double
precision), a shard as rows of many vectors, and a visit reports only points at
least as near as the nearest known.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label or id, link with nothing; vectors of
different dimension never link; repeated rows are vectors of their own; an
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bitsliced import usable
from .common import Scratch, connected_components

#: Points of a shard: about, and at most where shards can be split further.
SHARD, SHARD_MOST = 512, 2048
#: Centroids of a split at most, and points they are learned from at most.
CENTROIDS, SAMPLE = 64, 4096
LEVELS = 6
NEAR, FAR, POOL = 20, 6, 64
ALPHA = 1.2
BEAM = 32
#: Points expanded by one search at most; the exact verification of components makes up for the rest.
EXPAND = 512
#: Nearest known points whose shards a point visits.
BEST = 8
VISITORS = 256
#: Components in one row of a shard's vectors (one vector at least): rows stay small however large the shard.
HELD = 1024
BLOCK = 1024
#: Points audited of each size class of components (four times as many of single points); classes up to SMALL are one group.
AUDIT, SMALL = 64, 64


def _flat(column, dtype: str = "i8") -> tuple[np.ndarray, np.ndarray]:
    """The items of all lists (or of their bytes) in order, and each one's length; null is empty."""
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        lengths = pa.compute.fill_null(pa.compute.list_value_length(column), 0)
        return column.flatten().to_numpy(zero_copy_only=False), lengths.to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(column):
        return np.zeros(0, dtype), np.zeros(0, np.int64)
    column = column.cast(pa.binary())
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(dtype).itemsize
    if not at[-1]:
        return np.zeros(0, dtype), np.zeros(len(column), np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(dtype), np.diff(at) // size


def _bytes(values: np.ndarray, lengths: np.ndarray, dtype: str = "i8") -> pa.Array:
    """``_flat`` undone: Spark moves a value of bytes at once, a list item by item."""
    at = np.r_[0, np.cumsum(lengths)] * np.dtype(dtype).itemsize
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(
        np.ascontiguousarray(values, dtype))])


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(values))


def _matrix(column, dtype: str) -> np.ndarray:
    """Vectors of one dimension as rows, in double precision."""
    return _flat(column, dtype)[0].reshape(len(column), -1).astype(np.float64)


def _vectors(column, dtype: str) -> list[np.ndarray]:
    flat, lengths = _flat(column, dtype)
    return np.split(flat.astype(np.float64), np.cumsum(lengths)[:-1]) if len(lengths) else []


def _vector(value, dtype: str) -> np.ndarray:
    return np.frombuffer(value, dtype) if isinstance(value, (bytes, bytearray)) else np.array(value)


def _packed(dtype: str):
    """Rows with a list ``v`` -> the same with its bytes; -0.0 becomes 0.0, as Spark hashes it."""
    def run(batches):
        for b in batches:
            k = b.schema.get_field_index("v")
            v = _bytes(*(x if n else x + x.dtype.type(0) for n, x in enumerate(_flat(b.column(k)))), dtype)
            v = pa.compute.if_else(b.column(k).is_valid(), v, pa.scalar(None, pa.binary()))
            yield b.set_column(k, "v", v)
    return run


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every span, one span after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def _slices(batches, *keys):
    """(key, rows) for each stretch of equal keys within a batch."""
    for b in batches:
        if b.num_rows:
            got = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys], axis=1)
            cuts = np.r_[0, np.flatnonzero((got[1:] != got[:-1]).any(axis=1)) + 1, len(got)].tolist()
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                yield tuple(got[a].tolist()), b.slice(a, z - a)


def _joined(held) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _groups(batches, *keys):
    """The rows of each key, whole; the batches are sorted by key."""
    now, held = None, []
    for key, rows in _slices(batches, *keys):
        if held and key != now:
            yield _joined(held)
            held = []
        now = key
        held.append(rows)
    if held:
        yield _joined(held)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows by powers of two (exact), so that squares of tiny or huge components neither vanish nor overflow."""
    x = np.asarray(x, np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In double precision, of every row of ``x`` with every row of ``y``."""
    x, y = scaled(x), scaled(y)
    return (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))


# --- a shard's graph ------------------------------------------------------------------------

def robust_prune(near: np.ndarray, cand: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates (best first, -1 pads) those that no kept one shadows; -1 pads.

    ``near`` holds similarities of unit vectors; distances are 1 - similarity. A
    candidate goes when a kept one is ALPHA times nearer to it than the row's point.
    """
    m, c = cand.shape
    rows = np.arange(m)
    alive = cand >= 0
    safe = np.where(alive, cand, 0)
    own = 1 - near[rows[:, None], safe]
    out = np.full((m, keep), -1)
    count = np.zeros(m, int)
    for r in range(c):
        take = rows[alive[:, r] & (count < keep)]
        if not len(take):
            if (count == keep).all():
                break
            continue
        out[take, count[take]] = cand[take, r]
        count[take] += 1
        later = safe[take, r + 1:]
        shadow = ALPHA * (1 - near[safe[take, r][:, None], later]) <= own[take, r + 1:]
        alive[take, r + 1:] &= ~shadow
    return out


def build(near: np.ndarray, rng) -> np.ndarray:
    """Adjacency lists (m x width, -1 pads): pruned near and far candidates, and the edges back."""
    m = len(near)
    if m == 1:
        return np.full((1, 1), -1)
    pool = min(POOL, m - 1)
    own = near.copy()
    np.fill_diagonal(own, -np.inf)
    cand = np.argpartition(-own, pool - 1, axis=1)[:, :pool]
    cand = np.take_along_axis(cand, np.argsort(-np.take_along_axis(own, cand, axis=1), axis=1, kind="stable"), axis=1)
    first = robust_prune(near, cand, NEAR)
    far = rng.integers(0, m, (m, FAR))
    far = np.where(far == np.arange(m)[:, None], -1, far)
    out = np.concatenate([first, far], axis=1)
    src = np.repeat(np.arange(m), out.shape[1])
    dst = out.ravel()
    ok = dst >= 0
    pairs = np.unique(np.concatenate([src[ok] * m + dst[ok], dst[ok] * m + src[ok]]))
    src, dst = pairs // m, pairs % m
    degree = np.bincount(src, minlength=m)
    adj = np.full((m, int(degree.max())), -1)
    adj[src, np.arange(len(src)) - np.repeat(np.cumsum(degree) - degree, degree)] = dst
    # a point's edges back are bounded too: the best NEAR + FAR of them and all of its own far ones
    width = 2 * (NEAR + FAR)
    if adj.shape[1] > width:
        sims = np.where(adj >= 0, near[np.arange(m)[:, None], np.maximum(adj, 0)], -np.inf)
        order = np.argsort(-sims, axis=1, kind="stable")
        adj = np.concatenate([np.take_along_axis(adj, order[:, :width], axis=1), far], axis=1)
    return adj


def search(near: np.ndarray, adj: np.ndarray, start: int, least: float) -> np.ndarray:
    """For every point the points in range that a greedy search from ``start`` finds (m x m booleans).

    A search expands the best point it has seen and not expanded, until its best
    BEAM points are expanded; then it expands every point found in range.
    """
    m = len(near)
    # pads are the start, which every point has seen; point i's cell for j is i * m + j
    lists = np.where(adj >= 0, adj, start)
    active = np.arange(m)
    seen = np.zeros(m * m, bool)
    seen[active * m + start] = True
    # similarities of what is seen and not expanded
    front = np.full((m, m), -np.inf, np.float32)
    front[:, start] = near[:, start]
    flat, known = front.ravel(), near.ravel()
    for step in range(BEAM + EXPAND):
        best = (front if len(active) == m else front[active]).argmax(axis=1)
        value = flat[active * m + best]
        go = value >= least if step >= BEAM else value > -np.inf
        active, best = active[go], best[go]
        if not len(active):
            break
        flat[active * m + best] = -np.inf
        new = (lists[best] + active[:, None] * m).ravel()
        new = new[~seen.take(new)]
        seen[new] = True
        flat[new] = known.take(new)
    return seen.reshape(m, m) & (near >= least)


def _shard_graphs(least: float, dtype: str):
    """Rows (shard, point, v), sorted by shard -> (shard, point, neighbours, sims, linked).

    ``neighbours`` are the BEST nearest of the point's adjacency list, nearest first,
    ``linked`` a forest of verified links.
    """

    def graph(rows):
        x, ids = _matrix(rows.column("v"), dtype), rows.column("point").to_numpy()
        m = len(ids)
        near = unit(x).astype(np.float32)
        near = near @ near.T
        rng = np.random.default_rng([m, int(ids[0] & 0x7FFFFFFF)])
        adj = build(near, rng)
        medoid = int(near.sum(axis=1).argmax())
        found = search(near, adj, medoid, least - 1e-4)
        np.fill_diagonal(found, False)
        found |= found.T
        # edges of the graph in range count as found: they are part of the united lists
        r, c = np.nonzero(adj >= 0)
        edges = np.unique(r * m + adj[r, c])
        r, c = edges // m, edges % m
        sims = near[r, c]
        edge = sims >= least - 1e-4
        found[r[edge], c[edge]] = True
        np.fill_diagonal(found, False)
        # a forest of the found links that hold in double precision
        linked: list[list[int]] = [[] for _ in ids]
        left = found.any(axis=1)
        while left.any():
            queue = [int(np.argmax(left))]
            left[queue[0]] = False
            while queue:
                i = queue.pop()
                j = np.flatnonzero(found[i] & left)
                if len(j):
                    j = j[cosines(x[i:i + 1], x[j])[0] >= least]
                    linked[i] = ids[j].tolist()
                    left[j] = False
                    queue += j.tolist()
        order = np.lexsort((c, -sims, r))
        r, c, sims = r[order], c[order], sims[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < BEST
        r, c, sims = r[keep], c[keep], sims[keep]
        degree = np.bincount(r, minlength=m)
        return pa.RecordBatch.from_arrays(
            [rows.column("shard"), rows.column("point"), _bytes(ids[c], degree), _bytes(sims, degree, "f4"),
             pa.array(linked, pa.list_(pa.int64()))], ["shard", "point", "neighbours", "sims", "linked"])

    def run(batches):
        yield from map(graph, _groups(batches, "shard"))
    return run


# --- overlapping shards ---------------------------------------------------------------------

def kmeans(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        home = (x @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            some = x[home == c]
            if len(some):
                total = some.sum(axis=0)
                centres[c] = total / max(np.linalg.norm(total), 1e-12)
    return centres


def _centroids(level: int, dtype: str):
    """Rows (shard, point, v, k), sorted by shard: the sample of a shard -> its centroids."""

    def learn(rows):
        x = unit(_matrix(rows.column("v"), dtype))
        k = min(CENTROIDS, -(-rows.column("k")[0].as_py() // SHARD))
        c = kmeans(x, k, np.random.default_rng([level, len(x)]))
        return pa.RecordBatch.from_arrays(
            [rows.column("shard").slice(0, len(c)), pa.array(np.arange(len(c))),
             _bytes(c.ravel(), np.full(len(c), c.shape[1]), dtype)], ["shard", "point", "v"])

    def run(batches):
        yield from map(learn, _groups(batches, "shard"))
    return run


def _assign(overlap: int, dtype: str):
    """Rows (shard, salt, point, v, centre), centroids first -> (shard, nth, point) for the nearest centroids."""

    def run(batches):
        now, held, centres = None, [], None
        for (shard, salt, centre), rows in _slices(batches, "shard", "salt", "centre"):
            if (shard, salt) != now:
                now, held, centres = (shard, salt), [], None
            if centre:
                held.append(_matrix(rows.column("v"), dtype))
                continue
            if centres is None:
                centres = np.concatenate(held) if held else np.zeros((0, 1))
            if len(centres):
                nth = (scaled(_matrix(rows.column("v"), dtype)) @ centres.T).argsort(axis=1)[:, ::-1][:, :overlap]
            else:
                nth = np.zeros((rows.num_rows, 1), int)
            point = np.repeat(rows.column("point").to_numpy(), nth.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(point), shard)), pa.array(nth.ravel()), pa.array(point)],
                                             ["shard", "nth", "point"])
    return run


def _width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def deal(spark: SparkSession, scratch: Scratch, points: DataFrame, overlap: int, name: str, dtype: str) -> DataFrame:
    """``points`` (part, point, v) -> (shard, point, v): small overlapping shards within each part.

    Shards and points travel by their ids; vectors join those of shards to be split, and all at the end.
    """
    done = []
    vectors = points.select("point", "v")
    work = points.select(F.col("part").alias("shard"), "point")
    for level in range(LEVELS):
        sizes = work.groupBy("shard").agg(F.count(F.lit(1)).alias("k"))
        sized = scratch.stage(work.join(sizes, "shard"), f"{name}-sized-{level}")
        done.append(sized.where(F.col("k") <= SHARD_MOST).select("shard", "point"))
        if sized.where(F.col("k") > SHARD_MOST).isEmpty():
            break
        large = sized.where(F.col("k") > SHARD_MOST).join(vectors, "point")
        rank = F.pmod(F.xxhash64("point", F.lit(level)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        centres = (large.where(rank < F.lit(float(SAMPLE)) / F.col("k")).repartition(_width(spark), "shard")
                   .sortWithinPartitions("shard", "point")
                   .mapInArrow(_centroids(level, dtype), "shard bigint, point bigint, v binary"))
        salts = (F.floor(F.col("k") / 4096) + 1).cast("int")
        heads = sized.where(F.col("k") > SHARD_MOST).groupBy("shard").agg(F.max("k").alias("k"))
        rows = large.select("shard", F.pmod(F.xxhash64("point"), salts).cast("int").alias("salt"), "point", "v",
                            F.lit(False).alias("centre")).unionByName(
            centres.join(heads, "shard").select("shard", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
                                                "point", "v", F.lit(True).alias("centre")))
        nth = (rows.repartition(_width(spark), "shard", "salt").sortWithinPartitions("shard", "salt", F.desc("centre"))
               .mapInArrow(_assign(overlap, dtype), "shard bigint, nth bigint, point bigint"))
        work = nth.select(F.xxhash64("shard", "nth", F.lit(level)).alias("shard"), "point")
        if level == LEVELS - 1:
            # shards that centroids do not split are cut by hash; every cut also gets the same few points
            many = work.groupBy("shard").agg(F.count(F.lit(1)).alias("k"))
            cuts = (F.floor(F.col("k") / SHARD_MOST) + 1).cast("int")
            both = work.join(many, "shard")
            own = both.select(F.xxhash64("shard", F.pmod(F.xxhash64("point"), cuts)).alias("shard"), "point")
            joint = both.where(rank < 32 / F.col("k")).select(
                "shard", F.explode(F.sequence(F.lit(0), cuts - 1)).alias("cut"), "point").select(
                F.xxhash64("shard", F.col("cut").cast("bigint")).alias("shard"), "point")
            done.append(own.unionByName(joint))
    homes = reduce(DataFrame.unionByName, done).groupBy("point").agg(F.collect_set("shard").alias("homes"))
    return vectors.join(homes, "point").select(F.explode("homes").alias("shard"), "point", "v")


# --- search across shards -------------------------------------------------------------------

#: What a point learns of others: nearest points, how many shards each is in and which, shards of
#: points it got linked with; as bytes (``_bytes``).
NEWS = "ids binary, sims binary, counts binary, homes binary, near_linked binary"


def _blocks(dtype: str):
    """Rows (shard, kind, point, v, comp, own, ids, sims), sorted by shard, kind and point -> rows of blocks and news.

    Kinds: 0 a point's vector; 1 its component and its shards (``own``); 2 its list (``ids``, ``sims``) of points of the
    shard. A block's rows (``v`` not null) hold the vectors of a shard's points, their ids, components and shards; news
    (``v`` null) are the lists with the shards of their points.
    """
    names = ["shard", "point", "v", "comps", "ids", "sims", "counts", "homes"]

    def block(rows):
        kind = rows.column("kind").to_numpy()
        vectors, facts, lists = (rows.slice(a, z - a) for a, z in zip(
            np.searchsorted(kind, [0, 1, 2]).tolist(), np.searchsorted(kind, [0, 1, 2], "right").tolist(), strict=True))
        if not facts.num_rows:                  # a part of one shard
            return
        ids, shard = facts.column("point").to_numpy(), rows.column("shard")
        homes, counts = _flat(facts.column("own"))
        start = np.cumsum(counts) - counts
        v, dims = _flat(vectors.column("v"), dtype)
        size = max(1, HELD // int(dims[0]))
        size = np.diff(np.r_[np.arange(0, len(ids), size), len(ids)])
        first = np.cumsum(size) - size
        yield pa.RecordBatch.from_arrays(
            [shard.slice(0, len(size)), pa.array(ids[first]), _bytes(v, size * dims[0], dtype),
             _bytes(facts.column("comp").to_numpy(), size), _bytes(ids, size), pa.nulls(len(size), pa.binary()),
             _bytes(counts, size, "i4"), _bytes(homes, np.add.reduceat(counts, first))], names)
        if lists.num_rows:
            near, many = _flat(lists.column("ids"))
            at = np.searchsorted(ids, near)     # points are sorted
            row = np.repeat(np.arange(len(many)), many)
            yield pa.RecordBatch.from_arrays(
                [shard.slice(0, len(many)), lists.column("point"), *(pa.nulls(len(many), pa.binary()) for _ in range(2)),
                 lists.column("ids"), lists.column("sims"), _bytes(counts[at], many, "i4"),
                 _bytes(homes[_spans(start[at], counts[at])], np.bincount(row, counts[at], len(many)).astype(np.int64))], names)

    def run(batches):
        for rows in _groups(batches, "shard"):
            yield from block(rows)
    return run


def _visit(least: float, dtype: str):
    """Rows (shard, salt, visitor, point, v, comp, floor, comps, ids, counts, homes), the shard's block first -> news of visitors.

    A visitor gets the shard's BEST points nearest to it, without those less similar
    than ``floor`` (its BEST known ones, ``ids``, are at least as near) and those known, and in ``linked`` one
    verified point in range of every component but its own.
    """

    def home(held):
        rows = _joined(held)
        ids, comps, homes = (_flat(rows.column(c))[0] for c in ("ids", "comps", "homes"))
        counts = _flat(rows.column("counts"), "i4")[0].astype(np.int64)
        x = _flat(rows.column("v"), dtype)[0].reshape(len(ids), -1).astype(np.float64)
        return ids, comps, counts, np.cumsum(counts) - counts, homes, x, unit(x).astype(np.float32)

    def meet(visitors, ids, comps, counts, start, homes, x, units):
        own, floor = _matrix(visitors.column("v"), dtype), visitors.column("floor").to_numpy()
        n = len(own)
        sims = unit(own).astype(np.float32) @ units.T
        # most visitors see a few points above their floor; of more, the nearest
        above = sims >= floor[:, None]
        more = np.flatnonzero(np.count_nonzero(above, axis=1) > BEST)
        if len(more):
            best = np.argpartition(-sims[more], BEST - 1, axis=1)[:, :BEST]
            above[more] = False
            above[more[:, None], best] = True
        r, best = np.nonzero(above)
        known, many = _flat(visitors.column("ids"))
        told = np.zeros(len(r), bool)
        for k in range(int(many.max())):        # the k-th point that each visitor knows
            told |= (many[r] > k) & (known[np.minimum((np.cumsum(many) - many)[r] + k, len(known) - 1)] == ids[best])
        r, best = r[~told], best[~told]
        near, many = sims[r, best], np.bincount(r, minlength=n)
        linked: list[list[int]] = [[] for _ in range(n)]
        places: list[np.ndarray] = [np.zeros(0, np.int64)] * n
        maybe, comp = sims >= least - 1e-4, visitors.column("comp").to_numpy()
        for i in np.flatnonzero(maybe.any(axis=1)):
            # what single precision finds near the bound is decided in double precision
            j = np.flatnonzero(maybe[i] & (comps != comp[i]))
            j = j[cosines(own[i:i + 1], x[j])[0] >= least]
            j = j[np.unique(comps[j], return_index=True)[1]]
            linked[i], places[i] = ids[j].tolist(), homes[_spans(start[j], counts[j])]
        some = pa.array(np.flatnonzero((many > 0) | np.array([len(k) > 0 for k in linked])))
        return pa.RecordBatch.from_arrays(
            [visitors.column("point"), _bytes(ids[best], many), _bytes(near, many, "f4"), _bytes(counts[best], many, "i4"),
             _bytes(homes[_spans(start[best], counts[best])], np.bincount(r, counts[best], n).astype(np.int64)),
             _bytes(np.concatenate(places), np.array([len(k) for k in places])), pa.array(linked, pa.list_(pa.int64()))],
            ["q", "ids", "sims", "counts", "homes", "near_linked", "linked"]).take(some)

    def run(batches):
        now, held, found = None, [], None
        for (shard, salt, visitor), rows in _slices(batches, "shard", "salt", "visitor"):
            if (shard, salt) != now:
                now, held, found = (shard, salt), [], None
            if not visitor:
                held.append(rows)
                continue
            if found is None:
                found, held = home(held), []
            for at in range(0, rows.num_rows, VISITORS):
                yield meet(rows.slice(at, VISITORS), *found)
    return run


def _learn(dtype: str):
    """Rows (q, v, comp, seen, ask, NEWS), sorted by q -> what each q with a component knows now and which shards it visits next.

    Known are the BEST nearest of all points it has heard of; it visits those of their shards, and of the shards
    of points it got linked with, that are not in ``seen``. A q without a visit has no row: it is done.
    """

    def learn(rows):
        named = rows.column("comp").is_valid().to_numpy(zero_copy_only=False)
        with_v = rows.column("v").is_valid().to_numpy(zero_copy_only=False)
        q = rows.column("q").to_numpy()
        people = q[named]
        if not len(people):
            return None
        group = np.minimum(np.searchsorted(people, q), len(people) - 1)
        ours = people[group] == q
        (ids, many), sims = _flat(rows.column("ids")), _flat(rows.column("sims"), "f4")[0]
        counts, homes = _flat(rows.column("counts"), "i4")[0].astype(np.int64), _flat(rows.column("homes"))[0]
        start, of = np.cumsum(counts) - counts, np.repeat(np.arange(len(q)), many)
        # each known point once, then the nearest
        at = np.lexsort((-sims, ids, group[of]))
        at = at[ours[of[at]]]
        once = np.r_[True, (ids[at][1:] != ids[at][:-1]) | (group[of[at]][1:] != group[of[at]][:-1])][:len(at)]
        at = at[once]
        at = at[np.lexsort((ids[at], -sims[at], group[of[at]]))]
        g = group[of[at]]
        at = at[np.arange(len(at)) - np.searchsorted(g, g) < BEST]
        g = group[of[at]]
        place, number = _spans(start[at], counts[at]), len(people)
        parts = [(homes[place], np.repeat(g, counts[at]), 1)]
        for column, asked in (("near_linked", 1), ("seen", 0), ("ask", 0)):
            values, lengths = _flat(rows.column(column))
            row = np.repeat(np.arange(len(q)), lengths)
            parts.append((values[ours[row]], group[row[ours[row]]], asked))
        shard, who = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        asked = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
        order = np.lexsort((asked, shard, who))
        shard, who, asked = shard[order], who[order], asked[order]
        new = np.r_[True, (shard[1:] != shard[:-1]) | (who[1:] != who[:-1])][:len(shard)]
        shard, who, asked = shard[new], who[new], asked[new] == 1
        known = np.bincount(g, minlength=number)
        floor = np.full(number, -np.inf, np.float32)
        last = np.cumsum(known) - 1
        floor[known == BEST] = sims[at][last[known == BEST]]
        out = pa.RecordBatch.from_arrays(
            [pa.array(people), _bytes(*_flat(rows.column("v").filter(pa.array(with_v & ours)), dtype), dtype),
             rows.column("comp").filter(pa.array(named)),
             pa.array(floor), _bytes(ids[at], known), _bytes(sims[at], known, "f4"), _bytes(counts[at], known, "i4"),
             _bytes(homes[place], np.bincount(g, counts[at], number).astype(np.int64)),
             _bytes(shard[~asked], np.bincount(who[~asked], minlength=number)),
             _lists(shard[asked], np.bincount(who[asked], minlength=number))],
            ["q", "v", "comp", "floor", "ids", "sims", "counts", "homes", "seen", "ask"])
        return out.take(pa.array(np.flatnonzero(np.bincount(who[asked], minlength=number))))

    def run(batches):
        held, number = [], 0
        for b in batches:
            held.append(b)
            number += b.num_rows
            if number >= 20_000:
                rows = _joined(held)
                q = rows.column("q").to_numpy()
                cut = int(np.searchsorted(q, q[-1]))                # the last q may go on
                if cut and (out := learn(rows.slice(0, cut))) is not None:
                    yield out
                held, number = [rows.slice(cut)], rows.num_rows - cut
        if number and (out := learn(_joined(held))) is not None:
            yield out
    return run


def across(spark: SparkSession, scratch: Scratch, points: DataFrame, shards: DataFrame, lists: DataFrame,
           components: DataFrame, least: float, name: str, everywhere: bool = False,
           dtype: str = "f8") -> DataFrame | None:
    """Verified links (src, dst) between components that visits to other shards find; None where no part has other shards.

    A round's visits are the shards of the nearest points that a point knows (at
    first from ``lists``, united) and of the points it got linked with, without
    those it is in or has visited. ``everywhere``: all shards of its part.
    A shard's vectors, components and dealing are laid out once, as rows of many points.
    """
    if points.schema["v"].dataType.simpleString() != "binary":
        points = points.select("point", "part", "v").mapInArrow(_packed(dtype), "point bigint, part bigint, v binary")
    homes = shards.groupBy("point").agg(F.collect_set("shard").alias("homes"))
    facts = (points.select("point", "part").join(components, F.col("point") == F.col("id"), "left")
             .select("point", "part", F.coalesce("component", "point").alias("comp")).join(homes, "point"))
    facts = scratch.stage(facts, f"{name}-facts")
    many = (facts.select("part", F.explode("homes").alias("shard")).groupBy("part")
            .agg((F.min("shard") != F.max("shard")).alias("split")).where("split").select("part"))
    many = scratch.stage(many, f"{name}-many")
    if many.isEmpty():
        return None
    facts = facts.join(many, "part", "left_semi")
    parted = shards.selectExpr("shard", "0 AS kind", "point", "v").unionByName(
        facts.selectExpr("explode(homes) AS shard", "1 AS kind", "point", "comp", "homes AS own"), allowMissingColumns=True)
    if not everywhere:
        parted = parted.unionByName(lists.selectExpr("shard", "2 AS kind", "point", "neighbours AS ids", "sims"),
                                    allowMissingColumns=True)
    else:
        parted = parted.selectExpr("*", "CAST(NULL AS binary) AS ids", "CAST(NULL AS binary) AS sims")
    laid = scratch.stage(
        parted.repartition(_width(spark), "shard").sortWithinPartitions("shard", "kind", "point")
        .mapInArrow(_blocks(dtype), "shard bigint, point bigint, v binary, comps binary, ids binary, sims binary, "
                                    "counts binary, homes binary"), f"{name}-blocks")
    blocks = laid.where("v IS NOT NULL").drop("sims")
    state_schema = ("q bigint, v binary, comp bigint, floor float, ids binary, sims binary, counts binary, homes binary, "
                    "seen binary, ask array<bigint>")

    def learned(rows, at):
        rows = rows.select("q", "v", "comp", "ids", "sims", "counts", "homes", "near_linked", "seen", "ask")
        return scratch.stage(rows.repartition("q").sortWithinPartitions("q").mapInArrow(_learn(dtype), state_schema), at)

    if everywhere:
        every = facts.select("part", F.explode("homes").alias("shard")).distinct()
        visits = (facts.join(every, "part").where(~F.array_contains("homes", F.col("shard")))
                  .join(points.select("point", "v"), "point")
                  .selectExpr("shard", "point", "v", "comp", "CAST('-Infinity' AS float) AS floor",
                              "CAST(NULL AS binary) AS ids"))
    else:
        news = laid.where("v IS NULL").selectExpr("point AS q", "ids", "sims", "counts", "homes")
        state = learned(
            news.unionByName(points.selectExpr("point AS q", "v"), allowMissingColumns=True)
            .unionByName(facts.selectExpr("point AS q", "comp", "CAST(NULL AS binary) AS near_linked", "homes AS seen",
                                          "CAST(NULL AS binary) AS ask"), allowMissingColumns=True), f"{name}-state-0")
    links, rnd = None, 0
    while True:
        if not everywhere:
            if state.isEmpty():
                return links if links is not None else state.selectExpr("q AS src", "q AS dst")
            visits = state.selectExpr("explode(ask) AS shard", "q AS point", "v", "comp", "floor", "ids")
        # written first: Spark then knows its size and need not shuffle vectors to join it
        salted = scratch.stage(visits.groupBy("shard").agg((F.floor(F.count(F.lit(1)) / 4096) + 1).cast("int").alias("salts")),
                               f"{name}-salted-{rnd}")
        rows = blocks.join(salted, "shard").select(
            *blocks.columns, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("visitor")
        ).unionByName(visits.join(salted, "shard").select(
            *visits.columns, F.pmod(F.xxhash64("point"), F.col("salts")).cast("int").alias("salt"),
            F.lit(True).alias("visitor")), allowMissingColumns=True)
        met = scratch.stage(
            rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "visitor", "point")
            .mapInArrow(_visit(least, dtype), f"q bigint, {NEWS}, linked array<bigint>"), f"{name}-met-{rnd}")
        found = met.select(F.col("q").alias("src"), F.explode("linked").alias("dst"))
        links = found if links is None else links.unionByName(found)
        if everywhere:
            return links
        rnd += 1
        state = learned(state.drop("floor").unionByName(met.drop("linked"), allowMissingColumns=True), f"{name}-state-{rnd}")


# --- exact verification ---------------------------------------------------------------------

def _verify(least: float, dtype: str):
    """Rows (component, i, j, own, point, v, copies), sorted by block pair -> (point, n): verified links."""

    def flush(rows):
        i, j = rows[0][1], rows[0][2]
        a, b = [r for r in rows if r[3] == i], [r for r in rows if r[3] == j]
        x, y = (np.stack([r[5] for r in s]) for s in (a, b))
        hit = cosines(x, y) >= least
        if i == j:
            np.fill_diagonal(hit, False)
        out = [(r[4], n) for r, n in zip(a, hit @ np.array([r[6] for r in b], np.int64), strict=True)]
        if i != j:
            out += [(r[4], n) for r, n in zip(b, hit.T @ np.array([r[6] for r in a], np.int64), strict=True)]
        return out

    def run(batches):
        held: list = []
        for b in batches:
            out = []
            cols = [b.column(c).to_pylist() for c in ("component", "i", "j", "own", "point")]
            for r in zip(*cols, _vectors(b.column("v"), dtype), b.column("copies").to_pylist(), strict=True):
                if held and r[:3] != held[0][:3]:
                    out += flush(held) if len({h[3] for h in held}) == 1 + (held[0][1] != held[0][2]) else []
                    held = []
                held.append(r)
            if out:
                yield _counts(out)
        if held and len({h[3] for h in held}) == 1 + (held[0][1] != held[0][2]):
            yield _counts(flush(held))
    return run


def _counts(out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                       pa.array([int(o[1]) for o in out], pa.int64())], ["point", "n"])


def recall_of(strata) -> float:
    """Lower of two recalls, of components of at most SMALL points and of larger ones, from (size class, points,
    sampled, linked, whole) rows: share of the points with links whose links all lie inside their component."""
    out = 1.0
    for small in (True, False):
        some = [s for s in strata if (2 ** s[0] <= SMALL) == small and s[2]]
        linked = sum(n / k * a for _, n, k, a, _ in some)
        if linked:
            out = min(out, sum(n / k * w for _, n, k, _, w in some) / linked)
    return out


def audit(spark: SparkSession, points: DataFrame, components: DataFrame, least: float, dtype: str = "f8") -> float:
    """``recall_of`` a sample of every size class of components, single points included, by brute force over all points."""
    joined = points.join(components, points["point"] == components["id"], "left").select(
        "part", "point", "v", F.coalesce("component", "point").alias("component"))
    sizes = joined.groupBy("component").agg(F.floor(F.log2(F.count(F.lit(1)))).cast("int").alias("size"))
    sized = joined.join(sizes, "component")
    number = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not number:
        return 1.0
    # points below a hash threshold are about twice the sample; only they are ranked
    wanted = {k: AUDIT * (4 if k == 0 else 1) for k in number}
    place = F.pmod(F.xxhash64("point", F.lit("audit")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.create_map(*(F.lit(x) for k, n in number.items() for x in (k, min(1.0, 2 * wanted[k] / n))))
    few = sized.where(place <= share[F.col("size")])
    nth = F.row_number().over(Window.partitionBy("size").orderBy(place, "point"))
    asked = few.withColumn("nth", nth).where(
        F.col("nth") <= F.when(F.col("size") == 0, 4 * AUDIT).otherwise(AUDIT)).drop("nth").collect()
    shared = spark.sparkContext.broadcast([(r["part"], r["point"], _vector(r["v"], dtype), r["component"]) for r in asked])

    def scan(batches):
        for b in batches:
            total: dict = {}
            part, point, comp = (np.array(b.column(c).to_pylist(), np.int64) for c in ("part", "point", "component"))
            vectors = _vectors(b.column("v"), dtype)
            for p in set(part.tolist()):
                queries = [q for q in shared.value if q[0] == p]
                at = np.flatnonzero(part == p)
                if not queries:
                    continue
                x = np.stack([vectors[k] for k in at])
                hit = cosines(np.stack([q[2] for q in queries]), x) >= least
                hit &= np.array([q[1] for q in queries])[:, None] != point[at][None, :]
                lost = hit & (np.array([q[3] for q in queries])[:, None] != comp[at][None, :])
                total |= {q[1]: (int(h), int(n)) for q, h, n in zip(queries, hit.sum(axis=1), lost.sum(axis=1), strict=True)}
            rows = [(q, h, n) for q, (h, n) in total.items() if h]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                                             ["point", "links", "lost"])

    # at most one row a sampled point
    seen = {r["point"]: r["lost"] for r in joined.mapInArrow(scan, "point bigint, links bigint, lost bigint").groupBy(
        "point").agg(F.sum("lost").alias("lost")).collect()}
    strata = []
    for size, n in number.items():
        ids = [r["point"] for r in asked if r["size"] == size]
        strata.append((size, n, len(ids), sum(i in seen for i in ids), sum(seen.get(i) == 0 for i in ids)))
    shared.unpersist()
    return recall_of(strata)


def near_duplicates(spark: SparkSession, vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", overlap: int = 2,
                    recall_floor: float = 0.95) -> DataFrame:
    """(id, n_links, component_id, kept, audit_recall) for every row of ``vectors``."""
    scratch = Scratch(spark, "neardup")
    # vectors of floats stay so until their arithmetic: half the bytes, the same numbers
    dtype = "f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "f8"
    v = F.col(vector_col).cast("array<float>" if dtype == "f4" else "array<double>")
    takes_part = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(F.col(vector_col)) & F.coalesce(
        F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.when(takes_part, F.xxhash64(label_col, F.size(vector_col))).alias("part"),
                          F.when(takes_part, v).alias("v"))
    rows = rows.withColumn("point", F.when(F.col("part").isNotNull(), F.xxhash64("part", "v")))
    rows = scratch.stage(rows.mapInArrow(_packed(dtype), "id bigint, part bigint, v binary, point bigint"), "rows")
    points = scratch.stage(rows.where("point is not null").groupBy("point", "part", "v").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("id")), "points")
    attempt = 0

    def joined(parts, everywhere, name):
        more = across(spark, scratch, points, shards, graph, parts, least, name, everywhere, dtype)
        if more is None:
            return parts
        edges = more.unionByName(parts.select(F.col("id").alias("src"), F.col("component").alias("dst")))
        return scratch.stage(connected_components(scratch, edges, f"{name}-join"), f"{name}-components")

    while True:
        shards = scratch.stage(deal(spark, scratch, points, overlap, f"deal-{attempt}", dtype), f"shards-{attempt}")
        graph = scratch.stage(
            shards.repartition(_width(spark), "shard").sortWithinPartitions("shard", "point")
            .mapInArrow(_shard_graphs(least, dtype), "shard bigint, point bigint, neighbours binary, sims binary, "
                                                     "linked array<bigint>"), f"graph-{attempt}")
        # lists of all shards united: their links meet in the points that shards share
        # (lists are nearest first: the BEST of all are among the BEST of each)
        links = graph.select(F.col("point").alias("src"), F.explode("linked").alias("dst"))
        components = scratch.stage(connected_components(scratch, links, f"join-{attempt}"), f"components-{attempt}")
        components = joined(components, False, f"across-{attempt}")
        recall = audit(spark, points, components, least, dtype)
        if recall < recall_floor and attempt == 3:
            components = joined(components, True, "everywhere")
            recall = audit(spark, points, components, least, dtype)
        if recall >= recall_floor or attempt == 3:
            break
        overlap, attempt = 2 * overlap, attempt + 1
    if recall < recall_floor:
        raise RuntimeError(f"audited recall {recall:.3f} is below {recall_floor} after the last attempt")
    member = points.join(components.withColumnRenamed("id", "p"), F.col("point") == F.col("p")).select(
        "component", "point", "v", "copies", "id")
    member = scratch.stage(member, "members")
    blocks = member.groupBy("component").agg((F.floor((F.count(F.lit(1)) - 1) / BLOCK) + 1).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int")
    pairs = member.join(blocks, "component").select("component", "point", "v", "copies", own.alias("own"), F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "point", "v", "copies")
    counted = (pairs.repartition(_width(spark), "component", "i", "j")
               .sortWithinPartitions("component", "i", "j", "own", "point")
               .mapInArrow(_verify(least, dtype), "point bigint, n bigint").groupBy("point").agg(F.sum("n").alias("n")))
    named = member.groupBy("component").agg(F.min("id").alias("least"))
    facts = (points.select("point", "copies", F.col("id").alias("own")).join(counted, "point", "left")
             .join(member.select("point", "component"), "point", "left").join(named, "component", "left")
             .select("point", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("least", "own").alias("component_id")))
    return rows.join(facts, "point", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
        F.lit(recall).alias("audit_recall"))
