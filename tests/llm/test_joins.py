"""The Jaccard join, the near-duplicate graph and the bit-sliced search against brute force."""

import math
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civicledger.llm import bitsliced, jaccard_join, neardup_graph, shingles
from civicledger.llm.common import CLEANUP, Scratch, connected_components


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, a):
        self.up.setdefault(a, a)
        while self.up[a] != a:
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)), key=lambda x: (x is None, x))
        self.up[b] = a


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(rows):
    """(id, shingles, component) per row, by comparing all pairs of rows."""
    sets, up = [shingle_set(t) for _, t in rows], Sets()
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= 75 * (len(a) + len(b) - n):
                    up.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = up.find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(str((d, len(s), least[up.find(i)])) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def family(rng, size, words, edits, shared=()):
    """Copies of one text with words replaced here and there."""
    base = [f"w{rng.integers(1 << 30)}" for _ in range(words)]
    out = []
    for _ in range(size):
        t = list(base)
        for k in rng.integers(0, words, edits):
            t[k] = f"e{rng.integers(1 << 30)}"
        out.append(" ".join([*t, *shared]))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    passage = [f"p{k}" for k in range(60)]
    out = family(rng, 40, 120, 3, passage) + family(rng, 25, 60, 2) + family(rng, 8, 300, 5, passage)
    out += [" ".join(f"u{rng.integers(1 << 30)}" for _ in range(rng.integers(1, 80))) + " " + " ".join(passage) for _ in range(60)]
    out += ["same text here for all of them", "Same TEXT here for all of them"] * 6 + ["one two", "one  two", "one", "", None, " \n"]
    ids = [int(x) for x in rng.permutation(len(out))]
    return [*zip(ids, out, strict=True), (None, out[0]), (ids[3], out[3]), (ids[4], "another text under a known id, quite other")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("point", F.lit(1)).repartition(5)


def result(df):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in df.collect())


def test_shingles_are_those_of_the_definition(texts):
    got = shingles.shingle_sets([(t or "").encode() for _, t in texts], 5)
    assert [len(s) for s in got] == [len(shingle_set(t)) for _, t in texts]
    sets = {}
    for s, (_, t) in zip(got, texts):
        assert sets.setdefault(s.tobytes(), shingle_set(t)) == shingle_set(t)


def test_join_is_exact(spark, texts):
    assert result(jaccard_join.jaccard_components(spark, frame(spark, texts))) == brute_components(texts)


@pytest.mark.parametrize("leaf", [6, 12])
def test_pivots_windows_and_blocks_are_exact(spark, texts, monkeypatch, leaf):
    for name, value in (("LEAF", leaf), ("SMALL_CELL", 4), ("RECUR", 10 ** 9), ("WINDOWED_CELL", 20)):
        monkeypatch.setattr(jaccard_join, name, value)
    assert result(jaccard_join.jaccard_components(spark, frame(spark, texts))) == brute_components(texts)


def shuffle_files(spark) -> int:
    """Shuffle data files of this application on its local disks."""
    base = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(f.getName().startswith("shuffle_") and f.getName().endswith(".data") for d in base.localDirs()
               for sub in d.listFiles() for f in (sub.listFiles() or []))


def test_a_written_step_leaves_no_shuffle_files(spark):
    """Without waiting for the driver's garbage collector."""
    gone = lambda before: any(shuffle_files(spark) <= before or time.sleep(0.2) for _ in range(50))
    before, mode = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    table = Scratch(spark, "t").stage(spark.range(20000).repartition(5, "id").groupBy((F.col("id") % 999).alias("k")).count(), "a")
    assert gone(before)
    assert spark.conf.get(CLEANUP, None) == mode and table.count() == 999


def test_a_join_leaves_one_table(spark, texts, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAF", 6)            # all steps run
    scratch = Scratch(spark, "t")
    scratch.stage(spark.range(3), "other")
    found = jaccard_join.jaccard_components(spark, frame(spark, texts), scratch=scratch)
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch.root)
    left = {x.getPath().getName() for x in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)}
    assert left == {"other", "found"} == scratch.names
    assert result(found) == brute_components(texts)


@pytest.mark.parametrize("bucket", [1, 40, 10 ** 6])
def test_maps_of_counts(spark, monkeypatch, bucket):
    """Counted in buckets and blocks of any size: the same maps as counting whole shingles."""
    monkeypatch.setattr(jaccard_join, "BUCKET", bucket)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 700)
    rng = np.random.default_rng(21)
    common = [" ".join(f"p{k}w{i}" for i in range(9)) for k in range(6)]
    texts = [" ".join(common[k] for k in range(6) if i % (k * k + 1) == 0) + " " + " ".join(f"x{x}" for x in rng.integers(0, 9999, 30))
             for i in range(300)]
    sets = shingles.shingle_sets([t.encode() for t in texts], 5)
    packed = spark.createDataFrame([(bytearray(jaccard_join.pack_text(t.encode())),) for t in texts], "members binary")
    got = jaccard_join.often_maps(spark, packed.repartition(3), sum(map(len, sets)), 5)
    u, c = np.unique(np.concatenate(sets), return_counts=True)
    for n, m in zip(jaccard_join.OFTEN, got, strict=True):
        want = np.zeros(1 << jaccard_join.MAP_BITS, bool)
        want[(u[c >= n] >> np.uint64(64 - jaccard_join.MAP_BITS)).astype(np.int64)] = True
        assert want.any() and (np.unpackbits(m.bits, bitorder="little").astype(bool) == want).all()


def test_one_of_each_deals_texts_once(spark, texts):
    """Null ids and repeated rows too: join and duplicates share one exchange of the documents."""
    rows = [*texts, (None, "a text without any id at all"), (None, "a text without any id at all"), texts[0], texts[0]]
    with_joins = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in with_joins}
    try:
        for k, v in with_joins.items():
            spark.conf.set(k, v)
        kept = jaccard_join.one_of_each(spark, frame(spark, rows))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        left = [(r.doc_id, r.text) for r in kept.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    side = plan[plan.index("SortMergeJoin"):].split("Exchange")
    assert "Exchange" not in plan[:plan.index("SortMergeJoin")] and len(side) > 2
    assert len(left) == len(set(left)) and left.count((None, "a text without any id at all")) == 1


def test_far_families_split_into_voronoi_cells(spark, monkeypatch):
    """One region of many tight families: windows keep cells apart, and the result stays exact."""
    monkeypatch.setattr(jaccard_join, "LEAF", 16)
    rng = np.random.default_rng(9)
    rows = [t for _ in range(12) for t in family(rng, 9, 80, 1)]
    sets = [shingles.shingle_sets([t.encode()], 5)[0] for t in rows]
    members = spark.createDataFrame([(1, i, bytearray(jaccard_join.pack_text(t.encode())), len(rows), False)
                                     for i, t in enumerate(rows)],
                                    "region long, point long, members binary, k long, inside boolean")
    up = Sets()
    for e in jaccard_join.join_regions(spark, Scratch(spark, "t"), members, 75, 5):
        for r in e.collect():
            up.join(r.src, r.dst)
    want = brute_components(list(enumerate(rows)))
    least = {}
    for i in range(len(rows)):
        least.setdefault(up.find(i), i)
    assert want == sorted(str((i, len(s), least[up.find(i)])) for i, s in enumerate(sets))


def test_links_within_any_order():
    rng = np.random.default_rng(2)
    some = [shingles.shingle_sets([t.encode()], 5)[0] for t in family(rng, 90, 60, 4)]
    ball = np.zeros(90, bool)
    want = Sets()
    for i in range(90):
        for j in range(i):
            n = len(np.intersect1d(some[i], some[j]))
            if 100 * n >= 75 * (len(some[i]) + len(some[j]) - n):
                want.join(i, j)
    got = Sets()
    for i, j in jaccard_join.links_within(some, 75, ball):
        got.join(i, j)
    assert [got.find(i) == got.find(j) for i in range(90) for j in range(i)] == [
        want.find(i) == want.find(j) for i in range(90) for j in range(i)]


def test_one_of_each(spark, texts, none):
    df = frame(spark, texts)
    kept = jaccard_join.one_of_each(spark, df)
    assert kept.columns == df.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    found = jaccard_join.jaccard_components(spark, df).collect()
    groups = {r.component for r in found if r.component is not None}
    empty = {(d, t) for d, t in texts if not shingle_set(t)}
    assert len(left) == len(groups) + len(empty) and set(left) <= set(texts)
    again = jaccard_join.jaccard_components(spark, kept).collect()
    assert len({r.component for r in again if r.component is not None}) == len(groups)
    assert jaccard_join.one_of_each(spark, none).collect() == []
    assert jaccard_join.jaccard_components(spark, none).collect() == []


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [
        (2000, k) for k in range(2001, 2100)] + [(5, 5), (None, 3), (3, None)]
    up = Sets()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            up.join(a, b)
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.id: r.component for r in connected_components(Scratch(spark, "t"), df, "c").collect()}
    assert got == {i: up.find(i) for i in up.up}


# --- vectors

def vectors(seed=6, groups=6):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=16)
        rows += [(len(rows) + k, (centre + 0.12 * rng.normal(size=16)).tolist(), g % 3) for k in range(int(rng.integers(1, 30)))]
    base = len(rows)
    rows += [(base + k, rng.normal(size=16).tolist(), int(rng.integers(0, 3))) for k in range(120)]
    n = len(rows)
    rows += [(n, rows[0][1], rows[0][2]), (n + 1, rows[0][1], rows[0][2]), (n + 2, None, 1), (n + 3, [], 1),
             (n + 4, [0.0] * 16, 1), (n + 5, [math.nan] + [1.0] * 15, 1), (n + 6, [math.inf] + [1.0] * 15, 1),
             (n + 7, [None] + [1.0] * 15, 1), (n + 8, rows[0][1], None), (n + 9, [1.0, 2.0], 0), (n + 10, [2.0, 4.0], 0),
             (None, rows[0][1], rows[0][2])]
    return rows


def usable(v, zero=True):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and (not zero or any(v))


def brute_links(rows, least=0.93):
    up, n = Sets(), [0] * len(rows)
    for i, (a, v, lab) in enumerate(rows):
        for j in range(i):
            b, w, lab2 = rows[j]
            if None in (a, b, lab) or lab != lab2 or not usable(v) or not usable(w) or len(v) != len(w):
                continue
            x, y = np.array(v), np.array(w)
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                up.join(a, b)
                n[i] += 1
                n[j] += 1
    return sorted(str((a, k, up.find(a) if a is not None else None, a is not None and up.find(a) == a))
                  for (a, _, _), k in zip(rows, n))


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates(spark, monkeypatch, small):
    if small:
        for name, value in (("SHARD", 12), ("SHARD_MOST", 30), ("BLOCK", 8), ("SAMPLE", 60), ("LEVELS", 3)):
            monkeypatch.setattr(neardup_graph, name, value)
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("point", F.lit("clash")).repartition(4)
    got = neardup_graph.near_duplicates(spark, df).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in got) == brute_links(rows)
    assert {r.audit_recall for r in got} == {1.0}
    assert neardup_graph.near_duplicates(spark, df.where("false")).collect() == []


def test_near_duplicates_across_shards(spark, monkeypatch):
    """Pairs whose points share no shard: found by visits, without the audit's second build."""
    for name, value in (("SHARD", 24), ("SHARD_MOST", 60), ("SAMPLE", 400)):
        monkeypatch.setattr(neardup_graph, name, value)
    rng = np.random.default_rng(8)
    x = neardup_graph.unit(rng.normal(size=(600, 16)))
    y = neardup_graph.unit(x + 0.075 * rng.normal(size=x.shape))
    rows = [(k, [float(c) for c in v], 1) for k, v in enumerate(np.concatenate([x, y]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in neardup_graph.near_duplicates(spark, df, recall_floor=0.0).collect()}
    near = np.concatenate([x, y]) @ np.concatenate([x, y]).T
    pairs = [(i, j) for i, j in np.argwhere(near >= 0.93) if i < j]
    lost = [p for p in pairs if got[p[0]].component_id != got[p[1]].component_id]
    assert len(pairs) > 300 and len(lost) <= 0.01 * len(pairs)


def test_rounds_write_few_rows(spark, monkeypatch):
    """Float vectors over many shards, found exactly; what the rounds write is bounded: a shard is laid out once, as rows
    of many vectors, and visits that learn nothing leave no row."""
    for name, value in (("SHARD", 24), ("SHARD_MOST", 60), ("SAMPLE", 400)):
        monkeypatch.setattr(neardup_graph, name, value)
    written, stage = {}, Scratch.stage

    def counted(self, df, name):
        out = stage(self, df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "stage", counted)
    rng = np.random.default_rng(21)
    x = rng.normal(size=(500, 16)).astype(np.float32)
    x[1::5] = x[::5] + np.float32(0.02)
    x[2, :2], x[3] = (0.0, 1.0), x[2]
    x[3, 0] = -0.0                                # an equal vector
    rows = [(k, [float(c) for c in v], 1) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = neardup_graph.near_duplicates(spark, df).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in got) == brute_links(rows)
    rounds = sum(n for name, n in written.items() if name.startswith("across-0-") and "join" not in name)
    assert rounds <= 15 * len(rows), written


def test_bytes_and_lists_read_alike():
    values, lengths = np.arange(7, dtype=np.float32), np.array([2, 0, 4, 1])
    packed = neardup_graph._bytes(values, lengths, "f4")
    for column in (packed, pa.array([[0.0, 1.0], None, [2.0, 3.0, 4.0, 5.0], [6.0]], pa.list_(pa.float32()))):
        for a, z in ((0, 4), (1, 3), (2, 4), (1, 2), (3, 3)):
            got, many = neardup_graph._flat(column.slice(a, z - a), "f4")
            assert many.tolist() == lengths[a:z].tolist()
            assert got.tolist() == values[lengths[:a].sum():lengths[:z].sum()].tolist()


def test_audit_sees_lost_links_beside_a_large_group(spark):
    """200 near copies in one component and 150 pairs, every second of them split: many links are kept, many points lost."""
    rng = np.random.default_rng(9)
    x = neardup_graph.unit(rng.normal(size=(151, 32)))
    rows = [(k, 1, [float(c) for c in x[150] + 0.001 * rng.normal(size=32)]) for k in range(200)]
    rows += [(1000 + 2 * k + t, 1, [float(c) for c in x[k] + 0.001 * t]) for k in range(150) for t in (0, 1)]
    points = spark.createDataFrame(rows, "point long, part long, v array<double>")

    def recall(split):
        comps = [(p, 0 if p < 1000 else p - p % 2) for p, *_ in rows if p < 1000 or not (split and p % 4 < 2)]
        return neardup_graph.audit(spark, points, spark.createDataFrame(comps, "id long, component long"), 0.93)

    assert recall(False) == 1.0
    assert recall(True) < 0.7


def test_tiny_and_huge_vectors(spark):
    """Squares of the components vanish or overflow; cosines, links and the audit stay exact."""
    rng = np.random.default_rng(14)
    x = rng.normal(size=(30, 8))
    rows = [(3 * k + j, [float(c) for c in v * size], 1) for k, v in enumerate(x)
            for j, size in enumerate((1e-200, 1.0, 1e200))]
    got = neardup_graph.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    near = neardup_graph.unit(x) @ neardup_graph.unit(x).T >= 0.93
    assert {r.vec_id: r.n_links for r in got} == {3 * k + j: 3 * int(near[k].sum()) - 1 for k in range(30) for j in range(3)}
    assert {r.audit_recall for r in got} == {1.0}


def test_a_recall_below_the_floor_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(neardup_graph, "audit", lambda *_: 0.5)
    df = spark.createDataFrame([(k, [1.0, float(k)], 1) for k in range(6)], SCHEMA)
    with pytest.raises(RuntimeError, match="below 0.95"):
        neardup_graph.near_duplicates(spark, df)


def test_every_shard_is_visited_when_asked(spark):
    """The last resort below the recall floor: all pairs of a label, here over shards that share no point."""
    rng = np.random.default_rng(10)
    x = neardup_graph.unit(rng.normal(size=(30, 16)))
    rows = [(k, 1, [float(c) for c in v]) for k, v in enumerate(np.concatenate([x, x + 0.01]))]
    points = spark.createDataFrame(rows, "point long, part long, v array<double>")
    shards = points.select((F.col("point") / 20).cast("long").alias("shard"), "point", "v")
    none = spark.createDataFrame([], "id long, component long")
    got = neardup_graph.across(spark, Scratch(spark, "t"), points, shards, None, none, 0.93, "all", True)
    assert {tuple(sorted(r)) for r in got.collect()} >= {(k, k + 30) for k in range(30)}


def test_pruned_graph_search_finds_what_is_in_range():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 32))
    x = neardup_graph.unit(np.repeat(centres, 10, axis=0) + 0.1 * rng.normal(size=(400, 32)))
    near = (x @ x.T).astype(np.float32)
    adj = neardup_graph.build(near, rng)
    found = neardup_graph.search(near, adj, int(near.sum(axis=1).argmax()), 0.93)
    truth = near >= 0.93
    assert found[truth].mean() >= 0.9 and not found[~truth].any()
    assert (adj >= 0).sum(axis=1).max() <= 2 * (neardup_graph.NEAR + neardup_graph.FAR) + neardup_graph.FAR


def test_robust_prune_drops_shadowed_candidates():
    x = neardup_graph.unit(np.array([[1, 0.0], [0.99, 0.1], [0.98, 0.12], [0, 1.0]]))
    near = x @ x.T
    out = neardup_graph.robust_prune(near, np.array([[1, 2, 3]] + [[-1, -1, -1]] * 3), 3)
    assert out[0].tolist() == [1, 3, -1]


def brute_top(rows, k, by):
    v = [(a, [math.floor(64 * x) for x in w]) for a, w, _ in rows if a is not None and usable(w, zero=False)]
    out = []
    for a, q in v:
        if a % by:
            continue
        best = sorted((-sum(x * y for x, y in zip(q, c)), b) for b, c in v if b != a and len(c) == len(q))[:k]
        out += [(a, i + 1, b, -s) for i, (s, b) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize(("block", "chunk"), [(32768, 64), (50, 3)])
def test_bit_sliced_search(spark, block, chunk):
    rows = vectors(seed=11)
    rows += [(9000 + k, rows[1][1], 0) for k in range(40)]              # ties at the boundary
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).repartition(3)
    got = bitsliced.top_k(spark, df, F.col("vec_id") % 4 == 0, k=20, block_rows=block, chunk=chunk, chunks_per_part=2)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 20, 4)
    assert bitsliced.top_k(spark, df.where("false"), F.lit(True)).collect() == []
    assert bitsliced.top_k(spark, df, F.lit(False)).collect() == []


def test_bundles_are_bounded():
    """A row of the index has a bounded size, whatever a block holds; order and vectors stay."""
    rng = np.random.default_rng(31)
    dims = [64] * 5000 + [200_000] * 3
    rows = [(b, i, rng.integers(-9, 9, d)) for b in (3, 8) for i, d in enumerate(dims)]
    batches = [pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.int64()),
         pa.array([r[2] for r in some], pa.list_(pa.int64()))], ["block", "id", "v"]) for some in (rows[:3333], rows[3333:])]
    out = [r for b in bitsliced._bundle(0, 10 ** 6)(batches) for r in b.to_pylist()]
    assert max(len(r["vectors"]) for r in out) <= 4 * max(1 << 17, 200_000)
    assert [r["place"] for r in out] == sorted(r["place"] for r in out)
    got = [(r["block"], i, v) for r in out for i, v in zip(
        np.frombuffer(r["ids"], np.int64).tolist(), np.frombuffer(r["vectors"], np.int32).reshape(-1, r["dim"]), strict=True)]
    assert [g[:2] for g in got] == [r[:2] for r in rows]
    assert all((g[2] == r[2]).all() for g, r in zip(got, rows, strict=True))


def test_small_bundles_and_few_copies(spark, monkeypatch):
    """Slices put together from many bundles find the same; a block is copied no more often than tasks need."""
    monkeypatch.setattr(bitsliced, "BUNDLE_COMPONENTS", 20)
    rng = np.random.default_rng(32)
    rows = [(int(i), rng.integers(-3, 3, 4).astype(float).tolist()) for i in np.arange(300) // 2]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ask = lambda: bitsliced.top_k(spark, df, F.col("vec_id") % 2 == 0, k=5, scale=1, block_rows=100, chunk=2, chunks_per_part=1)
    few = ask()
    plan = few._jdf.queryExecution().executedPlan().toString()
    dealt = int(re.search(r"hashpartitioning\(block#\d+L?, part#\d+, (\d+)\)", plan).group(1))
    assert dealt <= 2 * (3 + int(spark.conf.get("spark.sql.shuffle.partitions")))
    want = []
    for q in sorted({i for i, _ in rows if i % 2 == 0}):
        best = []
        for v in [v for i, v in rows if i == q]:
            best += [(-int(np.dot(v, w)), i) for i, w in rows if i != q]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(best)[:5])]
    # a query id that occurs twice asks twice, and a candidate met by both counts twice
    assert sorted(map(tuple, few.collect())) == sorted(want)


def test_slices_add_up():
    rng = np.random.default_rng(5)
    values = rng.integers(-70, 70, (130, 9))
    s = bitsliced.Slices(values)
    for q in rng.integers(-40, 40, (20, 9)):
        sums = sum((np.unpackbits(p.view(np.uint8), bitorder="little")[:130].astype(int) << w)
                   for w, p in enumerate(s.score_slices(q)))
        exact = values @ q
        assert len(set((sums - exact).tolist())) == 1
        assert sorted((values[s.top(q, 7, s.all)] @ q).tolist()) == sorted(exact.tolist())[-7:]


def test_large_components(spark):
    """Beyond 32 bits and beyond doubles: scores are exact; an error only where one is no 64-bit number."""
    rng = np.random.default_rng(21)
    rows = [(k, [float(c) for c in v], 0) for k, v in enumerate(rng.integers(-9, 9, (40, 4)) / 4)]
    rows += [(100, [1e9, 1.0, 0.0, -2.0], 0), (101, [0.25, 3e14, 1.0, 0.5], 0), (102, [-1e10, 1.0, 2.0, 0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = bitsliced.top_k(spark, df, F.col("vec_id") < 40, k=5, block_rows=16, chunk=7)
    want = [r for r in brute_top(rows, 5, 1) if r[0] < 40]
    assert sorted(map(tuple, got.collect())) == want
    for far in ([1e10, 1.0, 0.0, 0.0], [1e300, 0.0, 0.0, 0.0]):
        with pytest.raises(Exception, match="too large"):
            bitsliced.top_k(spark, df.unionByName(spark.createDataFrame([(103, far, 0)], SCHEMA)), F.lit(True)).collect()


def test_leaves_are_bounded_by_shingles_too(spark, monkeypatch):
    """Few but long near copies are split like many short ones, with the same components."""
    monkeypatch.setattr(jaccard_join, "LEAF_SHINGLES", 3000)
    rng = np.random.default_rng(12)
    texts = [t for k in range(3) for t in family(rng, 12, 900, 1 + 4 * k)] + family(rng, 5, 400, 120)
    rows = [(i, t) for i, t in enumerate(texts)]
    seen = []
    real = jaccard_join._by_blocks

    def noted(*args):
        out = real(*args)
        seen.append(out.count())
        return out
    monkeypatch.setattr(jaccard_join, "_by_blocks", noted)
    got = jaccard_join.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got.collect()) == brute_components(rows)
    assert seen                                             # regions beyond a leaf went on to pivots and blocks


def test_a_leaf_of_long_texts_is_several(spark):
    """600 near copies of 20,000 words are far more than one task's leaf."""
    size = spark.range(600).select(jaccard_join.units(F.count(F.lit(1)), F.sum(F.lit(20_000))).alias("k")).first()[0]
    assert size >= 20 * jaccard_join.LEAF


def test_one_of_each_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", 1, 2, 3, 4), (2, "a b c d e f", 1, 2, 3, 4), (3, None, 1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __hash int, __own int, _own int, _HASH int")
    got = jaccard_join.one_of_each(spark, df)
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3]
