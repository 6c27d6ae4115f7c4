"""The prefix trie and the centroid rollup against plain Python."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicledger.llm import centroids, prefix_trie
from civicledger.llm.common import Scratch
from civicledger.llm.queries import op13_prefix_trie, remainder

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def plain(rows):
    """Every node of the trie, by building each rebuilt conversation and each of its prefixes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for *_, role, text in sorted(t)] for c, t in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        lender = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = own.get(lender, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        out, open_ = [], [p]
        while open_:
            q = open_.pop()
            out.append(q)
            open_ += children.get(q, [])
        return out

    result = []
    for p, cs in members.items():
        under = below(p)
        ends = sorted(c for c in cs if len(built[c]) == len(p))
        result.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children.get(p, [])),
                       sum(q not in children for q in under),
                       sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q),
                       hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(map(str, result))


def trie(spark, rows, most=centroids.MOST):
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_trie.of_conversations(spark, df, lambda c: c - c % 5, lambda c: remainder(c, 9), most=most)
    return sorted(str(tuple(r)) for r in got.collect())


def conversations(seed, n, turns, texts):
    rng = np.random.default_rng(seed)
    return [(int(c), t, ["user", "assistant"][t % 2], f"text {rng.integers(0, texts)}")
            for c in rng.choice(4 * n, n, replace=False) for t in range(rng.integers(1, turns + 1))]


@pytest.mark.parametrize("most", [3, 40, centroids.MOST])
def test_against_plain_python(spark, most):
    rows = conversations(1, 60, 7, 2) + [(1000 + k, t, "user", "the same text") for k in range(30) for t in range(3 + k % 9)]
    assert trie(spark, rows, most) == plain(rows)


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [(None, 1, "user", "x"), (0, None, "user", "first"), (0, 0, None, "second"), (0, 1, "user", None), (0, 2, "", ""),
            (1, 5, "b", "t"), (1, 5, "a", "t"), (2, 0, "user", "é漢"), (2, 0, "user", "é漢"), (2, 0, "user", "é漢"),
            (3, 0, "user", "only"), (-3, 0, "user", "negative"), (-5, 1, "user", "lender"), (10**12, 0, "x", "y" * 50_000)]
    rows += [(c, 0, "user", "gone with its first turns") for c in range(20, 40)]
    assert trie(spark, rows) == plain(rows)


def test_long_conversations_cross_blocks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(c, t, "user", "a" if t % 50 else str(c // 6)) for c in range(12) for t in range(150 - 9 * c)]
    rows += [(c, 0, "user", "a group of copies") for c in range(100, 200)]
    assert trie(spark, rows, most=50) == plain(rows)


def test_empty_table_and_further_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.of_conversations(spark, df, lambda c: c, lambda c: remainder(c, 9)).count() == 0
    rows = conversations(2, 10, 4, 2)
    named = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("depth"), F.lit("x").alias("owner"), F.lit(2).alias("conv"))
    got = prefix_trie.of_conversations(spark, named, lambda c: c - c % 5, lambda c: remainder(c, 9))
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows)


def test_ranks_of_a_conversation_that_spans_tasks(spark):
    rows = [(7, t, "user", str(t)) for t in range(5000)] + [(1, 0, "user", "x")]
    ranked = prefix_trie.ranked_turns(Scratch(spark, "test"), spark.createDataFrame(rows, SCHEMA).repartition(7))
    got = ranked.where("conv = 7")
    assert got.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first()[:] == (5000, 0, 4999)


@pytest.mark.parametrize("shape", ["random", "chain", "star", "forest", "comb"])
def test_forest_sums(shape):
    rng = np.random.default_rng(5)
    n = 700
    parent = np.array({"random": lambda: [-1] + [int(rng.integers(0, i)) for i in range(1, n)],
                       "chain": lambda: list(range(-1, n - 1)), "star": lambda: [-1] + [0] * (n - 1),
                       "forest": lambda: [-1 if i % 50 == 0 else int(rng.integers(i - i % 50, i)) for i in range(n)],
                       "comb": lambda: [-1] + [i - 1 if i % 2 else i - 2 for i in range(1, n)]}[shape]())
    depth = np.zeros(n, np.int64)
    for i in range(n):
        depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
    values = rng.integers(0, 100, (n, 2))
    want = values.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    assert (centroids.forest_sums(parent, depth, values) == want).all()
    order = rng.permutation(n)                                      # any order of the nodes
    back = np.argsort(order)
    mixed = np.where(parent[order] >= 0, back[parent[order]], -1)
    assert (centroids.forest_sums(mixed, depth[order], values[order]) == want[order]).all()
    assert len(centroids.forest_sums(parent[:0], depth[:0], values[:0])) == 0


def test_query_over_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op13_prefix_trie(spark, sf)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows)
