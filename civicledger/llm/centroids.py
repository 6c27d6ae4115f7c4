"""Subtree sums over a forest of parent edges by centroid decomposition.

A component is a connected part of a tree; its centroid is the deepest node whose
subtree inside the component weighs more than half of it. The totals of the pieces
below the centroid and the centroid's own values are its part of every sum from
there to the top of the component: they are added to the centroid and to the nodes
on its path to the top. Then the centroid goes, and what is left falls apart into
the pieces below it and the piece above, none heavier than half. Each pair of a node
and its descendant is parted exactly once (or joined at a centroid), so each value
is counted once, after at most log2(weight) rounds, however deep the tree is.

Large components are split by Spark, in rounds of joins (``rollup``); components of
at most ``most`` nodes are finished in tasks by the same steps on arrays
(``forest_sums``), many components at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Nodes of a component that one task finishes.
MOST = 50_000


def _by_level(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []


def forest_sums(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (nodes x columns) over every node's subtree; ``parent`` is -1 for a top."""
    n = len(parent)
    levels = _by_level(depth)
    size = np.ones(n, np.int64)
    for level in reversed(levels):
        inner = level[parent[level] >= 0]
        np.add.at(size, parent[inner], size[inner])
    # a node's subtree is the interval [at, at + size) of a depth-first order
    order = np.argsort(parent, kind="stable")
    before = np.concatenate([[0], np.cumsum(size[order])[:-1]]) if n else np.zeros(0, np.int64)
    first = np.r_[True, np.diff(parent[order]) != 0] if n else np.zeros(0, bool)
    started = before[np.flatnonzero(first)[np.cumsum(first) - 1]] if n else before
    at = np.empty(n, np.int64)
    at[order] = before - started + (parent[order] >= 0)
    top = np.arange(n)
    for level in levels:
        inner = level[parent[level] >= 0]
        at[inner] += at[parent[inner]]
        top[inner] = top[parent[inner]]

    weight, out, live, centre = size.copy(), np.zeros_like(values), np.arange(n), np.empty(n, np.int64)
    number, total = np.empty(n, np.int64), np.zeros_like(values)
    while len(live):
        heavy = live[2 * weight[live] > weight[top[live]]]
        heavy = heavy[np.lexsort((depth[heavy], top[heavy]))]
        found = heavy[np.r_[np.diff(top[heavy]) != 0, True]]                # the deepest of each component
        centre[top[found]] = found
        number[top[found]] = np.arange(len(found))
        c = centre[top[live]]
        below = (at[live] > at[c]) & (at[live] < at[c] + size[c])
        total[found] = values[found]
        np.add.at(total, c[below], values[live[below]])
        out[found] += total[found]
        # along every centroid's path to its top at once
        moving = found[found != top[found]]
        up = parent[moving]
        while len(moving):
            out[up] += total[moving]
            weight[up] -= weight[moving]
            on = up != top[moving]
            moving, up = moving[on], parent[up[on]]
        # the pieces below get their own tops: the centroid's child before them in depth-first order
        child = live[parent[live] == c]
        key = number[top[child]] * (n + 1) + at[child]
        child = child[np.argsort(key)]
        key = np.sort(key)
        lower = live[below]
        piece = child[np.searchsorted(key, number[top[lower]] * (n + 1) + at[lower], "right") - 1]
        live = live[live != c]
        top[lower] = piece
    return out


def _finish(columns: int):
    """Whole small components of a task, a bounded number of nodes at a time."""
    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 4 * MOST:
                table = pa.Table.from_batches(held).combine_chunks()
                tops = np.stack([table[c].to_numpy() for c in ("top_owner", "top_depth")], axis=1)
                change = np.flatnonzero((tops[1:] != tops[:-1]).any(axis=1))
                cut = int(change[-1]) + 1 if len(change) else 0             # the last component may go on
                if cut:
                    yield _finished(table.slice(0, cut), columns)
                held, rows = table.slice(cut).to_batches(), table.num_rows - cut
        if rows:
            yield _finished(pa.Table.from_batches(held), columns)
    return run


def _finished(table: pa.Table, columns: int) -> pa.RecordBatch:
    """Rows are sorted by component, depth and owner."""
    get = lambda c: table[c].to_numpy()
    owner, depth, parent = get("owner"), get("depth"), get("parent")
    top_owner, top_depth = get("top_owner"), get("top_depth")
    level = np.cumsum(np.r_[0, (np.diff(top_owner) != 0) | (np.diff(top_depth) != 0) | (np.diff(depth) != 0)])
    names, place = np.unique(np.concatenate([owner, parent]), return_inverse=True)
    key = level * len(names) + place[:len(owner)]
    # the depths of a component follow one another, so a parent's level is the one before
    up = np.searchsorted(key, (level - 1) * len(names) + place[len(owner):])
    up = np.where(depth > top_depth, up, -1)
    values = np.stack([get(f"own{k}") for k in range(columns)], axis=1)
    sums = forest_sums(up, depth, values)
    return pa.record_batch([pa.array(owner), pa.array(depth), *[pa.array(get(f"sum{k}") + sums[:, k]) for k in range(columns)]],
                           names=["owner", "depth", *[f"sum{k}" for k in range(columns)]])


def rollup(scratch: Scratch, nodes: DataFrame, paths: DataFrame, values: Sequence[str], most: int = MOST) -> DataFrame:
    """Sums of the columns ``values`` of ``nodes`` over every node's subtree.

    A node is known by (owner, depth): ``owner`` is the smallest sequence through it.
    ``nodes``: owner, depth, parent (the parent's owner; null at the one root, of depth 0), weight
    (of the whole subtree, at least 1 more than all its children's), the values.
    ``paths``: conv, depth, owner, parent: the nodes of depth 1 and more on the way of every
    sequence that owns a node. Returns owner, depth and a sum for each value, under its name.
    """
    k = len(values)
    sums = [f"sum{i}" for i in range(k)]
    state = nodes.select("owner", "depth", F.coalesce("parent", F.lit(-1)).alias("parent"), "weight",
                         *[F.col(v).cast("long").alias(f"own{i}") for i, v in enumerate(values)],
                         *[F.lit(0).cast("long").alias(s) for s in sums])
    # at first all nodes are one component, whose top is the root
    root = nodes.where("depth = 0").agg(F.min("owner")).first()[0]
    state = scratch.stage(state.withColumn("top_owner", F.lit(root).cast("long")).withColumn("top_depth", F.lit(0).cast("long")),
                          "state-0")
    done, small, turn = [], [], 0
    component = ["top_owner", "top_depth"]
    while True:
        turn += 1
        sizes = state.groupBy(*component).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("total"))
        large = scratch.stage(sizes.where(F.col("n") > most).drop("n"), f"large-{turn}")
        if large.isEmpty():
            small.append(state)
            break
        small.append(state.join(large, component, "left_anti"))
        inside = state.join(large, component)
        centres = scratch.stage(
            inside.where(2 * F.col("weight") > F.col("total")).groupBy(*component)
            .agg(F.max_by(F.struct("owner", "depth", "weight"), "depth").alias("c"))
            .select(*component, F.col("c.owner").alias("c_owner"), F.col("c.depth").alias("c_depth"),
                    F.col("c.weight").alias("c_weight")), f"centres-{turn}")
        # a node below the centroid finds the centroid's child on its own sequence's path
        child = paths.select(F.col("conv").alias("owner"), (F.col("depth") - 1).alias("c_depth"),
                             F.col("owner").alias("x_owner"), F.col("parent").alias("x_parent"))
        marked = (inside.drop("total").join(centres, component).join(child, ["owner", "c_depth"], "left")
                  .withColumn("below", F.coalesce((F.col("depth") > F.col("c_depth")) & (F.col("x_parent") == F.col("c_owner")),
                                                  F.lit(False)))
                  .withColumn("centre", (F.col("owner") == F.col("c_owner")) & (F.col("depth") == F.col("c_depth"))))
        marked = scratch.stage(marked, f"marked-{turn}")
        totals = (marked.where("below or centre").groupBy("c_owner", "c_depth")
                  .agg(*[F.sum(f"own{i}").alias(f"add{i}") for i in range(k)])
                  .join(centres, ["c_owner", "c_depth"]))
        totals = scratch.stage(totals, f"totals-{turn}")
        adds = [f"add{i}" for i in range(k)]
        way = (totals.join(paths.select(F.col("conv").alias("c_owner"), "depth", "owner"), "c_owner")
               .where((F.col("depth") < F.col("c_depth")) & (F.col("depth") >= F.col("top_depth")))
               .select("owner", "depth", F.col("c_weight").alias("less"), *adds))
        to_root = (totals.where("top_depth = 0 and c_depth > 0")
                   .select(F.col("top_owner").alias("owner"), F.col("top_depth").alias("depth"), F.col("c_weight").alias("less"), *adds))
        own = totals.select(F.col("c_owner").alias("owner"), F.col("c_depth").alias("depth"), F.lit(0).cast("long").alias("less"), *adds)
        given = reduce(DataFrame.unionByName, [way, to_root, own])
        nxt = marked.join(given, ["owner", "depth"], "left").select(
            "owner", "depth", "parent", (F.col("weight") - F.coalesce("less", F.lit(0))).alias("weight"),
            *[f"own{i}" for i in range(k)],
            *[(F.col(f"sum{i}") + F.coalesce(f"add{i}", F.lit(0))).alias(f"sum{i}") for i in range(k)],
            F.when(F.col("below"), F.col("x_owner")).otherwise(F.col("top_owner")).alias("top_owner"),
            F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"), "centre")
        nxt = scratch.stage(nxt, f"next-{turn}")
        done.append(nxt.where("centre").select("owner", "depth", *sums))
        state = nxt.where("not centre").drop("centre")
    schema = "owner long, depth long, " + ", ".join(f"{s} long" for s in sums)
    rest = (reduce(DataFrame.unionByName, small).drop("weight").repartition(*component)
            .sortWithinPartitions(*component, "depth", "owner").mapInArrow(_finish(k), schema))
    every = reduce(DataFrame.unionByName, [*done, rest])
    return every.select("owner", "depth", *[F.col(s).alias(v) for s, v in zip(sums, values, strict=True)])
