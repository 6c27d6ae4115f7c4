"""The prefix trie of conversations, with balanced rollups over its subtrees.

1. *Turns get their ranks* by a range-partitioned sort: a task knows the places of its
   own rows, and a conversation that spans tasks gets the number of its rows in earlier
   ones added. No conversation is gathered in one place.
2. *Prefixes get names*: a turn at a place is a pair of 64-bit hashes of role, text and
   place, and a prefix is the exclusive or of its turns. Running values restart in blocks
   of ``BLOCK`` turns, to which the value of all earlier blocks is added.
3. *Equal sequences are one*: only the smallest conversation of each distinct sequence
   goes on, with the number of its copies. Grouping its prefixes gives the nodes; a
   node's owner is its smallest member, and (owner, depth) names the node.
4. *Subtree sums* by centroid decomposition of the parent edges (``centroids``).
5. *Digests of members* that end in a node: ids are sorted over all tasks, joined to
   chunks, and the chunks of a node go through one hash state in order.

Defined cases: rows with a null id are left out; a null turn comes first, equal turns go
by role and then by the hashes of their texts; null roles and texts are empty; repeated
rows are turns of their own; a conversation without turns is a member of the root alone;
without any conversation there is no node; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import centroids
from .common import Scratch

#: Turns of a conversation whose running hash one task computes.
BLOCK = 4096
#: Ids in a chunk of a node's members.
CHUNK = 512
PLACES = (1 << 33) - 1


def ranked_turns(scratch: Scratch, conversations: DataFrame, id_column: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """conv, rank (from 0), a and b (hashes of role and text), bytes (of the text)."""
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    turns = conversations.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("role"),
        F.xxhash64(who, what).alias("a"), F.xxhash64(F.lit(1), what, who).alias("b"), F.octet_length(what).cast("long").alias("bytes"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("a"), F.col("b")]
    placed = scratch.stage(
        turns.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv", "a", "b", "bytes", F.monotonically_increasing_id().alias("at")), "placed")
    placed = placed.withColumn("task", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit(PLACES)))
    # one row a conversation and task; a conversation has rows in few tasks
    runs = placed.groupBy("conv", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv", "task", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return placed.join(runs, ["conv", "task"]).select(
        "conv", (F.col("at") - F.col("first") + F.col("before")).alias("rank"), "a", "b", "bytes")


def with_borrowed_starts(turns: DataFrame, ids: DataFrame, lender: Callable[[Column], Column],
                         length: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first ``length`` turns of another one, then their own turns after as many.

    ``turns`` as of ``ranked_turns``, ``ids``: conv. Returns the rebuilt turns (conv, place, a, b, bytes, n) and
    the rebuilt conversations (conv, n: their number of turns).
    """
    have = ids.join(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")), "conv", "left").na.fill(0, ["own"])
    plan = have.select("conv", "own", lender(F.col("conv")).alias("lender"), length(F.col("conv")).cast("long").alias("h"))
    plan = (plan.join(have.select(F.col("conv").alias("lender"), F.col("own").alias("lent")), "lender", "left")
            .withColumn("taken", F.least("h", F.coalesce("lent", F.lit(0))))
            .withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    own = (turns.join(plan.select("conv", "h", "taken", "n"), "conv").where("rank >= h")
           .select("conv", (F.col("taken") + F.col("rank") - F.col("h")).alias("place"), "a", "b", "bytes", "n"))
    lent = (turns.withColumnRenamed("conv", "lender").join(plan.where("taken > 0").select("lender", "conv", "taken", "n"), "lender")
            .where("rank < taken").select("conv", F.col("rank").alias("place"), "a", "b", "bytes", "n"))
    return own.unionByName(lent), plan.select("conv", "n")


def named_prefixes(turns: DataFrame) -> DataFrame:
    """conv, n, depth (from 1), a and b of the prefix, a0 and b0 of the one before, bytes of the last text."""
    at = turns.select("conv", "n", "place", "bytes", F.floor(F.col("place") / BLOCK).alias("block"),
                      F.xxhash64("a", "b", "place").alias("ta"), F.xxhash64(F.lit(2), "b", "a", "place").alias("tb"))
    whole = at.where(F.col("n") > BLOCK).groupBy("conv", "block").agg(F.bit_xor("ta").alias("ca"), F.bit_xor("tb").alias("cb"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select("conv", "block", F.bit_xor("ca").over(earlier).alias("ca"), F.bit_xor("cb").over(earlier).alias("cb"))
    here = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    run = at.select("*", F.bit_xor("ta").over(here).alias("ra"), F.bit_xor("tb").over(here).alias("rb"))
    run = (run.join(carried, ["conv", "block"], "left")
           .withColumn("a", F.col("ra").bitwiseXOR(F.coalesce("ca", F.lit(0))))
           .withColumn("b", F.col("rb").bitwiseXOR(F.coalesce("cb", F.lit(0)))))
    return run.select("conv", "n", (F.col("place") + 1).alias("depth"), "a", "b", F.col("a").bitwiseXOR(F.col("ta")).alias("a0"),
                      F.col("b").bitwiseXOR(F.col("tb")).alias("b0"), "bytes")


NODE = ["depth", "a", "b"]


def _chunks(batches):
    """Sorted (depth, a, b, conv) to rows of at most CHUNK ids of one node, joined by commas."""
    for batch in batches:
        depth, a, b, conv = (batch.column(k).to_pylist() for k in range(4))
        out, start = [], 0
        for i in range(1, len(conv) + 1):
            if i == len(conv) or i - start == CHUNK or (depth[i], a[i], b[i]) != (depth[start], a[start], b[start]):
                out.append((depth[start], a[start], b[start], conv[start], ",".join(map(str, conv[start:i]))))
                start = i
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 4 + (pa.string(),), strict=True)],
                              names=[*NODE, "conv", "ids"])


def _digests(batches):
    """Chunks sorted by node and first id to one digest a node; a node's hash state is all that is kept of it."""
    node, state = None, None
    for batch in batches:
        out = []
        for *at, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4)), strict=True):
            if at != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield _rows(out)
    if node is not None:
        yield _rows([(*node, state.hexdigest())])


def _rows(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 3 + (pa.string(),), strict=True)],
                           names=[*NODE, "digest"])


def member_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids that end in each node, ascending: depth, a, b, digest."""
    chunks = (ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
              .mapInArrow(_chunks, "depth long, a long, b long, conv long, ids string"))
    return (chunks.repartition(*NODE).sortWithinPartitions(*NODE, "conv")
            .mapInArrow(_digests, "depth long, a long, b long, digest string"))


def prefix_trie(scratch: Scratch, turns: DataFrame, convs: DataFrame, most: int = centroids.MOST) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv, place, a, b, bytes, n) over ``convs`` (conv, n).

    Returns conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved (summed over the
    subtree: copies beyond the first times bytes of the last text) and ends_sha256.
    """
    turns, convs = scratch.stage(turns, "turns"), scratch.stage(convs, "convs")
    prefixes = scratch.stage(named_prefixes(turns), "prefixes")
    zero = F.lit(0).cast("long")
    ends = prefixes.where("depth = n").select(*NODE, "conv").unionByName(
        convs.where("n = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv"))
    sequences = ends.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("copies"))
    kept = scratch.stage(prefixes.join(sequences.select("conv", "copies"), "conv"), "kept")
    inner = kept.groupBy(*NODE).agg(
        F.min("conv").alias("owner"), F.sum("copies").alias("n_convs"),
        F.sum(F.col("copies") * (F.col("n") - F.col("depth") + 1)).alias("weight"), F.min("bytes").alias("bytes"),
        F.min("a0").alias("a0"), F.min("b0").alias("b0"))
    root = convs.agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("n") + 1).alias("weight")
                     ).where("n_convs > 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "owner", "n_convs", "weight",
                                                   zero.alias("bytes"), F.lit(None).cast("long").alias("a0"),
                                                   F.lit(None).cast("long").alias("b0"))
    named = scratch.stage(inner.unionByName(root), "named")
    above = named.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("a0"), F.col("b").alias("b0"),
                         F.col("owner").alias("parent"))
    linked = scratch.stage(named.join(above, ["depth", "a0", "b0"], "left").drop("a0", "b0"), "linked")
    children = (linked.where("depth > 0").groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    nodes = linked.join(children, ["owner", "depth"], "left").na.fill(0, ["n_children"]).withColumn(
        "n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = scratch.stage(nodes, "nodes")
    paths = scratch.stage(kept.select("conv", *NODE).join(nodes.select(*NODE, "owner", "parent"), NODE)
                          .select("conv", "depth", "owner", "parent"), "paths")
    sums = centroids.rollup(scratch, nodes, paths, ["n_leaves", "saved"], most)
    none = hashlib.sha256(b"").hexdigest()
    return (nodes.drop("n_leaves", "saved", "weight", "bytes").join(sums, ["owner", "depth"])
            .join(member_digests(ends), NODE, "left")
            .select(F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", "saved", F.coalesce("digest", F.lit(none)).alias("ends_sha256")))


def of_conversations(spark: SparkSession, conversations: DataFrame, lender: Callable[[Column], Column],
                     length: Callable[[Column], Column], id_column: str = "conv_id", most: int = centroids.MOST) -> DataFrame:
    """The trie of conversations rebuilt with the first turns of others."""
    scratch = Scratch(spark, "trie")
    turns = scratch.stage(ranked_turns(scratch, conversations, id_column), "ranked")
    ids = conversations.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("conv")).distinct()
    return prefix_trie(scratch, *with_borrowed_starts(turns, ids, lender, length), most=most)
