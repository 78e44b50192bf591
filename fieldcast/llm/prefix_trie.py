"""Prefix trie of conversations, with subtree totals rolled up in bands of depths.

Turns are ordered by turn number (null first; ties by role, then text); null roles and texts are
empty.  A node stands for each distinct sequence of first turns, from the root without turns; it
is named by its depth and two 64-bit words, the exclusive-or of a hash of (place, role, text) over
its turns.  So places of a conversation need no chain: prefixes are running exclusive-ors, and a
turn taken from another conversation keeps its hash.

Long conversations.  Turns are sorted over the whole cluster by conversation and turn; a
conversation that spreads over several sorted parts is numbered inside each part, and parts add
their offsets.  No task needs all turns of a conversation.

Roll-up by bands (`rolled_up`).  Depths are cut into bands of `BAND`.  A node explodes only to its
ancestors inside its band, which gives totals inside bands.  The nodes at band tops then form a
trie that is `BAND` times lower; it is rolled up in the same way, and completed totals of band
tops go to the ancestors in the band above.  A trie of depth D takes log(D) / log(BAND) rounds,
and no node explodes to more than 2 * BAND rows in each.

Conversations that end at a node are hashed in number order: up to `CHUNK` neighbouring numbers are
joined by an aggregate, and one task streams the joined strings of a node through SHA-256, which
cannot be split.

Defined cases: rows without conversation number belong to none and are left out; a repeated row is
a turn of its own; empty tables give no rows; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.llm import common

BAND = 8
CHUNK = 4096
#: Prefixes are taken over from the first conversation of each block of this many numbers.
BLOCK = 100
#: Fewer turns than this are taken over: crc32(number) modulo it.
MOST_SHARED = 6


def hashed(place: Column, role: Column, text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a turn at a place."""
    return tuple(F.xxhash64(F.lit(seed), place, role, text) for seed in (1, 2))


def ordered(turns: DataFrame) -> DataFrame:
    """conv_id, at (place from 1), role, text, part: turns in order, numbered across parts."""
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_rows = common.pinned(rows.repartitionByRange(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text").withColumn(
        "part", F.spark_partition_id()))
    inside = Window.partitionBy("part", "conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text")
    here = sorted_rows.withColumn("k", F.row_number().over(inside))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = sorted_rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).withColumn(
        "start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return here.join(parts.select("conv_id", "part", "start"), ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("start") + F.col("k")).alias("at"), "role", "text")


def _turn(place: Column) -> list[Column]:
    x1, x2 = hashed(place, F.col("role"), F.col("text"))
    return [place.cast("long").alias("place"), x1.alias("e1"), x2.alias("e2"),
            F.length("text").cast("long").alias("chars")]


def rebuilt(turns: DataFrame, block: int = BLOCK, most: int = MOST_SHARED) -> DataFrame:
    """Prefixes of the rebuilt conversations: conv_id, depth, x1, x2, e1, e2, chars, ends.

    Conversation c starts with the first h turns of conversation ``c - c % block`` (all if there
    are fewer, none if it does not exist), then its own turns after its first h follow;
    h = crc32(c) % most.  x: name of the prefix, e: hash of its last turn, ends: it is the whole
    conversation.
    """
    rows = common.pinned(ordered(turns))
    heads = rows.where((F.col("conv_id") % block == 0) & (F.col("at") < most)).select(
        F.col("conv_id").alias("base"), F.struct(*_turn(F.col("at"))).alias("t")).groupBy(
        "base").agg(F.sort_array(F.collect_list("t")).alias("head"))  # at most `most` turns
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % block)
    convs = common.pinned(convs.join(heads, "base", "left").select(
        "conv_id", "n", "h", F.coalesce(F.slice("head", 1, F.col("h").cast("int")),
                                        F.array().cast(heads.schema["head"].dataType))
        .alias("head")).withColumn("m", F.size("head").cast("long")).withColumn(
        "length", F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h"))))
    # names of the first m prefixes: running exclusive-or over the few turns taken over
    name = lambda i: [F.aggregate(F.slice("head", 1, i), F.lit(0).cast("long"),
                                  lambda a, t: a.bitwiseXOR(t[e])).alias(x)
                      for e, x in (("e1", "x1"), ("e2", "x2"))]
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("x1"), zero.alias("x2"),
                        zero.alias("e1"), zero.alias("e2"), zero.alias("chars"),
                        (F.col("length") == 0).alias("ends"))
    taken = convs.where("m > 0").select("*", F.posexplode("head").alias("i", "t")).select(
        "conv_id", F.col("t.place").alias("depth"), *name(F.col("i") + 1), "t.e1", "t.e2",
        "t.chars", (F.col("length") == F.col("t.place")).alias("ends"))
    own = rows.join(convs.select("conv_id", "h", "m", "length",
                                 *(c.alias(f"{c_}0") for c, c_ in zip(name(F.size("head")),
                                                                      ("x1", "x2")))), "conv_id")
    own = own.where(F.col("at") > F.col("h")).select(
        "conv_id", "part", "length", "x10", "x20", *_turn(F.col("at") - F.col("h") + F.col("m")))
    # running exclusive-or inside a part, then over parts
    inside = Window.partitionBy("part", "conv_id").orderBy("place")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = own.groupBy("conv_id", "part").agg(F.bit_xor("e1").alias("p1"),
                                               F.bit_xor("e2").alias("p2"))
    parts = parts.select("conv_id", "part", *(F.coalesce(F.bit_xor(p).over(before), zero).alias(s)
                                              for p, s in (("p1", "s1"), ("p2", "s2"))))
    own = own.select("*", F.bit_xor("e1").over(inside).alias("r1"),
                     F.bit_xor("e2").over(inside).alias("r2")).join(parts, ["conv_id", "part"])
    x = lambda i: F.col(f"x{i}0").bitwiseXOR(F.col(f"s{i}")).bitwiseXOR(
        F.col(f"r{i}")).alias(f"x{i}")
    own = own.select("conv_id", F.col("place").alias("depth"), x(1), x(2), "e1", "e2", "chars",
                     (F.col("length") == F.col("place")).alias("ends"))
    return root.unionByName(taken).unionByName(own)


def _node(depth: str = "depth", x1: str = "x1", x2: str = "x2") -> Column:
    return F.struct(F.col(depth).alias("depth"), F.col(x1).alias("x1"), F.col(x2).alias("x2"))


def lines(prefixes: DataFrame, step: int, band: int) -> DataFrame:
    """node and line: for nodes at depths divisible by ``step``, themselves and the ancestors in
    their band of ``band`` such depths, top first; below also ``above``: the whole line of the
    band above, for band tops (else null).
    """
    height = step * band
    rows = prefixes.where(F.col("depth") % step == 0)
    groups = rows.groupBy("conv_id", F.expr(f"depth div {height}").alias("band")).agg(
        F.sort_array(F.collect_list(_node())).alias("path"))  # at most `band` nodes
    upper = groups.select("conv_id", (F.col("band") + 1).alias("band"),
                          F.col("path").alias("above"))
    both = groups.join(upper, ["conv_id", "band"], "left")
    each = both.select("above", "path", F.posexplode("path").alias("i", "node")).select(
        "node", F.slice("path", 1, F.col("i") + 1).alias("line"),
        F.when(F.col("i") == 0, F.col("above")).alias("above"))
    # all conversations of a node have the same line
    return each.groupBy("node").agg(F.first("line").alias("line"), F.first("above").alias("above"))


def rolled_up(nodes: DataFrame, prefixes: DataFrame, weights: list[str], deepest: int,
              band: int = BAND) -> DataFrame:
    """node and, under the names of ``weights``, their sums over the node's subtree."""
    levels, step = [], 1
    values = nodes.select("node", *weights)
    while True:
        line = common.pinned(lines(prefixes, step, band))
        inside = common.pinned(values.join(line, "node").select(
            F.explode("line").alias("node"), *weights).groupBy("node").agg(
            *(F.sum(w).alias(w) for w in weights)))
        levels.append((line, inside))
        step *= band
        if step > deepest:
            break
        values = inside.where(F.col("node.depth") % step == 0)
    total = levels[-1][1]
    for line, inside in reversed(levels[:-1]):
        # completed totals of band tops go to all nodes of the line above them
        passed = total.join(line.where(F.col("above").isNotNull()).select("node", "above"),
                            "node").select(F.explode("above").alias("node"), *weights)
        total = common.pinned(inside.unionByName(passed).groupBy("node").agg(
            *(F.sum(w).alias(w) for w in weights)))
    return total


def ends_digest(prefixes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """node and the SHA-256 of the numbers of the conversations that end there, comma-joined."""
    chunks = prefixes.where("ends").select(_node().alias("node"), "conv_id").groupBy(
        "node", (F.col("conv_id") - F.pmod("conv_id", F.lit(chunk))).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_set("conv_id")),
                                 lambda c: c.cast("string")), ",").alias("joined"))
    slim = chunks.select("node.depth", "node.x1", "node.x2", "chunk", "joined")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, out = None, None, []
        for batch in batches:
            for depth, x1, x2, _, joined in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, x1, x2) == last:
                    state.update(b",")
                else:
                    if last is not None:
                        out.append((*last, state.hexdigest()))
                    last, state = (depth, x1, x2), hashlib.sha256()
                state.update(joined.encode())
            if out:
                yield _digests(out)
                out = []
        if last is not None:
            yield _digests([(*last, state.hexdigest())])

    found = slim.repartition("depth", "x1", "x2").sortWithinPartitions(
        "depth", "x1", "x2", "chunk").mapInArrow(
        run, "depth long, x1 long, x2 long, ends_sha256 string")
    return found.select(_node().alias("node"), "ends_sha256")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        names=["depth", "x1", "x2", "ends_sha256"])


def trie(turns: DataFrame, block: int = BLOCK, most: int = MOST_SHARED,
         band: int = BAND) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (code points not to be stored again in the subtree), ends_sha256.
    """
    prefixes = common.pinned(rebuilt(turns, block, most))
    nodes = prefixes.groupBy(_node().alias("node")).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.first("chars").alias("chars"),  # all members have the same last turn
        F.first("e1").alias("e1"), F.first("e2").alias("e2"))
    x = lambda i: F.col(f"node.x{i}").bitwiseXOR(F.col(f"e{i}")).alias(f"x{i}")
    nodes = nodes.withColumn("parent", F.when(F.col("node.depth") > 0, F.struct(
        (F.col("node.depth") - 1).alias("depth"), x(1), x(2))))
    nodes = common.pinned(nodes)
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children"))
    nodes = common.pinned(nodes.join(children, "node", "left").select(
        "node", "conv_id", "n_convs", "parent", F.coalesce("n_children", F.lit(0))
        .alias("n_children"), F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")
        .alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")))
    deepest = nodes.agg(F.max("node.depth")).first()[0] or 0
    totals = rolled_up(nodes, prefixes, ["n_leaves", "saved_tokens"], deepest, band)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.drop("n_leaves", "saved_tokens").join(totals, "node")
            .join(ends_digest(prefixes), "node", "left").join(parents, "parent", "left")
            .select("conv_id", F.col("node.depth").alias("depth"), "parent_conv_id", "n_convs",
                    "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
