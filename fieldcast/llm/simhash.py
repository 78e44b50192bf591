"""SimHash near-duplicates: exact search of all fingerprints within a few bits.

Fingerprints: 64 bits, each set if more than half of the hashes of a text's word shingles set it.

Search.  Documents with one fingerprint are one node.  Two fingerprints that differ in at most r
bits agree in at least one of r + 1 blocks of bits, so each node goes to r + 1 groups, one per
block value, and no other pairs need a comparison.  A group is cut into tiles by population
count (and, beyond `TILE` rows, by hash), and tiles meet in pairs: exclusive-or of all rows
against all rows with numpy, bit counts, and the pairs within r.  Pairs of tiles whose population
counts differ by more than r are skipped, since each differing bit changes the count by one at
most.  A large group thus spreads over many tasks, one per pair of tiles.  A task returns links
of a spanning forest of its pairs only, never all pairs of a group.

The number of blocks that must agree grows with the number of fingerprints (`plan_blocks`), so
that groups stay small at any size; the pairs found are the same.

Components: links are contracted in rounds over the cluster, each round written to the checkpoint
folder, until few enough are left for one task (`TASK_LINKS`).

Defined cases: null and empty texts have fingerprint zero and are linked like any others; fewer
words than a shingle has: the whole sequence; repeated rows and ids share a component; a null id
counts for linking and is never the name of a component (a component of null ids is null); an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast.llm import common

WORDS = 4
RADIUS = 4
SEED = 42
TILE = 4096
#: Links that one task may resolve (about 100 MB there).
TASK_LINKS = 500_000
#: Mean rows per group above which one more block must agree.
GROUP_ROWS = 2048
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash of a text, A-Z lower-cased, over its word shingles with repeats."""
    import xxhash

    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:len(parts) - words]]).tolist()
    stops = (ends[words - 1:] - 1).tolist()
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)),
                         np.uint64, len(starts))
    split = hashes.view(np.uint8).reshape(-1, 8)  # little-endian: byte 0 has the lowest bits
    ones = np.concatenate([np.bincount(split[:, i], minlength=256) @ _BITS for i in range(8)])
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def signed(values: list[int]) -> pa.Array:
    """Unsigned 64-bit values as Spark's long, bit by bit."""
    return pa.array(np.array(values, np.uint64).view(np.int64))


def fingerprints(df: DataFrame, words: int = WORDS, text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """doc_id and its fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = [fingerprint(t, words) for t in common.strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), signed(found)],
                                             names=["doc_id", "fp"])

    return common.texts(df, text=text, doc_id=doc_id).mapInArrow(run, "doc_id long, fp long")


def plan_blocks(nodes: int, radius: int, group_rows: int = GROUP_ROWS) -> tuple[int, int]:
    """(blocks, blocks that must agree): the fewest that keep groups near the size wanted."""
    for agree in range(1, 5):
        blocks = radius + agree
        if nodes / 2 ** (64 * agree // blocks) <= group_rows:
            break
    return blocks, agree


def keys_of(fp: Column, blocks: int, agree: int) -> list[Column]:
    """One column per choice of blocks: the choice and the bits of its blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    out = []
    for at, chosen in enumerate(combinations(range(blocks), agree)):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        value = fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
        out.append(F.struct(F.lit(at).alias("choice"), value.alias("bits")))
    return out


def tile_links(fps: np.ndarray, side: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning links of the pairs within the radius.

    ``side`` is 0 for both roles of one tile against itself, or 1 and 2 for two tiles.
    """
    links: list[tuple[int, int]] = []
    own = np.flatnonzero(side == 0)
    first, second = (own, own) if own.size else (np.flatnonzero(side == 1),
                                                 np.flatnonzero(side == 2))
    if not first.size or not second.size:
        return links
    count = np.bitwise_count(fps).astype(np.int16)
    first = first[np.argsort(count[first], kind="stable")]
    second = second[np.argsort(count[second], kind="stable")]
    label = np.arange(len(fps))
    step = 512
    for i in range(0, len(first), step):
        rows = first[i:i + step]
        low, high = count[rows[0]] - radius, count[rows[-1]] + radius
        for j in range(i if own.size else 0, len(second), step):
            columns = second[j:j + step]
            if count[columns[-1]] < low or count[columns[0]] > high:
                continue  # no pair of these tiles can lie within the radius
            near = np.bitwise_count(fps[rows][:, None] ^ fps[columns][None, :]) <= radius
            if own.size and i == j:
                np.fill_diagonal(near, False)
            for a in np.flatnonzero(near.any(1)):
                x, hits = int(rows[a]), columns[near[a]]
                # one link per class that the row is not yet in
                classes, at = np.unique(label[hits], return_index=True)
                for other, y in zip(classes, hits[at]):
                    if other != label[x]:
                        links.append((x, int(y)))
                        label[label == other] = label[x]
    return links


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE,
          group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within the radius."""
    blocks, agree = plan_blocks(nodes.count(), radius, group_rows)
    keyed = (nodes.select("fp", F.bit_count("fp").cast("int").alias("ones"),
                          F.explode(F.array(*keys_of(F.col("fp"), blocks, agree))).alias("key"))
             .select("fp", "ones", F.xxhash64("key").alias("key")))
    # sizes of groups, from counts alone: only groups of more than one tile are cut
    sizes = keyed.groupBy("key", "ones").agg(F.count("*").alias("n"))
    big = (sizes.groupBy("key").agg(F.sum("n").alias("rows"), F.collect_list(F.struct(
        "ones", F.ceil(F.col("n") / tile).cast("int").alias("cuts"))).alias("tiles"))
        .where(F.col("rows") > 1))
    cut = F.col("rows") > tile
    joined = keyed.join(big, "key")  # groups of one row have no pairs and drop out
    mine = F.expr("filter(tiles, t -> t.ones = ones)[0].cuts")
    joined = joined.withColumn("cut", F.when(cut, F.pmod(F.xxhash64(F.lit(7), "fp"), mine))
                               .otherwise(0).cast("int"))
    # units of work: (lower tile, upper tile); a row goes to each unit its tile takes part in
    others = F.expr(f"""
        flatten(transform(filter(tiles, t -> abs(t.ones - ones) <= {radius}),
          t -> transform(sequence(0, t.cuts - 1), c -> case
            when t.ones = ones and c = cut
              then named_struct('o1', ones, 'c1', cut, 'o2', ones, 'c2', cut, 'side', 0)
            when t.ones > ones or (t.ones = ones and c > cut)
              then named_struct('o1', ones, 'c1', cut, 'o2', t.ones, 'c2', c, 'side', 1)
            else named_struct('o1', t.ones, 'c1', c, 'o2', ones, 'c2', cut, 'side', 2) end)))""")
    whole = F.expr("array(named_struct('o1', 0, 'c1', 0, 'o2', 0, 'c2', 0, 'side', 0))")
    work = (joined.select("fp", "key", F.explode(F.when(cut, others).otherwise(whole)).alias("u"))
            .select("fp", F.xxhash64("key", "u.o1", "u.c1", "u.o2", "u.c2").alias("unit"),
                    F.col("u.side").alias("side")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []

        def compare(unit: list[np.ndarray]) -> None:
            fps = np.concatenate([u[0] for u in unit])
            if len(fps) > 1:
                side = np.concatenate([u[1] for u in unit])
                found.extend((int(fps[a].view(np.int64)), int(fps[b].view(np.int64)))
                             for a, b in tile_links(fps, side, radius))

        last, held = None, []
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            units, side = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            cuts = np.flatnonzero(np.diff(units)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(units)]):
                if a == b:
                    continue
                if last is not None and units[a] != last:
                    compare(held)
                    held = []
                last = units[a]
                held.append((fps[a:b].copy(), side[a:b].copy()))
            if found:
                yield _pairs(found)
                found.clear()
        if held:
            compare(held)
        if found:
            yield _pairs(found)

    ordered = work.repartition("unit").sortWithinPartitions("unit")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    flat = np.array(found, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, 0].copy()), pa.array(flat[:, 1].copy())],
                                      names=["a", "b"])


def _point(live: DataFrame, turn: int) -> DataFrame:
    """node and up: every node follows the neighbours that hash lower to the end.

    The hash changes with the turn, so that chains of pointers are short whatever the links
    look like; about half of the linked nodes or more move.
    """
    both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = F.min(F.struct(F.xxhash64(F.lit(turn), "b").alias("h"), "b"))
    here = F.struct(F.xxhash64(F.lit(turn), "a").alias("h"), F.col("a").alias("b"))
    up = common.pinned(both.groupBy("a").agg(low.alias("low")).select(
        F.col("a").alias("node"), F.least(here, "low")["b"].alias("up")))
    moved = True
    while moved:
        after = common.pinned(up.alias("x").join(
            up.alias("y"), F.col("x.up") == F.col("y.node")).select(
            F.col("x.node").alias("node"), F.col("y.up").alias("up"),
            (F.col("x.up") != F.col("y.up")).alias("moved")))
        moved = not after.where("moved").isEmpty()
        up = after.select("node", "up")
    return up


def _finish(live: DataFrame) -> DataFrame:
    """node and up of a bounded number of links, by union-find in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(at: int) -> int:
            while up[at] != at:
                up[at] = up[up[at]]
                at = up[at]
            return at

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                up.setdefault(a, a)
                up.setdefault(b, b)
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(up), pa.int64()), pa.array([root(n) for n in up], pa.int64())],
            names=["node", "up"])

    return common.pinned(live.select("a", "b").repartition(1).mapInArrow(
        run, "node long, up long"))


def components(edges: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """node and root (one node of its component), for every linked node but the roots.

    Rounds over the whole cluster move nodes to neighbours, links to where their nodes went, and
    drop links inside one node, until at most ``task_links`` links are left, which one task
    resolves.  Either way gives the same components.
    """
    live = common.pinned(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .where("a < b").distinct())
    roots, turn, left = None, 0, live.count()
    while left:
        last = left <= task_links
        up = _finish(live) if last else _point(live, turn)
        step = up.where("node <> up")
        if roots is None:
            roots = step.withColumnRenamed("up", "root")
        else:
            later = step.select(F.col("node").alias("was"), "up")
            roots = roots.join(later, F.col("root") == F.col("was"), "left").select(
                "node", F.coalesce("up", "root").alias("root")).unionByName(
                step.withColumnRenamed("up", "root"))
        roots = common.pinned(roots)
        if last:
            break
        live = common.pinned(
            live.join(up.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
            .join(up.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .where("a < b").distinct())
        turn, left = turn + 1, live.count()
    if roots is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def near_duplicates(df: DataFrame, words: int = WORDS, radius: int = RADIUS, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fp (signed long) and component_id of every document."""
    rows = common.pinned(fingerprints(df, words, text, doc_id))
    return assign(rows, radius)


def assign(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Components of documents whose fingerprints are given (doc_id, fp)."""
    nodes = common.pinned(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("fp"), radius))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    # every fingerprint once on the right side; a fingerprint of many documents is a skewed key
    # of the left side, which adaptive execution splits
    return rows.join(named.join(lowest, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """16 lowercase hex digits of the 64 bits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_first(df: DataFrame, words: int = WORDS, radius: int = RADIUS, text: str = "text",
               doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``df`` with all their columns, one document of each component.

    The document with the smallest id stays, of equal ids the one with the smallest fingerprint,
    of rows equal in both any one; null ids stay only where a component has no other.
    """
    rows = common.pinned(fingerprints(df, words, text, doc_id))
    # component_id is null where all ids of a component are, so components are keyed by root here
    nodes = common.pinned(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("fp"), radius))
    winners = (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
               .groupBy(F.coalesce("root", "fp").alias("root"))
               .agg(F.min(F.struct(F.col("first").isNull().alias("last"), "first", "fp"))
                    .alias("w")))

    @F.pandas_udf("long")
    def fp_of(values):
        import pandas as pd

        return pd.Series(np.array([fingerprint(v or "", words) for v in values],
                                  np.uint64).view(np.int64))

    name, first, fp = (common.own_name(df, n) for n in ("fp_of_text", "first_id", "first_fp"))
    winners = winners.select(F.col("w.first").alias(first), F.col("w.fp").alias(fp))
    key = F.col(doc_id).cast("long")
    kept = df.withColumn(name, fp_of(F.col(text))).join(
        winners, F.col(first).eqNullSafe(key) & (F.col(fp) == F.col(name)), "leftsemi")
    return kept.dropDuplicates([doc_id, name]).select(*df.columns)
