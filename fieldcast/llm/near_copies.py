"""Near copies by SimHash, and by exact Jaccard similarity of five-word shingles.

Two texts are near copies if their sets of word shingles have a Jaccard similarity of `SHARE` or
more; near copies of near copies are one group, of which one document stays.  Texts with one set
are one node.

SimHash.  The links of `simhash` (fingerprints within 4 bits, the method of the operator) are
the first candidates.  An exact check follows: a link counts if the texts are near copies.

Other candidates.  Near copies may differ in more bits.  With all shingles in one order, two sets
of that similarity share a shingle among the first ``size - ceil(SHARE * size) + 1`` of each
(prefix filter), and the places of the first one that they share leave room for enough others
(positional filter).  Only nodes that meet at such a shingle are compared, and no pair is left
out.  Rare shingles come first: hashed counters, of at most `COUNTER_BYTES`, give the order.  They
count the shingles of all documents, in units that grow with the input; they bear on the number of
candidates only.

Few nodes.  A shingle that `FEW` nodes or less have is settled where they meet: their pairs that
pass both filters are candidates, and it takes no part in the rounds.  Those still in different
groups after the rounds are compared.

Rounds.  After SimHash every node is compared with one node at each of its frequent shingles, and
nodes found to be near copies are joined to groups.  That node is first the one with the fewest
rarer shingles, which is the most like the others, and then one by hash; after the first round
others follow, at most `STARS` in all, while there are more open pairs than rows.  Then all nodes
at a shingle that are still in different groups are compared.  So a large group costs comparisons
in proportion to its rows, and no link between groups is lost.  Nodes at a very frequent shingle
are dealt out as pairs of tiles of `TILE` nodes over many tasks.

Texts.  Only those of candidates move, picked by a Bloom filter in the scan, and similarities are
computed from whole texts.  Documents that surely stay do not move at all.

Defined cases: null and empty texts are copies of each other; fewer words than a shingle has: the
whole sequence; the smallest id of a group stays, null ids last, of equal ids the text with the
smallest hash, of equal rows one; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast.llm import bloom, common, simhash

WORDS = 5
SHARE = 0.8
SEED = 42
STARS = 4
TILE = 2048
#: Nodes of a shingle that are compared where they meet, without rounds.
FEW = 32
#: Bytes of the counters and of a Bloom filter at most; characters for each counter wanted.
COUNTER_BYTES, FILTER_BYTES, CHARS_PER_COUNTER = 1 << 24, 1 << 24, 8
#: What a counter is to show on average; with more shingles it shows whole units of several.
COUNTER_LOAD = 4
#: Pairs that a task holds before it hands them on.
FLUSH = 1 << 18
NO_ID = -(1 << 63)


class _Words(dict):
    """Hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1 << 16:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


_WORDS = _Words()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles, A-Z lower-cased."""
    parts = text.encode().lower().split()
    own = np.fromiter(map(_WORDS.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(own))
    out = np.full(max(1, len(own) - words + 1), width + 1, np.uint64)
    for at in range(width):
        out = _mixed(out + own[at:at + len(out)])
    return np.unique(out.view(np.int64))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def needed(size: int, share: float) -> int:
    """Fewest shingles that a near copy of a text of ``size`` shingles shares with it."""
    return math.ceil(share * size - 1e-9)


def row_key(text: str, doc_id: str) -> Column:
    """64-bit key of a document's id and text."""
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)),
                      F.coalesce(F.col(text), F.lit("")))


def frequencies(texts: DataFrame, words: int, most_bytes: int):
    """Broadcast counters of the documents each shingle is in; ``texts``: one column.

    All texts are counted.  Beyond `COUNTER_LOAD` shingles a counter, the sums over all tasks are
    shown in larger units: a byte that is full would tell no frequent shingle from a rare one.
    """
    chars = texts.agg(F.sum(F.length(texts.columns[0]))).first()[0] or 0
    wanted = chars / CHARS_PER_COUNTER
    size = bloom.counters_for(wanted, most_bytes)
    unit = max(1, math.ceil(wanted / size / COUNTER_LOAD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(size, np.uint8)
        for batch in batches:
            for value in common.strings(batch.column(0)):
                bloom.count(counters, shingles(value, words).view(np.uint64))
        yield from bloom.counter_pieces(counters)

    filled = bloom.counted(texts.mapInArrow(run, "segment int, counts binary"), size, unit)
    return texts.sparkSession.sparkContext.broadcast(filled)


def marked(df: DataFrame, words: int, share: float, text: str, doc_id: str,
           most_bytes: int = COUNTER_BYTES) -> DataFrame:
    """key, id, node, size, fp (the SimHash) and the tokens of the prefix in order."""
    import xxhash

    value = F.coalesce(F.col(text), F.lit(""))
    counts = frequencies(df.select(value.alias("text")), words, most_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = counts.value
        for batch in common.slices(batches):
            node, size, tokens, fps = [], [], [], []
            for item in common.strings(batch.column(2)):
                own = shingles(item, words)
                often = seen[(own.view(np.uint64) & np.uint64(len(seen) - 1)).astype(np.int64)]
                order = np.argsort(often, kind="stable")[:len(own) - needed(len(own), share) + 1]
                node.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                size.append(len(own))
                tokens.append(own[order])
                fps.append(simhash.fingerprint(item))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), simhash.signed(node), pa.array(size, pa.int32()),
                 simhash.signed(fps), common.list_array(np.concatenate(tokens),
                                                        [len(t) for t in tokens])],
                names=["key", "id", "node", "size", "fp", "tokens"])

    return df.select(row_key(text, doc_id).alias("key"), F.col(doc_id).cast("long").alias("id"),
                     value.alias("text")).mapInArrow(
        run, "key long, id long, node long, size int, fp long, tokens array<long>")


def alike(rows: DataFrame) -> DataFrame:
    """Pairs (early, late) of nodes that SimHash links; ``rows``: of `marked`.

    Of all nodes of one fingerprint one stands for it and meets the others.
    """
    own = common.pinned(rows.select("fp", "node").distinct())
    heads = common.pinned(own.groupBy("fp").agg(F.min("node").alias("head")))
    same = own.join(heads, "fp").select(F.col("head").alias("a"), F.col("node").alias("b"))
    side = lambda fp, out: heads.select(
        F.col("fp").alias(fp), F.col("head").alias(out))
    linked = simhash.links(heads.select("fp")).withColumnsRenamed({"a": "x", "b": "y"}).join(
        side("x", "a"), "x").join(side("y", "b"), "y").select("a", "b")
    return same.unionByName(linked).where("a <> b").select(
        F.least("a", "b").alias("early"), F.greatest("a", "b").alias("late")).distinct()


def met(nodes: DataFrame, share: float, few: int) -> DataFrame:
    """token, node, size, place, other: what the prefix shingles that several nodes have tell.

    A shingle of ``few`` nodes or less is settled on the spot: its pairs that may be near copies
    are rows with the two nodes in ``node`` and ``other``.  One of more nodes gives a row for each
    of them, and ``other`` is null.
    """
    rows = nodes.select("node", "size", F.explode(F.arrays_zip("tokens", "places")).alias("t"))
    ordered = rows.select(F.col("t.tokens").alias("token"), "node", "size",
                          F.col("t.places").alias("place")).repartition(
        "token").sortWithinPartitions("token")
    few, ratio = max(few, 1), share / (1 + share)

    def rows_of(token, node, size, place, other=None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(token), pa.array(node), pa.array(size, pa.int32()),
             pa.array(place, pa.int32()),
             pa.nulls(len(token), pa.int64()) if other is None else pa.array(other)],
            names=["token", "node", "size", "place", "other"])

    def settled(columns: np.ndarray, frequent: int | None) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.diff(columns[0], prepend=columns[0, :1] - 1))
        lengths = np.diff(starts, append=columns.shape[1])
        if frequent is not None:
            lengths[columns[0, starts] == frequent] += few
        many = np.repeat(lengths > few, np.diff(starts, append=columns.shape[1]))
        if many.any():
            yield rows_of(*columns[:, many])
        token, node, size, place = columns[:, ~many]
        for step in range(1, few):
            first = np.flatnonzero(token[step:] == token[:-step])
            if not len(first):
                return
            second = first + step
            a, b = size[first], size[second]
            room = np.minimum(a - place[first], b - place[second])
            hit = ((np.minimum(a, b) >= share * np.maximum(a, b) - 1e-9)
                   & (room >= (a + b) * ratio - 1e-9))
            if hit.any():
                x, y = node[first[hit]], node[second[hit]]
                zero = np.zeros(len(x), np.int64)
                yield rows_of(zero, np.minimum(x, y), zero, zero, np.maximum(x, y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, frequent = np.zeros((4, 0), np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            here = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            here = np.concatenate([held, here], axis=1)
            # the last shingle waits for its other nodes, unless it has too many already
            at = np.searchsorted(here[0], here[0, -1])
            if here.shape[1] - at > few or here[0, -1] == frequent:
                at = here.shape[1]
            if at:
                yield from settled(here[:, :at], frequent)
                if at == here.shape[1]:
                    frequent = here[0, -1]
            held = here[:, at:]
        if held.shape[1]:
            yield from settled(held, frequent)

    return ordered.mapInArrow(run, "token long, node long, size int, place int, other long")


def postings(nodes: DataFrame) -> DataFrame:
    """token, node, size, place: a row per node and prefix shingle that another node has too."""
    return met(nodes, SHARE, 1).drop("other")


def stars(rows: DataFrame, share: float, turn: int = 0) -> DataFrame:
    """Pairs (early, late) of nodes with one node of a shingle, in another group.

    ``rows``: postings and the group (label) of each.  The first turn takes the node with the
    smallest place, that is the fewest rarer shingles, others a node by hash.
    """
    by = F.col("place").cast("long") if turn == 0 else F.xxhash64(F.lit(turn), "node")
    leads = rows.groupBy("token").agg(
        F.min(F.struct(by.alias("by"), "node", "size", "place", "label")).alias("lead"),
        F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
    small, large = F.least("size", "lead.size"), F.greatest("size", "lead.size")
    room = F.least(F.col("size") - F.col("place"), F.col("lead.size") - F.col("lead.place"))
    overlap = F.ceil((small + large) * (share / (1 + share)) - 1e-9)
    return rows.join(leads, "token").where(
        (F.col("label") != F.col("lead.label")) & (small >= share * large - 1e-9)
        & (room >= overlap)).select(F.least("lead.node", "node").alias("early"),
                                    F.greatest("lead.node", "node").alias("late")).distinct()


def open_pairs(rows: DataFrame) -> int:
    """Pairs of nodes in different groups, summed over the shingles."""
    n = F.col("n").cast("double")
    held = rows.groupBy("token", "label").agg(F.count("*").alias("n")).groupBy("token").agg(
        ((F.sum(n) * F.sum(n) - F.sum(n * n)) / 2).alias("pairs"))
    return int(held.agg(F.sum("pairs")).first()[0] or 0)


def crossings(rows: DataFrame, share: float, tile: int = TILE) -> DataFrame:
    """All pairs (early, late) of nodes at a shingle that are in different groups."""
    active = rows.groupBy("token").agg(
        F.count("*").alias("n"), F.min("label").alias("least"), F.max("label").alias("most")).where(
        "least < most").select("token", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    cut = F.pmod(F.xxhash64(F.lit(5), "node"), F.col("tiles")).cast("int")
    dealt = rows.join(active, "token").withColumn("cut", cut).select(
        "token", "node", "size", "place", "label", "cut",
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        F.xxhash64("token", F.least("cut", "other"), F.greatest("cut", "other")).alias("unit"),
        "token", "node", "size", "place", "label", "cut", "other")
    ratio = share / (1 + share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number = [], 0

        def compare(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            node, size, place, label, side = np.concatenate(parts, axis=1)
            left, right = size - place, side
            for i in range(len(node) - 1):
                rest = slice(i + 1, None)
                a, b = np.minimum(size[i], size[rest]), np.maximum(size[i], size[rest])
                # two tiles meet each other here, a tile meets itself in a unit of its own
                hit = np.flatnonzero(
                    (label[rest] != label[i]) & (a >= share * b - 1e-9)
                    & (np.minimum(left[i], left[rest]) >= (a + b) * ratio - 1e-9)
                    & ((right[rest] != right[i]) | (right[i] == 0))) + i + 1
                if len(hit):
                    x = np.full(len(hit), node[i])
                    out.append(np.stack([np.minimum(x, node[hit]), np.maximum(x, node[hit])]))
                    number += len(hit)
                    if number >= FLUSH:
                        yield _pairs(out)
                        number = 0

        last, held = None, []
        for batch in batches:
            unit, node, size, place, label, mine, other = (c.to_numpy() for c in batch.columns)
            side = np.sign(mine.astype(np.int64) - other)
            columns = np.stack([c.astype(np.int64) for c in (node, size, place, label, side)])
            cuts = np.flatnonzero(np.diff(unit)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(unit)]):
                if a == b:
                    continue
                if unit[a] != last:
                    if held:
                        yield from compare(held)
                    last, held = unit[a], []
                held.append(columns[:, a:b])
        if held:
            yield from compare(held)
        if out:
            yield _pairs(out)

    ordered = dealt.select("unit", "node", "size", "place", "label", "cut", "other").repartition(
        "unit").sortWithinPartitions("unit")
    return ordered.mapInArrow(run, "early long, late long").distinct()


def _pairs(out: list[np.ndarray]) -> pa.RecordBatch:
    both = np.unique(np.concatenate(out, axis=1), axis=1)
    out.clear()
    return pa.RecordBatch.from_arrays([pa.array(x.copy()) for x in both], names=["early", "late"])


def picked(df: DataFrame, key: str, wanted: bloom.Shared, inside: bool = True) -> DataFrame:
    """Rows of ``df`` whose key the filter may hold, or those whose key it does not hold."""
    at = df.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = wanted.contains(batch.column(at).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(hit == inside))

    return df.mapInArrow(run, df.schema)


def verified(found: DataFrame, nodes: DataFrame, texts: DataFrame, words: int,
             share: float) -> DataFrame:
    """Links (a, b) of candidates that are near copies; ``texts``: key and text."""
    asked = found.select(F.col("early").alias("node")).unionByName(
        found.select(F.col("late").alias("node"))).distinct()
    keys = common.pinned(nodes.join(asked, "node").select("node", F.col("first.key").alias("key")))
    some = picked(texts, "key", bloom.filter_of(keys.select("key"), FILTER_BYTES))
    # equal rows have equal keys: one text for each node
    held = common.pinned(some.join(keys, "key").select("node", "text").dropDuplicates(["node"]))
    side = lambda n, t: held.select(F.col("node").alias(n), F.col("text").alias(t))
    both = found.join(side("early", "a"), "early").join(side("late", "b"), "late").select(
        "early", "late", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            same = pa.array([similarity(shingles(a, words), shingles(b, words)) >= share - 1e-9
                             for a, b in zip(*(common.strings(c) for c in batch.columns[2:]))],
                            pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(same) for c in batch.columns[:2]],
                                             names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def divided(found: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (early, late) whose nodes are in different groups."""
    side = lambda n, r: roots.select(F.col("node").alias(n), F.col("root").alias(r))
    return found.join(side("early", "x"), "early", "left").join(
        side("late", "y"), "late", "left").where(
        F.coalesce("x", "early") != F.coalesce("y", "late")).select("early", "late")


def grouped(rows: DataFrame, texts: DataFrame, words: int = WORDS,
            share: float = SHARE) -> DataFrame:
    """Nodes with their first document and group: node, first, label; ``rows``: of `marked`."""
    first = F.struct(F.col("id").isNull().alias("last"), "id", "key")
    nodes = common.pinned(rows.groupBy("node").agg(
        F.min(first).alias("first"), F.first("size").alias("size"),
        F.first("tokens").alias("tokens")))
    places = F.transform("tokens", lambda _, i: i.cast("int"))
    tokens = common.pinned(met(nodes.withColumn("places", places), share, FEW))
    shared = tokens.where("other is null").drop("other")
    rare = common.pinned(tokens.where("other is not null").select(
        F.col("node").alias("early"), F.col("other").alias("late")).distinct())
    most = shared.count()
    links = common.pinned(verified(common.pinned(alike(rows)), nodes, texts, words, share))
    turn, last = 0, not most
    while not last:
        roots = simhash.components(links)
        open_rows = shared.join(roots, "node", "left").withColumn(
            "label", F.coalesce("root", "node")).drop("root")
        last = turn >= STARS or (turn > 0 and open_pairs(open_rows) <= most)
        found = common.pinned(crossings(open_rows, share) if last
                              else stars(open_rows, share, turn))
        links = links.unionByName(common.pinned(verified(found, nodes, texts, words, share)))
        turn += 1
    apart = common.pinned(divided(rare, simhash.components(links)))
    links = links.unionByName(common.pinned(verified(apart, nodes, texts, words, share)))
    roots = simhash.components(links)
    labelled = nodes.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node"))
    return labelled.select("node", "first", "label")


def keep_first(df: DataFrame, words: int = WORDS, share: float = SHARE, text: str = "text",
               doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``df`` with all their columns, one of each group of near copies."""
    rows = common.pinned(marked(df, words, share, text, doc_id))
    texts = df.select(row_key(text, doc_id).alias("key"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))
    groups = grouped(rows, texts, words, share)
    stay = groups.groupBy("label").agg(F.min("first").alias("w")).select(F.col("w.key").alias("key"))
    unsure = common.pinned(rows.groupBy("key").agg(F.count("*").alias("n")).join(
        stay.withColumn("stays", F.lit(True)), "key", "left").where(
        F.col("stays").isNull() | (F.col("n") > 1)).select("key", "stays"))
    name = common.own_name(df, "key_of_row")
    keyed = df.withColumn(name, row_key(text, doc_id))
    wanted = bloom.filter_of(unsure.select("key"), FILTER_BYTES)
    # what the filter does not hold stays; the rest is looked up, and of equal rows one stays
    sure = picked(keyed, name, wanted, inside=False)
    some = picked(keyed, name, wanted)
    gone = unsure.where(F.col("stays").isNull()).select(F.col("key").alias(name))
    left = some.join(gone, name, "leftanti").dropDuplicates([name])
    return sure.unionByName(left).drop(name)
