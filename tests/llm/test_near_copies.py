"""Near copies of the pipeline against brute-force Jaccard similarity."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from fieldcast.llm import near_copies
from tests.llm.conftest import prose

BIG = "/root/testdata/sf0.01"


def slow_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def near(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def check(docs, kept):
    """No two that stay are near copies; all that went lead to one that stays."""
    sets = {d: slow_set(t) for d, t in docs}
    stay = sorted(kept)
    assert len(set(stay)) == len(stay)
    assert not [(a, b) for i, a in enumerate(stay) for b in stay[:i] if near(sets[a], sets[b])]
    reached, edge = set(stay), list(stay)
    while edge:
        at = edge.pop()
        more = [d for d in sets if d not in reached and near(sets[at], sets[d])]
        reached.update(more)
        edge += more
    assert reached == set(sets)


def test_stage_leaves_no_near_copies(spark):
    docs = [(d["doc_id"], d["text"]) for d in
            pq.read_table(f"{BIG}/documents.parquet").to_pylist()]
    out = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(f"{BIG}/documents.parquet"),
                                           BIG)
    check(docs, [r.doc_id for r in out.select("doc_id").collect()])


def test_groups_chains_and_frequent_passages(spark):
    chance, docs = random.Random(5), []
    passage = prose(99, 60)
    for family in range(6):
        words = prose(family, 120).split()
        for _ in range(12):  # a chain: each copy has one to three words changed
            words = list(words)
            for _ in range(chance.randint(1, 3)):
                words[chance.randrange(len(words))] = f"new{chance.random()}"
            docs.append((len(docs), " ".join(words)))
    docs += [(len(docs) + i, f"{passage} {prose(200 + i, 8 + i)}") for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    check(docs, [r.doc_id for r in near_copies.keep_first(frame).collect()])


def test_odd_documents(edge_docs, no_docs):
    kept = near_copies.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [(r.doc_id, r.text or "") for r in kept.collect()]
    # 1 and 2 are copies; of empty, null and blank texts the smallest id stays
    assert sorted(d for d, _ in texts if d is not None) == [1, 3, 6, 7, 7, 8, 9, 10]
    assert kept.where(F.col("doc_id").isNull()).count() == 1
    assert near_copies.keep_first(no_docs).count() == 0


def test_frequent_shingle_is_dealt_out(spark, monkeypatch):
    """One passage in all documents: pairs of tiles, few candidates, groups right."""
    monkeypatch.setattr(near_copies, "STARS", 0)
    passage, docs = prose(99, 12), []
    for i in range(600):
        docs.append((i, f"{prose(i % 500, 10)} {passage}"))
    nodes = spark.createDataFrame(
        [(d, 18, [1, 2 + d % 500], [0, 1]) for d, _ in docs],
        "node long, size int, tokens array<long>, places array<int>")
    rows = near_copies.postings(nodes)
    assert sorted(map(tuple, rows.collect())) == sorted(
        [(1, d, 18, 0) for d in range(600)] + [(2 + d % 500, d, 18, 1) for d in range(600)
                                               if d < 100 or d >= 500])
    rows = rows.withColumn("label", F.col("node"))
    found = {tuple(r) for r in near_copies.crossings(rows, 0.8, tile=64).collect()}
    assert found == {(a, b) for a in range(600) for b in range(a + 1, 600)}
    same = rows.withColumn("label", F.lit(1).cast("long"))
    assert near_copies.crossings(same, 0.8, tile=64).count() == 0
    assert near_copies.stars(same, 0.8).count() == 0
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    check(docs, [r.doc_id for r in near_copies.keep_first(frame).collect()])


def test_repeated_rows_and_null_ids(spark):
    docs = [(1, prose(1, 40)), (1, prose(1, 40)), (None, prose(2, 40)), (None, prose(2, 40)),
            (None, prose(3, 40)), (5, prose(3, 40) + " x"), (0, prose(4, 40)), (0, prose(5, 40))]
    frame = spark.createDataFrame([(*d, "clash") for d in docs],
                                  "doc_id long, text string, key_of_row string")
    kept = near_copies.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [docs[0], docs[2], docs[5], docs[6], docs[7]], key=repr)


def test_simhash_links_come_first(spark, monkeypatch):
    """Copies within 4 bits are found by fingerprints alone; others are no SimHash candidates."""
    docs = [(i, " ".join(prose(7, 400).split()[:400 - i])) for i in range(4)]
    docs += [(10 + i, prose(50 + i, 60)) for i in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near_copies.marked(frame, near_copies.WORDS, near_copies.SHARE, "text", "doc_id")
    by_id = {r.id: r for r in rows.collect()}
    for d, text in docs:
        assert by_id[d].fp % 2 ** 64 == near_copies.simhash.fingerprint(text)
    bits = lambda a, b: ((by_id[a].fp ^ by_id[b].fp) % 2 ** 64).bit_count()
    close = {frozenset((by_id[a].node, by_id[b].node)) for a in by_id for b in by_id
             if a < b and bits(a, b) <= 4}
    got = {frozenset(r) for r in near_copies.alike(rows).collect()}
    assert close and got <= close
    monkeypatch.setattr(near_copies, "postings", lambda nodes: nodes.limit(0).select(
        F.col("node").alias("token"), "node", "size", F.lit(0).alias("place")))
    kept = {r.doc_id for r in near_copies.keep_first(frame).collect()}
    assert {0, 10, 11, 12, 13, 14} <= kept and len(kept) < len(docs)


def test_large_group_needs_no_crossings(spark, monkeypatch):
    """Copies of one text that are unlike each other meet through it in the first rounds."""
    base = prose(3, 200).split()
    docs = [(0, " ".join(base))]
    for i in range(1, 150):
        words = list(base)
        for k in range(3):
            words[(i * 13 + k * 61) % 200] = f"own{i}x{k}"
        docs.append((i, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    crossed = []

    def crossings(rows, share):
        out = near_copies_crossings(rows, share)
        crossed.append(out.count())
        return out

    near_copies_crossings = near_copies.crossings
    monkeypatch.setattr(near_copies, "crossings", crossings)
    kept = [r.doc_id for r in near_copies.keep_first(frame).collect()]
    assert kept == [0]
    assert crossed == [0]


def test_counters_of_a_share_of_the_texts(spark, monkeypatch):
    """With far fewer counters than shingles the frequent ones still count most."""
    monkeypatch.setattr(near_copies, "COUNTER_LOAD", 1 / 64)
    docs = [(i, f"{prose(99, 12)} {prose(i, 30)}") for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    held = near_copies.frequencies(frame.select("text"), 5, 1 << 16).value
    assert 0 < held.max() < 200
    check(docs, [r.doc_id for r in near_copies.keep_first(frame).collect()])


def test_all_texts_are_counted(spark, monkeypatch):
    """With far fewer counters than shingles only a share of the texts used to be counted."""
    monkeypatch.setattr(near_copies, "COUNTER_LOAD", 1 / 64)
    texts = [f"{prose(99, 12)} {prose(i // 3, 30)}" for i in range(240)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    held = near_copies.frequencies(frame, 5, 1 << 16).value
    unit = math.ceil(sum(map(len, texts)) / near_copies.CHARS_PER_COUNTER / len(held) * 64)
    own = np.zeros(len(held), np.int64)
    for text in texts:
        at = near_copies.shingles(text).view(np.uint64) & np.uint64(len(held) - 1)
        own[np.unique(at).astype(np.int64)] += 1
    assert unit > 1 and (held == own // unit).all() and held.max() == 240 // unit


def test_shingles_of_few_nodes_take_no_rounds(spark, monkeypatch):
    """Pairs at a rare shingle are settled where they meet, against brute force."""
    chance, nodes, near = random.Random(3), [], set()
    for n in range(400):
        size = chance.randint(5, 40)
        tokens = chance.sample(range(-150, 150), 4) + [999]
        nodes.append((n, size, tokens, [0, 1, 2, 3, 4]))
    frame = spark.createDataFrame(nodes, "node long, size int, tokens array<long>, "
                                         "places array<int>")
    holders = {}
    for n, size, tokens, places in nodes:
        for token, place in zip(tokens, places):
            holders.setdefault(token, []).append((n, size, place))
    for token, held in holders.items():
        for i, (n, a, p) in enumerate(held if len(held) <= 8 else []):
            for m, b, q in held[:i]:
                if 5 * min(a, b) >= 4 * max(a, b) and 9 * min(a - p, b - q) >= 4 * (a + b):
                    near.add((m, n))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = near_copies.met(frame, 0.8, 8).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.node, r.other) for r in rows if r.other is not None} == near
    assert sorted((r.token, r.node, r.size, r.place) for r in rows if r.other is None) == sorted(
        (t, *h) for t, held in holders.items() if len(held) > 8 for h in held)

    # texts that share one passage two by two: nothing is left for the rounds
    docs = [(i, f"{prose(500 + i // 2, 6)} {prose(i, 30)}") for i in range(60)]
    docs += [(60 + i, f"{prose(i, 30)} tail") for i in range(5)]
    docs += [(65 + i, " ".join(prose(i, 30).split()[:-1])) for i in range(5)]
    monkeypatch.setattr(near_copies, "stars", None)
    monkeypatch.setattr(near_copies, "crossings", None)
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    check(docs, [r.doc_id for r in near_copies.keep_first(texts).collect()])
