"""Quality rules, classifier and toxicity: measures by brute force, models by held-out labels."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldcast.llm import labelled, quality_classifier, quality_rules, queries, toxicity
from tests.llm.conftest import pairs, prose

BIG = "/root/testdata/sf0.01"


def slow_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
              for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups,
            len(inside))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\x0b\x1c\x85\xa0é#|"), max_size=50))
def test_measures(text):
    assert quality_rules.measure(text)[:5] == slow_measures(text)


def test_rules_edges(edge_docs, no_docs):
    got = quality_rules.judge(edge_docs)
    want = sorted(((r.doc_id, *slow_measures(r.text)) for r in edge_docs.collect()), key=repr)
    assert pairs(got, "doc_id", *quality_rules.MEASURES[:5]) == want
    for r in got.collect():
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed is failed and not (r.kept and failed)
    assert quality_rules.judge(no_docs).count() == 0
    kept = quality_rules.keep(edge_docs)
    assert kept.columns == edge_docs.columns and quality_rules.keep(no_docs).count() == 0
    assert pairs(kept, "doc_id") == pairs(got.where("kept"), "doc_id")


def test_thresholds_follow_the_group(spark):
    # in source b a fifth of all words carries a symbol; in a none does
    rows = [(i, prose(200 + i, 100), "en", "a") for i in range(150)]
    rows += [(1000 + i, " ".join(w + "*" * (j % (3 + i % 5) == 0) for j, w in enumerate(
        prose(i, 100).split())), "en", "b") for i in range(150)]
    odd = " ".join(w + "*" * (j % 4 == 0) for j, w in enumerate(prose(7, 100).split()))
    rows += [(5000, odd, "en", "a"), (5001, odd, "en", "b"), (5002, odd, "xx", "rare")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(frame).collect()}
    assert not kept[5000] and kept[5001] and 5002 in kept
    assert all(kept[i] for i in range(150))


def test_sketch_is_mergeable_and_close(spark):
    values = [float(v) for v in np.random.default_rng(5).lognormal(size=4000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    cells = frame.select(quality_rules.bin_of(F.col("v")).alias("bin"))
    got = {r.bin: r.value for r in cells.select(
        "bin", quality_rules.bin_value(F.col("bin")).alias("value")).distinct().collect()}
    order = sorted(cells.collect(), key=lambda r: r.bin)
    for q in (0.25, 0.5, 0.75):
        exact = sorted(values)[int(np.ceil(q * len(values))) - 1]
        assert abs(got[order[int(np.ceil(q * len(values))) - 1].bin] / exact - 1) <= 0.0101


def test_rules_query_brute_force(spark, sf):
    docs = {d["doc_id"]: d for d in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    rows = queries.op6_quality_rules(spark, sf).collect()
    assert len(rows) == len(docs)
    table, shares = {}, []
    for d in docs.values():
        m = slow_measures(d["text"])
        lines = sum(bool(x.strip(" \t\n\r\v\f")) for x in d["text"].split("\n"))
        table[d["doc_id"]] = m
        shares.append((d, {"symbols_per_word": (m[2], m[0]), "word_length": (m[1], m[0]),
                           "dup_line_share": (m[3], lines), "repeat_share": (m[4], m[0])}))

    step = np.log(1.01 / 0.99)

    def binned(value):
        return 0.0 if value <= 0 else (1.01 / 0.99) ** np.ceil(np.log(value) / step) * 2 / (
            1 + 1.01 / 0.99)

    def quartile(values, q):
        return sorted(map(binned, values))[int(np.ceil(q * len(values))) - 1]

    def sample(name, *match):
        return [n / b for d, s in shares for n, b in [s[name]]
                if b and all(d[k] == v for k, v in match)]

    for r in rows:
        d = docs[r.doc_id]
        assert tuple(r)[1:6] == table[r.doc_id]
        verdict = not r.base_failed
        for name, (_, _, below, above) in quality_rules.FEATURES.items():
            n, b = next(s[name] for x, s in shares if x is d)
            if not b:
                continue
            pool = next(p for p in (sample(name, ("lang", d["lang"]), ("source", d["source"])),
                                    sample(name, ("lang", d["lang"])), sample(name))
                        if len(p) >= quality_rules.MIN_ROWS or len(p) == len(sample(name)))
            q1, q3 = quartile(pool, 0.25), quartile(pool, 0.75)
            verdict &= n / b <= q3 + 3 * (q3 - q1) + above
            if below is not None:
                verdict &= n / b >= q1 - 3 * (q3 - q1) - below
        assert r.kept is bool(verdict)


# classifier

def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_classifier_on_held_out_documents(spark):
    rows = queries.op1_quality_classifier(spark, BIG).collect()
    marks = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{BIG}/labels.parquet").to_pylist()}
    assert len(rows) == pq.read_table(f"{BIG}/documents.parquet").num_rows
    right = []
    for r in rows:
        assert r.held_out is held(r.doc_id) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
        if r.held_out and r.doc_id in marks:
            right.append(r.predicted == marks[r.doc_id])
    assert np.mean(right) > 0.93


def test_classifier_does_not_learn_from_held_out(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    # wrong labels on held-out documents change nothing
    wrong = labels.withColumn("quality", F.when(labelled.held_out(), 1 - F.col("quality"))
                              .otherwise(F.col("quality")).cast("int"))
    assert quality_classifier.fit(docs, labels) == quality_classifier.fit(docs, wrong)


def test_classifier_edges(spark, edge_docs, no_docs):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, labels)
    got = quality_classifier.score(edge_docs, model).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1
    assert quality_classifier.score(no_docs, model).count() == 0
    none = labels.where("false")
    assert {r.score for r in quality_classifier.score(
        edge_docs, quality_classifier.fit(docs, none)).collect()} == {0.5}
    one = quality_classifier.fit(docs, labels.where("quality = 1"))
    assert {r.score for r in quality_classifier.score(edge_docs, one).collect()} == {1.0}
    empty = quality_classifier.fit(no_docs, labels)
    assert empty.weights == (0.5,)


def test_calibration_takes_ids_from_the_whole_range(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    # low ids are good, high ids bad: the smallest ids alone are of one class
    labels = docs.select("doc_id", (F.col("doc_id") < 500).cast("int").alias("quality"))
    model = quality_classifier.fit(docs, labels, dict_rows=100, fit_rows=100)
    assert len(model.weights) == 6


def test_dictionary_pieces_reach_every_position(spark):
    size, most = quality_classifier.PIECE, quality_classifier.PIECES
    letter = lambda i: chr(ord("a") + i)
    texts = [(d, "".join(letter(i) * size for i in range(20)) + "z" * 5) for d in range(60)]
    texts += [(100, ""), (101, "short"), (102, "a" * size), (103, "a" * size + "b")]
    got = {r.doc_id: r.cut for r in spark.createDataFrame(texts, "doc_id long, text string").select(
        "doc_id", quality_classifier.pieces("text", "doc_id", 1).alias("cut")).collect()}
    assert all(got[d] == dict(texts)[d] for d in (100, 101, 102, 103))
    seen = set()
    for d in range(60):
        runs = [c for c in dict.fromkeys(got[d])]
        assert len(runs) == most and runs == sorted(runs) and len(got[d]) <= most * size
        seen.update(runs)
    assert seen == {letter(i) for i in range(20)} | {"z"}


# toxicity

def test_equal_texts_take_their_smallest_label(spark):
    rows = [(i, f"plain words number {i}", 0) for i in range(40)]
    rows += [(100 + i, f"vile slur{i % 3} vile slur", 1) for i in range(40)]
    rows += [(200 + i, "vile slur0 vile slur", 0) for i in range(5)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    alone = [r for r in rows if r[1] != "vile slur0 vile slur"] + [rows[-1]]
    some = docs.where(F.col("doc_id").isin([r[0] for r in alone]))
    first = toxicity.fit(docs, labels)
    assert first == toxicity.fit(docs.orderBy(F.desc("doc_id")), labels)
    assert first == toxicity.fit(some, labels)


def test_toxicity_on_held_out_documents(spark):
    big = "/root/testdata/sf0.1"
    rows = queries.op4_toxicity(spark, big).collect()
    marks = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{big}/labels.parquet").to_pylist()}
    test = [(r, marks[r.doc_id]) for r in rows if held(r.doc_id) and r.doc_id in marks]
    toxic, clean = [r.toxic for r, y in test if y], [r.toxic for r, y in test if not y]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.02
    for r in rows:
        assert 0 <= r.severity <= 3 and r.toxic is (r.grade > 0)


def test_thresholds_are_shared_and_ordered():
    chance = np.random.default_rng(2)
    truth = np.array([2.0, 1.0, 0.0])
    lists = [np.flatnonzero(chance.random(3) < 0.5) for _ in range(4000)]
    margin = np.array([truth[x].sum() for x in lists]) + chance.logistic(size=4000)
    grades = np.digitize(margin, [1.0, 2.0, 3.5])
    weights, cuts = toxicity.ordinal_fit(lists, grades, 3, penalty=0.0)
    assert np.allclose(weights, truth, atol=0.25) and np.allclose(cuts, [1, 2, 3.5], atol=0.3)
    assert (np.diff(cuts) > 0).all()


def test_toxicity_edges(spark, edge_docs, no_docs):
    docs = spark.createDataFrame(
        [(i, prose(i, 20) + (" vile" * (i % 3 == 0)) + (" nasty" * (i % 6 == 0)))
         for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    assert "vile " in model.weights and list(model.thresholds) == sorted(model.thresholds)
    asked = spark.createDataFrame([(1, "you VILE thing"), (2, "a vile, nasty thing"),
                                   (3, "a kind thing"), (4, None), (5, "")],
                                  "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(asked, model).collect()}
    assert got[1].toxic and got[2].toxic and not got[3].toxic and not got[4].toxic
    assert got[4].severity == got[5].severity
    assert toxicity.score(edge_docs, model).count() == edge_docs.count()
    assert toxicity.score(no_docs, model).count() == 0
    kept = toxicity.keep(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert toxicity.keep(no_docs, model).count() == 0
    assert sorted(r.doc_id for r in toxicity.keep(asked, model).collect()) == [3, 4, 5]
    for bad in (labels.where("false"), labels.where("toxic = 1"),
                labels.withColumn("toxic", F.lit(None).cast("int"))):
        empty = toxicity.fit(docs, bad)
        assert not any(r.toxic or r.severity for r in toxicity.score(docs, empty).collect())
    graded = labels.withColumn("toxic", F.col("toxic") * (1 + (F.col("doc_id") % 6 == 0)
                                                          .cast("int")))
    assert len(toxicity.fit(docs, graded).thresholds) == 2
