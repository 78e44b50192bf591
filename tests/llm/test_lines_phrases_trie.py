"""Line dedup, phrase mining and the conversation trie against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcast.llm import bloom, line_dedup, phrases, prefix_trie, queries
from tests.llm.conftest import SCHEMA, pairs, prose

BLANKS = " \t\n\v\f\r"


def lower(text):
    return text.encode().lower().decode()


def lines_by_hand(rows, min_chars=40, min_docs=5):
    """(doc_id, n_lines, n_dropped, text) of (doc_id, text) rows."""
    held = defaultdict(set)
    for at, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANKS))
            if len(key) >= min_chars:
                held[key].add(at)
    rank = lambda i: -float("inf") if i is None else i
    keeper = {k: max((rank(rows[a][0]) for a in v)) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for doc_id, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines
                if rank(doc_id) >= keeper.get(lower(x.strip(BLANKS)), -float("inf"))]
        out.append((doc_id, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def with_schema(spark, rows):
    """Documents from (doc_id, text, lang, source) rows, with clashing columns."""
    return spark.createDataFrame(
        [(d, t, la, s, 0, 1.0, 5, [1], 7, "m", True, 3, 1, 2, False, 1, 1, 0)
         for d, t, la, s in rows], SCHEMA)


def line_rows():
    long = [f"{prose(i, 9)} line {i} of many that is shared" for i in range(30)]
    rows = []
    for d in range(60):
        own = [f"{prose(1000 + d, 12)} only here and nowhere else"]
        shared = [long[i] for i in range(30) if d % (i + 2) == 0]
        if d % 3 == 0:
            shared = [f" \t{x.upper()}\r" for x in shared] + shared[:1] * 2
        rows.append((d, "\n".join(own + shared + ["short", ""]), "en", "a"))
    rows += [(None, long[0], "en", "a"), (None, None, None, None), (7, "", "en", "b"),
             (59, long[1], "en", "a"), (59, long[1], "en", "a")]
    rows += [(200 + i, "É" * 39 + "\n" + "É" * 40 + "\n" + "é" * 40, "fr", "c") for i in range(6)]
    rows += [(None, "held by rows without an id alone, more than five", "en", "a")] * 6
    return rows


@pytest.mark.parametrize("filter_bytes", [1 << 25, 1 << 13])
def test_line_dedup_against_brute_force(spark, filter_bytes):
    rows = line_rows()
    found = line_dedup.dedup(with_schema(spark, rows).repartition(5), filter_bytes=filter_bytes)
    assert found.columns[:3] == ["doc_id", "text", "lang"] and "kept" in found.columns
    assert pairs(found, "doc_id", "n_lines", "n_dropped", "text") == lines_by_hand(
        [(d, t) for d, t, _, _ in rows])


def test_line_dedup_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    found = line_dedup.dedup(edge_docs.withColumn("n_lines", F.lit("clash")), min_docs=2)
    assert pairs(found, "doc_id", "n_lines", "n_dropped", "text") == lines_by_hand(
        rows, min_docs=2)
    assert line_dedup.dedup(no_docs).count() == 0


def test_line_dedup_hot_line_meets_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 3)
    rows = [(d, prose(5, 9) + "\n" + prose(6 + d % 40, 9), "en", "a") for d in range(400)]
    found = line_dedup.dedup(with_schema(spark, rows))
    assert pairs(found, "doc_id", "n_lines", "n_dropped", "text") == lines_by_hand(
        [(d, t) for d, t, _, _ in rows])


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    rng = np.random.default_rng(3)
    once, twice = rng.integers(1 << 63, size=20_000).astype(np.uint64), rng.integers(
        1 << 63, size=500).astype(np.uint64)
    bits = bloom.bits_for(20_500, 1 << 25)
    probes = bloom.probes_for(20_500, bits)
    parts = [np.concatenate([p, twice]) for p in np.array_split(once, 4)]
    rows = spark.createDataFrame([(i,) for i in range(4)], "i int").repartition(4)

    def run(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from bloom.pieces(parts[i], bits, probes)

    filled = bloom.collected(rows.mapInArrow(run, bloom.SCHEMA), bits, "twice")
    assert bloom.contains(filled, twice, probes).all()
    assert bloom.contains(filled, once, probes).mean() < 0.02
    assert bloom.bits_for(1e12, 1 << 20) == 8 << 20


def phrases_by_hand(rows, min_count, max_words=5, top=2000, percent=100):
    import re

    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang or "und"
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        big = {p: c for p, c in counts.items() if c >= min_count and len(p) > 1}
        found = []
        for p, a in big.items():
            cut = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k)
                      for k in range(1, len(p)))
            gone = any(len(q) > len(p) and 100 * c >= percent * a and any(
                q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in big.items())
            if not gone:
                k = cut[1]
                found.append((-cut[0], -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


PHRASES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("shard_bytes,filter_bytes", [(48 << 20, 1 << 25), (4000, 1 << 13)])
def test_phrases_against_brute_force(spark, shard_bytes, filter_bytes):
    rng = np.random.default_rng(5)
    vocab = ["the", "of", "AND", "é", "straße", "x\x0ey", "a-b", "to"]
    rows = []
    for d in range(300):
        words = [vocab[min(int(rng.exponential(2)), 7)] for _ in range(40)]
        for at in range(0, 40, 9):
            words[at] += ".,;:!?\n\v\f\r"[int(rng.integers(10))]
        if d % 7 == 0:
            words.append("new york city hall of  fame\tand glory")
        rows.append((d, " ".join(words), [None, "en", "de"][d % 3], "a"))
    rows += [(1, None, "en", "a"), (2, "", None, "a"), (3, " \t.,", "fr", "a")]
    found = phrases.collocations(with_schema(spark, rows).repartition(3), min_count=10,
                                 shard_bytes=shard_bytes, filter_bytes=filter_bytes, top=25)
    assert pairs(found, *PHRASES) == phrases_by_hand([(r[2], r[1]) for r in rows], 10, top=25)


def test_phrases_percent_ties_and_empty(spark, no_docs, edge_docs):
    rows = [(i, "b c d e. b c d. c d e; a b", "en", "a") for i in range(6)]
    for percent in (50, 100):
        found = phrases.collocations(with_schema(spark, rows), min_count=3,
                                     absorb_percent=percent)
        assert pairs(found, *PHRASES) == phrases_by_hand([(r[2], r[1]) for r in rows], 3,
                                                         percent=percent)
    assert phrases.collocations(no_docs).count() == 0
    rows = [(r.lang, r.text) for r in edge_docs.select("lang", "text").collect()]
    assert pairs(phrases.collocations(edge_docs), *PHRASES) == phrases_by_hand(rows, 100)


def test_phrases_local_support_of_one(spark):
    """More shards than the support: every phrase is locally frequent, the result is the same."""
    rows = [(i, f"{prose(i % 9, 8)} with common words", "en", "a") for i in range(60)]
    found = phrases.collocations(with_schema(spark, rows), min_count=6, shard_bytes=64)
    assert pairs(found, *PHRASES) == phrases_by_hand([(r[2], r[1]) for r in rows], 6)


def trie_by_hand(rows, block=100, most=6):
    """rows: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % block) * (1 if c >= 0 else -1)
        full[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p],
                    leaves[p], saved[p], hashlib.sha256(",".join(
                        str(c) for c in sorted(m) if len(full[c]) == len(p)).encode()).hexdigest())
                   for p, m in members.items()), key=repr)


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")
TURNS = "conv_id long, turn int, role string, text string, node string, depth int, part int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], TURNS)


def trie_rows():
    rng = np.random.default_rng(8)
    rows = []
    for c in [*range(95, 130), *range(200, 230), -5, 305, 7_000_000_000]:
        for t in range(int(rng.integers(1, 9))):
            kind = int(rng.integers(2))
            rows.append((c, t, ["user", "assistant"][t % 2], f"say {kind} é" if t < 5 else prose(t, 3)))
    rows += [(100, None, None, None), (100, 2, "user", "tie"), (100, 2, "user", "tie"),
             (None, 1, "user", "nobody"), (101, None, "user", None)]
    rows += [(c, t, "user", "the same") for c in range(400, 480) for t in range(3)]
    return rows


@pytest.mark.parametrize("band", [2, 3, 8])
def test_trie_against_brute_force(spark, band):
    rows = trie_rows()
    found = prefix_trie.trie(conversations(spark, rows).repartition(4), band=band)
    assert pairs(found, *TRIE) == trie_by_hand(rows)


def test_trie_of_a_very_long_conversation(spark):
    """One conversation holds most rows and spreads over several sorted parts."""
    rows = [(1, t, "user", f"turn {t % 5}") for t in range(200)] + [
        (c, t, "user", f"turn {t % 5}") for c in range(2, 9) for t in range(20)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = prefix_trie.ordered(conversations(spark, rows)).where("conv_id = 1")
        assert split.select("part").distinct().count() > 1
        assert pairs(split, "at") == sorted(((i,) for i in range(1, 201)), key=repr)
        found = prefix_trie.trie(conversations(spark, rows), band=6)
        assert pairs(found, *TRIE) == trie_by_hand(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_trie_empty_and_turnless(spark):
    assert prefix_trie.trie(conversations(spark, [])).count() == 0
    rows = [(c, 0, "user", "x") for c in range(501, 520)]  # no conversation 500: some are turnless
    assert pairs(prefix_trie.trie(conversations(spark, rows)), *TRIE) == trie_by_hand(rows)


def test_chunks_of_ends(spark):
    rows = [(c, 0, "user", "x") for c in range(600, 700)]
    found = prefix_trie.ends_digest(prefix_trie.rebuilt(conversations(spark, rows)), chunk=7)
    plain = prefix_trie.ends_digest(prefix_trie.rebuilt(conversations(spark, rows)))
    assert pairs(found, "node", "ends_sha256") == pairs(plain, "node", "ends_sha256")


def test_sql_twins_on_edge_rows(spark, tmp_path):
    """Control characters and nulls, which the given tables lack."""
    import pyarrow as pa

    texts = ["a\rb c\vd e\ff " * 30, None, "", "  \v" + prose(3, 12) + "\f\n" + prose(3, 12)]
    docs = [(i % 9 if i % 5 else None, texts[i % 4], None if i % 3 else "en", None)
            for i in range(24)]
    frame = with_schema(spark, docs).select("doc_id", "text", "lang", "source", "n_chars")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    turns = conversations(spark, trie_rows()).select("conv_id", "turn", "role", "text")
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    for name, rows in (("documents", frame), ("conversations", turns)):
        con.register(f"{name}_rows", pa.table(rows.toArrow()))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_rows")
    for name in ("op6_quality_rules", "op11_line_dedup", "op12_phrases", "op13_prefix_trie"):
        found = queries.QUERIES[name](spark, str(tmp_path))
        cursor = con.execute(queries.ORACLES[name])
        order = [[c[0] for c in cursor.description].index(n) for n in found.columns]
        wanted = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
        assert pairs(found, *found.columns) == wanted, name


def test_a_counting_task_names_a_phrase_once(spark, monkeypatch):
    """Shards of one task are summed before its rows leave it, in any number of hand-overs."""
    rows = [(i, f"one two three four word{i % 7}", "en") for i in range(400)]
    docs = with_schema(spark, [(d, t, la, "s") for d, t, la in rows]).repartition(3)
    shards = phrases._shards(docs, 600)
    assert len(shards.inputFiles()) >= 8
    wanted = phrases._candidates(shards, range(1, 3), 100, 600, 1 << 16)
    named = phrases._task_counts(shards, range(1, 3), 600, wanted).collect()
    tasks = max(spark.sparkContext.defaultParallelism, -(-len(shards.inputFiles()) // 16))
    of_one = [r.n for r in named if bytes(r.phrase) == b"one"]
    assert len(of_one) <= tasks < len(shards.inputFiles()) and sum(of_one) == 400
    want = sorted((r.length, bytes(r.phrase), r.n) for r in phrases._counts(
        shards, range(1, 3), 100, 600, wanted).collect())
    assert (2, b"three four", 400) in want and (0, b"", 2000) in want
    monkeypatch.setattr(phrases, "HELD", 1)
    again = phrases._counts(shards, range(1, 3), 100, 600, wanted)
    assert sorted((r.length, bytes(r.phrase), r.n) for r in again.collect()) == want


def test_texts_are_cut_into_words_once(spark):
    """Each of the four passes over the shards used to read the texts and cut them again."""
    rows = [(i, f"Alpha beta, gamma\tdelta {i % 5}. " * (i % 3 + 1), ["en", None][i % 2], "a")
            for i in range(90)] + [(99, ". ,", "fr", "a"), (100, None, "fr", "a")]
    shards = phrases._shards(with_schema(spark, rows), 500)
    assert "text" not in shards.columns
    held = [phrases.Numbered(*r) for r in shards.collect()]
    of = lambda lang: [x for x in held if x.lang == lang]
    assert {x.lang for x in held} == {"en", "und", "fr"} and len(of("en")) > 1
    for lang in ("en", "und", "fr"):
        texts = [lower(t or "") for _, t, la, _ in rows if (la or "und") == lang]
        assert {x.total for x in of(lang)} == {sum(map(len, texts))}
        assert sum(x.chars for x in of(lang)) == sum(map(len, texts))
        words = Counter(w for t in texts for w in t.replace(",", " ").replace(".", " ").split())
        got = Counter(x.names[i].decode() for x in of(lang) for i in x.ids[x.ids > 0].tolist())
        assert got == words and sum(x.words for x in of(lang)) == sum(words.values())
    for x in held:
        parts = list(x.parts(7))
        assert np.array_equal(np.concatenate(parts), x.ids)
        assert all(p[-1] == 0 for p in parts)
