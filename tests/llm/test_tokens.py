"""Token operators against the tokenizers library, text by text."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldcast.llm import bpe, packing, queries, token_counts, token_files, tokenizer
from fieldcast.session import scratch_dir

BYTES = tokenizer.default_path("byte_bpe_50k.json")
WORDS = tokenizer.default_path("word_bpe_49k.json")
BYTE_LIBRARY, WORD_LIBRARY = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


def byte_ids(text):
    return BYTE_LIBRARY.encode(text or "", add_special_tokens=False).ids


def word_ids(text):
    return WORD_LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ALPHABET = st.text(st.sampled_from("ab zE'sté 1½\n\t\r中“😀İΣß_-<|# ́ "), max_size=60)


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_encoders_equal_the_library(text):
    ids = bpe.encoder(BYTES).encode([text])[0].tolist()
    assert ids == byte_ids(text) == tokenizer.encode(BYTES, text).tolist()
    assert bpe.decode_ids(np.array(ids), BYTES) == BYTE_LIBRARY.decode(
        ids, skip_special_tokens=False)
    assert np.frombuffer(token_files.encoder(WORDS).encode(text), "<u4").tolist() == word_ids(text)


def test_special_strings_long_words_and_cut_texts(monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT", 50)
    texts = ["a<|endoftext|>b <|endoftext|>", "<|startoftext|> x", "ab" * 400, " " * 300 + "x",
             "the quick  brown\n\nfox " * 40, "don't 'sit ''s" * 9]
    for text in texts:
        assert bpe.encoder(BYTES).encode([text])[0].tolist() == byte_ids(text)
        assert np.frombuffer(token_files.encoder(WORDS).encode(text), "<u4").tolist() == \
            word_ids(text)


def test_frequent_words_are_learned_once(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 10)
    encoder, made = token_files.Encoder(WORDS), Counter()
    learn = encoder.words.make
    encoder.words.make = lambda word: made.update([word]) or learn(word)
    for first in "abcdefgh":
        for second in "abcdefgh":
            text = f"often x{first}{second}"
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == word_ids(text)
            assert len(encoder.words) + len(encoder.words.old) <= 10
    assert made[b"often"] == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(ALPHABET, max_size=8), st.sampled_from([1, 20, 1 << 22]))
def test_texts_encoded_together(texts, held):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_files, "HELD", held)
        texts = [*texts, "it's '' 's we'll 12", "", "'"]
        ids, count = token_files.encoder(WORDS).encode_all(texts, b"\2\0\0\0")
    want = [[*word_ids(text), 2] for text in texts]
    assert ids.tolist() == [i for x in want for i in x] and count.tolist() == list(map(len, want))


def test_word_dictionary_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    encoder = bpe.Encoder(BYTES)
    texts = [f"w{i} v{i} u{i}" for i in range(30)]
    for text in texts:  # at most the limit or the words of one call
        assert encoder.encode([text])[0].tolist() == byte_ids(text)
        assert len(encoder.words) <= 10


def test_long_white_space_falls_back():
    text = "a" + " " * 3_000_000 + "b"
    assert tokenizer.encode(BYTES, text).tolist() == byte_ids(text)


def test_round_trip_edges(edge_docs, no_docs):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in bpe.round_trip(edge_docs, BYTES).collect()}
    want = set()
    for r in edge_docs.collect():
        ids = byte_ids(r.text)
        text = BYTE_LIBRARY.decode(ids, skip_special_tokens=False)
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256(text.encode()).hexdigest()))
    assert got == want
    assert bpe.round_trip(edge_docs, BYTES).count() == edge_docs.count()
    assert bpe.round_trip(no_docs, BYTES).count() == 0


def test_encode_then_decode(edge_docs):
    back = bpe.decode(bpe.encode(edge_docs, BYTES), BYTES)
    got = Counter((r.doc_id, r.text) for r in back.collect())
    assert got == Counter((r.doc_id, r.text or "") for r in edge_docs.collect())


def test_query_bpe_on_whole_table(spark, sf):
    rows = {r.doc_id: r for r in queries.op3_bpe_round_trip(spark, sf).collect()}
    for doc in pq.read_table(f"{sf}/documents.parquet").to_pylist():
        ids = byte_ids(doc["text"])
        row = rows.pop(doc["doc_id"])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(doc["text"].encode()).hexdigest()
    assert not rows


# token files

def test_token_files_query(spark, sf):
    docs = sorted(pq.read_table(f"{sf}/documents.parquet").to_pylist(), key=lambda d: d["doc_id"])
    want, start = [], 0
    for doc in docs:
        ids = [*word_ids(doc["text"]), 2]
        want.append((doc["doc_id"], start, len(ids), crc(ids)))
        start += len(ids)
    got = queries.op2_token_files(spark, sf).collect()
    assert sorted(tuple(r) for r in got) == want


def test_token_files_edges_and_format(spark, edge_docs, no_docs, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write(edge_docs.repartition(5), folder, WORDS, 2, row_group_mb=1, page_kb=8)
    rows = token_files.read(spark, folder).orderBy("start").collect()
    docs = sorted(edge_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0,
                                                      r.text or ""))
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    start = 0
    for row, doc in zip(rows, docs):
        assert row.ids == [*word_ids(doc.text), 2] and row.start == start
        assert row.n_tokens == len(row.ids)
        start += row.n_tokens
    # selective reads leave the ids alone
    plan = token_files.read(spark, folder, ids=False)._jdf.queryExecution().toString()
    assert "ids:array" not in plan.split("== Physical Plan ==")[-1]
    file = next((tmp_path / "tokens").glob("part-*.parquet"))
    meta = pq.ParquetFile(file).metadata
    column = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i)
              for i in range(meta.num_columns)}
    ids = next(c for path, c in column.items() if path.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings and ids.has_offset_index and ids.has_column_index
    assert any("DELTA" in e for e in column["n_tokens"].encodings)
    empty = str(tmp_path / "empty")
    token_files.write(no_docs, empty, WORDS, 2)
    assert token_files.read(spark, empty).count() == 0
    assert token_files.checksums(token_files.read(spark, empty)).count() == 0


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


# packing

def check_pieces(rows, docs, window=2048, end=1):
    """Every id in one piece, sequences gapless and full or a power of two."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(p.length for p in parts[:i])
                                             for i in range(len(parts))]
        total = sum(r.length for r in parts)
        assert total <= window and (total & (total - 1)) == 0
    want = Counter()
    for doc_id, text in docs:
        ids = [*byte_ids(text), end]
        mine = sorted(pieces[doc_id, len(ids)], key=lambda r: r.start)
        assert sum(r.length for r in mine) % len(ids) == 0
        for r in mine:
            assert r.length > 0 and r.ids_crc32 in {crc(ids[r.start:r.start + r.length])}
        want[doc_id, len(ids)] += len(ids)
    assert want == Counter({k: sum(r.length for r in v) for k, v in pieces.items()})


def test_packing_query(spark, sf):
    docs = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    check_pieces(queries.op7_packing(spark, sf).collect(), docs)


def test_packing_edges(edge_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.where(
        "doc_id is not null and doc_id not in (2, 7)").collect()]
    some = edge_docs.where("doc_id is not null and doc_id not in (2, 7)")
    rows = packing.pack(some, BYTES, 1, with_ids=True).collect()
    check_pieces(rows, docs)
    assert all(len(r.ids) == r.length and crc(r.ids) == r.ids_crc32 for r in rows)
    every = packing.pack(edge_docs, BYTES, 1).agg(F.sum("length")).first()[0]
    assert every == sum(len(byte_ids(r.text)) + 1 for r in edge_docs.collect())
    assert packing.pack(no_docs, BYTES, 1).count() == 0


def test_level_choice_is_the_smallest_sum_of_squares():
    chance = random.Random(3)
    packer, window = packing.Packer(32), 32
    for doc in range(400):
        size = chance.randint(1, 31)
        before = packer.count.copy()

        def cost(level):
            after = before.copy()
            if level:
                after[level] -= 1
            if level + size < window:
                after[level + size] += 1
            return int((after[1:window] ** 2).sum())

        options = [h for h in range(window - size + 1) if h == 0 or before[h] > 0]
        list(packer.add(doc, np.zeros(size, "<u4")))
        assert int((packer.count[1:window] ** 2).sum()) == min(map(cost, options))


# token counts

def slow_counts(text, rule):
    """Tokens of each line, character by character."""
    encoding = BYTE_LIBRARY.encode(text, add_special_tokens=False)
    raw = [0]
    for at, c in enumerate(text):
        if c == "\n" and at + 1 < len(text):
            raw.append(at + 1)
    line = lambda at: sum(1 for s in raw if s <= at) - 1
    out = Counter()
    starts, ends = token_counts.token_spans(text, BYTES)
    assert len(starts) == len(encoding.ids)
    for a, b in zip(starts, ends):
        lines = [line(at) for at in range(a, b)]
        held = Counter(lines)
        pick = {"first": lines[0], "last": lines[-1],
                "most": min(held, key=lambda k: (-held[k], k))}[rule]
        out[pick] += 1
    return [out[i] for i in range(len(raw))]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab\n .é中😀\t"), max_size=40), st.sampled_from(token_counts.RULES))
def test_section_rules(text, rule):
    starts, ends = token_counts.token_spans(text, BYTES)
    cuts = token_counts.line_starts(text)
    got = np.bincount(token_counts.allot(starts, ends, cuts, rule), minlength=len(cuts))
    assert got.tolist() == slow_counts(text, rule)


def test_spans_are_those_of_the_library():
    # white space at the end of a token is trimmed by the library's post-processing only
    text = "naïve 中文 😀 don't\n\nstop <|endoftext|> é"
    starts, ends = token_counts.token_spans(text, BYTES)
    assert list(zip(starts.tolist(), ends.tolist())) == BYTE_LIBRARY.encode(
        text, add_special_tokens=False).offsets


def test_counts_add_up(edge_docs, no_docs, spark, sf):
    rows = token_counts.count_sections(edge_docs, BYTES).collect()
    assert sum(r.n_tokens for r in rows) == sum(len(byte_ids(r.text)) for r in edge_docs.collect())
    assert token_counts.count_sections(no_docs, BYTES).count() == 0
    whole = defaultdict(int)
    for r in queries.op5_token_counts(spark, sf).collect():
        whole[r.doc_id] += r.n_tokens
    assert whole == {d["doc_id"]: len(byte_ids(d["text"]))
                     for d in pq.read_table(f"{sf}/documents.parquet").to_pylist()}


def test_given_sections(spark):
    rows = [(1, "title line body text tail", [("title", 0, 5), ("body", 4, 15), None,
                                              ("far", 90, 99)]),
            (2, None, None), (3, "abc", []), (4, "x y", [("all", None, None)])]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, parts array<struct<name:string,start:int,end:int>>")
    got = defaultdict(list)
    for r in token_counts.count_sections(frame, BYTES, sections="parts").collect():
        got[r.doc_id].append((r.section, r.name, r.start, r.end, r.n_tokens))
    assert sorted(got[1]) == [(-1, None, 15, 25, 2), (0, "title", 0, 5, 1), (1, "body", 5, 15, 2),
                              (3, "far", 25, 25, 0)]
    assert got[2] == [(-1, None, 0, 0, 0)] and got[3] == [(-1, None, 0, 3, 1)]
    assert got[4] == [(0, "all", 0, 3, 2)]
    with pytest.raises(ValueError):
        token_counts.count_sections(frame, BYTES, rule="none")
