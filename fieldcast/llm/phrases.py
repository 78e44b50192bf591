"""Phrase collocations by SON partitioning: local mining, union, exact global counts.

Texts are lower-cased (A-Z), cut at `[.,;:!?\\x0A-\\x0D]` into pieces and those into words
(everything but blanks and tabs).  Phrases are runs of words inside a piece, counted per language.

1. Shards.  The texts are dealt once into shards of about `SHARD_BYTES`, cut into words there and
   written to the shared folder as numbers, with the list of words of each language: the later
   steps read numbers and cut no text again.  A shard's share of a language is its characters of
   that language over all of them.
2. Local mining.  Each shard is mined completely, length by length, at the local support
   ``min_count * share``: a phrase with less than that in every shard has less than ``min_count``
   in all.  A phrase is looked at only where both phrases of one word less are locally frequent.
3. Union.  Shards name their locally frequent phrases by hash, with counts.  A shard that does
   not name a phrase has less than its local support of it, so the sum of counts and of what the
   other shards may have bounds a phrase's count.  Those that can reach ``min_count`` set bits in
   one Bloom filter (`bloom`): a candidate set of any size reaches all shards in a bounded number
   of bytes.
4. Global counts.  Every shard counts all its occurrences of the phrases in the filter (and of
   those that only seem to be there).  A task counts up to `TASK_SHARDS` shards one after the
   other and sums them, so it names a phrase once and not once for each shard, and hands its sums
   on when it holds `HELD` of them.  Whole phrases are summed over the tasks, and those with
   ``min_count`` or more remain.

Steps 2 to 4 run for words and pairs first and then for longer phrases, where a place is mined
only if its pairs may be frequent in the whole table.  With very many shards, where the local
support falls to one occurrence, this keeps the candidates of longer phrases few.

Numbers are exact at any filter size: the filter has no false negatives, and everything that
passes it is counted.

Defined cases: null text: no words; null language: `und`; a repeated row counts again; an empty
table gives no rows.  Columns other than text and language are not used.
"""

from __future__ import annotations

import math
from array import array
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldcast.llm import bloom, common

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
NO_LANG = "und"
#: UTF-8 bytes of a shard, and of a Bloom filter at most.
SHARD_BYTES = 24 << 20
FILTER_BYTES = 1 << 25
#: Characters of text for each candidate expected, to size the filter.
CHARS_PER_CANDIDATE = 128
#: Shards that a task counts at most, and phrases that it holds before it hands them on.
TASK_SHARDS, HELD = 16, 1 << 19
#: Parts of a shard that are counted one by one: sums are held across them, so small ones do.
COUNT_PARTS = 6
#: Bytes that Spark hands to Python at once: a row of numbers is large, and one or two do.
BATCH_BYTES = 4 << 20
#: Hash buckets of the union for each shard.
BUCKETS = 4
#: A candidate goes if a longer one that holds it has this percentage of its count.
ABSORB_PERCENT = 100
#: Fixed value: characters that end a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
#: A byte that UTF-8 never has marks the end of a piece; its number is zero.
BREAK = b"\xff"
_TABLE = bytes(ord("\n") if c in ENDS else ord(" ") if c == 9 else c + 32 if 65 <= c <= 90 else c
               for c in range(256))


class Vocabulary(dict):
    """Numbers words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def words_of(text: str) -> list[bytes]:
    """Words of a text with `BREAK` between pieces."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).replace(
        b"\n", b" " + BREAK + b" ").split()


class Corpus:
    """Words of one language of one shard, as numbers."""

    def __init__(self) -> None:
        self.vocab = Vocabulary({BREAK: 0})
        self.ids = array("i")
        self.chars = self.total = 0

    def add(self, text: str) -> None:
        self.ids.extend(map(self.vocab.__getitem__, words_of(text)))
        self.ids.append(0)
        self.chars += len(text)

    def row(self, lang: str) -> pa.RecordBatch:
        """The numbers (packed) and the words by number, but for the break."""
        names = iter(self.vocab)
        next(names)
        size = len(self.ids)
        words = int(np.count_nonzero(np.frombuffer(self.ids, np.int32)))
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), *(pa.array([n], pa.int64())
                                 for n in (self.total, self.chars, words, size)),
             pa.array([b"\n".join(names)], pa.binary()),
             pa.array([pa.compress(pa.py_buffer(self.ids), "zstd", asbytes=True)], pa.binary())],
            names=["lang", "total", "chars", "words", "size", "names", "ids"])


class Numbered:
    """Words of one language of one shard, as they are read again."""

    def __init__(self, lang: str, total: int, chars: int, words: int, size: int, names: bytes,
                 ids: bytes) -> None:
        self.lang, self.total, self.chars, self.words = lang, total, chars, words
        self.names = [BREAK, *(names.split(b"\n") if names else ())]
        self.ids = np.frombuffer(pa.decompress(ids, 4 * size, "zstd"), np.int32)
        self.hashes = word_hashes(self.names, lang)

    def parts(self, size: int) -> Iterator[np.ndarray]:
        """The numbers in parts of about ``size``, cut where pieces end."""
        ends = np.flatnonzero(self.ids == 0) + 1
        at = 0
        while at < len(self.ids):
            to = ends[min(np.searchsorted(ends, at + size), len(ends) - 1)]
            yield self.ids[at:to]
            at = to


def word_hashes(names: list[bytes], lang: str) -> np.ndarray:
    """64-bit hash of each word, with the language in it."""
    import xxhash

    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in names), np.uint64, len(names))


def grown(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of its beginning and of its last word."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(32))) + last
    return mixed * np.uint64(0x94D049BB133111EB)


def mine(corpus: Numbered, ids: np.ndarray, lengths: range, support: float, allowed=None,
         pairs=None):
    """Phrases of the lengths asked for in some numbers of the corpus, level by level.

    Yields (length, place of the first occurrence, count, hash) arrays.  A place counts at a
    level if it did at the level before, here and one word on.  ``allowed`` tells by hash which
    phrases are wanted at these lengths; ``pairs`` which word pairs may lie in longer phrases.
    """
    of_word = corpus.hashes
    counts = np.bincount(ids, minlength=len(corpus.names))
    good = counts >= support
    if allowed is not None and 1 in lengths:
        good &= allowed(of_word)
    good[0] = False
    at = np.flatnonzero(good[ids])  # places where a phrase of the level begins
    if 1 in lengths:
        first = np.full(len(corpus.names), -1, np.int64)
        first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
        kept = np.flatnonzero(good & (counts > 0))
        yield 1, first[kept], counts[kept], of_word[kept]
    code = np.full(len(ids) + 1, -1, np.int32)  # number of the phrase that begins at a place
    code[at] = ids[at]
    hashes = of_word[ids[at]]
    for length in range(2, lengths.stop):
        both = code[at + 1] >= 0
        at, hashes = at[both], hashes[both]
        left, right = code[at], code[at + 1]
        hashes = grown(hashes, of_word[ids[at + length - 1]])
        if length == 2 and pairs is not None:
            wanted = pairs(hashes)
        elif allowed is not None and length in lengths:
            wanted = allowed(hashes)
        else:
            wanted = None
        if wanted is not None:
            at, hashes, left, right = at[wanted], hashes[wanted], left[wanted], right[wanted]
        if not len(at):
            return
        _, begin, inverse, n = np.unique(
            (left.astype(np.int64) << 32) | right, return_index=True, return_inverse=True,
            return_counts=True)
        kept = n >= support
        if length in lengths:
            yield length, at[begin[kept]], n[kept], hashes[begin[kept]]
        code[:] = -1
        stays = kept[inverse]
        at, hashes = at[stays], hashes[stays]
        code[at] = inverse[stays]


def _shards(docs: DataFrame, size: int) -> DataFrame:
    """Words of all texts by shard and language, see `Corpus.row`; shards of one file each.

    ``total`` is the characters of the language in all texts, ``chars`` those in the shard.
    """
    rows = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text").where(
        F.length("text") > 0)
    chars = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("total"),
                                     F.sum(F.octet_length("text")).alias("bytes"))
    number = -(-(chars.agg(F.sum("bytes")).first()[0] or 1) // size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _corpora(batches, size):
            for lang in list(held):
                yield held.pop(lang).row(lang)

    return common.pinned(rows.join(chars.drop("bytes"), "lang").select(
        "lang", "text", "total").repartition(number).mapInArrow(
        run, "lang string, total long, chars long, words long, size long, names binary, "
             "ids binary"))


def _corpora(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[dict[str, Corpus]]:
    """Languages of a shard; a shard beyond twice its size is kept in parts."""
    held: dict[str, Corpus] = {}
    chars = 0
    for batch in batches:
        for lang, text, total in zip(*map(common.strings, batch.columns[:2]),
                                     batch.column(2).to_pylist()):
            if lang not in held:
                held[lang] = Corpus()
            held[lang].total = total
            held[lang].add(text)
            chars += len(text)
            if chars > 2 * size:
                yield held
                held, chars = {}, 0
    if held:
        yield held


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of `BATCH_BYTES` for the plans that run inside."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[Numbered]:
    """Rows of `_shards` one by one."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield Numbered(*(c[at].as_py() for c in batch.columns))


def _mined(shards: DataFrame, lengths: range, min_count: int, buckets: int,
           pairs=None) -> DataFrame:
    """Locally frequent phrases, packed by hash bucket: bucket, lang, hashes, excess, floor.

    A shard may hold up to ``floor`` occurrences of a phrase that it does not name; ``excess`` is
    what a phrase named has beyond that.  Bucket -1 has the floor of a shard and language.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for corpus in _numbered(batches):
            lang = corpus.lang
            support = math.ceil(min_count * corpus.chars / corpus.total - 1e-9)
            yield _packed(-1, lang, np.empty(0, np.uint64), np.empty(0, np.int64), support - 1)
            levels = [(h, n) for _, _, n, h in mine(corpus, corpus.ids, lengths, support,
                                                    pairs=pairs and pairs.contains)]
            if not levels:
                continue
            hashes, n = (np.concatenate(x) for x in zip(*levels))
            home = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            hashes, excess = hashes[order], n[order] - (support - 1)
            cuts = np.searchsorted(home[order], np.arange(buckets + 1))
            for at in np.flatnonzero(np.diff(cuts)):
                here = slice(cuts[at], cuts[at + 1])
                yield _packed(int(at), lang, hashes[here], excess[here], 0)

    return shards.mapInArrow(
        run, "bucket int, lang string, hashes binary, excess binary, floor long")


def _packed(bucket: int, lang: str, hashes: np.ndarray, excess: np.ndarray,
            floor: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([lang]),
         pa.array([hashes.tobytes()], pa.binary()),
         pa.array([np.minimum(excess, 1 << 30).astype(np.int32).tobytes()], pa.binary()),
         pa.array([floor], pa.int64())], names=["bucket", "lang", "hashes", "excess", "floor"])


def _candidates(shards: DataFrame, lengths: range, min_count: int, size: int,
                filter_bytes: int, pairs=None) -> bloom.Shared:
    """Bloom filter of the phrases whose counts may reach ``min_count`` in all shards."""
    spark = shards.sparkSession
    chars = shards.agg(F.sum("chars")).first()[0] or 0
    bits = bloom.bits_for(chars / CHARS_PER_CANDIDATE, filter_bytes)
    probes = bloom.probes_for(chars / CHARS_PER_CANDIDATE, bits)
    buckets = BUCKETS * (1 + chars // size)
    mined = common.pinned(_mined(shards, lengths, min_count, buckets, pairs))
    floors = mined.where("bucket < 0").groupBy("lang").agg(F.sum("floor").alias("floors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []

        def union() -> Iterator[pa.RecordBatch]:
            hashes, excess = (np.concatenate(x) for x in zip(*held))
            names, inverse = np.unique(hashes, return_inverse=True)
            most = np.bincount(inverse, weights=excess) + last[2]
            yield from bloom.pieces(names[most >= min_count], bits, probes)

        for batch in batches:
            for *key, hashes, excess in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last:
                    if held:
                        yield from union()
                    last, held = key, []
                held.append((np.frombuffer(hashes, np.uint64), np.frombuffer(excess, np.int32)))
        if held:
            yield from union()

    named = mined.where("bucket >= 0").join(floors, "lang").select(
        "bucket", "lang", "floors", "hashes", "excess").repartition(
        "bucket", "lang").sortWithinPartitions("bucket", "lang")
    union = bloom.collected(named.mapInArrow(run, bloom.SCHEMA), bits, "once")
    return bloom.Shared(spark.sparkContext.broadcast(union), probes)


def _task_counts(shards: DataFrame, lengths: range, size: int, allowed: bloom.Shared,
                 pairs=None) -> DataFrame:
    """lang, length, phrase and its count in the shards of a task, of the phrases in the filter.

    With words (length 1) also a row of length 0 for each language: all its words.
    """
    part = max(1, size // (4 * COUNT_PARTS))  # a number has four bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], dict[bytes, int]] = defaultdict(lambda: defaultdict(int))
        for corpus in _numbered(batches):
            lang, names = corpus.lang, corpus.names
            if 1 in lengths:
                sums[lang, 0][b""] += corpus.words
            for ids in corpus.parts(part):
                for length, at, n, _ in mine(corpus, ids, lengths, 1, allowed.contains,
                                             pairs and pairs.contains):
                    into = sums[lang, length]
                    for a in range(0, len(at), 1 << 16):
                        rows = ids[at[a:a + (1 << 16), None] + np.arange(length)].tolist()
                        for row, count in zip(rows, n[a:a + (1 << 16)].tolist()):
                            into[b" ".join([names[i] for i in row])] += count
                if sum(map(len, sums.values())) >= HELD:
                    yield from _summed(sums)
        yield from _summed(sums)

    # as many tasks as run at once, or that many some times over: no few tasks are left to the end
    wide = shards.sparkSession.sparkContext.defaultParallelism
    tasks = wide * max(1, -(-len(shards.inputFiles()) // (TASK_SHARDS * wide)))
    return shards.coalesce(tasks).mapInArrow(
        run, "lang string, length int, phrase binary, n long")


def _counts(shards: DataFrame, lengths: range, min_count: int, size: int,
            allowed: bloom.Shared, pairs=None) -> DataFrame:
    """lang, length, phrase and its count in all shards, `_task_counts` summed."""
    return _task_counts(shards, lengths, size, allowed, pairs).groupBy(
        "lang", "length", "phrase").agg(F.sum("n").alias("n")).where(
        (F.col("n") >= min_count) | (F.col("length") == 0))


def _summed(sums: dict[tuple[str, int], dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
    """The sums of a task, which are empty afterwards."""
    for lang, length in list(sums):
        found = sums.pop((lang, length))
        phrases, n = list(found), list(found.values())
        del found
        for a in range(0, len(phrases), 1 << 16):
            yield _batch(lang, length, phrases[a:a + (1 << 16)], n[a:a + (1 << 16)])


def _batch(lang: str, length: int, phrases: list[bytes], n) -> pa.RecordBatch:
    count = len(phrases)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * count), pa.array([length] * count, pa.int32()),
         pa.array(phrases, pa.binary()), pa.array(np.asarray(n, np.int64))],
        names=["lang", "length", "phrase", "n"])


def frequent(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
             shard_bytes: int = SHARD_BYTES, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """lang, length (words), phrase and n of all phrases with ``min_count`` or more.

    Rows of length 0 have an empty phrase and the number of all words of the language.
    """
    shards = _shards(docs, shard_bytes)
    found, pairs = None, None
    for lengths in (range(1, min(3, max_words + 1)), range(3, max_words + 1)):
        if not lengths:
            continue
        with _small_batches(docs.sparkSession):
            wanted = _candidates(shards, lengths, min_count, shard_bytes, filter_bytes, pairs)
            level = common.pinned(_counts(shards, lengths, min_count, shard_bytes, wanted, pairs)
                                  .withColumn("phrase", F.col("phrase").cast("string")))
        found = level if found is None else found.unionByName(level)
        if max_words > 2 and 1 in lengths:
            pairs = _filter_of(level.where(F.col("length") == 2), filter_bytes)
    return found


def _filter_of(pairs: DataFrame, filter_bytes: int) -> bloom.Shared:
    """Bloom filter of given word pairs."""
    expected = pairs.count()
    bits = bloom.bits_for(expected, filter_bytes)
    probes = bloom.probes_for(expected, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.empty(batch.num_rows, np.uint64)
            for i, (lang, phrase) in enumerate(zip(*(common.strings(c) for c in batch.columns))):
                a, b = word_hashes(phrase.encode().split(b" "), lang)
                hashes[i] = grown(np.array([a]), np.array([b]))[0]
            yield from bloom.pieces(hashes, bits, probes)

    filled = bloom.collected(pairs.select("lang", "phrase").mapInArrow(run, bloom.SCHEMA),
                             bits, "once")
    return bloom.Shared(pairs.sparkSession.sparkContext.broadcast(filled), probes)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 top: int = TOP, absorb_percent: int = ABSORB_PERCENT,
                 shard_bytes: int = SHARD_BYTES, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a``: count of the phrase; ``l`` and ``r``: counts of the two parts of its weakest cut;
    ``n``: words of the language; ``score``: floor(1000 a n / (l r)) in exact arithmetic.  Ties of
    score and count rank by phrase.
    """
    found = frequent(docs, min_count, max_words, shard_bytes, filter_bytes)
    parts = found.where(F.col("length") > 0).select("lang", "phrase", "n")
    total = found.where(F.col("length") == 0).select("lang", F.col("n").alias("all_words"))
    words = F.split("phrase", " ")
    whole = found.where(F.col("length") > 1).select(
        "lang", "phrase", F.col("n").alias("a"), words.alias("w"))
    joined = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    cuts = whole.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"),
        joined(F.col("k") + 1, F.size("w") - F.col("k")).alias("tail"))
    side = lambda name, n: parts.select(
        "lang", F.col("phrase").alias(name), F.col("n").alias(n))
    exact = lambda c: F.col(c).cast("decimal(18,0)")
    product = (exact("a") * exact("all_words")).cast("decimal(35,0)") * F.lit(1000).cast(
        "decimal(4,0)")
    scored = (cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"),
                                                                  ["lang", "tail"])
              .join(total, "lang")
              .withColumn("score", F.call_function("div", product, exact("l") * exact("r"))))
    weakest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", F.col("all_words").alias("n"))).alias("cut"))
    # what lies inside longer candidates, with the largest count of these
    inner = whole.select("lang", "a", "w", F.size("w").alias("size")).where(F.size("w") > 2)
    inside = (inner.select("lang", "a", "w", "size", F.explode(F.sequence(
        F.lit(2), F.col("size") - 1)).alias("m"))
        .select("lang", "a", "w", "m", F.explode(F.sequence(
            F.lit(1), F.col("size") - F.col("m") + 1)).alias("start"))
        .groupBy("lang", joined(F.col("start"), F.col("m")).alias("phrase"))
        .agg(F.max("a").alias("longer")))
    left = weakest.join(inside, ["lang", "phrase"], "left").where(
        F.coalesce(F.lit(100) * F.col("longer") < F.lit(absorb_percent) * F.col("cut.a"),
                   F.lit(True)))
    ranked = left.select("lang", "phrase", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return ranked.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                                     "a", "l", "r", "n", "score")

