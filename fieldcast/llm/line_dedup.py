"""Lines that many documents share, removed everywhere but in one document.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased.  Keys of at
least `MIN_CHARS` code points that occur in at least `MIN_DOCS` documents lose all their lines
except in the document with the largest id that holds them.

1. Every task hashes the keys of its documents (a key once per document) and sets bits in two
   Bloom filters, for hashes met once and for hashes met again (`bloom`).  Only these bits move.
2. Keys that the second filter may hold are suspects: (key, document) rows of 128-bit key hashes,
   the only lines that shuffle.  They are counted exactly and the largest id is chosen.
3. Keys confirmed go back to the documents that lose them, and these lines are dropped.

The filters are sized by the characters of the table and bounded by `FILTER_BYTES`.  Beyond that
bound more keys are suspects by mistake; the result stays the same.  Keys held by more than
1 / `HOT_SHARE` of the suspect rows, of which there are at most `HOT_SHARE`, meet their rows by a
broadcast join, so that no task gets all rows of a common line.

Defined cases: null and empty texts have one empty line; a repeated row is a document of its own;
rows of one id that share a key all keep it if theirs is the largest id; a null id is smaller
than any other; lines without a key long enough always stay; an empty table gives no rows.
Input columns of the same names as results are kept and the results renamed by the caller's
prefix (`names`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm import bloom, common

MIN_CHARS = 40
MIN_DOCS = 5
#: Bytes of one filter at most, and characters of text for each key expected.
FILTER_BYTES = 1 << 25
CHARS_PER_KEY = 128
HOT_SHARE = 10_000
#: Hashes that a task gathers before it sends bits.
FLUSH = 1 << 21
#: Fixed value: the white space cut off at both ends.
BLANKS = " \t\n\x0b\x0c\r"


def keys(text: str, min_chars: int) -> list[tuple[int, bytes]]:
    """(line number, key) of the lines with a key long enough."""
    out = []
    for at, line in enumerate(text.split("\n")):
        if len(line) >= min_chars:
            key = line.strip(BLANKS)
            if len(key) >= min_chars:
                out.append((at, key.encode().lower()))
    return out


def _digests(text: str, min_chars: int) -> dict[bytes, list[int]]:
    """128-bit hash of each distinct key and its line numbers."""
    import xxhash

    out: dict[bytes, list[int]] = {}
    for at, key in keys(text, min_chars):
        out.setdefault(xxhash.xxh3_128_digest(key), []).append(at)
    return out


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def shared_lines(rows: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Document keys (doc_id, mark) and the 128-bit hashes (list of binary) they lose.

    ``rows``: doc_id, mark (hash of the text) and text.
    """
    spark = rows.sparkSession
    expected = (rows.agg(F.sum(F.length("text"))).first()[0] or 0) / CHARS_PER_KEY
    bits = bloom.bits_for(expected, filter_bytes)
    probes = bloom.probes_for(expected, bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for text in common.strings(batch.column(0)):
                found = _digests(text, min_chars)
                if found:
                    held.append(_halves(list(found))[:, 0])
                    n += len(found)
                if n >= FLUSH:
                    yield from bloom.pieces(np.concatenate(held), bits, probes)
                    held, n = [], 0
        if held:
            yield from bloom.pieces(np.concatenate(held), bits, probes)

    again = bloom.Shared(spark.sparkContext.broadcast(bloom.collected(
        rows.select("text").mapInArrow(fill, bloom.SCHEMA), bits, "twice")), probes)

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            rows_of, found = [], []
            for at, text in enumerate(common.strings(batch.column(2))):
                own = list(_digests(text, min_chars))
                found += own
                rows_of += [at] * len(own)
            if not found:
                continue
            halves = _halves(found)
            hit = again.contains(halves[:, 0])
            at = pa.array(np.array(rows_of)[hit])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at),
                 *(pa.array(halves[hit, i].copy().view(np.int64)) for i in range(2))],
                names=["doc_id", "mark", "k1", "k2"])

    suspects = common.pinned(rows.select("doc_id", "mark", "text").mapInArrow(
        suspect, "doc_id long, mark long, k1 long, k2 long"))
    counted = common.pinned(suspects.groupBy("k1", "k2").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(
        F.col("n") >= min_docs))
    many = suspects.count() / HOT_SHARE
    sides = []
    for hot in (True, False):
        some = counted.where((F.col("n") > many) if hot else (F.col("n") <= many)).drop("n")
        # at most HOT_SHARE keys can have more than 1 / HOT_SHARE of the rows
        sides.append(suspects.join(F.broadcast(some) if hot else some, ["k1", "k2"]))
    lost = sides[0].unionByName(sides[1]).where(
        F.col("doc_id").isNull() & F.col("keeper").isNotNull() | (F.col("doc_id") < F.col("keeper")))
    digest = F.struct("k1", "k2")
    return lost.groupBy("doc_id", "mark").agg(F.collect_set(digest).alias("lost"))


def dedup(df: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
          filter_bytes: int = FILTER_BYTES, text: str = "text", doc_id: str = "doc_id",
          names: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """Rows of ``df`` with the lines left in ``text``, and the numbers of lines and lost lines.

    The counts are added under ``names``; columns of ``df`` with these names are replaced.
    """
    others = [c for c in df.columns if c not in names]
    mark, lost = (common.own_name(df, n) for n in ("mark_of_text", "lost_lines"))
    value = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"),
                     F.xxhash64(value).alias("mark"), value.alias("text"))
    found = shared_lines(rows, min_chars, min_docs, filter_bytes).select(
        F.col("doc_id").alias("id_that_loses"), F.col("mark").alias("mark_that_loses"),
        F.col("lost").alias(lost))
    marked = df.select(*others, F.xxhash64(value).alias(mark))
    both = marked.join(found, F.col(doc_id).cast("long").eqNullSafe(F.col("id_that_loses")) & (
        F.col(mark) == F.col("mark_that_loses")), "left").select(*others, lost)
    at = others.index(text)
    schema = T.StructType([f for f in both.schema.fields[:-1]] + [
        T.StructField(n, T.LongType()) for n in names])
    schema[at].nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            kept, lines, dropped = [], [], []
            gone = batch.column(batch.num_columns - 1)
            for value, out in zip(common.strings(batch.column(at)), gone):
                lines.append(value.count("\n") + 1)
                drop: set[int] = set()
                if out.is_valid:
                    pairs = np.array([[p["k1"], p["k2"]] for p in out.as_py()], np.int64)
                    hashes = {p.tobytes() for p in pairs.view("<u8")}
                    for digest, numbers in _digests(value, min_chars).items():
                        if digest in hashes:
                            drop.update(numbers)
                if drop:
                    value = "\n".join(x for i, x in enumerate(value.split("\n")) if i not in drop)
                kept.append(value)
                dropped.append(len(drop))
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=[*batch.schema.names[:-1], *names])

    return both.mapInArrow(run, schema)
