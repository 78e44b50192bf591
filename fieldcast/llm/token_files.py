"""Token ids as Parquet list columns: written in document order, read selectively.

File format, one folder per corpus, each file a range of ascending ``doc_id``:

* ``part`` int: number of the range, the same in all rows of a file,
* ``doc_id`` long,
* ``local_start`` long: ids of the documents before it in its file,
* ``n_tokens`` long: its ids, the end id counted,
* ``ids`` list of int.

``ids`` are dictionary encoded (a vocabulary fits one dictionary page), the integer columns are
delta encoded (data page version 2), all zstd compressed.  Row groups and pages are small and
carry the format's column and offset index, so a range of documents or the counts alone can be
read without touching other ids.  The position of a file in the corpus is not stored: it is the
sum over the files before it, taken from ``local_start`` and ``n_tokens``.

Encoding uses the tokenizers library.  Texts whose non-ASCII characters are all Latin letters
are lower-cased, joined and cut into words here, about 2 MB at once.  Each distinct word of such
a batch is looked up once in the worker's bounded dictionary and goes through the library's BPE
model if it is not there; every other text goes through the library's whole pipeline.

Defined cases: null and empty texts hold the end id alone; documents with equal ids keep the
order of their texts; a null id sorts first; an empty table gives an empty folder of one file.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldcast.llm import bpe, common, tokenizer

CACHE_WORDS = 600_000
ROW_GROUP_MB = 16
PAGE_KB = 64
SCHEMA = "part int, doc_id long, local_start long, n_tokens long, ids array<int>"

#: About so many bytes of text are split at once.
HELD = 1 << 21
#: Put behind each text; this byte is in no UTF-8 text.
END = b"\xff"

_SHOWN = re.compile(rb"[\x21-\x7e]+")

# Kind of each byte.  Neighbours of one kind are one word; from _DIGIT on a byte stands alone.
_OTHER, _LETTER, _SPACE, _DIGIT, _END = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 0xff)]] = _LETTER
_KIND[list(b" \t\n\r\f\v")] = _SPACE
_KIND[list(b"0123456789")] = _DIGIT
_KIND[ord(END)] = _END
_BLANKS = bytes.maketrans(b"\t\n\r\f\v", b"     ")


def starts_of_words(data: np.ndarray) -> np.ndarray:
    """Where words begin, a blank before a word included, in lower-case UTF-8 ending in a blank."""
    kind = _KIND[data]
    cut = np.ones(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    cut |= kind >= _DIGIT
    blank = kind == _SPACE
    cut[1:] &= ~blank[:-1]
    cut |= blank
    # 's 't 're 've 'm 'll 'd are words, unless the apostrophe goes on a run of other characters
    at = np.flatnonzero(data == ord("'"))
    at = at[kind[at - 1] != _OTHER]
    first, second = data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
    short = np.isin(first, list(b"stmd"))
    long = (np.isin(first, list(b"rv")) & (second == ord("e"))) | (
        (first == ord("l")) & (second == ord("l")))
    cut[at[short | long] + 1] = False
    cut[at[short] + 2] = True
    cut[at[long] + 3] = True
    return np.flatnonzero(cut)


class _Known(dict):
    """Ids of words, made on first use; of two halves the one not used for longer is dropped."""

    def __init__(self, make: Callable[[bytes], bytes]) -> None:
        super().__init__()
        self.make = make
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        found = self.old.pop(word, None)
        if found is None:
            found = self.make(word)
        if len(self) >= CACHE_WORDS // 2:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


class Encoder:
    """Whole texts to ids by the tokenizers library."""

    def __init__(self, path: str):
        # each task has one core; threads of the library would only compete
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.words = _Known(self._word)
        self.chars = {byte: char for char, byte in tokenizer.byte_chars().items()}
        kinds = [str(type(x).__name__) for x in self._steps()]
        self.fast = kinds == ["NFC", "Replace", "Lowercase"]

    def _steps(self) -> list:
        normalizer = self.library.normalizer
        try:
            return [normalizer[i] for i in range(len(normalizer))]
        except TypeError:
            return [normalizer]

    def _plain(self, text: str) -> bool:
        """Lower-casing and splitting here gives what the library gives."""
        if not self.fast or "<|" in text:
            return False
        if text.isascii():
            return True
        return "İ" not in text and bpe.plain(text) and unicodedata.is_normalized("NFC", text)

    def _word(self, word: bytes) -> bytes:
        word = word.strip(b" " + END)
        if not word:
            return b""
        shown = word.decode("latin-1") if _SHOWN.fullmatch(word) else "".join(
            map(self.chars.__getitem__, word))
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _joined(self, pieces: list[bytes], end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of plain texts, and how many there are up to each `END`."""
        text = b"".join([*pieces, b" "]).translate(_BLANKS)
        data = np.frombuffer(text, np.uint8)
        starts = starts_of_words(data)
        offsets = np.append(starts, len(data)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
        words = words.dictionary_encode()
        which = words.indices.to_numpy()
        # each different word is looked up once, its ids are then taken wherever it stands
        ids = list(map(self.words.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)))
        ends = np.flatnonzero(data[offsets[1:] - 1] == ord(END))
        for mark in np.unique(which[ends]).tolist():
            ids[mark] = end
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(size) - size
        size = size[which]
        until = np.cumsum(size)
        at = np.repeat(first[which] - until + size, size) + np.arange(int(until[-1]))
        return np.frombuffer(b"".join(ids), "<i4")[at], until[ends]

    def encode_all(self, texts: Iterable[str], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, ``end`` behind each, and the number of ids of each text."""
        flat, until = [np.zeros(0, "<i4")], [np.zeros(1, np.int64)]
        held: list[bytes] = []
        total = size = 0

        def take(ids: np.ndarray, ends: np.ndarray) -> None:
            nonlocal total
            flat.append(ids)
            until.append(ends + total)
            total += len(ids)

        for text in texts:
            if self._plain(text):
                for piece in bpe.segments(text):
                    if size >= HELD:
                        take(*self._joined(held, end))
                        held, size = [], 0
                    held.append(piece.lower().encode())
                    size += len(piece)
                held.append(END)
                continue
            if held:
                take(*self._joined(held, end))
                held, size = [], 0
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            ids = np.frombuffer(ids + end, "<i4")
            take(ids, np.array([len(ids)]))
        if held:
            take(*self._joined(held, end))
        return np.concatenate(flat), np.diff(np.concatenate(until))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0].tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write(df: DataFrame, folder: str, path: str, end_id: int, text: str = "text",
          doc_id: str = "doc_id", row_group_mb: int = ROW_GROUP_MB, page_kb: int = PAGE_KB) -> None:
    """Encode all documents and write them to ``folder`` in ascending order of ``doc_id``."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, encode = 0, encoder(path).encode_all
        pieces = (part for batch in batches
                  for part in common.slices([batch], rows=batch.num_rows, size=HELD))
        for batch in pieces:
            ids, count = encode(common.strings(batch.column(1)), end)
            before = start + np.cumsum(count) - count
            start += int(count.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(0), pa.array(before), pa.array(count),
                 common.list_array(ids, count.tolist())],
                names=["part", "doc_id", "local_start", "n_tokens", "ids"])

    narrow = common.texts(df, text=text, doc_id=doc_id, spread=False)
    ranged = (narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
              .withColumn("part", F.spark_partition_id()))
    (ranged.mapInArrow(run, SCHEMA).write.mode("errorifexists")
     .option("compression", "zstd")
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", str(row_group_mb << 20))
     .option("parquet.page.size", str(page_kb << 10))
     .option("parquet.dictionary.page.size", str(1 << 20))
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#local_start", "false")
     .option("parquet.enable.dictionary#n_tokens", "false")
     .parquet(folder))


def read(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """Documents of a folder with ``start`` in the whole corpus; without ``ids`` if not asked."""
    files = spark.read.schema(SCHEMA).parquet(folder)
    ends = files.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("size"))
    # one row per file: a window over them is small at any corpus size
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select("part", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("base"))
    columns = ["doc_id", "start", "n_tokens", *(["ids"] if ids else [])]
    # no more rows than the writing stage had tasks, so the broadcast is small at any corpus size
    return (files.join(F.broadcast(base), "part")
            .withColumn("start", F.col("base") + F.col("local_start")).select(*columns))


def checksums(df: DataFrame) -> DataFrame:
    """Documents as read, with ``ids_crc32`` in place of the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, rows=4096):
            column = batch.column(3)
            flat = column.values.to_numpy(zero_copy_only=False).astype("<u4")
            at = column.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return df.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
