"""Byte-level BPE by contiguous rank arrays, many words at a time.

A short word is one row of a matrix: token ids between the remaining part boundaries, and
beside each the merge rank of the pair that starts there.  Again and again the smallest rank
of each row is found, the boundary behind it deleted, the row closed up, and the ranks of the
two neighbouring pairs refreshed.  Rows without a mergeable pair are done.  Words longer than
`SHORT` bytes, where repeated scans would be quadratic, use a heap over linked parts.

Encoded words are kept per Python worker in a bounded dictionary, so that frequent words are
merged once.  Decoding concatenates the bytes of the ids and replaces invalid UTF-8.

Defined cases: null text counts as empty (no ids, decodes to the empty text); strings of added
tokens become their ids; very long texts are worked off in segments cut where the split pattern
always ends a word; repeated rows give equal results; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldcast.llm import common, tokenizer

SHORT = 64
CACHE_WORDS = 400_000
SEGMENT = 1 << 20
NONE = np.int32(2**31 - 1)

# In texts whose non-ASCII characters are all letters, bytes above 0x7f are letter bytes, and
# the split pattern can run on bytes.
_BYTE_WORDS = re.compile(rb"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z\x80-\xff]+| ?[0-9]+"
                         rb"| ?[^A-Za-z0-9\x80-\xff\s]+|\s+(?!\S)|\s+")
#: Letters below this code point are letters in every Unicode version the libraries use.
PLAIN_LETTERS = 0x250


class Merges:
    """Pair table of a vocabulary: hashed lookup of (left, right) to merge rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.base = max(vocab.values(), default=0) + 1
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        alphabet = tokenizer.byte_chars()
        self.byte_id = np.zeros(256, np.int32)
        for char, byte in alphabet.items():
            self.byte_id[byte] = vocab[char]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bits = max(8, int(np.ceil(np.log2(max(2, len(pairs))))) + 4)
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = left * self.base + right
        self.pairs = {key: at for at, key in reversed(list(enumerate(keys.tolist())))}
        mask = len(self.slots) - 1
        for at, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist())):
            while self.slots[slot] not in (-1, key):
                slot = (slot + 1) & mask
            if self.slots[slot] == -1:  # of equal pairs the first counts
                self.slots[slot], self.ranks[slot] = key, at

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NONE where the pair never merges."""
        keys = left.astype(np.int64) * self.base + right
        slot, out = self._slot(keys), np.full(keys.shape, NONE, np.int32)
        found = self.slots[slot]
        out[...] = np.where(found == keys, self.ranks[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        mask = len(self.slots) - 1
        while open_.size:
            slot[open_] = (slot[open_] + 1) & mask
            found = self.slots[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def merge_short(words: list[bytes], table: Merges) -> list[np.ndarray]:
    """Ids of words of at most SHORT bytes: one contiguous rank array per word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max(initial=1))
    ids = np.zeros((len(words), width), np.int32)
    inside = np.arange(width) < lengths[:, None]
    ids[inside] = table.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    ranks = np.full((len(words), width), NONE, np.int32)
    pairs = inside[:, 1:]
    ranks[:, :-1][pairs] = table.rank(ids[:, :-1][pairs], ids[:, 1:][pairs])
    out: list[np.ndarray] = [None] * len(words)
    rows, column = np.arange(len(words)), np.arange(width)
    while rows.size:
        best = ranks.argmin(1)
        low = ranks[np.arange(rows.size), best]
        going = low != NONE
        for at in np.flatnonzero(~going):
            out[rows[at]] = ids[at, :lengths[at]].copy()
        if not going.all():
            rows, ids, ranks, lengths = rows[going], ids[going], ranks[going], lengths[going]
            best, low = best[going], low[going]
        if not rows.size:
            break
        each = np.arange(rows.size)
        shifted = np.minimum(column + (column > best[:, None]), ids.shape[1] - 1)
        ids = np.take_along_axis(ids, shifted, 1)
        # the pair behind the deleted boundary goes with it; the others close up
        ranks = np.take_along_axis(ranks, shifted, 1)
        lengths = lengths - 1
        ids[each, best] = merged = table.merged[low]
        ranks[each, np.minimum(lengths, ids.shape[1] - 1)] = NONE
        has = best > 0
        ranks[each[has], best[has] - 1] = table.rank(ids[each[has], best[has] - 1], merged[has])
        ranks[each, best] = NONE
        has = best + 1 < lengths
        ranks[each[has], best[has]] = table.rank(merged[has], ids[each[has], best[has] + 1])
        if int(lengths.max()) < ids.shape[1]:
            width = int(lengths.max())
            ids, ranks, column = ids[:, :width], ranks[:, :width], column[:width]
    return out


def merge_long(word: bytes, table: Merges) -> np.ndarray:
    """Ids of a long word: a heap of mergeable pairs over linked parts."""
    ids = table.byte_id[np.frombuffer(word, np.uint8)].tolist()
    size = len(ids)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    first = table.rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
    heap = [(rank, at, ids[at], ids[at + 1]) for at, rank in enumerate(first) if rank != NONE]
    heapq.heapify(heap)

    def offer(at: int) -> None:
        right = after[at]
        rank = table.pairs.get(ids[at] * table.base + ids[right])
        if rank is not None:
            heapq.heappush(heap, (rank, at, ids[at], ids[right]))

    while heap:
        rank, at, left, right = heapq.heappop(heap)
        behind = after[at]
        if ids[at] != left or behind >= size or ids[behind] != right:
            continue
        ids[at], ids[behind] = int(table.merged[rank]), -1
        after[at] = after[behind]
        if after[at] < size:
            before[after[at]] = at
            offer(at)
        if before[at] >= 0:
            offer(before[at])
    return np.array([i for i in ids if i >= 0], np.int32)


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Cut a long text before a blank that a non-blank follows: a word always ends there."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = len(text)
                break
            if not text[cut + 1].isspace():
                break
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def plain(text: str) -> bool:
    """All characters beyond ASCII are letters of the Latin blocks."""
    return text.isascii() or all(c < "\x80" or (ord(c) < PLAIN_LETTERS and c.isalpha())
                                 for c in set(text))


class Encoder:
    """Words of a vocabulary to ids, with a bounded dictionary of words already merged."""

    def __init__(self, path: str):
        import regex

        self.table = merges(path)
        self.words: dict[bytes, bytes] = {}
        self.pattern = regex.compile(tokenizer.BYTE_LEVEL_PATTERN)
        added = sorted(self.table.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def split(self, text: str) -> list[bytes]:
        """Words of a text without added tokens."""
        if plain(text):
            return _BYTE_WORDS.findall(text.encode())
        return [w.encode() for w in self.pattern.findall(text)]

    def learn(self, words: list[bytes]) -> None:
        """Merge words and remember their ids as little-endian unsigned 32-bit integers."""
        if len(self.words) + len(words) > CACHE_WORDS:
            self.words.clear()
        short = sorted((w for w in words if len(w) <= SHORT), key=len)
        for at in range(0, len(short), 4096):
            part = short[at:at + 4096]
            for word, ids in zip(part, merge_short(part, self.table)):
                self.words[word] = ids.astype("<u4").tobytes()
        for word in words:
            if len(word) > SHORT:
                self.words[word] = merge_long(word, self.table).astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[bytes]]] = []
        held = 0
        for at, text in enumerate(texts):
            parts = self.added.split(text) if self.added else [text]
            for part in parts:
                if self.added and part in self.table.added:
                    waiting.append((at, part))
                    continue
                for piece in segments(part) if part else ():
                    waiting.append((at, self.split(piece)))
                    held += len(piece)
                    if held > 4 * SEGMENT:
                        self._finish(waiting, out)
                        waiting, held = [], 0
        self._finish(waiting, out)
        return [np.frombuffer(b"".join(x), "<u4") for x in out]

    def _finish(self, waiting: list, out: list[list[bytes]]) -> None:
        known = self.words
        need: set[bytes] = set()
        for _, ws in waiting:
            if isinstance(ws, list):
                need.update(ws)
        missing = list(need.difference(known))
        if missing:
            if len(known) + len(missing) > CACHE_WORDS:
                known.clear()
                missing = list(need)
            self.learn(missing)
        get = known.__getitem__
        for at, ws in waiting:
            if isinstance(ws, list):
                out[at].append(b"".join(map(get, ws)))
            else:
                out[at].append(np.array([self.table.added[ws]], "<u4").tobytes())


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker: its dictionary serves all tasks of the worker."""
    return Encoder(path)


def decode_ids(ids: np.ndarray, path: str) -> str:
    """Text of ids: their bytes, invalid UTF-8 replaced; unknown ids give nothing."""
    table = tokenizer.token_bytes(path)
    if ids.size and (int(ids.max()) >= len(table) or int(ids.min()) < 0):
        ids = ids[(ids >= 0) & (ids < len(table))]
    return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _mapped(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            got = work(batch)
            yield pa.RecordBatch.from_arrays([got[n] for n in names], names=names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id and its ids."""
    def work(batch: pa.RecordBatch) -> dict:
        ids = encoder(path).encode(list(common.strings(batch.column(1))))
        flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
        return {"doc_id": batch.column(0), "ids": common.list_array(flat, [len(x) for x in ids])}

    return _mapped(common.texts(df, text=text, doc_id=doc_id), "doc_id long, ids array<int>", work)


def decode(df: DataFrame, path: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id and the text that its ids stand for; null ids: empty."""
    def work(batch: pa.RecordBatch) -> dict:
        out = [decode_ids(np.array([i for i in x.as_py() or () if i is not None], np.int64), path)
               for x in batch.column(1)]
        return {"doc_id": batch.column(0), "text": pa.array(out, pa.string())}

    from pyspark.sql import functions as F

    narrow = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return _mapped(narrow, "doc_id long, text string", work)


def round_trip(df: DataFrame, path: str, text: str = "text",
               doc_id: str = "doc_id") -> DataFrame:
    """Encode and decode again; per document the count of ids and digests of both sides.

    ``ids_sha256`` is taken over the decimal ids joined by commas, ``decoded_sha256`` over the
    decoded text in UTF-8.  Ids do not leave the task, so nothing wide is shuffled or stored.
    """
    def work(batch: pa.RecordBatch) -> dict:
        count, left, right = [], [], []
        for ids in encoder(path).encode(list(common.strings(batch.column(1)))):
            decimal = ",".join(map(str, ids.tolist())).encode()
            count.append(len(ids))
            left.append(hashlib.sha256(decimal).hexdigest())
            right.append(hashlib.sha256(decode_ids(ids, path).encode()).hexdigest())
        return {"doc_id": batch.column(0), "n_tokens": pa.array(count, pa.int64()),
                "ids_sha256": pa.array(left, pa.string()),
                "decoded_sha256": pa.array(right, pa.string())}

    return _mapped(common.texts(df, text=text, doc_id=doc_id),
                   "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", work)
