"""Sum-of-squares packing of documents into windows of a fixed number of tokens.

Documents of a partition arrive one after the other.  Whole windows are cut off a long document
at once; what is left, an item shorter than a window, goes to the fill level that makes the sum
of squared counts of partially filled windows smallest: an array holds, for each level, how many
windows stand at it, and all levels are compared at once (a new window is level 0).  Ties go to
the fullest level.

A document is cut only at whole windows until its partition ends.  Then the windows still
partly filled are closed without padding: the fullest are filled up with pieces cut from the
emptiest, and the one left at the end is divided into sequences whose lengths are powers of two,
which need no padding.  So no sequence of a partition holds padding at all, and each partition
cuts at most about one document per window that was still open.

Every partition packs for itself, so the work spreads over all tasks; rows are sorted by id in
each, so that a task that runs again packs alike.  A task keeps digests (and, if asked for, ids)
of pieces in windows that are still open, not of finished ones.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; ties of
ids are ordered by text; an empty table gives no pieces.  ``sequence_id`` is unique over the
table, not dense.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast.llm import common, tokenizer

WINDOW = 2048
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Packer:
    """Level array and open windows of one partition; pieces are (document, start, ids)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)  # windows at each fill level; 0 and full: none
        self.open: dict[int, deque] = defaultdict(deque)
        self.next = 0

    def _close(self, pieces: list) -> tuple[int, list]:
        self.next += 1
        return self.next - 1, pieces

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple[int, list]]:
        """Place one document; yields the windows that are full now."""
        whole = len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            yield self._close([(doc, at, ids[at:at + self.window])])
        size = len(ids) - whole
        if not size:
            return
        piece = (doc, whole, ids[whole:].copy())  # not a view: the document may be long
        # moving a window from level h to h + size changes the sum of squares by
        # 2 (count[h + size] - count[h]) + 2, where a full window no longer counts
        last = self.window - size
        after = self.count[size:self.window + 1]
        change = 2 * (after - self.count[:last + 1]) + 2
        change[last] = 1 - 2 * self.count[last]
        change[0] = 2 * self.count[size] + 1
        change[1:][self.count[1:last + 1] == 0] = np.iinfo(np.int64).max
        level = last - int(np.argmin(change[::-1]))
        pieces = []
        if level:
            pieces = self.open[level].popleft()
            self.count[level] -= 1
        pieces.append(piece)
        if level == last:
            yield self._close(pieces)
        else:
            self.open[level + size].append(pieces)
            self.count[level + size] += 1

    def finish(self) -> Iterator[tuple[int, list]]:
        """Close the open windows without padding."""
        left = deque(pieces for level in sorted(self.open, reverse=True)
                     for pieces in self.open[level])
        self.open.clear()
        self.count[:] = 0
        while len(left) > 1:
            pieces = left.popleft()
            room = self.window - sum(len(p[2]) for p in pieces)
            while room and left:
                doc, start, ids = left[-1].pop()
                keep = max(0, len(ids) - room)
                if keep:
                    left[-1].append((doc, start, ids[:keep]))
                elif not left[-1]:
                    left.pop()
                pieces.append((doc, start + keep, ids[keep:]))
                room -= len(ids) - keep
            if room:
                left.append(pieces)
                break
            yield self._close(pieces)
        for pieces in left:
            yield from self._powers(pieces)

    def _powers(self, pieces: list) -> Iterator[tuple[int, list]]:
        """Divide one window into sequences whose lengths are powers of two."""
        total = sum(len(p[2]) for p in pieces)
        waiting = deque(pieces)
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            out = []
            while room:
                doc, start, ids = waiting.popleft()
                take = min(room, len(ids))
                out.append((doc, start, ids[:take]))
                if take < len(ids):
                    waiting.appendleft((doc, start + take, ids[take:]))
                room -= take
            yield self._close(out)


def pack(df: DataFrame, path: str, end_id: int, window: int = WINDOW, text: str = "text",
         doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids themselves as a list column.

    The ids of a sequence are its pieces in order of ``offset``.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, rows, lists, held = Packer(window), [], [], 0
        part = None

        def take(done: Iterator[tuple[int, list]]) -> int:
            size = 0
            for number, pieces in done:
                offset = 0
                for (doc, tokens), start, ids in pieces:
                    rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens,
                                 (part << 40) + number, offset))
                    offset += len(ids)
                    if with_ids:
                        lists.append(ids)
                size += offset
            return size

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            if with_ids:
                flat = np.concatenate(lists).astype(np.int32)
                columns.append(common.list_array(flat, [len(x) for x in lists]))
            out = pa.RecordBatch.from_arrays(columns, names=[*names, *["ids"] * with_ids])
            rows.clear()
            lists.clear()
            return out

        for batch in batches:
            part = batch.column(2)[0].as_py() if part is None and batch.num_rows else part
            for doc, value in zip(batch.column(0), batch.column(1)):
                ids = np.append(tokenizer.encode(path, value.as_py()), np.uint32(end_id))
                held += take(packer.add((doc.as_py(), len(ids)), ids.astype("<u4")))
                if len(rows) >= 4096 or held > 1 << 20:
                    yield flush()
                    held = 0
        take(packer.finish())
        if rows:
            yield flush()

    narrow = (common.texts(df, text=text, doc_id=doc_id).sortWithinPartitions("doc_id", "text")
              .withColumn("part", F.spark_partition_id()))
    return narrow.mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
