"""Token counts per section from one encoding of the whole document.

The whole text is encoded once.  Each token has a character span; spans and sections are both
sorted by position, so they meet by binary search (an interval join inside the document), and
each token is given to exactly one section.  Counts of the sections therefore add up to the
count of the document, which separate encodings of the sections would not.

A token that lies in several sections goes by the rule chosen:

* ``"most"`` (default): to the section that holds most of its characters, ties to the earlier,
* ``"first"``: to the section of its first character,
* ``"last"``: to the section of its last character.

Sections are the lines of a text, the line break belonging to the line it ends, or spans given
in a column ``array<struct<name:string,start:int,end:int>>`` of character positions.  Given
spans are sorted by start and end and cut where they overlap (the earlier keeps the place);
characters outside all of them form a section without a name, whose index is -1.  A token of
part of a character takes the span of that character.

Defined cases: null and empty texts have one empty section of 0 tokens (given sections: those);
sections outside the text are cut to it; null sections count as none; repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast.llm import common, tokenizer

RULES = ("most", "first", "last")
SCHEMA = ("doc_id long, section int, name string, start int, end int, n_tokens long, "
          "doc_tokens long")


@lru_cache(maxsize=2)
def id_bytes(path: str) -> np.ndarray:
    """Bytes of each id."""
    return np.array([len(b) for b in tokenizer.token_bytes(path)], np.int64)


def token_spans(text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and character behind the last of each token."""
    size = id_bytes(path)[tokenizer.encode(path, text)]
    end = np.cumsum(size)
    start = end - size
    if text.isascii():
        return start, end
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[start], char[end - 1] + 1


def line_starts(text: str) -> np.ndarray:
    """Position at which each line starts; the first is 0."""
    out, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        out.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(out, np.int64)


def allot(first: np.ndarray, last: np.ndarray, cuts: np.ndarray, rule: str) -> np.ndarray:
    """Section of each token: section k covers the characters cuts[k] to cuts[k + 1]."""
    a = np.searchsorted(cuts, first, "right") - 1
    if rule == "first":
        return a
    b = np.searchsorted(cuts, last - 1, "right") - 1
    if rule == "last":
        return b
    out = a.copy()
    for at in np.flatnonzero(a != b):
        edges = np.clip(cuts[a[at]:b[at] + 2], first[at], last[at])
        if len(edges) < b[at] - a[at] + 2:
            edges = np.append(edges, last[at])
        out[at] += int(np.argmax(np.diff(edges)))
    return out


def covering(given: list[dict] | None, size: int) -> tuple[np.ndarray, list[tuple]]:
    """Cuts and (index, name, start, end) of given spans and the places between them."""
    def cut(at: int | None, missing: int) -> int:
        return min(size, max(0, missing if at is None else at))

    spans = sorted((cut(s["start"], 0), cut(s["end"], size), i)
                   for i, s in enumerate(given or []) if s is not None)
    parts, at = [], 0
    for start, end, i in spans:
        start, end = max(start, at), max(end, at, start)
        if start > at:
            parts.append((-1, None, at, start))
        parts.append((i, given[i]["name"], start, end))
        at = end
    if at < size or not parts:
        parts.append((-1, None, at, size))
    full = [p for p in parts if p[3] > p[2]] or parts[:1]
    empty = [p for p in parts if p not in full]
    return np.array([p[2] for p in full], np.int64), [*full, *empty]


def count_sections(df: DataFrame, path: str, sections: str | None = None, rule: str = "most",
                   text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document and section, see the module's text."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            docs, rows, parts = [], [], []
            for at, value in enumerate(batch.column(1)):
                value = value.as_py()
                first, last = token_spans(value, path)
                if sections is None:
                    cuts = line_starts(value)
                    labels = None
                else:
                    cuts, labels = covering(batch.column(2)[at].as_py(), len(value))
                count = np.bincount(allot(first, last, cuts, rule), minlength=len(cuts))
                if labels is None:
                    index, names = np.arange(len(cuts)), None
                    start, end = cuts, np.append(cuts[1:], len(value))
                else:
                    count = np.append(count, np.zeros(len(labels) - len(cuts), np.int64))
                    index, names, start, end = map(list, zip(*labels))
                docs.append((batch.column(0)[at].as_py(), len(count), len(first)))
                parts.append((index, start, end, count))
                rows.extend(names or [None] * len(count))
            if not docs:
                continue
            repeat = [d[1] for d in docs]
            whole = pa.array(np.repeat(np.arange(len(docs)), repeat))
            joined = [np.concatenate([np.asarray(p[i], np.int64) for p in parts])
                      for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in docs], pa.int64()).take(whole),
                 pa.array(joined[0].astype(np.int32)), pa.array(rows, pa.string()),
                 pa.array(joined[1].astype(np.int32)), pa.array(joined[2].astype(np.int32)),
                 pa.array(joined[3]),
                 pa.array(np.repeat(np.array([d[2] for d in docs], np.int64), repeat))],
                names=[c.split()[0] for c in SCHEMA.split(", ")])

    more = [F.col(sections).alias("sections")] if sections else []
    return common.texts(df, *more, text=text, doc_id=doc_id).mapInArrow(run, SCHEMA)
