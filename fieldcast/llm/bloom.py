"""Bloom filters filled inside tasks and merged by segment, of a bounded number of bytes.

A filter of `m` bits is cut into segments.  Tasks set bits for the hashes they meet and send the
segments that are not empty, packed; segments are merged on the cluster one after the other, so
no task holds more than one segment, and only the merged filter (at most the bytes asked for)
reaches the driver, which broadcasts it.  More hashes than the filter was made for raise the
share of false positives; they never lead to a false negative.

Seen twice.  `pieces` keeps two filters: bits set once, and bits set again.  Two of these pairs
merge to ``once = a.once | b.once`` and ``twice = a.twice | b.twice | (a.once & b.once)``, in any
order, so a hash met twice anywhere has all its bits in the second filter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

SEGMENT = 1 << 20
SCHEMA = "segment int, once binary, twice binary"
_LOW = np.uint64(0xFFFFFFFF)


def bits_for(hashes: float, most_bytes: int, per_hash: int = 8) -> int:
    """Bits of a filter: a power of two, `per_hash` for each hash, `most_bytes` at most."""
    wanted = max(1 << 16, int(hashes * per_hash))
    return min(1 << (wanted - 1).bit_length(), 1 << (max(1 << 13, most_bytes).bit_length() + 2))


def probes_for(hashes: float, bits: int) -> int:
    """Bits set for a hash: about half the bits there are for each, 1 to 4."""
    return int(min(4, max(1, round(bits / max(hashes, 1) / 2))))


def positions(hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Bit positions, one row per probe; ``bits`` is a power of two."""
    low, high = hashes & _LOW, (hashes >> np.uint64(32)) | np.uint64(1)
    mixed = (low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return np.stack([(mixed + np.uint64(j) * (high + np.uint64(j))) & np.uint64(bits - 1)
                     for j in range(probes)])


def pieces(hashes: np.ndarray, bits: int, probes: int) -> Iterator[pa.RecordBatch]:
    """Segments of the two filters of some hashes (repeats included)."""
    if not len(hashes):
        return
    flat, counts = np.unique(positions(hashes, bits, probes), return_counts=True)
    step = min(SEGMENT, bits)
    cuts = np.searchsorted(flat, np.arange(0, bits + 1, step, dtype=np.uint64))
    for at in np.flatnonzero(np.diff(cuts)):
        here = slice(cuts[at], cuts[at + 1])
        inside = (flat[here] - np.uint64(int(at) * step)).astype(np.int64)
        yield _row(int(at), *(_packed(p, step) for p in (inside, inside[counts[here] > 1])))


def _packed(at: np.ndarray, step: int) -> np.ndarray:
    flags = np.zeros(step, np.uint8)
    flags[at] = 1
    return np.packbits(flags, bitorder="little")


def _row(segment: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([segment], pa.int32()), *(pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())
                                            for x in (once, twice))],
        names=["segment", "once", "twice"])


def merged(found: DataFrame) -> DataFrame:
    """Pieces of all tasks, one row per segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, None, None
        for batch in batches:
            for segment, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
                if segment != at:
                    if at is not None:
                        yield _row(at, once, twice)
                    at, once, twice = segment, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if at is not None:
            yield _row(at, once, twice)

    return found.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, SCHEMA)


def collected(found: DataFrame, bits: int, which: str) -> np.ndarray:
    """The merged filter ``once`` or ``twice`` as bytes, at most ``bits / 8`` of them."""
    step = min(SEGMENT, bits) // 8
    out = np.zeros(bits // 8, np.uint8)
    for row in merged(found).select("segment", which).toLocalIterator():
        out[row[0] * step:(row[0] + 1) * step] = np.frombuffer(zlib.decompress(row[1]), np.uint8)
    return out


def contains(filled: np.ndarray, hashes: np.ndarray, probes: int) -> np.ndarray:
    """Which hashes the filter may hold."""
    ok = np.ones(len(hashes), bool)
    for at in positions(hashes, len(filled) * 8, probes):
        ok &= (filled[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(
            np.uint8)) & 1 == 1
    return ok


def counters_for(hashes: float, most_bytes: int) -> int:
    """Counters of one byte: a power of two, one for each hash, `most_bytes` at most."""
    return bits_for(hashes, most_bytes, per_hash=1) if hashes < most_bytes else (
        1 << (max(1 << 16, most_bytes).bit_length() - 1))


def count(counters: np.ndarray, hashes: np.ndarray) -> None:
    """Count distinct hashes, up to 255."""
    at = np.unique((hashes & np.uint64(len(counters) - 1)).astype(np.int64))
    held = counters[at]
    counters[at] = held + (held < 255)


def counter_pieces(counters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Segments of counters that are not empty."""
    for segment, part in enumerate(np.split(counters, max(1, len(counters) // SEGMENT))):
        if part.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()),
                 pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                names=["segment", "counts"])


def counted(found: DataFrame, size: int, unit: int = 1) -> np.ndarray:
    """Counters of all tasks added up, in whole ``unit``s and to 255 at most, ``size`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for segment, packed in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(zlib.decompress(packed), np.uint8)
                if segment != at:
                    if at is not None:
                        yield _counts(at, total, unit)
                    at, total = segment, part.astype(np.uint32)
                else:
                    total += part
        if at is not None:
            yield _counts(at, total, unit)

    summed = found.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        run, "segment int, counts binary")
    step = min(SEGMENT, size)
    out = np.zeros(size, np.uint8)
    for row in summed.toLocalIterator():
        out[row[0] * step:(row[0] + 1) * step] = np.frombuffer(zlib.decompress(row[1]), np.uint8)
    return out


def _counts(segment: int, total: np.ndarray, unit: int) -> pa.RecordBatch:
    total //= np.uint32(unit)
    low = np.minimum(total, np.uint32(255), out=total).astype(np.uint8)
    return pa.RecordBatch.from_arrays(
        [pa.array([segment], pa.int32()), pa.array([zlib.compress(low.tobytes(), 1)],
                                                   pa.binary())], names=["segment", "counts"])


def filter_of(hashes: DataFrame, most_bytes: int) -> Shared:
    """Filter of a column of 64-bit hashes (longs)."""
    number = hashes.count()
    bits = bits_for(number, most_bytes)
    probes = probes_for(number, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from pieces(batch.column(0).to_numpy().view(np.uint64), bits, probes)

    filled = collected(hashes.mapInArrow(run, SCHEMA), bits, "once")
    return Shared(hashes.sparkSession.sparkContext.broadcast(filled), probes)


class Shared:
    """A filter that tasks read from a broadcast."""

    def __init__(self, held: Broadcast, probes: int) -> None:
        self.held, self.probes = held, probes

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        return contains(self.held.value, hashes, self.probes)
