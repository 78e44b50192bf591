"""Quality score from compression with dictionaries of good and of bad text.

Two zstandard dictionaries are built from labelled texts, one of good, one of bad documents.  A
whole text is compressed block by block with each; its normalised difference
(good size - bad size) / plain size is positive where the bad dictionary helps more.  A logistic
regression on the difference, its square, the plain compression ratio (text that repeats itself
compresses far better than either dictionary explains), the ratio with the good dictionary and its
square turns it into a probability.

Labels are learned only from documents that are not held out.  At most `DICT_ROWS` labelled
documents of each class go into the dictionaries, and at most `FIT_ROWS` others, whole, into the
calibration; both are those whose ids hash lowest.  For the dictionaries a text is cut wholly into
pieces of `PIECE` characters, of which the `PIECES` that hash lowest are taken, so every position
may be among them.  Only the text is an input of a score.

Defined cases: null and empty texts have difference 0 and ratio 1; without labels of both
classes every score is the share of good labels (0.5 without any); repeated rows score alike;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast.llm import common, labelled

DICT_ROWS = 1500
PIECE, PIECES = 1024, 4
DICT_BYTES = 64 << 10
FIT_ROWS = 6000
BLOCK = 2048
LEVEL = 3
CUT = 0.3
SEED = 1


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; a few hundred kB."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def score(self, text: str) -> float:
        if len(self.weights) == 1:
            return self.weights[0]
        margin = float(inputs(text, self.good, self.bad) @ np.array(self.weights))
        return float(1 / (1 + np.exp(-np.clip(margin, -60, 60))))


@lru_cache(maxsize=8)
def compressor(dictionary: bytes):
    """A compressor with a prepared dictionary, kept per worker."""
    import zstandard

    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False,
                                        write_dict_id=False)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False,
                                    write_dict_id=False)


def sizes(text: str, good: bytes, bad: bytes) -> tuple[int, int, int, int, int]:
    """Bytes of a text: raw, blocks compressed with each dictionary, blocks plain, whole plain."""
    raw = text.encode()
    tools = compressor(good), compressor(bad), compressor(b"")
    total = [0, 0, 0]
    for at in range(0, len(raw), BLOCK):
        block = raw[at:at + BLOCK]
        for i, tool in enumerate(tools):
            total[i] += len(tool.compress(block))
    return len(raw), *total, len(tools[2].compress(raw))


def inputs(text: str, good: bytes, bad: bytes) -> np.ndarray:
    """Inputs of the calibration."""
    raw, by_good, by_bad, plain, whole = sizes(text, good, bad)
    if not raw:
        return np.array([1.0, 0.0, 0.0, 1.0, 1.0, 0.0])
    difference = (by_good - by_bad) / max(1, plain)
    return np.array([1.0, difference, difference * difference, min(2.0, whole / raw),
                     min(2.0, by_good / raw), min(2.0, by_good / raw) ** 2])


def build_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A zstandard dictionary; of the texts themselves where there are too few to train one."""
    import zstandard

    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def calibrate(rows: np.ndarray, labels: np.ndarray, penalty: float = 1e-5) -> np.ndarray:
    """Logistic regression by damped Newton steps; inputs are scaled inside."""
    mean, scale = rows.mean(0), rows.std(0)
    mean[0], scale[0] = 0.0, 1.0
    scale[scale < 1e-12] = 1.0
    x = (rows - mean) / scale
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty * len(x))
    ridge[0] = 1e-3

    def loss(v: np.ndarray) -> float:
        margin = x @ v
        return float((np.logaddexp(0, margin) - labels * margin).sum() + (ridge * v * v).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (p - labels) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step, now = np.linalg.solve(curve, grad), loss(w)
        rate = 1.0
        while rate > 1e-6 and loss(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-8:
            break
    out = w / scale
    out[0] = w[0] - (w[1:] * mean[1:] / scale[1:]).sum()
    return out


def pieces(text: str, doc_id: str, seed: int) -> Column:
    """At most `PIECES` pieces of a text, chosen by hash and joined in their order."""
    numbers = F.sequence(F.lit(0), F.ceil(F.length(text) / PIECE).cast("int"))
    turns = F.transform(numbers, lambda i: F.struct(F.xxhash64(F.lit(seed), doc_id, i).alias("turn"),
                                                       i.alias("i")))
    # the last number is one too many: it stands for a piece only in an empty text
    all_but_last = F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(1)))
    chosen = F.transform(F.slice(F.array_sort(all_but_last), 1, PIECES), lambda t: t["i"])
    cut = F.transform(F.array_sort(chosen), lambda i: F.substring(F.col(text), i * PIECE + 1,
                                                                 F.lit(PIECE)))
    return F.array_join(cut, "")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", dict_rows: int = DICT_ROWS,
        fit_rows: int = FIT_ROWS, text: str = "text", doc_id: str = "doc_id",
        seed: int = SEED) -> Model:
    """Model learned from labelled documents that are not held out."""
    # one scan for all samples: per class the ids that hash lowest
    rows = common.pinned(labelled.sample(docs, labels, label, 4 * dict_rows + fit_rows, seed,
                                         text, doc_id).repartition("doc_id"))
    turn = F.xxhash64(F.lit(seed), "doc_id")
    rows = rows.withColumn("turn", turn)
    share = rows.agg(F.avg(F.when(F.col("label") > 0, 1.0).otherwise(0.0))).first()[0]
    picked, used = {}, []
    for name, one in (("good", F.col("label") > 0), ("bad", F.col("label") <= 0)):
        # at most half of a class goes into its dictionary, the rest is for the calibration
        half = int(rows.where(one).count() / 2)
        got = (rows.where(one).orderBy(turn).limit(min(dict_rows, half))
               .select("doc_id", pieces("text", "doc_id", seed).alias("text")).collect())
        picked[name] = [r.text.encode() for r in got]
        used += [r.doc_id for r in got]
    if not picked["good"] or not picked["bad"]:
        return Model(b"", b"", (0.5 if share is None else float(share),))
    good, bad = build_dictionary(picked["good"]), build_dictionary(picked["bad"])
    spent = frozenset(used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            mask = [i for i, d in enumerate(batch.column(0).to_pylist()) if d not in spent]
            part = batch.take(pa.array(mask, pa.int64()))
            x = [inputs(t, good, bad).tolist() for t in common.strings(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), part.column(3),
                 pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "label", "turn", "x"])

    table = rows.mapInArrow(run, "doc_id long, label int, turn long, x array<double>").toArrow()
    order = np.lexsort((table["doc_id"].to_numpy(), table["turn"].to_numpy()))[:fit_rows]
    x = np.array(table["x"].to_pylist(), float).reshape(-1, 6)[order]
    y = (table["label"].to_numpy()[order] > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return Model(b"", b"", (float(share),))
    return Model(good, bad, tuple(calibrate(x, y).tolist()))


def score(df: DataFrame, model: Model, cut: float = CUT, text: str = "text",
          doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            got = [model.score(t) for t in common.strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(got, pa.float64()),
                 pa.array([int(s >= cut) for s in got], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    narrow = common.texts(df, labelled.held_out(doc_id).alias("held_out"), text=text,
                          doc_id=doc_id)
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
