"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text and their beginnings of three to six letters.  The
model has one weight per feature, shared by all thresholds: P(grade >= k) = logistic(w x - t_k)
with t_1 < t_2 < t_3.  Expected severity is the sum of these probabilities; a document counts
as toxic if P(grade >= 1) reaches `TOXIC`.

Grades.  Labels may carry grades themselves (0 upwards).  From labels 0 and 1 alone, documents
labelled 1 are graded 1 to 3 by thirds of their evidence, the summed log-odds of their features.

Fitting uses at most `SAMPLE_ROWS` labelled documents (those whose ids hash lowest): Spark
counts features per class there, the `MAX_FEATURES` with the clearest log-odds are kept, and the
regression runs on their sparse rows.  Scoring covers every document and its whole text.

Defined cases: null and empty texts have no features and get the model's base severity; words
are compared lower-cased; repeated rows are scored each; equal texts are learned from once, with
the smallest of their labels; without labels, or with one class only,
nothing is learned and no document is toxic; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast.llm import common, labelled

SAMPLE_ROWS = 12_000
MAX_FEATURES = 4096
MIN_DOCS = 3
MIN_ODDS = 2.0  # log-odds: seven times as frequent in toxic documents
MIN_Z = 4.5  # among a million features chance alone passes this a few times
TOXIC = 0.3
GRADES = 3
SEED = 4
PENALTY = 1e-5
STEPS = 400
_WORD = re.compile(r"\w+")
_CACHE = 200_000


def features_of(word: str) -> list[str]:
    """A word (marked by a blank) and its beginnings."""
    return [f"{word} ", *(word[:n] for n in range(3, 7) if len(word) > n)]


@dataclass
class Model:
    """Weights and thresholds; small and bounded, so it travels with the tasks."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()
    known: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def features(self, text: str) -> set[str]:
        """The model's features that a text has."""
        known, weights, out = self.known, self.weights, set()
        for word in set(_WORD.findall(text.lower())):
            has = known.get(word)
            if has is None:
                if len(known) > _CACHE:
                    known.clear()
                has = known[word] = tuple(f for f in features_of(word) if f in weights)
            if has:
                out.update(has)
        return out

    def at_least(self, text: str) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        score = sum(self.weights[f] for f in sorted(self.features(text)))
        return 1 / (1 + np.exp(-np.clip(score - np.array(self.thresholds), -60, 60)))

    def __getstate__(self):
        return {"weights": self.weights, "thresholds": self.thresholds, "known": {}}


def feature_counts(rows: DataFrame) -> DataFrame:
    """feature, pos, neg: documents of each class that have the feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def flush() -> pa.RecordBatch:
            names = list(seen[True].keys() | seen[False].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()),
                 *(pa.array([seen[k][n] for n in names], pa.int64()) for k in (True, False))],
                names=["feature", "pos", "neg"])
            seen[True].clear()
            seen[False].clear()
            return out

        for batch in common.slices(batches):
            for text, label in zip(common.strings(batch.column(1)), batch.column(2).to_pylist()):
                seen[label > 0].update({f for w in set(_WORD.findall(text.lower()))
                                        for f in features_of(w)})
            if len(seen[False]) + len(seen[True]) > 400_000:
                yield flush()
        yield flush()

    return rows.mapInArrow(run, "feature string, pos long, neg long").groupBy("feature").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def select(counts: DataFrame, pos: int, neg: int, most: int = MAX_FEATURES) -> dict[str, float]:
    """Log-odds of the features that speak for the toxic class most clearly.

    Only such features are kept: a long text has many features that lean the other way a
    little, and they would outvote its few toxic words.
    """
    a, b = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(a / (pos + 1.0 - F.col("pos") + 0.5)) - F.log(b / (neg + 1.0 - F.col("neg") + 0.5))
    z = odds / F.sqrt(1 / a + 1 / b)
    top = (counts.where(F.col("pos") + F.col("neg") >= MIN_DOCS).select(
        "feature", odds.alias("odds"), z.alias("z")).where((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_ODDS))
        .orderBy(F.desc("z"), "feature").limit(most).collect())
    return {r.feature: r.odds for r in top}


def ordinal_fit(rows: list[np.ndarray], grades: np.ndarray, width: int, penalty: float = PENALTY,
                steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the likelihood of a cumulative-link model.

    rows: feature positions of each document.  The thresholds are a first one and positive
    steps, so they stay in order.
    """
    levels = int(grades.max())
    lengths = np.array([len(r) for r in rows])
    at = np.repeat(np.arange(len(rows)), lengths)
    cols = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    share = np.array([(grades >= k).mean() for k in range(1, levels + 1)]).clip(1e-4, 1 - 1e-4)
    start = -np.log(share / (1 - share))
    params = np.concatenate([np.zeros(width), start[:1], np.log(np.diff(start).clip(1e-2))])
    mean, var = np.zeros_like(params), np.zeros_like(params)
    index = np.arange(len(rows))
    for step in range(1, steps + 1):
        gaps = np.exp(params[width + 1:])
        cuts = params[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(at, params[:width][cols], len(rows))
        upper = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts, -40, 40)))
        full = np.column_stack([np.ones(len(rows)), upper, np.zeros(len(rows))])
        slope = full * (1 - full)
        p = np.maximum(full[index, grades] - full[index, grades + 1], 1e-9)
        d_score = -(slope[index, grades] - slope[index, grades + 1]) / p / len(rows)
        d_cut = np.zeros(levels + 2)
        np.add.at(d_cut, grades, slope[index, grades] / p / len(rows))
        np.add.at(d_cut, grades + 1, -slope[index, grades + 1] / p / len(rows))
        d_cut = d_cut[1:-1]
        later = np.cumsum(d_cut[::-1])[::-1]
        grad = np.concatenate([np.bincount(cols, d_score[at], width) + penalty * params[:width],
                               later[:1], later[1:] * gaps])
        mean, var = 0.9 * mean + 0.1 * grad, 0.999 * var + 0.001 * grad * grad
        rate = 0.05 * (1 - 0.9 * step / steps)
        params = params - rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(var / (1 - 0.999**step)) + 1e-8)
        # every feature was picked as evidence for the toxic class, so none may speak against it
        params[:width] = np.maximum(params[:width], 0)
    gaps = np.exp(params[width + 1:])
    return params[:width], params[width] + np.concatenate([[0.0], np.cumsum(gaps)])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS,
        text: str = "text", doc_id: str = "doc_id", seed: int = SEED) -> Model:
    """Model learned from labelled documents that are not held out."""
    found = labelled.sample(docs, labels, label, rows, seed, text, doc_id)
    sample = common.pinned(found.groupBy("text").agg(
        F.min("doc_id").alias("doc_id"), F.min("label").alias("label")).select(
        "doc_id", "text", "label").repartition("doc_id"))
    size = {r.c: r.n for r in sample.groupBy((F.col("label") > 0).alias("c"))
            .agg(F.count("*").alias("n")).collect()}
    if not size.get(True) or not size.get(False):
        return Model()
    odds = select(feature_counts(sample), size[True], size[False])
    names = sorted(odds)
    number = {name: at for at, name in enumerate(names)}
    picker = Model(odds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            got = [sorted(number[f] for f in picker.features(t))
                   for t in common.strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(got, pa.list_(pa.int32()))],
                names=["doc_id", "label", "at"])

    # bounded by the sample: at most `rows` short lists of feature numbers
    table = sample.mapInArrow(run, "doc_id long, label int, at array<int>").toArrow()
    order = np.argsort(table["doc_id"].to_numpy(), kind="stable")
    lists = [np.array(x, np.int64) for x in table["at"].to_pylist()]
    lists = [lists[i] for i in order]
    grade = table["label"].to_numpy()[order].astype(np.int64)
    if grade.max() == 1:
        value = np.array([odds[n] for n in names]).clip(0)
        evidence = np.array([value[x].sum() for x in lists])
        cuts = np.quantile(evidence[grade > 0], [1 / GRADES * i for i in range(1, GRADES)])
        grade = np.where(grade > 0, 1 + np.searchsorted(cuts, evidence, "left"), 0)
    # grades without any document would leave a threshold undefined
    grade = np.unique(grade, return_inverse=True)[1]
    weights, thresholds = ordinal_fit(lists, grade, len(names))
    return Model(dict(zip(names, weights.tolist())), tuple(thresholds.tolist()))


def grade_of(chances: np.ndarray) -> int:
    """The highest grade whose chance reaches `TOXIC`."""
    return int((chances >= TOXIC).sum())


def score(df: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, expected severity, grade and toxic of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            chances = [model.at_least(t) for t in common.strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([float(c.sum()) for c in chances], pa.float64()),
                 pa.array([grade_of(c) for c in chances], pa.int32()),
                 pa.array([bool(len(c) and c[0] >= TOXIC) for c in chances], pa.bool_())],
                names=["doc_id", "severity", "grade", "toxic"])

    return common.texts(df, text=text, doc_id=doc_id).mapInArrow(
        run, "doc_id long, severity double, grade int, toxic boolean")


def keep(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows of ``df`` that are not toxic, with all their columns."""
    @F.pandas_udf("boolean")
    def toxic(values):
        import pandas as pd

        return pd.Series([bool(len(c) and c[0] >= TOXIC)
                          for c in (model.at_least(v or "") for v in values)], dtype=bool)

    return df.where(~toxic(F.col(text)))
