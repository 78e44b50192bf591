"""Quality rules whose thresholds follow the data of each language and source.

Every document is measured over its whole text.  Each (language, source) keeps a quantile
sketch per feature: counts of values in bins of geometric width (relative error `ERROR`).
Sketches of parts are merged by adding counts, so they combine on the map side, do not depend
on the order of rows, and those of a language or of all documents are sums of the smaller ones.
A group with fewer than `MIN_ROWS` documents is judged by its language's sketch, and that by the
sketch of all documents.

A document is rejected by the base rules (fewer than 50 words, or more than half of its words in
repeated three-word windows), or if a feature lies beyond its group's fence: the quartile plus
`SPREAD` quartile distances plus a slack per feature, so that a group without any spread does
not reject its first deviation.

Defined cases: null and empty texts have no words and fail the base rules; a null language or
source counts as the empty name; repeated rows count and are judged each; ties fall into one
bin; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.llm import common

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ERROR = 0.01
MIN_ROWS = 100
SPREAD = 3.0
BROADCAST_GROUPS = 100_000  # about 10 MB of limits
ZERO_BIN = -1_000_000  # bin of values not above zero
#: Feature: numerator, denominator, slack below (None: no lower fence), slack above.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words", None, 0.1),
    "word_length": ("word_chars", "n_words", 1.25, 1.25),
    "dup_line_share": ("n_dup_lines", "n_lines", None, 0.4),
    "repeat_share": ("n_repeat_words", "n_words", None, 0.4),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_BLANKS, _SYMBOLS = b" \t\n\r\v\f", b"#*$%&|<>"


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first included."""
    if len(words) < 4:
        return 0
    index = {word: at for at, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    pairs = ids[:-2] * len(index) + ids[1:-1]
    if len(index) >= 1_500_000:  # three ids would not fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    triples = pairs * len(index) + ids[2:]
    _, inverse, count = np.unique(triples, return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift:len(words) - 2 + shift] |= again
    return int(inside.sum())


def measure(text: str) -> tuple[int, ...]:
    """The values named in MEASURES; words are runs without ASCII white space."""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    blanks = len(raw) - len(raw.translate(None, _BLANKS))
    return (len(words), len(text) - blanks, len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines))


def measured(df: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
             source: str = "source") -> DataFrame:
    """doc_id, lang, source and the measures of every document."""
    names = ["doc_id", "lang", "source", *MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            rows = [measure(value) for value in common.strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3),
                 *(pa.array(c, pa.int64()) for c in zip(*rows))], names=names)

    keys = [F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"),
                                                                  (source, "source"))]
    return common.texts(df, *keys, text=text, doc_id=doc_id).mapInArrow(
        run, "doc_id long, lang string, source string, "
        + ", ".join(f"{m} long" for m in MEASURES))


def feature(name: str, at: str = "") -> Column:
    """Value of a feature; null without denominator. ``at``: prefix of the measure columns."""
    top, bottom = FEATURES[name][:2]
    low = F.col(f"{at}{bottom}")
    return F.when(low > 0, F.col(f"{at}{top}").cast("double") / low)


def bin_step() -> float:
    """Width of a bin in logarithms."""
    return float(np.log((1 + ERROR) / (1 - ERROR)))


def bin_of(value: Column) -> Column:
    """Sketch bin: geometric, so that a bin's middle is within ERROR of all its values."""
    step = bin_step()
    return F.when(value <= 0, F.lit(ZERO_BIN)).when(
        value > 0, F.ceil(F.log(value) / F.lit(step)).cast("int"))


def bin_value(number: Column) -> Column:
    """Middle of a bin."""
    gamma = (1 + ERROR) / (1 - ERROR)
    return F.when(number == ZERO_BIN, F.lit(0.0)).otherwise(
        F.pow(F.lit(gamma), number.cast("double")) * F.lit(2 / (gamma + 1)))


def sketch(df: DataFrame, at: str = "", lang: str = "lang", source: str = "source") -> DataFrame:
    """Mergeable sketches: lang, source, feature, bin, n."""
    cells = F.explode(F.array(*(F.struct(F.lit(n).alias("feature"),
                                         bin_of(feature(n, at)).alias("bin"))
                                for n in FEATURES))).alias("cell")
    return (df.select(F.col(lang).alias("lang"), F.col(source).alias("source"), cells)
            .select("lang", "source", "cell.feature", "cell.bin").where("bin is not null")
            .groupBy("lang", "source", "feature", "bin").agg(F.count("*").alias("n")))


def _quartiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """rows, q1 and q3 per group; a group has at most as many rows here as it has bins."""
    group = Window.partitionBy(*keys, "feature")
    placed = cells.select("*", F.sum("n").over(group.orderBy("bin")).alias("upto"),
                          F.sum("n").over(group).alias("rows"))
    def quartile(q: float) -> Column:
        return bin_value(F.min(F.when(F.col("upto") >= F.col("rows") * q, F.col("bin"))))

    return placed.groupBy(*keys, "feature").agg(
        F.max("rows").alias("rows"), quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))


def fences(cells: DataFrame, min_rows: int = MIN_ROWS, spread: float = SPREAD) -> DataFrame:
    """One row per language and source: ``<feature>_low`` and ``<feature>_high``."""
    merged = cells.groupBy("lang", "feature", "bin").agg(F.sum("n").alias("n"))
    whole = merged.groupBy("feature", "bin").agg(F.sum("n").alias("n"))
    own = _quartiles(cells, ["lang", "source"])
    lang = _quartiles(merged, ["lang"]).select(
        "lang", "feature", *(F.col(c).alias(f"{c}_lang") for c in ("rows", "q1", "q3")))
    base = _quartiles(whole, []).select(
        "feature", *(F.col(c).alias(f"{c}_all") for c in ("q1", "q3")))

    def chosen(name: str) -> Column:
        return (F.when(F.col("rows") >= min_rows, F.col(name))
                .when(F.col("rows_lang") >= min_rows, F.col(f"{name}_lang"))
                .otherwise(F.col(f"{name}_all")))

    q1, q3 = chosen("q1"), chosen("q3")
    reach = (q3 - q1) * F.lit(spread)
    picked = (own.join(lang, ["lang", "feature"]).join(base, "feature")
              .select("lang", "source", "feature", (q1 - reach).alias("low"),
                      (q3 + reach).alias("high")))
    columns = []
    for name, (_, _, below, above) in FEATURES.items():
        here = F.col("feature") == name
        columns.append(F.max(F.when(here, F.col("high") + F.lit(above))).alias(f"{name}_high"))
        if below is not None:
            columns.append(F.max(F.when(here, F.col("low") - F.lit(below))).alias(f"{name}_low"))
    return picked.groupBy("lang", "source").agg(*columns)


def _beside_rows(limits: DataFrame) -> DataFrame:
    """Limits for a join to all rows: broadcast up to `BROADCAST_GROUPS` groups, counted first.

    Without the broadcast the texts would be shuffled by language and source, and a source with
    a third of all rows would meet in few tasks; beyond the bound adaptive execution splits it.
    """
    limits = common.pinned(limits)
    return F.broadcast(limits) if limits.count() <= BROADCAST_GROUPS else limits


def base_failed(at: str = "") -> Column:
    words, again = F.col(f"{at}n_words"), F.col(f"{at}n_repeat_words")
    return (words < MIN_WORDS) | (again * 100 > words * MAX_REPEAT_PERCENT)


def within(at: str = "") -> Column:
    """No feature beyond its fence; a missing feature or fence does not reject."""
    tests = []
    for name, (_, _, below, _) in FEATURES.items():
        tests.append(F.coalesce(feature(name, at) <= F.col(f"{name}_high"), F.lit(True)))
        if below is not None:
            tests.append(F.coalesce(feature(name, at) >= F.col(f"{name}_low"), F.lit(True)))
    return reduce(lambda a, b: a & b, tests)


def judge(df: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
          source: str = "source", min_rows: int = MIN_ROWS, spread: float = SPREAD) -> DataFrame:
    """doc_id, measures, base_failed and kept for every document.

    The measures are written to the checkpoint folder once and read for sketches and verdicts.
    """
    rows = common.pinned(measured(df, text, doc_id, lang, source))
    limits = _beside_rows(fences(sketch(rows), min_rows, spread))
    return (rows.join(limits, ["lang", "source"], "left")
            .select("doc_id", *MEASURES[:5], base_failed().alias("base_failed"),
                    (~base_failed() & within()).alias("kept"), "n_lines"))


def keep(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
         min_rows: int = MIN_ROWS, spread: float = SPREAD) -> DataFrame:
    """Rows of ``df`` that pass, with all their columns and no others.

    The measures ride beside the row, so neither ids nor other columns need to be unique; they
    are taken twice (for the sketches and for the verdicts) instead of writing texts again.
    """
    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def measures(values):
        import pandas as pd

        return pd.DataFrame([measure(v or "") for v in values], columns=list(MEASURES))

    name = common.own_name(df, "measures")
    key_lang, key_source = common.own_name(df, "key_lang"), common.own_name(df, "key_source")
    rows = (df.withColumn(name, measures(F.col(text)))
            .withColumn(key_lang, F.coalesce(F.col(lang), F.lit("")))
            .withColumn(key_source, F.coalesce(F.col(source), F.lit(""))))
    limits = _beside_rows(fences(sketch(rows, f"{name}.", key_lang, key_source), min_rows, spread))
    limits = (limits.withColumnRenamed("lang", f"{key_lang}_limit")
              .withColumnRenamed("source", f"{key_source}_limit"))
    same = ((F.col(key_lang) == F.col(f"{key_lang}_limit"))
            & (F.col(key_source) == F.col(f"{key_source}_limit")))
    passed = ~base_failed(f"{name}.") & within(f"{name}.")
    return rows.join(limits, same, "left").where(passed).select(*(df[c] for c in df.columns))
