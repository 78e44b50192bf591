"""Chunking, embedding, retrieval and advisory text on tables."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import IDF, HashingTF, IDFModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast import config as C
from fieldcast.operators.blocks import blocks
from fieldcast.operators.ranking import dedup_first
from fieldcast.session import checkpoint


#: Scores that one slice of items may have in a task (8 MB).
PRODUCT_VALUES = 1_000_000
#: Bytes of text that are cut into chunks before the chunks are handed on.
PIECE_BYTES = 1 << 20


def _cut(text: str, sep: str) -> list[str]:
    """Pieces of ``text``; each separator stays at the head of the piece it opens."""
    starts = [m.start() for m in re.finditer(re.escape(sep), text)]
    edges = [0, *starts, len(text)]
    return [text[a:b] for a, b in zip(edges, edges[1:]) if b > a]


def _join(pieces: Sequence[str], size: int, overlap: int) -> Iterator[str]:
    """Pack pieces into chunks up to ``size``; the tail up to ``overlap`` is repeated."""
    held: deque[str] = deque()
    length = 0
    for piece in pieces:
        if held and length + len(piece) > size:
            yield "".join(held).strip()
            while held and (length > overlap or length + len(piece) > size):
                length -= len(held.popleft())
        held.append(piece)
        length += len(piece)
    yield "".join(held).strip()


def split_text(text: str, size: int = C.CHUNK_SIZE, overlap: int = C.CHUNK_OVERLAP,
               separators: Sequence[str] = C.CHUNK_SEPARATORS) -> list[str]:
    """Chunks of one text: coarse separators first, finer ones for long pieces only."""
    sep = next((s for s in separators if s in text), separators[-1])
    finer = separators[separators.index(sep) + 1:]
    chunks: list[str] = []
    short: list[str] = []

    def flush():
        chunks.extend(c for c in _join(short, size, overlap) if c)
        short.clear()

    for piece in _cut(text, sep):
        if len(piece) < size:
            short.append(piece)
        else:
            flush()
            chunks.extend(split_text(piece, size, overlap, finer) if finer else [piece])
    flush()
    return chunks


def chunk_documents(docs: DataFrame, text: str = "text", size: int = C.CHUNK_SIZE,
                    overlap: int = C.CHUNK_OVERLAP,
                    separators: Sequence[str] = C.CHUNK_SEPARATORS) -> DataFrame:
    """One row per chunk with its position; all other columns are kept."""
    seps = tuple(separators)
    keep = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for low, high in _pieces(texts):
                rows, positions, found = [], [], []
                for i in range(low, high):
                    parts = split_text(texts[i].as_py() or "", size, overlap, seps)
                    rows += [i] * len(parts)
                    positions += range(len(parts))
                    found += parts
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(at) for c in batch.columns[:-1]), pa.array(positions, pa.int32()),
                     pa.array(found, pa.string())], names=[*keep, "position", "page_content"])

    narrow = docs.select(*keep, text)
    schema = T.StructType([*narrow.schema.fields[:-1], T.StructField("position", T.IntegerType()),
                           T.StructField("page_content", T.StringType())])
    return narrow.mapInArrow(run, schema)


def _pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text, one row at least."""
    low, held = 0, 0
    for i, length in enumerate(pc.binary_length(texts).to_pylist()):
        held += length or 0
        if held >= most:
            yield low, i + 1
            low, held = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def tokens(text: str | Column) -> Column:
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    return F.filter(F.split(lowered, r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _term_counts(df: DataFrame, text: str, features: int) -> DataFrame:
    tf = HashingTF(numFeatures=features, inputCol="_tokens", outputCol="_tf")
    return tf.transform(df.withColumn("_tokens", tokens(text)))


def fit_weights(df: DataFrame, text: str = "page_content", features: int = 512) -> IDFModel:
    """Term weights of a corpus, to embed it and its queries alike."""
    return IDF(inputCol="_tf", outputCol="_idf").fit(
        _term_counts(df.select(text), text, features).select("_tf"))


def embed(df: DataFrame, text: str = "page_content", out: str = "embedding",
          model: Callable[[pd.Series], pd.Series] | None = None, features: int = 512,
          weights: IDFModel | None = None) -> DataFrame:
    """Unit vectors as ``array<double>``.

    Default is hashed TF-IDF (``weights`` from :func:`fit_weights`, else learned from
    ``df``); ``model`` may be any function from a batch of texts to a series of float lists.
    """
    if model is not None:
        return df.withColumn(out, F.pandas_udf(model, "array<double>")(F.col(text)))
    if weights is None:
        weights = fit_weights(df, text, features)
    counted = weights.transform(_term_counts(df, text, weights.idf.size))
    unit = Normalizer(inputCol="_idf", outputCol="_unit").transform(counted)
    return unit.withColumn(out, vector_to_array("_unit")).drop(
        "_tokens", "_tf", "_idf", "_unit")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in column.chunks]
    return (flat[0] if len(flat) == 1 else np.concatenate(flat)).reshape(-1, width)


def similarity_topk(queries: DataFrame, items: DataFrame, k: int = 1,
                    query_id: str = "query_id", item_id: str = "item_id",
                    vector: str = "embedding", block_values: int = 8_000_000) -> DataFrame:
    """Best k items per query row by dot product; ties go to the smaller item id.

    Items are dealt into shards and queries into blocks of about ``block_values`` numbers, and
    every block meets every shard by equality on (shard, block), so a task holds one of each and
    keeps a running best k while it multiplies slices.  The driver sees two sums only.  Rows are
    dealt by their place in the pinned tables, so one id with very many rows is spread as well.

    Vectors that are NULL, empty, or hold a NULL or NaN take no part, nor do items without an
    id; only vectors of one length meet.  Repeated query rows get k items each.
    """
    def narrow(rows: DataFrame, name: str, out: str) -> DataFrame:
        whole = (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x))
        kept = rows.filter(whole).select(
            F.col(name).alias(out), F.col(vector).cast("array<double>").alias("vector"))
        return checkpoint(kept).withColumns({
            "size": F.size("vector"), "row": F.monotonically_increasing_id()})

    def parts(rows: DataFrame) -> int:
        return max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // block_values))

    asked = narrow(queries, query_id, "query")
    held = narrow(items.filter(F.col(item_id).isNotNull()), item_id, "item")
    blocks, shards = parts(asked), parts(held)
    own = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["size", "shard", "block"]
    left = asked.select("*", own(blocks).alias("block"), every(shards).alias("shard"))
    right = held.select("item", "vector", "size", own(shards).alias("shard"),
                        every(blocks).alias("block"))

    def best(mine: pa.Table, others: pa.Table) -> pa.Table:
        score, at = np.empty((mine.num_rows, 0)), np.empty((mine.num_rows, 0), np.int64)
        if mine.num_rows and others.num_rows:
            width = mine.column("size")[0].as_py()
            first = pc.sort_indices(others.column("item")).to_numpy()  # ties: smaller id first
            matrix, rest = (_matrix(t.column("vector"), width) for t in (mine, others))
            step = max(1, PRODUCT_VALUES // mine.num_rows)
            for low in range(0, len(rest), step):
                here = first[low:low + step].astype(np.int64)
                new = matrix @ rest[here].T
                score = np.hstack([score, new])
                at = np.hstack([at, np.broadcast_to(here, new.shape)])
                order = np.argsort(-score, axis=1, kind="stable")[:, :k]
                score, at = (np.take_along_axis(x, order, 1) for x in (score, at))
        asks = pa.array(np.repeat(np.arange(mine.num_rows), at.shape[1]), pa.int64())
        return pa.table({
            "row": mine.column("row").take(asks), "query": mine.column("query").take(asks),
            "item": others.column("item").take(pa.array(at.ravel(), pa.int64())),
            "score": pa.array(score.ravel(), pa.float64())})

    schema = (f"row long, query {asked.schema['query'].dataType.simpleString()}, "
              f"item {held.schema['item'].dataType.simpleString()}, score double")
    found = left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(best, schema)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "item")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        F.col("query").alias(query_id), F.col("item").alias(item_id), "score", "rank")


def _name_finder(names: Sequence[str]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """Function from texts to the lists of names they contain; holds one text at a time."""
    lowered: dict[str, list[str]] = {}
    for n in names:
        lowered.setdefault(n.lower(), []).append(n)

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = ahocorasick.Automaton()  # once per task
        for key in lowered:
            machine.add_word(key, key)
        machine.make_automaton()
        for texts in batches:
            yield pa.array([[n for key in {k for _, k in machine.iter((t.as_py() or "").lower())}
                             for n in lowered[key]] for t in texts], pa.list_(pa.string()))

    return find


def keyword_topk(queries: DataFrame, chunks: DataFrame, k: int = 2, name: str = "crop_name",
                 text: str = "page_content", order: Sequence[str] = ("source", "position")
                 ) -> DataFrame:
    """First k chunks that contain each name, case-insensitively.

    The names are counted and cut into blocks; a block is sent to the tasks, which find
    all its names in one pass over each text, so only actual matches become rows.
    """
    keep = chunks.columns
    found = []
    for part in blocks(queries.select(name).distinct().filter(F.length(name) > 0), name):
        names = [r[0] for r in part.collect()]  # at most one block
        if not names:
            continue
        matches = F.arrow_udf(_name_finder(names), "array<string>",
                              F.ArrowUDFType.SCALAR_ITER)
        found.append(chunks.select(F.explode(matches(text)).alias(name), *keep))
    if not found:
        found = [chunks.select(F.lit("").alias(name), *keep).limit(0)]
    ranked = reduce(DataFrame.unionByName, found).withColumn(
        "rank", F.row_number().over(Window.partitionBy(name).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def clean_chunks(df: DataFrame, text: str = "page_content",
                 order: Sequence[str] = ("source", "position")) -> DataFrame:
    """Drop repeated texts (first in ``order`` stays) and turn headings into bold."""
    trimmed = df.withColumn(text, F.trim(text)).withColumn("_key", F.sha2(text, 256))
    unique = dedup_first(trimmed, ["_key"], list(order)).drop("_key")
    return unique.withColumn(text, F.regexp_replace(
        text, r"(?m)^#+[ \t]*(.*?)[ \t]*$", "**$1**"))


def retrieval_query(crop: str = "crop_name", temp: str = "temperature", rain: str = "rainfall",
                    ph: str = "ph") -> Column:
    """Search text from crop and condition tags."""
    t, r, p = F.col(temp), F.col(rain), F.col(ph)
    return F.concat_ws(
        " ", crop, F.lit("cultivation"),
        F.when(t > 30, "high temperature heat stress tolerance")
        .when(t < 18, "cool temperature frost sensitivity")
        .otherwise("optimal temperature growth"),
        F.when(r < 400, "drought water stress low rainfall")
        .when(r > 1200, "heavy rainfall drainage excess moisture")
        .otherwise("irrigation rainfall schedule"),
        F.when(p < 6.2, "acidic soil amendment")
        .when(p > 7.5, "alkaline saline soil management")
        .otherwise("neutral soil NPK fertility"),
        F.lit("fertilizer pest disease"))


def advisory(df: DataFrame) -> DataFrame:
    """Four rule-based diagnostics per row: class, deviation and action text.

    Input: crop_name, temperature, rainfall, humidity, ph and the ideal_* columns,
    n_req, p_req, k_req, avg_yield_kg_ha.
    """
    dev = {n: F.col(c) - F.col(f"ideal_{i}") for n, c, i in (
        ("temp", "temperature", "temp"), ("ph", "ph", "ph"),
        ("humidity", "humidity", "humidity"), ("rain", "rainfall", "rain"))}
    out = df.withColumns({f"{n}_deviation": d for n, d in dev.items()})
    t, p, h, r = (F.col(f"{n}_deviation") for n in ("temp", "ph", "humidity", "rain"))
    classes = {
        "temp_class": F.when(F.abs(t) <= 2.5, "optimal").when(t > 2.5, "warmer")
        .otherwise("cooler"),
        "ph_class": F.when(F.abs(p) <= 0.5, "balanced").when(F.col("ph") < 6.0, "acidic")
        .otherwise("alkaline"),
        "humidity_class": F.when(h > 10, "disease risk").when(h < -15, "pest alert")
        .otherwise("low pressure"),
        "rain_class": F.when(r < -200, "deficit").when(r > 300, "surplus").otherwise("matched"),
    }

    def by_class(col: str, texts: dict[str, Column]) -> Column:
        expr = None
        for label, text in texts.items():
            test = F.col(col) == label
            expr = F.when(test, text) if expr is None else expr.when(test, text)
        return expr

    npk = F.format_string("N %.0f, P %.0f, K %.0f kg/ha", "n_req", "p_req", "k_req")
    actions = {
        "sowing_action": by_class("temp_class", {
            "optimal": F.lit("sow in the standard window"),
            "warmer": F.lit("sow heat-tolerant seed and mulch the seedbed"),
            "cooler": F.concat(F.lit("treat seed and hold irrigation until the soil reaches "),
                               F.format_string("%.1f C", "ideal_temp"))}),
        "nutrient_action": by_class("ph_class", {
            "balanced": F.concat(F.lit("apply baseline "), npk, F.format_string(
                ", expected yield %.0f kg/ha", "avg_yield_kg_ha")),
            "acidic": F.format_string("add lime and P %.0f kg/ha as single super phosphate",
                                      "p_req"),
            "alkaline": F.concat(F.lit("add gypsum and zinc sulphate with "), npk)}),
        "protection_action": by_class("humidity_class", {
            "disease risk": F.lit("spray against mildew, rust and blight"),
            "pest alert": F.lit("set pheromone traps against mites and borers"),
            "low pressure": F.lit("monitor sucking pests with sticky traps")}),
        "irrigation_action": by_class("rain_class", {
            "deficit": F.format_string("micro-irrigate to bridge %.0f mm", F.abs(r)),
            "surplus": F.format_string("open drainage for %.0f mm", r),
            "matched": F.lit("rainfed, two supplemental irrigations in dry spells")}),
    }
    return out.withColumns(classes).withColumns(actions)


def location_text(city: str = "city", district: str = "district", state: str = "state") -> Column:
    """Labelled place parts; a district named like its city is left out."""
    def part(label, col):
        return F.when(F.nullif(F.col(col), F.lit("")).isNotNull(),
                      F.concat(F.lit(label), F.col(col)))

    own_district = F.when(
        F.lower(district) != F.lower(F.coalesce(F.col(city), F.lit(""))),
        part("District: ", district))
    return F.concat_ws(", ", part("City: ", city), own_district, part("State: ", state))


def advisory_prompt(df: DataFrame, context: str = "context", out: str = "prompt") -> DataFrame:
    """Prompt text with place, conditions, crop baseline and retrieved context."""
    def line(template: str, *cols: str) -> Column:
        return F.format_string(template, *[F.col(c) for c in cols])

    return df.withColumn(out, F.concat_ws(
        "\n",
        F.lit("Write a data-driven farming advisory."),
        F.concat(F.lit("Location: "), location_text()),
        F.concat(F.lit("Season: "), F.col("season")),
        line("Conditions: temperature %.1f C, rain %.1f mm, humidity %.1f %%, pH %.1f",
             "temperature", "rainfall", "humidity", "ph"),
        F.concat(F.lit("Crop: "), F.col("crop_name"),
                 line(" (suitability %.2f %%)", "suitability_score")),
        line("Baseline: temperature %.1f C, rain %.1f mm, humidity %.1f %%, pH %.1f",
             "ideal_temp", "ideal_rain", "ideal_humidity", "ideal_ph"),
        line("Nutrients: N %.1f, P %.1f, K %.1f kg/ha", "n_req", "p_req", "k_req"),
        line("Expected yield: %.1f kg/ha", "avg_yield_kg_ha"),
        F.lit("Guidelines:"),
        F.coalesce(F.nullif(F.col(context), F.lit("")),
                   F.lit("Standard agronomic practices apply.")),
        F.lit("Sections: sowing window, nutrients, pests and diseases, irrigation.")))
