"""Text quality by boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu.llm import boosting
from jangbu.llm.spans import Texts, counts_within, small
from jangbu.session import settle

#: At most so many labelled rows are fitted to: those with the smallest hash of their key.
FIT_ROWS = 20_000
THRESHOLD = 0.3

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".!?",
    "comma": b",;:",
    "symbol": b"#*$%&|<>",
    "bracket": b"()[]{}/\\=_+~^@",
    "quote": b"'\"`-",
    "feed": b"\n",
}


def statistics(texts: Texts) -> np.ndarray:
    """A row of statistics for each text, all finite; every word and line counts."""
    data, n_bytes = texts.data, np.diff(texts.ends)
    (starts, stops), owner = texts.words, texts.word_text
    n_words, some_bytes = texts.n_words, np.maximum(n_bytes, 1)
    some_words = np.maximum(n_words, 1)
    per = lambda flags: np.bincount(owner, flags, texts.n) / some_words
    columns = [np.log1p(n_bytes), np.log1p(n_words)]
    shares = {}
    for name, kind in _KINDS.items():
        of = np.zeros(256, bool)
        of[list(kind)] = True
        shares[name] = of[data]
        columns.append(texts.sums(shares[name]) / some_bytes)
    columns.append(texts.sums(data >= 128) / some_bytes)
    columns.append(texts.sums((data < 32) & (data != 10)) / some_bytes)
    size = stops - starts
    columns += [per(size), np.sqrt(np.maximum(per(size.astype(float) ** 2) - per(size) ** 2, 0)), per(size <= 3), per(size >= 12)]
    for name in ("symbol", "digit", "upper"):
        seen = np.concatenate([[0], np.cumsum(shares[name])])
        columns.append(per(seen[stops] > seen[starts]))
    hashes = texts.hashes(texts.words)
    often, again = counts_within(owner, hashes)
    columns += [per(~again), per(often >= 5), np.log1p(_most(owner, often, texts.n)) - np.log1p(n_words)]
    grams, first = texts.grams(hashes, 3)
    columns.append(np.bincount(owner[first], counts_within(owner[first], grams)[1], texts.n) / some_words)
    line_starts, line_stops = texts.lines
    line_owner = np.searchsorted(texts.ends, line_starts, "right") - 1
    n_lines = np.maximum(np.bincount(line_owner, minlength=texts.n), 1)
    _, line_again = counts_within(line_owner, texts.hashes(texts.lines))
    columns += [
        np.bincount(line_owner, line_again, texts.n) / n_lines,
        np.bincount(line_owner, line_again * (line_stops - line_starts), texts.n) / some_bytes,
        np.bincount(line_owner, shares["stop"][line_stops - 1] if len(line_stops) else None, texts.n) / n_lines,
        n_words / n_lines,
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _most(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    np.maximum.at(out, owner, values)
    return out


def described(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of `docs`: key and its statistics as an array."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = statistics(Texts.of(batch.column(1)))
            lists = pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [key, "statistics"])

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("statistics", T.ArrayType(T.FloatType()))])
    return docs.select(key, text).mapInArrow(rows, schema)


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def learned(stats: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", fit_rows: int = FIT_ROWS) -> boosting.Forest:
    """Trees fitted to the labelled rows of `stats`: all of them, or `fit_rows` chosen by hash where there are more."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    sample = (
        stats.join(known, F.col(key) == F.col("_key"))
        .select("statistics", "_label", F.xxhash64("_key").alias("_order"))
        .orderBy("_order", "_label", "statistics")
        .limit(fit_rows)
        .toArrow()
    )
    values = np.array(sample.column("statistics").to_pylist(), np.float32)
    return boosting.fit(values.reshape(sample.num_rows, values.shape[-1] if sample.num_rows else 0), sample.column("_label").to_numpy())


def score(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    text: str = "text",
    key: str = "doc_id",
    held_out_of: int = 5,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per row of `docs`: key, held_out, score, predicted.

    Trees are learned from labels of keys whose crc32 modulo `held_out_of` is not 0; a score comes from the
    text alone. Labels that are null or neither 0 nor 1, and labels without a document, are left
    out; without any label all scores are 0.5. Null and empty texts are scored like others (their statistics are 0), repeated
    rows get equal scores, a null key is held out of nothing. Further columns are not looked at, an empty table gives no rows.
    """
    stats = settle(described(docs, text, key), "statistics")
    away = F.coalesce(fold(key, held_out_of) == 0, F.lit(False))
    forest = learned(stats.where(~away), labels, key=key, fit_rows=fit_rows)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(forest.scores(values), pa.float64())], [key, "held_out", "score"])

    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())]
    )
    found = stats.select(key, away.alias("held_out"), "statistics").mapInArrow(scored, schema)
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    text: str = "text",
    key: str = "doc_id",
    held_out_of: int = 5,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """The rows of `docs`, with all columns, whose score reaches the threshold.

    Each row is judged by its own text where it stands, so no text is moved and repeated keys do not matter; null texts
    count as empty, rows without a key are judged like others, repeated rows stay or go together. Columns may have any names, an
    empty table gives no rows; without any label all rows score 0.5.
    """
    labelled = docs.join(labels.select(F.col(key).alias("_labelled")).distinct(), F.col(key) == F.col("_labelled"), "left_semi")
    stats = settle(described(labelled, text, key), "labelled_statistics")
    away = F.coalesce(fold(key, held_out_of) == 0, F.lit(False))
    forest = learned(stats.where(~away), labels, key=key, fit_rows=fit_rows)
    place = docs.columns.index(text)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, place):
            yield batch.filter(pa.array(forest.scores(statistics(Texts.of(batch.column(place)))) >= threshold))

    return docs.mapInArrow(good, docs.schema)
