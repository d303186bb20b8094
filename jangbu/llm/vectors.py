"""Scores of a set of query vectors against all vectors, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jangbu.session import settle

#: Rows of a block, of queries as of candidates: as many are copied on either side.
BLOCK = 8192
_LEAST, _MOST = -(2.0**63), 2.0**63


def usable(vector: Column, scale: int) -> Column:
    """Whether a vector is there and each component, scaled, is a number that fits a long."""

    def fits(x: Column) -> Column:
        scaled = x.cast("double") * float(scale)
        return x.isNotNull() & (scaled >= _LEAST) & (scaled < _MOST)  # a NaN is above all numbers

    return F.coalesce(F.forall(vector, fits), F.lit(False))


def vector_rows(df: DataFrame, scale: int, *more: str, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, embedding, *more) of the rows that take part, stored, with a number of their own.

    Rows without a key take no part, nor do those whose vector is null or holds a component that is null, not finite, or
    beyond a long when scaled.
    """
    rows = df.where(F.col(key).isNotNull() & usable(F.col(vector), scale))
    rows = rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("embedding"), *more)
    return settle(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def scaled(column: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component as doubles, one row a vector, filled up with zeros to `width`."""
    lists = column.combine_chunks()
    ends = lists.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width), np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(np.float64)
    out[np.arange(width) < sizes[:, None]] = np.floor(values * scale).astype(np.int64)
    return out


def widest(*columns: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.combine_chunks().offsets.to_numpy()).max(initial=0)) for c in columns), default=0)


def _block(salt: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(blocks)).cast("int")


def _blocks_of(df: DataFrame, block: int) -> int:
    return max(1, -(-df.count() // block))


def against_all(
    queries: DataFrame,
    rows: DataFrame,
    work: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    block: int = BLOCK,
) -> DataFrame:
    """`work` (block of queries, block of rows) for every pair of blocks.

    Rows are dealt to blocks by a hash of their number, so that no value of theirs makes a block large; a query is copied
    once a block of rows and a row once a block of queries, which with blocks of one size costs rows x queries / block.
    """
    i, j = _blocks_of(rows, block), _blocks_of(queries, block)
    dealt = rows.select(*[F.col(c).alias(c) for c in rows.columns], _block("rows", i).alias("_i"))
    dealt = dealt.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(j - 1))))
    asked = queries.withColumn("_j", _block("queries", j)).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(i - 1))))
    grid = ["_i", "_j"]
    return asked.groupBy(*grid).cogroup(dealt.groupBy(*grid)).applyInArrow(work, schema)


def against_one(
    queries: DataFrame,
    rows: DataFrame,
    work: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    block: int = BLOCK,
) -> DataFrame:
    """`work` of each query against a single one of the blocks, without a copy."""
    i = _blocks_of(rows, block)
    asked = queries.withColumn("_i", _block("queries", i))
    # Columns of their own: queries may be a selection of these rows.
    dealt = rows.select(*[F.col(c).alias(c) for c in rows.columns], _block("rows", i).alias("_i"))
    return asked.groupBy("_i").cogroup(dealt.groupBy("_i")).applyInArrow(work, schema)


def first_places(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    near = np.arange(len(scores))
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: in doubles where these are exact, else in longs."""
    most = np.abs(queries).max(initial=0) * float(np.abs(vectors).max(initial=0)) * max(1, vectors.shape[1])
    if most < 2.0**53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


def long_table(columns: dict[str, list[np.ndarray]]) -> pa.Table:
    return pa.table({c: np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64) for c, parts in columns.items()})


def best(df: DataFrame, keys: list[str], k: int, score: str = "score", row: str = "vec_id") -> DataFrame:
    """The k rows of highest score per key, ties to the smaller id, with their rank from 1."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(row))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
