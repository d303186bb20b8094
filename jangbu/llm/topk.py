"""Exact search of the highest inner products without random access: sorted lists, bounds, and an early stop.

Every block of vectors keeps one list per component, sorted by value. A query reads all lists from the end where its own
component makes the most of it, a stretch at a time. What a vector has shown so far, with the least and the most that the
unread part can add, bounds its score from below and above. Reading stops when few vectors can still reach the k-th
highest lower bound, and the scores of these are settled. Each query meets one block first: its k-th score there is a bar
for all other blocks, so that most of them hand on little. Spark merges the best of all blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jangbu.llm.vectors import against_all, against_one, best, first_places, long_table, scaled, vector_rows, widest
from jangbu.session import settle

SCALE = 1024
#: Shares of the lists at which bounds are compared.
STOPS = (1 / 4, 3 / 8, 1 / 2, 9 / 16, 5 / 8, 3 / 4, 7 / 8)
#: Reading also stops when as many vectors as this many times k are left.
FEW = 4
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def _sums(packed: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each row of packed bits the sum of the weights whose bits are set, by a table for each byte."""
    tables = _BITS @ np.pad(weights, (0, -len(weights) % 8)).reshape(-1, 8).T
    out = np.zeros(len(packed))
    for byte in range(packed.shape[1]):
        out += tables[packed[:, byte], byte]
    return out


class SortedLists:
    """A block of vectors (n x width, whole numbers) with one list per component, falling by value."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        n, width = vectors.shape
        order = np.argsort(-vectors, axis=0, kind="stable")
        #: Where each vector stands in each list.
        self.rank = np.empty((n, width), np.uint16 if n < 1 << 16 else np.int64)
        np.put_along_axis(self.rank, order, np.arange(n).astype(self.rank.dtype)[:, None], axis=0)
        self.order = np.ascontiguousarray(order.T)
        self.values = np.take_along_axis(vectors.T, self.order, axis=1).astype(np.float64)

    def top(self, query: np.ndarray, k: int, skip: int = -1, bar: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all vectors that may be among the k highest; `skip` is the query's own place, `bar` a score
        that k others are known to reach.

        Ties with the k-th stay in. Bounds are sums of doubles: whole numbers below 2^53 are exact, beyond it the slack covers
        their rounding. Scores themselves are sums of longs.
        """
        n = len(self.vectors)
        used = np.flatnonzero(query)
        alive = np.arange(n)
        alive = alive[alive != skip]
        if len(used) and len(alive) > FEW * k:
            weights = query.astype(np.float64)
            down = query < 0
            ends = self.values[:, [0, -1]] * weights[:, None]
            size = float(np.abs(ends).max(axis=1).sum())
            slack = 2 * size * 2.0**-50 * (len(used) + 2) if size >= 2.0**52 else 0.0
            worst = ends.min(axis=1)
            shown = np.zeros(n)
            at = 0
            for stop in STOPS:
                to = max(at + 1, int(n * stop))
                # The next stretch of each list, from the end that gains most.
                parts = [slice(n - to, n - at) if down[j] else slice(at, to) for j in used]
                places = np.concatenate([self.order[j, p] for j, p in zip(used, parts)])
                gains = np.concatenate([self.values[j, p] * weights[j] for j, p in zip(used, parts)])
                shown += np.bincount(places, gains, n)
                at = to
                next_ = np.where(down, self.values[:, n - 1 - at], self.values[:, at]) * weights
                rank = self.rank if len(alive) > n // 2 else self.rank[alive]
                unread = np.packbits((rank >= np.where(down, n - at, at).astype(rank.dtype)) ^ down, axis=1)
                unread = unread if rank is not self.rank else unread[alive]
                low, high = shown[alive] + _sums(unread, worst), shown[alive] + _sums(unread, next_)
                bar = max(bar, np.partition(low, len(low) - k)[len(low) - k])
                alive = alive[high >= bar - slack]
                if len(alive) <= FEW * k:
                    break
        scores = self.vectors[alive] @ query
        return alive, scores


def _searched(scale: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"query": [], "query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(rows):
            width = widest(queries["embedding"], rows["embedding"])
            lists = SortedLists(scaled(rows["embedding"], width, scale))
            ids, numbers = rows["vec_id"].to_numpy(), rows["row"].to_numpy()
            place = dict(zip(numbers.tolist(), range(len(numbers))))
            asked = scaled(queries["embedding"], width, scale)
            bars = queries["bar"].to_pylist()
            for query, number, own, bar in zip(asked, queries["row"].to_pylist(), queries["vec_id"].to_pylist(), bars):
                found, scores = lists.top(query, k, place.get(number, -1), -np.inf if bar is None else bar)
                if bar is not None:
                    found, scores = found[scores >= bar], scores[scores >= bar]
                first = first_places(scores, ids[found], k)
                out["query"].append(np.full(len(first), number))
                out["query_id"].append(np.full(len(first), own))
                out["vec_id"].append(ids[found[first]])
                out["score"].append(scores[first])
        return long_table(out)

    return work


_FOUND = "query long, query_id long, vec_id long, score long"


def search(df: DataFrame, every: int = 100, k: int = 10, scale: int = SCALE) -> DataFrame:
    """The k highest scores of each query: (query_id, rank from 1, vec_id, score), ties to the smaller vec_id.

    A component x counts as floor(scale * x); the score is the inner product, which must fit a long; of vectors of unlike
    lengths the shorter is filled up with zeros. Queries are the rows whose vec_id is divisible by `every`, candidates all
    rows but the query's own. Fewer candidates give fewer rows, an empty table none. Repeated rows are rows of their own:
    each is a candidate, and as a query has its own k rows. Rows without a vec_id, a vector or with a component that is
    null, not finite or beyond a long when scaled take no part. Other columns are ignored.
    """
    rows = vector_rows(df, scale)
    queries = rows.where(F.col("vec_id") % every == 0)
    work = _searched(scale, k)
    known = best(against_one(queries.withColumn("bar", F.lit(None).cast("long")), rows, work, _FOUND), ["query"], k)
    bars = known.groupBy(F.col("query").alias("row")).agg(F.min(F.when(F.col("rank") == k, F.col("score"))).alias("bar"))
    found = against_all(settle(queries.join(bars, "row", "left"), "bars"), rows, work, _FOUND)
    return best(found, ["query"], k).select("query_id", "rank", "vec_id", "score")
