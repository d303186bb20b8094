"""Hard negatives: for each anchor and positive, the best scores of other labels within a window below the positive's.

The windows of one anchor overlap: each reaches from its own upper limit down. Their upper limits cut the scores into
disjoint slots, and every block of rows keeps its best k of each slot, which Spark merges. A window's result is then merged
from its own slot and those below it, so that one scan of all rows answers all windows of an anchor.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jangbu.llm.vectors import against_all, best, first_places, long_table, products, scaled, vector_rows, widest
from jangbu.session import settle

SCALE = 256
#: Anchors whose scores are held at a time.
_HELD = 256


def _of_blocks(scale: int, columns: tuple[str, ...], pick: Callable) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Work on a pair of blocks: `pick(anchor, its scores, rows, add)` for each anchor, rows as arrays."""

    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = {c: [] for c in columns}

        def add(*parts) -> None:
            size = next(len(p) for p in parts if isinstance(p, np.ndarray))
            for c, p in zip(columns, parts):
                out[c].append(p if isinstance(p, np.ndarray) else np.full(size, p))

        if len(anchors) and len(rows):
            width = widest(anchors["embedding"], rows["embedding"])
            vectors, asked = scaled(rows["embedding"], width, scale), scaled(anchors["embedding"], width, scale)
            held = {c: np.asarray(rows[c]) for c in ("row", "vec_id", "label")}
            plain = anchors.drop(["embedding"]).to_pylist()
            for at in range(0, len(plain), _HELD):
                for anchor, scores in zip(plain[at : at + _HELD], products(asked[at : at + _HELD], vectors)):
                    pick(anchor, scores, held, add)
        return long_table(out)

    return work


def _positives(k: int) -> Callable:
    def pick(anchor, scores, rows, add) -> None:
        own = np.flatnonzero((rows["label"] == anchor["label"]) & (rows["row"] != anchor["row"]))
        own = own[first_places(scores[own], rows["vec_id"][own], k)]
        add(anchor["row"], rows["vec_id"][own], scores[own])

    return pick


def _slots(k: int) -> Callable:
    def pick(anchor, scores, rows, add) -> None:
        limits = np.array(anchor["limits"], np.int64)  # falling
        near = np.flatnonzero((scores >= anchor["least"]) & (scores <= limits[0]) & (rows["label"] != anchor["label"]))
        slot = len(limits) - 1 - np.searchsorted(limits[::-1], scores[near])
        for s in np.unique(slot):
            own = near[slot == s]
            own = own[first_places(scores[own], rows["vec_id"][own], k)]
            add(anchor["row"], s, rows["vec_id"][own], scores[own])

    return pick


def _share(score: str, percent: int, up: bool = False) -> Column:
    """score * percent / 100, rounded down or up, in whole numbers and without a product that leaves the range of a long."""
    rest = f"pmod({score}, 100)"
    return F.expr(f"({score} - {rest}) div 100 * {percent} + ({rest} * {percent} + {99 if up else 0}) div 100")


def mine(
    df: DataFrame, every: int = 100, positives: int = 5, k: int = 10, low: int = 30, high: int = 90, scale: int = SCALE
) -> DataFrame:
    """(anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id is divisible by `every`; an anchor's positives are its best other rows of its label; a
    positive's negatives are the best k rows of other labels with low * positive_score <= 100 * negative_score <=
    high * positive_score. Scores are inner products of floor(scale * x) and must fit a long; higher ones come first, ties by
    the smaller vec_id; of vectors of unlike lengths the shorter is filled up with zeros. A negative positive_score has an
    empty window, an anchor without positives or negatives gives no rows, nor does an empty table. Repeated rows are rows of
    their own: each may be a positive or a negative, and each anchor row has its own results. Rows without a vec_id, a label,
    a vector or with a component that is null, not finite or beyond a long when scaled take no part. Other columns are ignored.
    """
    rows = vector_rows(df.where("label IS NOT NULL"), scale, "label")
    anchors = rows.where(F.col("vec_id") % every == 0)
    found = against_all(anchors, rows, _of_blocks(scale, ("row", "positive_id", "positive_score"), _positives(positives)),
                        "row long, positive_id long, positive_score long")
    # Scores below 0 have no window.
    kept = best(found, ["row"], positives, "positive_score", "positive_id").withColumnRenamed("rank", "of").where("positive_score >= 0")
    kept = kept.withColumn("upper", _share("positive_score", high)).withColumn("lower", _share("positive_score", low, up=True))
    kept = settle(kept, "positives")
    limits = F.sort_array(F.collect_set("upper"), asc=False).alias("limits")
    windows = kept.groupBy("row").agg(limits, F.min("lower").alias("least"))
    asked = settle(anchors.join(windows, "row"), "anchors")
    slots = against_all(asked, rows, _of_blocks(scale, ("row", "slot", "negative_id", "negative_score"), _slots(k)),
                        "row long, slot long, negative_id long, negative_score long")
    slots = best(slots, ["row", "slot"], k, "negative_score", "negative_id").drop("rank")
    # At most `positives` windows and as many slots of k an anchor meet here.
    own = kept.join(asked.select("row", F.col("vec_id").alias("anchor_id"), "limits"), "row")
    own = own.withColumn("from", F.array_position("limits", F.col("upper")) - 1)
    inside = own.join(slots, "row").where((F.col("slot") >= F.col("from")) & (F.col("negative_score") >= F.col("lower")))
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return best(inside, ["row", "of"], k, "negative_score", "negative_id").select(*columns)
