"""Exact and approximate group quantiles.

The built-in exact `percentile` keeps every distinct value of a group in one task. Here values are counted first and placed
in order over the tasks, whatever the groups: a hot group, or a narrow range with many values, spreads over
many of them. Sums per task and group tell where the wanted ranks lie, and only rows from there are ranked. There is one way for
all sizes and all doubles; NaN is above every number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jangbu.session import settle


def frequencies(df: DataFrame, keys: list[str], value: str, weight: str = "n") -> DataFrame:
    """Rows per (keys, value). Counted before the shuffle, and a hot key is spread over its values."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(weight))


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    weight: str | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation per group, one column per entry of `probs`, plus `n_values`.

    `weight` names the count column when `df` already holds frequencies; otherwise they are made first.
    Missing keys and values are left out.
    """
    present = df.na.drop(subset=[*keys]).filter(F.col(value).isNotNull())
    if weight is None:
        # Stored, so that choosing the range borders does not compute the rows a second time.
        present, weight = settle(frequencies(present, keys, value), "value_counts"), "n"
    counted = present.select(*keys, F.col(value).cast("double").alias("_v"), F.col(weight).alias("_n"))
    placed = settle(counted.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()), "placed_counts")

    # Ranks held by each part of a group: at most one row for each group and task.
    in_order = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    parts = (
        placed.groupBy(*keys, "_part")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_end", F.sum("_n").over(in_order))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    )
    position = {name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in probs.items()}
    wanted = {
        f"{name}/{side}": rank.cast("bigint")
        for name, pos in position.items()
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos)))
    }

    def holds(rank: Column) -> Column:
        return (rank < F.col("_end")) & (rank >= F.col("_end") - F.col("_n"))

    holds_any = reduce(Column.__or__, [holds(rank) for rank in wanted.values()], F.lit(False))
    chosen = parts.filter(holds_any).select(*keys, "_part", "_total", (F.col("_end") - F.col("_n")).alias("_start"))

    # Rank inside the chosen parts; none holds more than one task was given.
    by_value = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    slots = (
        placed.join(chosen, [*keys, "_part"])
        .withColumn("_end", F.col("_start") + F.sum("_n").over(by_value))
        .filter(holds_any)
        .groupBy(*keys)
        .agg(F.max("_total").alias("_total"), *[F.max(F.when(holds(rank), F.col("_v"))).alias(slot) for slot, rank in wanted.items()])
    )

    def interpolated(name: str) -> Column:
        lo, hi, pos = F.col(f"`{name}/lo`"), F.col(f"`{name}/hi`"), position[name]
        share = pos - F.floor(pos)
        # Between equal values, or on one, nothing is computed: infinities stay what they are.
        return F.when((lo == hi) | (share == 0), lo).otherwise(lo + (hi - lo) * share).alias(name)

    return slots.select(*keys, *[interpolated(name) for name in probs], F.col("_total").alias("n_values"))


def group_median(df: DataFrame, keys: list[str], value: str, name: str = "median", weight: str | None = None):
    return exact_quantiles(df, keys, value, {name: 0.5}, weight)


def group_quartiles(df: DataFrame, keys: list[str], value: str, weight: str | None = None):
    return exact_quantiles(df, keys, value, {"q1": 0.25, "q3": 0.75}, weight)


def approx_group_median(df: DataFrame, keys: list[str], value: str, accuracy: int = 10_000, name: str = "median"):
    """Mergeable sketch per group: the state is bounded by `accuracy`, not by the group."""
    sketch = F.percentile_approx(value, 0.5, accuracy)
    return df.na.drop(subset=keys).groupBy(*keys).agg(sketch.alias(name), F.count(value).alias("n_values"))


def approx_group_quartiles(df: DataFrame, keys: list[str], value: str, relative_error: float = 0.05):
    """All groups in one job; one sketch with error `relative_error` each."""
    sketch = F.percentile_approx(value, [0.25, 0.75], round(1 / relative_error))
    return (
        df.na.drop(subset=keys)
        .groupBy(*keys)
        .agg(sketch.alias("_q"), F.count(value).alias("n_values"))
        .select(*keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"), "n_values")
    )
