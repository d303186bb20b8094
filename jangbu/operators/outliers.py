"""Outlier removal by interquartile fences per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jangbu import rules
from jangbu.operators.quantiles import approx_group_quartiles, frequencies, group_quartiles
from jangbu.session import settle


def fences(quartiles: DataFrame, factor: float = rules.FENCE_FACTOR) -> DataFrame:
    """Replace `q1`, `q3` by the inclusive bounds `lower`, `upper`."""
    reach = (F.col("q3") - F.col("q1")) * factor
    return quartiles.withColumns({"lower": F.col("q1") - reach, "upper": F.col("q3") + reach}).drop("q1", "q3")


def exact_fences(df: DataFrame, keys: list[str], price: str = "price", weight: str | None = None) -> DataFrame:
    return settle(fences(group_quartiles(df, keys, price, weight)), "fences")


def approx_fences(df: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    return settle(fences(approx_group_quartiles(df, keys, price, rules.QUARTILE_ERROR)), "fences")


def within(price: str = "price"):
    return F.col(price).between(F.col("lower"), F.col("upper"))


def apply_fences(df: DataFrame, bounds: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    joined = df.join(bounds.drop("n_values"), keys)
    return joined.filter(within(price)).select(*df.columns)


def remove_outliers(df: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    """Keep rows inside the exact fences of their group; a missing key or price is dropped."""
    return apply_fences(df, exact_fences(df, keys, price), keys, price)


def remove_outliers_approx(df: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    return apply_fences(df, approx_fences(df, keys, price), keys, price)


def removed_counts(df: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    """Per group: rows, rows outside the fences (a missing price counts as outside).

    Everything comes from the (keys, price) counts, made in one pass over the rows.
    """
    counts = settle(frequencies(df.na.drop(subset=keys), keys, price), "price_counts")
    bounds = exact_fences(counts, keys, price, "n")
    inside = F.coalesce(within(price), F.lit(False))
    return (
        counts.join(bounds, keys, "left")
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_removed"),
        )
    )
