"""Mean, standard deviation, count and coefficient of variation per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jangbu.functions.measures import cv, cv_or_zero, moments

DISTRICT, CATEGORY, GROUP, YEAR, MONTH = "district_name", "category", "item_group", "year", "month"

# The levels the reports use.
LEVELS = {
    "district": [DISTRICT],
    "district_year": [DISTRICT, YEAR],
    "district_month": [DISTRICT, MONTH],
    "category_year": [CATEGORY, YEAR],
    "category_month": [CATEGORY, MONTH],
    "category_district_year": [CATEGORY, DISTRICT, YEAR],
    "category_district_month": [CATEGORY, DISTRICT, MONTH],
}


def volatility(df: DataFrame, keys: list[str], price: str = "price", zero_cv: bool = False) -> DataFrame:
    """One row per group; rows with a missing key are left out, a missing price is not counted.

    `zero_cv` writes 0 instead of NULL where the mean is 0 or missing.
    """
    ratio = cv_or_zero if zero_cv else cv
    return (
        df.na.drop(subset=keys)
        .groupBy(*keys)
        .agg(*moments(price))
        .select(*keys, "mean", "std", "count", ratio(F.col("mean"), F.col("std")).alias("cv"))
    )


def volatility_levels(df: DataFrame, levels: dict[str, list[str]] = LEVELS, price: str = "price") -> DataFrame:
    """All levels from one pass over the rows: columns `level`, every key (NULL where unused), measures.

    Every task keeps count, mean and squared distance of each group of each level; one shuffle brings these states together,
    where they are merged pairwise. Rows are neither shuffled nor read again. Groups with a missing key are left out; groups
    without any price stay with count 0.
    """
    keys = list(dict.fromkeys(k for level in levels.values() for k in level))
    sets = {}
    for name, level in levels.items():
        sets.setdefault(frozenset(level), []).append(name)
    measured = df.select(*keys, price).groupingSets([[k for k in keys if k in s] for s in sets], *keys)
    # A bit for each key, the first one highest, set where a level leaves the key out.
    bits = {sum((k not in s) << (len(keys) - 1 - i) for i, k in enumerate(keys)): s for s in sets}
    names = [F.when((F.col("_set") == bit) & _present(s), F.array(*map(F.lit, sets[s]))) for bit, s in bits.items()]
    return (
        measured.agg(F.grouping_id().alias("_set"), *moments(price))
        .select(F.explode(F.coalesce(*names)).alias("level"), *keys, "mean", "std", "count")
        .withColumn("cv", cv(F.col("mean"), F.col("std")))
    )


def _present(level) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in sorted(level)], F.lit(True))
