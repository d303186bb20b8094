"""Data profiles: distinct values, missing values, descriptions, item and year coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu import rules
from jangbu.functions.measures import moments
from jangbu.operators.columns import quoted
from jangbu.operators.outliers import exact_fences, within
from jangbu.operators.quantiles import exact_quantiles, frequencies
from jangbu.session import settle

_SUMMARY_PROBS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def _melted(df: DataFrame, columns: list[str], dtype: str) -> DataFrame:
    """Rows (column, value), all values as `dtype`."""
    pairs = [F.struct(F.lit(c).alias("column"), quoted(c).cast(dtype).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def column_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every distinct value of every column with its row count, in one shuffle of counted values."""
    return frequencies(_melted(df, columns, "string"), ["column"], "value")


def distinct_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: number of distinct values, a missing value counting as one."""
    return column_values(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: number of missing values; one row is aggregated, then turned into lines."""
    counts = df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in df.columns])
    lines = [F.struct(F.lit(c).alias("column"), quoted(c).alias("n_null")) for c in df.columns]
    return counts.select(F.inline(F.array(*lines)))


def price_quality(df: DataFrame, price: str = "price") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(price).isNull()).alias("n_null"),
        F.count_if(F.col(price) == 0).alias("n_zero"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def category_counts(df: DataFrame, category: str = "category", other: str = rules.OTHER_CATEGORY) -> DataFrame:
    """Rows per category plus the lines `(classified)` and `(total)`."""
    named = F.col(category).isNotNull() & (F.col(category) != other)
    labels = F.array_compact(F.array(F.col(category), F.when(named, F.lit("(classified)")), F.lit("(total)")))
    return (
        df.groupBy(category)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode(labels).alias(category), "n")
        .groupBy(category)
        .agg(F.sum("n").alias("n_rows"))
    )


def value_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def _shifted_moments(df: DataFrame, keys: list[str], value: str, n: str, center: str) -> DataFrame:
    """count, mean, std, min and max per group from value counts, in one aggregate whose sums any tasks can merge.

    Distances from `center` are summed, a number within the group's range that is the same for all its rows. That bounds what
    squares of large values lose: the variance is at least the squared range divided by twice the count.
    """
    off = F.col(value) - F.col(center)
    squares = F.greatest(F.col("_squares") - F.col("_sum") * F.col("_sum") / F.col("count"), F.lit(0.0))
    return (
        df.groupBy(*keys)
        .agg(
            F.sum(n).alias("count"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.max(center).alias("_center"),
            F.sum(off * F.col(n)).alias("_sum"),
            F.sum(off * off * F.col(n)).alias("_squares"),
        )
        .withColumn("mean", F.col("_center") + F.col("_sum") / F.col("count"))
        .withColumn("std", F.sqrt(F.try_divide(squares, F.nullif(F.col("count") - 1, F.lit(0)))))
    )


_DESCRIBED = ["count", "mean", "std", "min", *_SUMMARY_PROBS, "max"]


def price_summary(df: DataFrame, category: str = "category", item: str = "item_name", price: str = "price") -> DataFrame:
    """Description of the price per category, before and after outlier removal by item.

    One pass over the rows gives (category, item, price) counts. With the fences of the items they become one row for each
    category and price, of which ranks and moments of both stages are computed; items are not looked at again.
    """
    keys, group = [category, item], [category, "stage"]
    counts = settle(frequencies(df.na.drop(subset=[*keys, price]), keys, price), "price_counts")
    bounds = exact_fences(counts, keys, price, "n")
    # The mean of the middles of the items' fences lies within the prices of a category, outliers or not.
    middle = (F.col("lower") + F.col("upper")) / 2
    finite = F.when(F.abs(middle) < float("inf"), middle)
    centers = bounds.groupBy(category).agg(F.coalesce(F.avg(finite), F.lit(0.0)).alias("_middle"))
    told = counts.join(bounds.join(centers, category), keys)
    both = F.sum("n").alias("_before"), F.sum(F.when(within(price), F.col("n"))).alias("_after"), F.max("_middle").alias("_middle")
    merged = settle(told.groupBy(category, price).agg(*both), "category_counts")
    stages = [F.struct(F.lit(stage).alias("stage"), F.col(f"_{stage}").alias("n")) for stage in ("before", "after")]
    staged = merged.select(category, price, "_middle", F.inline(F.array(*stages))).filter("n IS NOT NULL")
    quantiles = exact_quantiles(staged, group, price, _SUMMARY_PROBS, "n").drop("n_values")
    return _shifted_moments(staged, group, price, "n", "_middle").join(quantiles, group).select(*group, *_DESCRIBED)


def describe_all(df: DataFrame, columns: list[str]) -> DataFrame:
    """One line per column: count; unique, top, freq for text; mean to max for numbers.

    Of equally frequent texts the smallest is the top.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in columns if isinstance(types[c], T.NumericType)]
    texts = [c for c in columns if c not in numeric]
    parts = []
    if texts:
        best = F.min(F.struct((-F.col("n")).alias("m"), "value"))
        parts.append(
            column_values(df, texts)
            .na.drop(subset=["value"])
            .groupBy("column")
            .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("_best"))
            .select("column", "count", "unique", F.col("_best.value").alias("top"), (-F.col("_best.m")).alias("freq"))
        )
    if numeric:
        cells = _melted(df, numeric, "double").na.drop(subset=["value"])
        whole = cells.groupBy("column").agg(*moments("value"), F.min("value").alias("min"), F.max("value").alias("max"))
        quantiles = exact_quantiles(cells, ["column"], "value", _SUMMARY_PROBS).drop("n_values")
        parts.append(whole.join(quantiles, "column").select("column", *_DESCRIBED))
    result = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return result


def year_coverage(df: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """Sorted years in which a key occurs; at most one entry per year is held."""
    return (
        df.select(*keys, year)
        .na.drop(subset=keys)
        .distinct()
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set(year)).alias("years"))
    )


def keys_in_all_years(df: DataFrame, key: str, year: str = "year", years: list[int] | None = None) -> DataFrame:
    """Keys that occur in every wanted year; without `years`, in every year of the table."""
    pairs = df.select(key, year).na.drop()
    if years is None:
        wanted = pairs.agg(F.count_distinct(year)).scalar()
    else:
        pairs, wanted = pairs.filter(F.col(year).isin(*years)), F.lit(len(set(years)))
    return pairs.groupBy(key).agg(F.count_distinct(year).alias("n_years")).filter(F.col("n_years") == wanted)


def items_by_category(df: DataFrame, category: str = "category", item: str = "item_name") -> DataFrame:
    """The item names of each category, one per row."""
    return df.select(category, item).na.drop().distinct()


def item_profile(
    df: DataFrame,
    category: str = "category",
    item: str = "item_name",
    price: str = "price",
    unit: str = "sales_unit",
    remark: str = "remark",
) -> DataFrame:
    """Per item: mean price, row count, most frequent unit and remark (smallest on a tie, `nan` if none).

    Rows are counted per value before the shuffle, and the mode is a struct minimum, so no group is collected.
    """
    keys = [category, item]
    spread = F.inline(
        F.array(
            F.struct(F.lit("unit").alias("kind"), F.col(unit).alias("value")),
            F.struct(F.lit("remark").alias("kind"), F.col(remark).alias("value")),
        )
    )
    counted = (
        df.na.drop(subset=keys)
        .select(*keys, price, spread)
        .groupBy(*keys, "kind", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(price).alias("total"), F.count(price).alias("n_price"))
    )

    def mode(kind: str):
        chosen = (F.col("kind") == kind) & F.col("value").isNotNull()
        best = F.min(F.when(chosen, F.struct((-F.col("n")).alias("m"), "value")))
        return F.coalesce(best["value"], F.lit("nan"))

    def of_unit(column: str):
        return F.sum(F.when(F.col("kind") == "unit", F.col(column)))

    return counted.groupBy(*keys).agg(
        mode("unit").alias(unit),
        mode("remark").alias(remark),
        F.try_divide(of_unit("total"), of_unit("n_price")).alias("mean_price"),
        of_unit("n").alias("n_rows"),
    )
