"""Zero prices: ratios, bands, imputation, removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jangbu import rules
from jangbu.operators.quantiles import approx_group_median, group_median
from jangbu.session import settle


def _ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("zero_ratio", F.coalesce(F.try_divide(F.col("zero_count") * 100.0, F.col("total_count")), F.lit(0.0)))


def zero_ratio(df: DataFrame, item: str = "item_name", price: str = "price") -> DataFrame:
    """Per item: rows with a price, rows with price 0, their ratio in percent (0 for items without zeros)."""
    return _ratio(
        df.na.drop(subset=[item])
        .groupBy(item)
        .agg(F.count(price).alias("total_count"), F.count_if(F.col(price) == 0).alias("zero_count"))
    )


def zero_ratio_inner(df: DataFrame, item: str = "item_name", price: str = "price") -> DataFrame:
    """The variant over all rows, listing only items that have a zero price."""
    return _ratio(
        df.na.drop(subset=[item])
        .groupBy(item)
        .agg(F.count(F.lit(1)).alias("total_count"), F.count_if(F.col(price) == 0).alias("zero_count"))
        .filter("zero_count > 0")
    )


def zero_band(ratios: DataFrame, limit: float = rules.ZERO_RATIO_LIMIT) -> DataFrame:
    """Label items `none`, `low` (0 < ratio <= limit) or `high`."""
    r = F.col("zero_ratio")
    return ratios.withColumn("band", F.when(r > limit, "high").when(r > 0, "low").otherwise("none"))


def low_zero_rows(df: DataFrame, bands: DataFrame, item: str = "item_name") -> DataFrame:
    """Rows of low-band items (`bands` settled)."""
    return df.join(bands.filter("band = 'low'").select(item), [item], "left_semi")


def drop_high_zero_items(df: DataFrame, bands: DataFrame, item: str = "item_name") -> DataFrame:
    """Rows of all but the high-band items (`bands` settled); rows without an item name stay."""
    return df.join(bands.filter("band = 'high'").select(item), [item], "left_anti")


def repair_zeros(
    df: DataFrame,
    item: str = "item_name",
    year: str = "year",
    price: str = "price",
    limit: float = rules.ZERO_RATIO_LIMIT,
    drop_high: bool = True,
) -> DataFrame:
    """Impute the zeros of low-band items by the (item, year) median and drop high-band items.

    The rows are evaluated and stored once, for ratios, medians and result. The ratios are one row an item, summed before
    any shuffle; only rows of low-band items are counted for the medians. These include the zeros and may be 0 themselves.
    Without a median (missing year) the zero stays.
    """
    df = settle(df, "facts")
    bands = settle(zero_band(zero_ratio(df, item, price), limit), "zero_bands")
    medians = settle(group_median(low_zero_rows(df, bands, item), [item, year], price, "_median").drop("n_values"), "medians")
    kept = drop_high_zero_items(df, bands, item) if drop_high else df
    joined = kept.join(medians, [item, year], "left")
    filled = F.when(F.col(price) == 0, F.coalesce(F.col("_median"), F.col(price))).otherwise(F.col(price))
    return joined.withColumn(price, filled).select(*df.columns)


def repair_zeros_monthly_approx(
    df: DataFrame,
    item: str = "item_name",
    month_key: str = "year_month",
    price: str = "price",
    limit: float = rules.ZERO_RATIO_LIMIT,
) -> DataFrame:
    """The variant with approximate (item, year-month) medians.

    Ratios are over all rows; a zero without a median becomes NULL; rows of high-band items and rows without
    an item name are dropped. The rows are evaluated and stored once.
    """
    df = settle(df, "facts")
    bands = settle(zero_band(zero_ratio_inner(df, item, price), limit), "zero_bands")
    low = low_zero_rows(df, bands, item)
    medians = approx_group_median(low, [item, month_key], price, name="_median")
    medians = settle(medians.drop("n_values"), "medians")
    kept = drop_high_zero_items(df.na.drop(subset=[item]), bands, item)
    joined = kept.join(medians, [item, month_key], "left")
    return joined.withColumn(price, F.when(F.col(price) == 0, F.col("_median")).otherwise(F.col(price))).select(*df.columns)
