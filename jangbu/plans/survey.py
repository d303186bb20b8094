"""The survey jobs end to end: combine, clean, prepare, report."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu import rules, schema
from jangbu.operators import columns, outliers, quality, rows
from jangbu.operators.volatility import GROUP, LEVELS, MONTH, YEAR, volatility_levels
from jangbu.session import settle
from jangbu.sinks import tables as sinks
from jangbu.sources import tables, xml


def combine(survey: DataFrame, records: DataFrame) -> DataFrame:
    """API records and survey files (both canonical names) in one table; absent columns are NULL."""
    return rows.union_outer(records, columns.align_types(survey, records.schema))


def load_checked(
    spark: SparkSession,
    files: list[tables.CsvFile],
    api_pages: str | list[str] | None = None,
    date_prefix: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Landed survey files, plus landed API responses, under canonical names; and (file, record) of what does not parse.

    `date_prefix` keeps the API records of one period (the survey's own job takes 2024); by default all stay.
    """
    survey = tables.read_dialects(spark, files) if files else None
    if api_pages is None:
        return survey, spark.createDataFrame([], f"{xml.FILE} string, {xml.RECORD} string")
    good, bad = xml.split_rows(spark, api_pages)
    records = xml.api_rows(good, date_prefix)
    return records if survey is None else combine(survey, records), bad


def load(
    spark: SparkSession,
    files: list[tables.CsvFile],
    api_pages: str | list[str] | None = None,
    date_prefix: str | None = None,
    quarantine: str | None = None,
) -> DataFrame:
    """The rows of `load_checked`. Records that do not parse are added to the `quarantine` table, with their files.

    They are counted in a warning where no such table is named.
    """
    loaded, bad = load_checked(spark, files, api_pages, date_prefix)
    if quarantine is not None:
        bad.write.mode("append").parquet(quarantine)
    elif n := bad.count():
        warnings.warn(f"{n} API records did not parse and are left out; name a quarantine table to keep them", stacklevel=2)
    return loaded


def clean(raw: DataFrame) -> DataFrame:
    """Repair texts, drop rows without year-month or item, parse year, month and price.

    Only projections and filters: one stage without a shuffle.
    """
    schema.require_columns(raw, "item_name", "price", "year_month")
    df = columns.null_tokens(columns.repair_text(columns.drop_columns_like(raw)))
    df = columns.parse_year_month(df.na.drop(subset=["year_month"]))
    return columns.to_number(columns.drop_unused(df).na.drop(subset=["item_name"]), "price")


def prepare(
    cleaned: DataFrame,
    category_rules=rules.CATEGORY_RULES,
    other: str = rules.OTHER_CATEGORY,
) -> DataFrame:
    """Repair zero prices, drop high-zero items, assign categories."""
    return columns.assign_category(quality.repair_zeros(cleaned), ordered_rules=category_rules, other=other)


def store_categories(prepared: DataFrame, folder: str, slugs: dict[str, str] = rules.CATEGORY_SLUGS) -> None:
    """One CSV table per stored category, in a folder by its stored name, under the headers of the files.

    The files begin with a byte-order mark, as those of the survey do.
    """
    named = prepared.withColumn("stored_as", F.create_map(*[F.lit(x) for pair in slugs.items() for x in pair])[F.col("category")])
    tables_ = sinks.with_headers(named.filter(F.col("stored_as").isNotNull()), schema.CLEAN_HEADERS)
    sinks.write_by(tables_, "stored_as", folder, bom=True)


def load_categories(spark: SparkSession, folder: str) -> DataFrame:
    """The stored category tables in one, with canonical names and types; columns that were not stored are NULL."""
    return tables.read_csv(spark, folder, schema.CLEAN, schema.CLEAN_HEADERS)


def without_outliers(prepared: DataFrame) -> DataFrame:
    """Rows inside the fences of their item."""
    return outliers.remove_outliers(prepared, ["category", "item_name"])


def volatility_report(prepared: DataFrame, drop_outliers: bool = False, levels=LEVELS) -> DataFrame:
    """All district and category levels. The stored results of the survey keep the outliers."""
    return volatility_levels(without_outliers(prepared) if drop_outliers else prepared, levels)


def grouped_items(prepared: DataFrame, groups=rules.ITEM_GROUPS, fixes=rules.UNIT_FIXES, categories=rules.ITEM_GROUP_CATEGORIES):
    """Rows of the item groups with repaired units; other categories may name the same goods and stay out."""
    schema.require_columns(prepared, "category", "item_name", "price")
    return columns.fix_units(rows.explode_groups(prepared.filter(F.col("category").isin(*categories)), groups=groups), fixes)


def item_rows(
    prepared: DataFrame,
    groups=rules.ITEM_GROUPS,
    fixes=rules.UNIT_FIXES,
    approximate: bool = False,
    categories=rules.ITEM_GROUP_CATEGORIES,
):
    """Rows of the item groups with repaired units, inside the fences of their group."""
    grouped = grouped_items(prepared, groups, fixes, categories)
    remove = outliers.remove_outliers_approx if approximate else outliers.remove_outliers
    return remove(grouped, [GROUP])


def item_report(prepared: DataFrame, **options) -> DataFrame:
    """Yearly and monthly volatility of the item groups, one job for all groups."""
    levels = {"item_year": [GROUP, YEAR], "item_month": [GROUP, MONTH]}
    return volatility_levels(item_rows(prepared, **options), levels)


def stored(prepared: DataFrame) -> DataFrame:
    """Settle the prepared rows when several reports follow."""
    return settle(prepared, "prepared")
