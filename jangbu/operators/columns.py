"""Column-level operators: rename, drop, trim, type alignment, text repair, derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu import rules, schema
from jangbu.functions import keywords, text


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that are present; absent ones are ignored."""
    return df.withColumnsRenamed(mapping)


def drop_columns_like(df: DataFrame, fragment: str = rules.JUNK_HEADER_TEXT) -> DataFrame:
    return df.drop(*[c for c in df.columns if fragment in c])


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def quoted(name: str):
    """Column reference for names with dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def _converted(col, source: T.DataType, target: T.DataType):
    if isinstance(source, T.StringType) and isinstance(target, T.NumericType):
        return text.number(col, target.simpleString())
    return col.try_cast(target)


def align_types(df: DataFrame, target: T.StructType) -> DataFrame:
    """Give shared columns the target's types; values that do not convert become NULL."""
    wanted = {f.name: f.dataType for f in target.fields}

    def aligned(field: T.StructField):
        col = quoted(field.name)
        if field.name in wanted and wanted[field.name] != field.dataType:
            col = _converted(col, field.dataType, wanted[field.name])
        return col.alias(field.name)

    return df.select(*[aligned(f) for f in df.schema.fields])


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Names in both, in the order of `left`."""
    shared = set(right.columns)
    return [c for c in left.columns if c in shared]


def to_number(df: DataFrame, column: str, target: T.DataType = T.DoubleType()) -> DataFrame:
    """Numeric column; what is not a number becomes NULL."""
    return df.withColumn(column, _converted(quoted(column), df.schema[column].dataType, target))


def _each_string(df: DataFrame, change) -> DataFrame:
    """Apply `change` to every string column in one projection."""
    return df.select(
        *[
            (change(quoted(f.name)) if isinstance(f.dataType, T.StringType) else quoted(f.name)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def repair_text(df: DataFrame, marker: str = rules.CELL_TAIL_MARKER) -> DataFrame:
    return _each_string(df, lambda c: text.cut_at(c, marker))


def null_tokens(df: DataFrame, tokens=rules.NULL_TOKENS) -> DataFrame:
    return _each_string(df, lambda c: text.null_tokens(c, tokens))


def empty_for_null(df: DataFrame) -> DataFrame:
    return df.na.fill("")


def parse_year_month(df: DataFrame, column: str = "year_month") -> DataFrame:
    return df.withColumns({"year": text.year_of(F.col(column)), "month": text.month_of(F.col(column))})


def drop_unused(df: DataFrame) -> DataFrame:
    return df.drop(*schema.UNUSED)


def fix_units(
    df: DataFrame,
    fixes=rules.UNIT_FIXES,
    item: str = "item_name",
    price: str = "price",
    unit: str = "sales_unit",
) -> DataFrame:
    """Divide the price and replace the unit of exactly named items; a table without units keeps only prices."""
    changed = {c: F.col(c) for c in (price, unit) if c in df.columns}
    for name, divisor, written in fixes:
        hit = F.col(item) == name
        changed[price] = F.when(hit, F.col(price) / divisor).otherwise(changed[price])
        if unit in changed:
            changed[unit] = F.when(hit, F.lit(written)).otherwise(changed[unit])
    return df.withColumns(changed)


def assign_category(
    df: DataFrame,
    item: str = "item_name",
    label: str = "category",
    ordered_rules=rules.CATEGORY_RULES,
    other: str = rules.OTHER_CATEGORY,
) -> DataFrame:
    """Category of the item by the first matching rule.

    The shortened name is a column of its own, so that it is made once per row and not once per keyword.
    """
    named = df.withColumn("_base", text.base_name(F.col(item)))
    return named.withColumn(label, keywords.first_rule(F.col("_base"), ordered_rules, other)).drop("_base")


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """Presentation view: floating columns rounded half to even."""
    return df.select(
        *[
            (F.bround(quoted(f.name), digits) if isinstance(f.dataType, T.DoubleType) else quoted(f.name)).alias(f.name)
            for f in df.schema.fields
        ]
    )
