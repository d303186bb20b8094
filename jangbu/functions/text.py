"""Column expressions that repair and parse survey and listing text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from jangbu import rules

# Characters Python's str.strip() removes that occur in text tables.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85   　"


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(WHITESPACE))


def cut_at(col: Column, marker: str = rules.CELL_TAIL_MARKER) -> Column:
    """The part before the first `marker`; the whole text where it is absent."""
    return F.substring_index(col, marker, 1)


def null_tokens(col: Column, tokens=rules.NULL_TOKENS) -> Column:
    return F.when(~col.isin(*tokens), col)


def base_name(col: Column) -> Column:
    """Item name without the parenthesis tail."""
    return strip(F.substring_index(col, "(", 1))


def number(col: Column, dtype: str = "double") -> Column:
    """Numeric value of a text, NULL where it is not a number.

    The cast alone would also take `nan` and the suffixes in `12d`, `12f`; their letters are spoiled first.
    """
    return F.translate(col, "dDfFnN", "xxxxxx").try_cast(dtype)


def year_of(year_month: Column) -> Column:
    return number(F.substring(year_month, 1, 4), "bigint")


def month_of(year_month: Column) -> Column:
    """Month number; 0 where it cannot be read, 3 for the mistyped `.3`."""
    written = F.replace(F.substring(year_month, 6, 2), F.lit(".3"), F.lit("3"))
    return F.coalesce(written.try_cast("decimal(10,2)").cast("int"), F.lit(0))


def price_from_text(col: Column) -> Column:
    """`3,980원` -> 3980."""
    return F.regexp_replace(col, "[원,]", "").try_cast("bigint")


def unit_price_parts(col: Column) -> Column:
    """`(100g당 2,633원)` -> struct(quantity 100, unit g, price 2633)."""
    pattern = r"\(?([0-9.]+)\s*(\D+?)당\s*([0-9,]+)원\)?"

    def part(i):
        return F.nullif(F.regexp_extract(col, pattern, i), F.lit(""))

    return F.when(
        col.rlike(pattern),
        F.struct(
            part(1).try_cast("double").alias("quantity"),
            part(2).alias("unit"),
            price_from_text(part(3)).alias("price"),
        ),
    )


def product_id(href: Column) -> Column:
    """Last piece after `/`, then the part before `?`. The order matters."""
    return F.substring_index(F.substring_index(href, "/", -1), "?", 1)


# The entities that occur in shop pages, `&amp;` last so that nothing is decoded twice.
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def markup_text(html: Column) -> Column:
    """Visible text of a markup fragment: tags removed, entities decoded, ends trimmed."""
    plain = F.regexp_replace(html, "<[^>]*>", "")
    return strip(reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), _ENTITIES, plain))
