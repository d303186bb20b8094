"""Product rows from stored shop pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jangbu import rules
from jangbu.functions.text import markup_text, price_from_text, product_id


def element(tag: str, css_class: str | None = None) -> str:
    """Pattern of an element with one group around its inside."""
    if css_class is None:
        return rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"
    return rf'(?s)<{tag}\b[^>]*\bclass="[^"]*\b{css_class}\b[^"]*"[^>]*>(.*?)</{tag}>'


TILE = element("a", rules.TILE_CLASS)
TILE_FIELDS = {
    "name": element("span", rules.TILE_NAME_CLASS),
    "price": element("em", rules.TILE_PRICE_CLASS),
}
ITEM = element("li", rules.ITEM_CLASS)
ITEM_FIELDS = {
    "title": element("[a-z0-9]+", rules.ITEM_TITLE_CLASS),
    "price": element("[a-z0-9]+", rules.ITEM_PRICE_CLASS),
    "unit_price": element("[a-z0-9]+", rules.ITEM_UNIT_PRICE_CLASS),
}
for _name, _pattern in ITEM_FIELDS.items():
    # The closing tag is not known in advance: the text ends at the next closing tag.
    ITEM_FIELDS[_name] = _pattern.replace("</[a-z0-9]+>", "</")
ITEM_HREF = rf'<a\b(?=[^>]*\bclass="[^"]*\b{rules.ITEM_LINK_CLASS}\b)[^>]*\bhref="([^"]*)"'


def _field(fragment: Column, pattern: str) -> Column:
    """Text of the first match, NULL where there is none."""
    return F.when(fragment.rlike(pattern), markup_text(F.regexp_extract(fragment, pattern, 1)))


def tiles(df: DataFrame, html: str = "html", tile: str = TILE, fields: dict[str, str] = TILE_FIELDS, keep=("page_id",)):
    """One row per product tile: position on the page and the fields; a missing field is NULL."""
    found = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(tile), 1)).alias("pos", "_tile"))
    return found.select(*keep, "pos", *[_field(F.col("_tile"), p).alias(n) for n, p in fields.items()])


def items(
    df: DataFrame,
    html: str = "html",
    item: str = ITEM,
    href: str = ITEM_HREF,
    fields: dict[str, str] = ITEM_FIELDS,
    keep=("page_id",),
) -> DataFrame:
    """One row per list item with its product id, taken from the link; items without link or a field are left out."""
    found = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(item), 1)).alias("pos", "_item"))
    return found.filter(F.col("_item").rlike(href)).select(
        *keep,
        "pos",
        product_id(F.regexp_extract("_item", href, 1)).alias("product_id"),
        *[_field(F.col("_item"), p).alias(n) for n, p in fields.items()],
    ).na.drop(subset=list(fields))


def listing(df: DataFrame) -> DataFrame:
    """Listing table (title, price, unit_price) of extracted items."""
    return df.select("title", price_from_text(F.col("price")).alias("price"), "unit_price")
