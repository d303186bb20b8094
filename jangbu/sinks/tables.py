"""CSV sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


#: A quote inside a cell is written twice, as other programs do.
_WRITTEN = {"header": True, "quote": '"', "escape": '"'}


#: The byte-order mark, which some programs need to read UTF-8.
BOM = "\ufeff"


def _marked(df: DataFrame, bom: bool, *, but: str | None = None) -> DataFrame:
    """With `bom`, the mark before the first header: every part file begins with it, and readers take it off again."""
    first = next((c for c in df.columns if c != but), None) if bom else None
    return df if first is None else df.withColumnsRenamed({first: BOM + first})


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """A header and a file per task; with `bom` each file begins with a byte-order mark."""
    _marked(df, bom).write.mode("overwrite").options(**_WRITTEN).csv(path)


def write_single_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """One output file, written by one task: for small results only."""
    write_csv(df.coalesce(1), path, bom)


def write_by(df: DataFrame, column: str, path: str, bom: bool = False) -> None:
    """One directory per value of `column`; values without rows get none. With `bom` each file begins with the mark.

    The rebalance hint groups rows by value but splits a value that holds much of the data.
    """
    _marked(df, bom, but=column).hint("rebalance", column).write.mode("overwrite").options(**_WRITTEN).partitionBy(column).csv(path)


def write_volatility(yearly: DataFrame, monthly: DataFrame, base: str, column: str = "item_group") -> None:
    """Yearly and monthly results below `base`, each partitioned by item group."""
    for name, result in (("yearly", yearly), ("monthly", monthly)):
        write_by(result, column, f"{base}/{name}")


def not_available(df: DataFrame, text: str = "N/A") -> DataFrame:
    """Missing texts as the crawl writes them."""
    strings = [c for c, t in df.dtypes if t == "string"]
    return df.na.fill(text, strings) if strings else df


def with_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Canonical names back to file headers (`headers` maps header -> canonical)."""
    return df.withColumnsRenamed({v: k for k, v in headers.items()})
