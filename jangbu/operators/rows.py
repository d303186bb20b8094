"""Row-level operators: filters, unions, order-based slices, keep-first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jangbu import rules
from jangbu.functions import keywords
from jangbu.operators.columns import common_columns
from jangbu.session import scratch_path, settle


def drop_zero(df: DataFrame, price: str = "price") -> DataFrame:
    """Rows whose price is not 0; a missing price stays."""
    return df.filter(~F.col(price).eqNullSafe(F.lit(0)))


def in_markets(df: DataFrame, markets=rules.NEAR_MARKETS, column: str = "market_name") -> DataFrame:
    return df.filter(F.col(column).isin(*markets))


def containing(df: DataFrame, column: str, word: str) -> DataFrame:
    return df.filter(F.col(column).contains(word))


def titles_including(df: DataFrame, column: str = "title", words=rules.TITLE_INCLUDE) -> DataFrame:
    return df.filter(keywords.has_any(F.col(column), words))


def titles_including_excluding(
    df: DataFrame,
    column: str = "title",
    include=rules.TITLE_INCLUDE,
    exclude=rules.TITLE_EXCLUDE,
) -> DataFrame:
    col = F.col(column)
    return df.filter(keywords.has_any(col, include)).filter(~keywords.has_any(col, exclude))


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def explode_groups(df: DataFrame, item: str = "item_name", groups=rules.ITEM_GROUPS, label: str = "item_group"):
    """One row per (row, item group whose word the item contains)."""
    return df.withColumn(label, F.explode(keywords.group_labels(F.col(item), groups)))


def union_by_position(*frames: DataFrame) -> DataFrame:
    """Union of frames whose schemas agree; anything else would mix columns silently."""
    first = [(f.name, f.dataType) for f in frames[0].schema.fields]
    for frame in frames[1:]:
        if [(f.name, f.dataType) for f in frame.schema.fields] != first:
            raise ValueError("union by position needs equal schemas; use union_common or union_outer")
    return reduce(DataFrame.union, frames)


def union_common(first: DataFrame, second: DataFrame) -> DataFrame:
    names = common_columns(first, second)
    return first.select(*names).unionByName(second.select(*names))


def union_outer(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ranked(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Largest measure first, for presentation."""
    return df.orderBy(F.col(measure).desc(), *ties)


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def global_row_number(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """1-based position in the total order, without passing the rows through one task.

    The rows are range-partitioned, sorted and written; position = rows in earlier files + index in the file.
    Order by enough columns to make equal neighbours interchangeable; they also spread a hot leading key.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ordered")
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", 0).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path).select(
        "*",
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint").alias("_file"),
        F.col("_metadata.row_index").alias("_index"),
    )
    # One row per written file, so bounded by the number of partitions; files are numbered in range order.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_file")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return stored.join(F.broadcast(offsets), "_file").select(
        *df.columns, (F.col("_offset") + F.col("_index") + 1).alias(name)
    )


#: Keys drawn to find borders, and keys that one task may sort.
_DRAWN, _SORTED = 20_000, 50_000


def _border(keys: DataFrame, at: int, size: int) -> tuple[Column, int, int]:
    """The key at a 1-based position of the order of `keys` (one column `key`, `size` rows), as a value of a query, how
    many rows are below it and how many equal it.

    Rows are counted, not moved: a sample gives two borders that enclose the position, counts below and at them tell the
    position inside, and so on until few keys are left, which are sorted. A border that is the wanted key ends the search.
    """
    key, below, seed = F.col("key"), 0, 0
    inside = keys
    while size > _SORTED:
        seed += 1
        drawn = settle(inside.sample(min(1.0, _DRAWN / size), seed), "drawn_keys")
        n = drawn.count()
        if not n:
            continue
        middle, spread = (at - 0.5) / size * n, 4 * ((at / size) * (1 - at / size) * n) ** 0.5 + 2
        ends = [drawn.orderBy("key").offset(int(min(n - 1, max(0, e)))).limit(1) for e in (middle - spread, middle + spread)]
        ends = [settle(e, "border_key") for e in ends]
        low, high = (e.scalar() for e in ends)
        counts = [F.count_if(c) for c in (key < low, key <= low, key < high, key <= high)]
        under, to_low, under_high, to_high = inside.agg(*counts).first()
        if at <= under:
            inside, size = inside.filter(key < low), under
        elif at <= to_low:
            return low, below + under, to_low - under
        elif at <= under_high:
            inside, size, at, below = inside.filter((key > low) & (key < high)), under_high - to_low, at - to_low, below + to_low
        elif at <= to_high:
            return high, below + under_high, to_high - under_high
        else:
            inside, size, at, below = inside.filter(key > high), size - to_high, at - to_high, below + to_high
    inside = settle(inside, "near_border")
    cut = settle(inside.orderBy("key").offset(at - 1).limit(1), "border_key").scalar()
    under, equal = inside.agg(F.count_if(key < cut), F.count_if(key == cut)).first()
    return cut, below + under, equal


def head_slice(df: DataFrame, n: int, order: list[str], size: int | None = None) -> DataFrame:
    """The first `n` rows of the total order, whatever the size of `n`; `size` is the number of rows where it is known.

    The key of the last row is found by counting and the rows are filtered where they stand: nothing is sorted or copied
    but keys near it. Columns not in `order` break ties, nulls come first; of equal rows as many stay as belong to the head.
    `df` must give the same rows each time it is read.
    """
    size = df.count() if size is None else size
    if n >= size:
        return df
    if n <= 0:
        return df.limit(0)
    names = [*order, *[c for c in df.columns if c not in order]]
    key = F.struct(*[F.col(f"`{c}`") for c in names])
    cut, below, equal = _border(df.select(key.alias("key")), n, size)
    if below + equal == n:
        return df.filter(key <= cut)
    # Equal rows on both sides of the border are alike in all columns: as many as are wanted are made from one.
    same = df.sparkSession.range(n - below).select(cut.alias("_row")).select(*[F.col("_row")[c].alias(c) for c in df.columns])
    return df.filter(key < cut).union(same)


def drop_tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """All but the last `n` rows of the total order."""
    size = df.count()
    return head_slice(df, size - n, order, size)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by `order`, ties broken by the other columns.

    A struct minimum is merged before the shuffle, so copies of a hot key never meet in one sort.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    unpacked = best.select(*keys, "_first.*") if order or rest else best.select(*keys)
    return unpacked.select(*df.columns)
