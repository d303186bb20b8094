"""What several corpus operators share: the word pattern, text defaults and row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jangbu.session import settle

#: A word: characters other than the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def present(text: Column | str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column | str) -> Column:
    """Number of words of the whole text as a long; 0 for null."""
    return F.regexp_count(present(text), F.lit(WORD)).cast("long")


def ranked(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """`df` with the 0-based position of each row in its group, in the order (group, *order).

    Rows are range-partitioned over the whole order, so a group that holds most rows spreads over many
    tasks; only one count per task and group is gathered. Rows equal in all order columns may
    swap places, so the order should name every column that matters.
    """
    keys = [F.col(group).asc_nulls_last(), *order]
    placed = settle(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "ranked",
    )
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(F.col(group).alias("_group"), "_part")
        .agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumnRenamed("_part", "_of")
    )
    return (
        placed.join(starts, (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
        .withColumn(name, F.col("_before") + F.col("_at") - F.col("_first"))
        .select(*df.columns, name)
    )
