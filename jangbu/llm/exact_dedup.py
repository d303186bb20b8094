"""Exact duplicates by content-defined chunk recipes, with DataFrame functions only.

A text is cut where its content says so (at a line or sentence end after a least length), each chunk is
replaced by an identifier, and texts are equal when their ordered identifier lists are equal. A chunk's
text moves at most once, and after that only identifier lists do, so long documents are not carried
through the grouping. An identifier is the chunk's 64-bit hash; all distinct chunks are grouped by their
text to verify that no two share a hash, and those that do get a number of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jangbu.llm.text import present
from jangbu.session import settle

#: A chunk ends at the first line or sentence end after 512 characters, or after 4096, or with the text.
CHUNK = r"(?s).{512,4096}?(?:[\n.!?\x{3002}]|\z)|.{1,4096}"


def chunks(text: Column | str) -> Column:
    """The chunks of a text in order; joined they are the text. The empty text has none."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, text: str = "text", key: str = "doc_id", hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Per row of `docs`: key, SHA-256 of the text, and the recipe: chunk hashes plus, where two
    different chunks share a hash, the numbers that tell them apart (else null)."""
    texts = docs.select(F.col(key).alias("key"), present(text).alias("text"))
    listed = settle(
        texts.select(
            "key",
            F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
            F.transform(chunks("text"), lambda c: hashed(c)).alias("recipe"),
        ),
        "recipes",
    )
    cut = texts.select(F.explode(chunks("text")).alias("chunk")).withColumn("h", hashed(F.col("chunk")))
    shared = settle(
        cut.select("h", "chunk").distinct().groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "shared_hashes"
    )
    if shared.isEmpty():
        return listed.withColumn("numbers", F.lit(None).cast("array<int>"))
    return _numbered(texts, listed, shared, hashed)


def _numbered(texts: DataFrame, listed: DataFrame, shared: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """Number the chunks under each shared hash and add the numbers to the recipes that use one."""
    used = (
        texts.select(
            "key",
            F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
            F.posexplode(chunks("text")).alias("pos", "chunk"),
        )
        .withColumn("h", hashed(F.col("chunk")))
        .join(shared, "h", "left_semi")
    )
    numbers = (
        used.select("h", "chunk").distinct().withColumn("number", F.row_number().over(Window.partitionBy("h").orderBy("chunk")))
    )
    by_row = (
        used.join(numbers, ["h", "chunk"])
        .groupBy("key", "text_sha256")
        .agg(F.array_sort(F.collect_set(F.struct("pos", "number"))).alias("at"))
        .select("key", "text_sha256", F.transform("at", lambda x: x["number"]).alias("numbers"))
    )
    same = listed["key"].eqNullSafe(by_row["key"]) & (listed["text_sha256"] == by_row["text_sha256"])
    return listed.join(by_row, same, "left").select(listed["*"], by_row["numbers"])


def exact_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", hashed: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """One row per row of `docs`: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty, and empty texts form a group like any other.
    The largest key of a group stays. Rows that repeat both key and text get equal answers, so
    all of them are marked as kept if one is; a null key is below every other and stays only in a group
    without any other key. Further columns of `docs` are not looked at. An empty table gives no rows.
    """
    told = recipes(docs, text, key, hashed)
    groups = (
        told.groupBy(F.col("recipe").alias("of_recipe"), F.col("numbers").alias("of_numbers"))
        .agg(F.max("key").alias("keep_id"), F.count("*").alias("group_size"))
    )
    return told.join(
        groups, (F.col("recipe") == F.col("of_recipe")) & F.col("numbers").eqNullSafe(F.col("of_numbers"))
    ).select(
        F.col("key").alias(key), "keep_id", "group_size", F.col("key").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs`, with all columns, that stay: one for each text, also where rows repeat.

    Of the rows with the largest key of a text the first by all columns stays. Null texts count as empty, a row without a
    key stays only where no row of its text has one. An empty table gives no rows.
    """
    stays = (
        exact_duplicates(docs, text, key).where("kept").select(F.col(key).alias("_key"), F.col("text_sha256").alias("_sha")).distinct()
    )
    named = docs.withColumn("_row_sha", F.sha2(present(text).cast("binary"), 256))
    found = named.join(stays, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_row_sha") == F.col("_sha")))
    first = Window.partitionBy("_key", "_sha").orderBy(*[c for c, kind in docs.dtypes if not kind.startswith("map")])
    return found.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*docs.columns)
