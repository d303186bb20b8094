"""Mix sources to target weights by systematic sampling, with DataFrame functions only.

A source's target is shared out by weight; each of its documents is then expected target / size times.
Documents stand in a fixed order (longest first), their expected copies are summed up from a random offset,
and a document is taken once for each whole number its step crosses. Because lengths fall along that order, what a
source yields differs from its target by no more than the length of its longest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jangbu.llm.text import ranked, word_count
from jangbu.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 7


def offset(source: Column, seed: int) -> Column:
    """A random number in [0, 1) for each source: 20 bits, so that sums with it stay exact."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\x00"))).cast("binary")), 1, 5)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 20))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per row (source, source_size): its target. Sources in code point order, null last, take the weights in turn.

    The targets sum to `share` times all sizes; none exceeds `most` times its source's size, what is
    above is shared again by weight. The shares are settled by a few sums over the sources, not by a sort on one task.
    """
    in_order = ranked(sources.withColumn("all", F.lit(0)), "all", [F.col("source").asc_nulls_last()], "at")
    cycle = F.array(*[F.lit(w) for w in weights])
    own = settle(in_order.withColumn("weight", F.element_at(cycle, (F.col("at") % len(weights) + 1).cast("int"))), "sources")
    total = own.agg(F.sum("source_size")).first()[0] or 0
    limit, level, capped = F.col("source_size") * most, None, -1
    while True:
        above = F.lit(False) if level is None else limit < F.lit(level) * F.col("weight")
        n, taken, free = own.agg(
            F.count_if(above), F.sum(F.when(above, limit).otherwise(0)), F.sum(F.when(~above, F.col("weight")).otherwise(0))
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (share * total - taken) / free
    return own.select(
        "source", "source_size", F.least(limit.cast("double"), F.lit(level or 0.0) * F.col("weight")).alias("target")
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of `docs`: key, source, size, source_size, target, copies, taken.

    Sizes are words; null and empty texts have size 0. A null source is a source of its own, the last.
    The same rows give the same answer in any layout: ties in size go by key, and rows equal in key, source
    and size differ in nothing that is returned. A source without words has target 0. No copies exceed
    `most`. Further columns of `docs` are not looked at; an empty table gives no rows.
    """
    sizes = settle(
        docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(text).alias("size")), "sizes"
    )
    shares = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    placed = ranked(sizes, "source", [F.col("size").desc(), F.col("key").asc_nulls_first()], "rank")
    shares = shares.withColumnRenamed("source", "of_source")
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = offset(F.col("source"), seed)
    upto = lambda rank: F.floor(rank * F.col("step") + start)
    return (
        placed.join(shares, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("step", step)
        .withColumn("copies", upto(F.col("rank") + 1) - upto(F.col("rank")))
        .select(
            F.col("key").alias(key), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
        )
    )


def mixed_rows(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken, with its own columns only.

    Rows that repeat key, source and size share their copies evenly, in the order of their texts; rows without a key are
    taken as rows of one key. Rows without words go at the rate of their source, none of a source that has no word; an empty
    table gives no rows.
    """
    taken = mix(docs, text, source, key, **options)
    shared = taken.groupBy(F.col(key).alias("_key"), F.col("source").alias("_source"), F.col("size").alias("_size")).agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_rows")
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(source).eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size"))
    found = docs.withColumn("_words", word_count(text)).join(shared.where("_copies > 0"), same)
    turn = F.row_number().over(Window.partitionBy("_key", "_source", "_size").orderBy(text))
    upto = lambda i: F.floor(F.col("_copies") * i / F.col("_rows"))
    return (
        found.withColumn("_turn", turn)
        .withColumn("_own", (upto(F.col("_turn")) - upto(F.col("_turn") - 1)).cast("int"))
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_own"))))
        .select(*docs.columns)
    )
