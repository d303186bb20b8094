"""TF-IDF weights of word 1- and 2-grams, and cosine similarity of titles to short targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jangbu import rules
from jangbu.session import settle

# Words of two or more letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)


def grams(words: Column) -> Column:
    """The words followed by all pairs of neighbours."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    bigrams = F.zip_with(F.slice(words, 1, pairs), F.slice(words, 2, pairs), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, bigrams)


# Counted once per text, so that its text frequency is the number of texts; its weight is 0.
_EVERY_TEXT = ""


def _runs(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, gram, tf) of every text by itself: its grams are sorted, and a run of equal ones is a row."""
    found = F.array_append(grams(F.col("_words")), F.lit(_EVERY_TEXT))
    first = F.filter(
        F.sequence(F.lit(0), F.size("_grams") - 1), lambda i: (i == 0) | (F.get("_grams", i) != F.get("_grams", i - 1))
    )
    tf = F.coalesce(F.get("_first", F.col("_run") + 1), F.size("_grams")) - F.col("_at")
    return (
        # The words are a column of their own, so that the pattern runs once per text.
        df.select(key, tokens(F.col(text)).alias("_words"))
        .select(key, F.sort_array(found).alias("_grams"))
        .withColumn("_first", first)
        # There is always a marker. The outer form, or Spark infers a filter on all that makes the runs, and sorts once a gram.
        .select(key, "_grams", "_first", F.posexplode_outer("_first").alias("_run", "_at"))
        .select(key, F.get("_grams", F.col("_at")).alias("gram"), tf.cast("bigint").alias("tf"))
    )


def gram_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, gram, tf) and one marker row per text; missing texts have none.

    Whole texts are placed by key. A text that has its key for itself is counted within its row; only the texts of a repeated
    key, which count as one, are aggregated.
    """
    sharing = F.count(F.lit(1)).over(Window.partitionBy(key))
    placed = df.select(key, text).na.drop(subset=[text]).repartition(key).withColumn("_sharing", sharing)
    alone = _runs(placed.filter(F.col("_sharing") == 1), key, text)
    shared = _runs(placed.filter(F.col("_sharing") > 1), key, text).groupBy(key, "gram").agg(F.sum("tf").alias("tf"))
    return alone.unionByName(shared)


def _smoothed(texts: int, frequency: Column) -> Column:
    return F.log((F.lit(1.0) + texts) / (F.lit(1.0) + frequency)) + 1


#: Texts drawn to find frequent grams, the least of them that hold such a gram, and the most grams that are broadcast.
_DRAWN, _LEAST, _FREQUENT = 4000, 3, 1 << 17


def _frequent(df: DataFrame, key: str, text: str) -> DataFrame:
    """Grams (gram) that many of some drawn texts hold. They only decide by which way a gram is counted, never a result."""
    present = df.select(key, text).na.drop(subset=[text])
    drawn = settle(present.sample(min(1.0, _DRAWN / max(present.count(), 1)), 1), "drawn_texts").repartition(key, text)
    counted = _runs(drawn, key, text).groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= _LEAST)
    return counted.orderBy(F.desc("_n"), "gram").limit(_FREQUENT).select("gram")


def text_frequencies(df: DataFrame, key: str, text: str, needed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(listed, rest, frequencies, texts): each gram of each text is a row of `listed` or of `rest`.

    `listed` (key, _id, tf) holds the markers, the `needed` grams (gram) and frequent ones; `frequencies` (_id, gram, df) names
    them, without those that no text holds, and is small enough to broadcast. `rest` (key, gram, tf, df) holds all others, which
    are placed by gram and counted there. No gram of the rest is held by a large share of the texts, so none is a hot key.
    """
    marker = df.sparkSession.createDataFrame([(_EVERY_TEXT,)], "gram string")
    names = _frequent(df, key, text).union(needed.select("gram")).union(marker).distinct()
    named = settle(names.withColumn("_id", F.monotonically_increasing_id()), "frequent_grams")
    found = gram_counts(df, key, text).join(F.broadcast(named), "gram", "left")
    counts = settle(found.select(key, "_id", F.when(F.col("_id").isNull(), F.col("gram")).alias("gram"), "tf"), "gram_counts")
    listed = counts.filter(F.col("_id").isNotNull()).select(key, "_id", "tf")
    held = listed.groupBy("_id").agg(F.count(F.lit(1)).alias("df"))
    frequencies = settle(held.join(F.broadcast(named), "_id"), "text_frequencies")
    texts = frequencies.filter(F.col("gram") == _EVERY_TEXT).agg(F.max("df")).first()[0] or 0
    rest = counts.filter(F.col("_id").isNull()).select(key, "gram", "tf").repartition("gram")
    # Sorted by a hash first: numbers are compared faster than grams that begin alike.
    same = Window.partitionBy("_hash", "gram")
    rest = rest.withColumn("_hash", F.xxhash64("gram")).withColumn("df", F.count(F.lit(1)).over(same)).drop("_hash")
    return listed, rest, frequencies, texts


def _target_terms(spark: SparkSession, targets: list[str]) -> DataFrame:
    """Rows (target, gram, tf)."""
    return (
        spark.createDataFrame(list(enumerate(targets)), "target int, _text string")
        .select("target", tokens(F.col("_text")).alias("_words"))
        .select("target", F.explode(grams(F.col("_words"))).alias("gram"))
        .groupBy("target", "gram")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def tfidf_weights(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, gram, weight), the weights of a text having length 1."""
    none = df.sparkSession.createDataFrame([], "gram string")
    listed, rest, frequencies, texts = text_frequencies(df, key, text, none)
    named = frequencies.filter(F.col("gram") != _EVERY_TEXT)
    every = listed.join(F.broadcast(named), "_id").select(key, "gram", "tf", "df").unionByName(rest)
    raw = every.select(key, "gram", (F.col("tf") * _smoothed(texts, F.col("df"))).alias("weight"))
    # A window by text: the weights are computed once, and a text has no more rows than words and pairs.
    squares = F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key))
    return raw.select(key, "gram", (F.col("weight") / F.sqrt(squares)).alias("weight"))


def _target_grams(idf: DataFrame, terms: DataFrame) -> DataFrame:
    """An inverted index of the targets: (gram, _targets), with (target, share) of each target that holds the gram.

    Only grams that occur in the texts, weights of a target having length 1.
    """
    # A few rows per target, so a window per target is small.
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("target")))
    shares = idf.join(terms, "gram").withColumn("_w", F.col("tf") * F.col("idf")).withColumn("share", F.col("_w") / length)
    return shares.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("target", "share"))).alias("_targets"))


def max_similarity(
    df: DataFrame,
    key: str,
    text: str,
    targets: list[str],
    limit: float | None = rules.SIMILARITY_LIMIT,
) -> DataFrame:
    """Rows (key, max_similarity): best cosine similarity to any target, above `limit` if given.

    A text without a shared gram has similarity 0; a missing text has none. Grams meet an inverted index of the targets, so
    only shared grams make rows, one for each target that holds them, and the plan is the same for any number of targets.
    """
    terms = settle(_target_terms(df.sparkSession, targets), "target_terms")
    listed, rest, frequencies, texts = text_frequencies(df, key, text, terms)
    idf = frequencies.withColumn("idf", F.when(F.col("gram") == _EVERY_TEXT, 0.0).otherwise(_smoothed(texts, F.col("df"))))
    wanted = settle(idf.join(_target_grams(idf, terms), "gram", "left").select("_id", "idf", "_targets"), "target_grams")
    # One row a text and target before any shuffle, as the rows of a text lie together.
    weighted = listed.join(F.broadcast(wanted), "_id").withColumn("weight", F.col("tf") * F.col("idf"))
    lines = weighted.select(key, "weight", F.posexplode_outer("_targets").alias("_at", "_entry"))
    # The square of a gram counts once, however many targets share it.
    square = F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("weight") * F.col("weight"))
    near = lines.select(key, F.col("_entry.target").alias("_target"), (F.col("weight") * F.col("_entry.share")).alias("_product"), square.alias("_square"))
    weight = F.col("tf") * _smoothed(texts, F.col("df"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("_target", "int"), ("_product", "double"))]
    every = near.unionByName(rest.select(key, *none, (weight * weight).alias("_square")))
    by_target = every.groupBy(key, "_target").agg(F.sum("_product").alias("_product"), F.sum("_square").alias("_squares"))
    best = F.coalesce(F.try_divide(F.max("_product"), F.sqrt(F.sum("_squares"))), F.lit(0.0))
    scored = by_target.groupBy(key).agg(best.alias("max_similarity"))
    return scored if limit is None else scored.filter(F.col("max_similarity") > limit)
