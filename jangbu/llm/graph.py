"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jangbu.session import settle


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each node that has a link: (node, component), for links (a, b).

    Links are turned towards smaller nodes (each node's larger neighbours to its smallest one, then its smaller
    ones), until every node links to the smallest of its component. Only pairs and minima are moved, never
    a node's neighbours as a group; each step is written to the scratch folder.
    """
    now = settle(_turned(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "links")
    seen = _state(now)
    while True:
        now = settle(_small(_large(now)), "links")
        state = _state(now)
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _turned(links: DataFrame) -> DataFrame:
    return links.where("a > b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def _large(links: DataFrame) -> DataFrame:
    """The larger neighbours of each node, linked to the smallest of its neighbours and itself."""
    # The smallest neighbour of a node: its own smaller ones, else the node itself.
    least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    return _turned(
        links.join(least, F.col("b") == F.col("u"), "left").select("a", F.coalesce("m", "b").alias("b"))
    )


def _small(links: DataFrame) -> DataFrame:
    """The smaller neighbours of each node and itself, linked to the smallest of them."""
    least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = links.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _turned(moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
