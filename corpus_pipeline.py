"""A training corpus from raw documents: good texts, one of each, sources mixed, encoded.

Each stage takes all rows that the one before it kept and returns the columns of documents; the last returns what the
encoding gives. Between stages rows are written to the shared scratch folder and read again. Null texts count as empty, an empty
table gives no rows at any stage, and further columns are carried on by all but the last.
"""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from jangbu.llm import bpe, exact_dedup, mixing, near_dedup, quality
from jangbu.session import settle

#: Least similarity of the five-word shingle sets of near duplicates.
NEAR = Fraction(80, 100)
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def different_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def unlike_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, that with the smallest doc_id; rows without a doc_id come last."""
    return near_dedup.keep_one(docs, limit=NEAR)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix: its tokens, and digests of the ids and of the text decoded from them."""
    return bpe.tokenize(docs, VOCABULARY, ("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality classifier", good_texts),
    ("exact dedup", different_texts),
    ("MinHash near-dedup", unlike_texts),
    ("mixing sources", mixed_sources),
    ("BPE encoding", encoded),
]

#: The classifier has no SQL form; run() is tested against a plain version in tests/llm/test_pipeline.py instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settle(docs, "stage")
    return docs
