"""One query for each corpus operator, over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jangbu.llm import bpe, exact_dedup, language, mixing, near_dedup, negatives, perplexity, prefix_trie, quality, repeats, token_counts, topk, urls

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each whole text and the text decoded from them, as digests."""
    return bpe.tokenize(_table(spark, sf_dir, "documents"), VOCABULARY, ("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document gives to a mix of the sources, weighed 5, 2, 1."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document by boosted trees, learned from four fifths of the labels."""
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document in strings of 200 bytes that also start elsewhere, and what is left without them."""
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and repeat limits, and the perplexity band of each document's language."""
    return perplexity.rules(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document by a conditional random field, learned from three quarters of the documents."""
    return language.identify(_table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are at least 0.85 alike; the smallest doc_id of each stays."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


#: (verdict, host, path), as the contract of the query states them.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and verdict of each page's URL; what no rule names is allowed."""
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of each document, and how they split by characters."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), VOCABULARY)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beginnings that conversations share, after each took the first turns of its family's first one."""
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations")).drop("turn_name")


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    return topk.search(_table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rows of other labels at 30 to 90 percent of the score of each of an anchor's five positives."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe_round_trip, op2_mix_sources, op3_quality, op4_repeated_strings, op5_exact_dedup, op6_quality_rules, op7_language, op8_near_dedup, op9_url_rules, op10_token_counts, op11_prefix_trie, op12_top_k, op13_hard_negatives)
}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

#: The closed form of the shares: sources by limit / weight, the first level that holds the next one.
MIX = f"""
WITH sizes AS (SELECT doc_id, source, {_WORDS}::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size,
        list_value(5, 2, 1)[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
        FROM sizes GROUP BY source),
cum AS (SELECT *, 1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT AS total,
        coalesce(sum(2 * source_size) OVER before, 0)::BIGINT AS taken, (sum(w) OVER all_of - coalesce(sum(w) OVER before, 0))::BIGINT AS free
        FROM per WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), all_of AS ()),
level AS (SELECT (total - taken) / free AS level FROM cum WHERE (total - taken) / free * w <= 2 * source_size
        ORDER BY source_size / w, source NULLS LAST LIMIT 1),
shares AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, coalesce((SELECT level FROM level), 0) * w) AS target FROM cum),
placed AS (SELECT s.*, p.source_size, p.target,
        CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0 END AS step,
        ('0x' || substr(md5('7:' || coalesce(s.source, chr(0))), 1, 5))::BIGINT / 1048576::DOUBLE AS start,
        row_number() OVER (PARTITION BY s.source ORDER BY size DESC, doc_id NULLS FIRST) - 1 AS rank
        FROM sizes s JOIN shares p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       ((floor((rank + 1) * step + start) - floor(rank * step + start)) * size)::BIGINT AS taken
FROM placed
"""

_RULES = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in URL_RULES)
URLS = f"""
WITH rules AS (SELECT * FROM (VALUES {_RULES}) AS r(verdict, of_host, of_path)),
parts AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url[instr(url, '://') + 3:] ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM parts),
urls AS (SELECT row_number() OVER () AS n, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest[length(raw) + 1:], '^[^?#]*') AS path FROM cut),
fits AS (SELECT n, arg_max(of_host || of_path, length(of_host || of_path)) AS rule,
         arg_max(verdict, length(of_host || of_path)) AS verdict
         FROM urls JOIN rules ON (host = of_host OR ends_with(host, '.' || of_host)) AND starts_with(path, of_path) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (n)
"""

#: The unsigned crc32 of the ids, the regrown conversations, and a row for each of their beginnings.
TRIE = """
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT conv_id, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda c, k: xor(c >> 1, 3988292384::BIGINT * (c & 1)))) AS r FROM ids),
heads AS (SELECT conv_id, conv_id - conv_id % 5 AS first, xor(r, 4294967295::BIGINT) % 9 AS h FROM crc),
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
          sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n FROM conversations WHERE conv_id IS NOT NULL),
again AS (SELECT h.conv_id, t.role, t.text, t.n FROM heads h JOIN turns t ON t.conv_id = h.first AND t.n <= h.h
          UNION ALL SELECT h.conv_id, t.role, t.text, 1000000000000 + t.n FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.n > h.h),
lists AS (SELECT i.conv_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY n) FILTER (n IS NOT NULL), []) AS turns
          FROM ids i LEFT JOIN again a USING (conv_id) GROUP BY 1),
depths AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM lists),
nodes AS (SELECT turns[1:depth] AS prefix, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
          sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
          FROM depths GROUP BY turns[1:depth]),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
own AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_children IS NULL)::BIGINT AS leaf,
        CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(n.prefix[depth].text) ELSE 0 END AS saved FROM nodes n LEFT JOIN kids k ON n.prefix = k.prefix),
above AS (SELECT unnest([prefix[1:k] FOR k IN range(depth + 1)]) AS prefix, leaf, saved FROM own),
sums AS (SELECT prefix, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY 1)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
FROM own o JOIN sums s ON o.prefix = s.prefix LEFT JOIN nodes p ON o.depth > 0 AND p.prefix = o.prefix[1:o.depth - 1]
"""

def _vectors(scale: int) -> str:
    return f"""rows AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


TOP_K = f"""
WITH {_vectors(1024)},
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
           FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

NEGATIVES = f"""
WITH {_vectors(256)},
named AS (SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM rows WHERE label IS NOT NULL),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
           FROM named a JOIN named b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
near AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM scored WHERE same),
pairs AS (SELECT p.anchor_id, p.vec_id AS positive_id, q.vec_id AS negative_id, p.score AS positive_score, q.score AS negative_score,
          row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY q.score DESC, q.vec_id)::INTEGER AS rank
          FROM near p JOIN scored q ON p.anchor_id = q.anchor_id AND NOT q.same
          AND 100 * q.score BETWEEN 30 * p.score AND 90 * p.score WHERE p.n <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM pairs WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op11_prefix_trie": TRIE,
    "op12_top_k": TOP_K,
    "op13_hard_negatives": NEGATIVES,
    "op2_mix_sources": MIX,
    "op9_url_rules": URLS,
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
