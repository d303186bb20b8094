"""The driver's test tables seen as survey, raw survey and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# English stand-ins for the survey's word lists, with the same traps: order decides, words overlap.
CATEGORY_RULES = [("fast", ["bolt", "rod"]), ("ringed", ["ring", "gear"]), ("heat", ["hot", "cold"])]
OTHER = "other"
ITEM_GROUPS = {"old": "old", "hot": "hot", "ring": "ring"}
UNIT_FIXES = [("old bolt", 2, "1ea")]
# Categories whose rows the item jobs take, before and after categories are assigned; groups occur in others too.
ITEM_CATEGORIES = ["ECONOMY", "STANDARD", "PROMO"]
ASSIGNED_CATEGORIES = ["fast", "heat"]
# Rows from the end that one download had too many.
TAIL_ROWS = 500
TITLE_INCLUDE = ["widget", "gear"]
TITLE_EXCLUDE = ["old"]
LISTED, UNLISTED = ["th", "en"], ["er"]
CATEGORY_SLUGS = {"fast": "quick", "ringed": "round"}
TARGETS = ["bolt", "ring", "hot gear"]
DOCUMENT_TARGETS = ["the", "que les", "der und", "los de la"]
PROFILE_ITEMS = ["bolt", "ring", "hot"]
MARKETS = [
    "Supplier#000000000",
    "Supplier#000000001",
    "Supplier#000000002",
    "Supplier#000000003",
    "Supplier#000000004",
]
DATE_PREFIX = "1999"


# Declared, so that opening a table starts no job.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def survey(spark: SparkSession, folder: str) -> DataFrame:
    """Prices by market, district, category, item, year and month; zeros and outliers are made by rule.

    The joins carry no hints: the files' sizes decide what is broadcast.
    """
    line, part, market, district = (table(spark, folder, t) for t in ("lineitem", "part", "supplier", "nation"))
    year, month = F.year("l_shipdate"), F.month("l_shipdate")
    limit = F.when(F.col("p_name").like("%bolt"), 0.035).when(F.col("p_name").like("hot%"), 0.015).otherwise(-1.0)
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(market, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(district, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("s_name").alias("market_name"),
            F.col("n_name").alias("district_name"),
            F.col("p_type").alias("category"),
            F.col("p_name").alias("item_name"),
            F.col("p_brand").alias("sales_unit"),
            F.col("l_returnflag").alias("remark"),
            year.cast("bigint").alias("year"),
            month.cast("int").alias("month"),
            F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0")).alias("year_month"),
            F.when(F.col("l_discount") < limit, 0.0)
            .when((F.col("l_orderkey") * 10 + F.col("l_linenumber")) % 83 == 5, F.col("l_extendedprice") * 40)
            .otherwise(F.col("l_extendedprice"))
            .alias("price"),
        )
    )


def survey_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The survey as all-string rows with missing, broken and mistyped cells."""
    i = F.col("id")
    return survey(spark, folder).select(
        i.cast("string").alias("id"),
        "market_name",
        "district_name",
        F.when(i % 60 != 5, F.concat("item_name", F.lit("("), "sales_unit", F.lit(") 1ea"))).alias("item_name"),
        F.when(i % 40 == 3, "N/A").otherwise(F.col("price").cast("string")).alias("price"),
        F.when(i % 50 == 2, None)
        .when(i % 50 == 7, "nan")
        .when(i % 50 == 14, F.concat(F.col("year").cast("string"), F.lit("-xx")))
        .when((F.col("month") == 3) & (i % 10 == 1), F.concat(F.col("year").cast("string"), F.lit("-.3")))
        .otherwise(F.col("year_month"))
        .alias("year_month"),
        F.when(i % 7 == 0, "").otherwise(F.concat("remark", F.lit('";'), "sales_unit")).alias("remark"),
    )


def titles(spark: SparkSession, folder: str) -> DataFrame:
    """Listing titles of all parts."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("listing_id"), F.concat_ws(" ", "p_name", "p_type").alias("title")
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def shops(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two whole tables that share some columns."""
    first = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    second = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return first, second
