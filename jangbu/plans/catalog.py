"""Named queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu import rules, schema
from jangbu.functions import keywords, text
from jangbu.operators import columns, outliers, profile, quality, quantiles, rows, similarity
from jangbu.operators import volatility as vol
from jangbu.plans import samples
from jangbu.plans import survey as plan
from jangbu.session import scratch_path, settle
from jangbu.sinks import tables as sinks
from jangbu.sources import pages, tables, xml

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


_DIGITS = {"cv": 6, "weight": 6, "max_similarity": 6, "zero_ratio": 6}


def shown(df: DataFrame) -> DataFrame:
    """Floating measures rounded to a precision that does not depend on summation order.

    The small offset moves exact halves off the rounding edge.
    """

    def rounded(name: str):
        digits = _DIGITS.get(name, 4)
        return F.round(F.col(name) + 10.0 ** -(digits + 3), digits).alias(name)

    return df.select(*[rounded(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    raw = samples.survey_raw(spark, folder)
    return plan.prepare(plan.clean(raw), samples.CATEGORY_RULES, samples.OTHER)


# Sources -------------------------------------------------------------------------------------------------


@query
def scan_csv(spark, folder):
    raw = samples.survey_raw(spark, folder)
    path = scratch_path(spark, "scan_csv")
    sinks.write_csv(raw, path)
    return tables.read_csv(spark, path, raw.schema)


@query
def scan_csv_inferred(spark, folder):
    path = scratch_path(spark, "scan_csv_inferred")
    part = samples.table(spark, folder, "part")
    sinks.write_csv(part, path)
    inferred = tables.read_csv_inferred(spark, path)
    return inferred.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query
def scan_by_name(spark, folder):
    """Columns in another order, one of them unknown, cells with quotes, separators and line breaks."""
    raw = samples.survey_raw(spark, folder).withColumn("remark", F.concat(F.lit('a "'), "remark", F.lit('",\nend')))
    path = scratch_path(spark, "scan_by_name")
    headers = {v: k for k, v in schema.SURVEY_HEADERS.items()}
    written = [*reversed(raw.columns[1:]), "unknown", "id"]
    sinks.write_csv(raw.withColumn("unknown", F.lit("x")).select(*written).withColumnsRenamed(headers), path)
    return tables.read_csv(spark, path, raw.schema, multi_line=True)


def _written_shops(spark, folder, base, dialects):
    names = ["name", "nation", "balance"]
    paths = []
    for frame, stem, options in zip(samples.shops(spark, folder), ("customer", "supplier"), dialects):
        path = f"{base}/{stem}.csv"
        frame.select(*names).write.options(header=True, **options).csv(path)
        paths.append(path)
    return T.StructType([T.StructField(n, T.StringType()) for n in names]), paths


@query
def scan_dialects(spark, folder):
    dialects = [{"sep": ";", "encoding": "UTF-16LE"}, {"sep": ",", "encoding": "UTF-8"}]
    columns_, paths = _written_shops(spark, folder, scratch_path(spark, "dialects"), dialects)
    files = [tables.CsvFile(p, d["sep"], d["encoding"]) for p, d in zip(paths, dialects)]
    return tables.read_dialects(spark, files, columns_)


@query
def scan_many(spark, folder):
    columns_, paths = _written_shops(spark, folder, scratch_path(spark, "many"), [{}, {}])
    return tables.read_many(spark, paths, columns_)


@query
def scan_missing_ok(spark, folder):
    base = scratch_path(spark, "missing")
    columns_, paths = _written_shops(spark, folder, base, [{}, {}])
    frames = [tables.read_or_empty(spark, p, columns_) for p in [*paths, f"{base}/absent.csv"]]
    return rows.union_by_position(*frames)


def _mixed_folder(spark, folder, label):
    """A folder of files that hold the shops under three orders of columns, one of them with a column more."""
    customers, suppliers = samples.shops(spark, folder)
    even = F.col("nation") % 2 == 0
    path = scratch_path(spark, label)
    for frame in (
        customers.filter(even).select("name", "nation", "balance"),
        customers.filter(~even).select("balance", "name", "nation"),
        suppliers.select("nation", F.lit("x").alias("unknown"), "balance", "name"),
    ):
        frame.write.mode("append").options(header=True).csv(path)
    return path


@query
def scan_unlike_headers(spark, folder):
    names = ["name", "nation", "balance"]
    columns_ = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return tables.read_csv(spark, _mixed_folder(spark, folder, "unlike"), columns_)


@query
def scan_unlike_inferred(spark, folder):
    """The same folder with types inferred; a column that some files lack is NULL there."""
    found = tables.read_csv_inferred(spark, _mixed_folder(spark, folder, "unlike_inferred"))
    return found.select("name", "nation", "balance", F.col("unknown").isNotNull().alias("has_more"))


@query
def scan_whitelist(spark, folder):
    base = scratch_path(spark, "whitelist")
    columns_, _ = _written_shops(spark, folder, base, [{}, {}])
    return tables.read_whitelist(spark, base, ["supplier", "absent"], columns_)


def _api_records(spark, folder):
    """The raw survey under API tags; the tags the test tables lack are missing elements."""
    raw = samples.survey_raw(spark, folder)
    by_name = {v: k for k, v in schema.API_TAGS.items()}
    return raw.withColumnsRenamed(by_name)


#: Records in a packed XML file, which one task reads whole.
_FILE_RECORDS = 100_000


@query
def xml_rows(spark, folder):
    """Tags make records many times as long as their rows, so the files are packed and hold a limited number each."""
    path = scratch_path(spark, "xml_rows")
    options = {"rowTag": "row", "rootTag": "response", "compression": "gzip", "maxRecordsPerFile": _FILE_RECORDS}
    _api_records(spark, folder).write.format("xml").options(**options).save(path)
    found = xml.read_rows(spark, path).withColumnsRenamed(schema.API_TAGS)
    return found.select(*samples.survey_raw(spark, folder).columns)


@query
def xml_pages(spark, folder):
    """The same records held as response texts, one page per market and month."""
    records = _api_records(spark, folder)
    tags = [F.concat(F.lit(f"<{c}>"), columns.quoted(c), F.lit(f"</{c}>")) for c in records.columns]
    body = F.concat(F.lit("<row>"), *[F.coalesce(t, F.lit("")) for t in tags], F.lit("</row>"))
    page = records.select(F.concat(F.lit("<page>"), body, F.lit("</page>")).alias("page"))
    found = xml.rows_from_pages(page, "page").withColumnsRenamed(schema.API_TAGS)
    return found.select(*samples.survey_raw(spark, folder).columns)


@query
def xml_quarantine(spark, folder):
    """Pages with broken records among the others: the survey job loads the good ones and stores the rest apart."""
    records = _api_records(spark, folder)
    name = F.when(F.col("P_SEQ").cast("bigint") % 97 == 3, "x & y").otherwise(F.col("A_NAME"))
    broken = records.withColumn("A_NAME", name)
    tags = [F.concat(F.lit(f"<{c}>"), columns.quoted(c), F.lit(f"</{c}>")) for c in broken.columns]
    body = F.concat(F.lit("<row>"), *[F.coalesce(t, F.lit("")) for t in tags], F.lit("</row>"))
    path, aside = scratch_path(spark, "xml_quarantine"), scratch_path(spark, "quarantine")
    broken.select(body).write.text(path)
    good = plan.load(spark, [], path, quarantine=aside)
    kept = good.select(F.lit("good").alias("kind"), *samples.survey_raw(spark, folder).columns)
    rest = spark.read.parquet(aside).filter(F.col(xml.FILE).contains("xml_quarantine"))
    rest = rest.select(F.lit("broken").alias("kind"), F.regexp_extract(xml.RECORD, "<P_SEQ>([^<]*)", 1).alias("id"))
    return rows.union_outer(kept, rest)


_LI = pages.element("li")
_TILE = pages.element("article")
_TILE_FIELDS = {"name": pages.element("h1"), "price": pages.element("p")}
_HREF = r'<a\b[^>]*\bhref="([^"]*)"'


@query
def html_tiles(spark, folder):
    return pages.tiles(samples.table(spark, folder, "pages"), tile=_TILE, fields=_TILE_FIELDS)


@query
def href_product_id(spark, folder):
    source = samples.table(spark, folder, "pages")
    return source.select("page_id", text.product_id(F.col("url")).alias("product_id"))


@query
def dedup_first(spark, folder):
    source = samples.table(spark, folder, "pages")
    found = pages.items(source, item=_LI, href=_HREF, fields={"title": pages.element("a")})
    return rows.keep_first(found, ["product_id"], ["page_id", "pos"])


@query
def listing_job(spark, folder):
    """Pages to a filtered list: items, the first of each product, titles with one word and without another, CSV."""
    found = dedup_first(spark, folder)
    chosen = rows.titles_including_excluding(found, include=samples.LISTED, exclude=samples.UNLISTED)
    path = scratch_path(spark, "listing_job")
    sinks.write_csv(chosen, path)
    return tables.read_csv(spark, path, chosen.schema)


# Sinks ---------------------------------------------------------------------------------------------------


@query
def sink_csv(spark, folder):
    df = samples.survey(spark, folder)
    path = scratch_path(spark, "sink_csv")
    sinks.write_csv(df, path)
    return tables.read_csv(spark, path, df.schema)


@query
def sink_csv_bom(spark, folder):
    """Rows read back from files that begin with a byte-order mark, and whether every one does."""
    df = samples.survey(spark, folder)
    path = scratch_path(spark, "sink_csv_bom")
    sinks.write_csv(df, path, bom=True)
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    marked = parts.agg(F.every(F.substring("content", 1, 3) == F.unhex(F.lit("EFBBBF"))).alias("marked"))
    return tables.read_csv(spark, path, df.schema).withColumn("marked", marked.scalar())


@query
def sink_single(spark, folder):
    df = vol_district(spark, folder)
    path = scratch_path(spark, "sink_single")
    sinks.write_single_csv(df, path)
    return tables.read_csv(spark, path, df.schema)


@query
def sink_by_category(spark, folder):
    df = samples.survey(spark, folder)
    path = scratch_path(spark, "sink_by_category")
    sinks.write_by(df, "category", path)
    return tables.read_csv(spark, path, df.schema).select(*df.columns)


@query
def sink_by_group(spark, folder):
    df = _item_rows(spark, folder)
    path = scratch_path(spark, "sink_by_group")
    sinks.write_by(df, "item_group", path)
    return tables.read_csv(spark, path, df.schema).select(*df.columns)


@query
def category_tables(spark, folder):
    """The category tables written under their stored names and loaded again; rows of other categories are not stored."""
    path = scratch_path(spark, "category_tables")
    plan.store_categories(prepared(spark, folder), path, samples.CATEGORY_SLUGS)
    return shown(plan.load_categories(spark, path)).select("item_name", "price", "year", "month", "remark", "category")


@query
def sink_volatility(spark, folder):
    yearly, monthly = vol_item_year(spark, folder), vol_item_month(spark, folder)
    base = scratch_path(spark, "sink_volatility")
    sinks.write_volatility(yearly, monthly, base)
    back = [
        tables.read_csv(spark, f"{base}/{name}", df.schema).withColumnRenamed(period, "period").withColumn("kind", F.lit(name))
        for name, df, period in (("yearly", yearly, "year"), ("monthly", monthly, "month"))
    ]
    return rows.union_outer(*[b.withColumn("period", F.col("period").cast("bigint")) for b in back])


# Columns -------------------------------------------------------------------------------------------------


@query
def rename_map(spark, folder):
    raw = samples.survey_raw(spark, folder)
    return columns.rename(raw, {"id": "serial", "market_name": "market", "absent": "nothing"})


@query
def drop_cols(spark, folder):
    return columns.drop_unused(samples.survey_raw(spark, folder))


@query
def drop_cols_like(spark, folder):
    return columns.drop_columns_like(samples.survey(spark, folder), "name")


@query
def trim_names(spark, folder):
    raw = samples.survey_raw(spark, folder)
    return columns.trim_names(raw.toDF(*[f"  {c} " for c in raw.columns]))


@query
def align_schema(spark, folder):
    target = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("year_month", T.DoubleType()),
            T.StructField("absent", T.StringType()),
        ]
    )
    return columns.align_types(samples.survey_raw(spark, folder), target)


@query
def common_cols(spark, folder):
    first, second = samples.shops(spark, folder)
    return first.select(*columns.common_columns(first, second))


@query
def coerce_numeric(spark, folder):
    return columns.to_number(samples.survey_raw(spark, folder), "price").select("id", "item_name", "price")


@query
def parse_year_month(spark, folder):
    raw = columns.null_tokens(samples.survey_raw(spark, folder)).na.drop(subset=["year_month"])
    return columns.parse_year_month(raw).select("id", "item_name", "year_month", "year", "month")


@query
def text_repair(spark, folder):
    return columns.repair_text(samples.survey_raw(spark, folder))


@query
def null_tokens(spark, folder):
    return columns.null_tokens(samples.survey_raw(spark, folder))


@query
def fill_defaults(spark, folder):
    return columns.empty_for_null(samples.survey_raw(spark, folder))


@query
def clean_item_name(spark, folder):
    raw = samples.survey_raw(spark, folder)
    return raw.select("id", "item_name", text.base_name(F.col("item_name")).alias("base_name"))


@query
def assign_category(spark, folder):
    raw = samples.survey_raw(spark, folder).na.drop(subset=["item_name"])
    labelled = columns.assign_category(raw, "item_name", "item_category", samples.CATEGORY_RULES, samples.OTHER)
    return labelled.select("id", "item_name", "item_category")


@query
def unit_fix(spark, folder):
    return columns.fix_units(samples.survey(spark, folder), samples.UNIT_FIXES)


@query
def price_text(spark, folder):
    written = F.concat(F.format_number(F.floor("l_extendedprice"), 0), F.lit("원"))
    line = samples.table(spark, folder, "lineitem").withColumn("price_text", written)
    return line.select("l_orderkey", "l_linenumber", "price_text", text.price_from_text(F.col("price_text")).alias("price"))


@query
def unit_price_parts(spark, folder):
    written = F.concat(F.lit("("), "p_size", F.lit("g당 "), F.format_number(F.floor("p_retailprice"), 0), F.lit("원)"))
    part = samples.table(spark, folder, "part").withColumn("unit_price", written)
    parts = part.select("p_partkey", "unit_price", text.unit_price_parts(F.col("unit_price")).alias("parts"))
    return parts.select("p_partkey", "unit_price", "parts.*")


@query
def item_groups(spark, folder):
    return rows.explode_groups(samples.survey(spark, folder), groups=samples.ITEM_GROUPS)


@query
def rounded_view(spark, folder):
    return columns.rounded(vol.volatility(samples.survey(spark, folder), ["district_name", "year"]))


# Rows ----------------------------------------------------------------------------------------------------


@query
def drop_null_keys(spark, folder):
    return samples.survey_raw(spark, folder).na.drop(subset=["year_month", "item_name"])


@query
def filter_eq(spark, folder):
    return samples.survey(spark, folder).filter(F.col("category") == "ECONOMY")


@query
def market_isin(spark, folder):
    return rows.in_markets(samples.survey(spark, folder), samples.MARKETS)


@query
def contains_keyword(spark, folder):
    return rows.containing(samples.survey_raw(spark, folder), "item_name", "old")


@query
def title_include(spark, folder):
    return rows.titles_including(samples.titles(spark, folder), words=samples.TITLE_INCLUDE)


@query
def item_alternation(spark, folder):
    raw = samples.survey_raw(spark, folder)
    return raw.filter(keywords.matches_any(F.col("item_name"), samples.PROFILE_ITEMS))


@query
def title_include_exclude(spark, folder):
    return rows.titles_including_excluding(
        samples.titles(spark, folder), include=samples.TITLE_INCLUDE, exclude=samples.TITLE_EXCLUDE
    )


@query
def date_prefix(spark, folder):
    return rows.with_prefix(samples.survey_raw(spark, folder), "year_month", samples.DATE_PREFIX)


@query
def drop_zero_price(spark, folder):
    return rows.drop_zero(columns.to_number(samples.survey_raw(spark, folder), "price"))


def _total_order(df: DataFrame, first: str) -> list[str]:
    return [first, *[c for c in df.columns if c != first]]


@query
def head_slice(spark, folder):
    df = samples.survey(spark, folder)
    return rows.drop_tail(df, samples.TAIL_ROWS, _total_order(df, "id"))


@query
def preview_top_n(spark, folder):
    df = samples.survey(spark, folder)
    return rows.first_rows(df, 10, *_total_order(df, "id"))


@query
def preview_last_n(spark, folder):
    df = samples.survey(spark, folder)
    return rows.last_rows(df, 5, *_total_order(df, "id"))


@query
def union_position(spark, folder):
    first, second = samples.shops(spark, folder)
    names = ["name", "nation", "balance"]
    return rows.union_by_position(first.select(*names), second.select(*names))


@query
def union_common(spark, folder):
    return rows.union_common(*samples.shops(spark, folder))


@query
def union_outer(spark, folder):
    return rows.union_outer(*samples.shops(spark, folder))


# Zero prices ---------------------------------------------------------------------------------------------


@query
def zero_ratio_by_item(spark, folder):
    return rows.ranked(shown(quality.zero_ratio(samples.survey(spark, folder))), "zero_ratio", "item_name")


@query
def zero_ratio_inner(spark, folder):
    return shown(quality.zero_ratio_inner(samples.survey(spark, folder)))


def _bands(spark, folder):
    return quality.zero_band(quality.zero_ratio(samples.survey(spark, folder)))


@query
def zero_ratio_bands(spark, folder):
    return shown(_bands(spark, folder))


@query
def low_zero_rows(spark, folder):
    return quality.low_zero_rows(samples.survey(spark, folder), settle(_bands(spark, folder), "zero_bands"))


@query
def drop_high_zero_items(spark, folder):
    return quality.drop_high_zero_items(samples.survey(spark, folder), settle(_bands(spark, folder), "zero_bands"))


@query
def item_year_median(spark, folder):
    return shown(quantiles.group_median(samples.survey(spark, folder), ["item_name", "year"], "price"))


@query
def item_month_median_approx(spark, folder):
    """Whether each approximate median lies within its rank error."""
    survey, keys = samples.survey(spark, folder), ["item_name", "year_month"]
    return _rank_checked(survey, quantiles.approx_group_median(survey, keys, "price"), keys, {"median": 0.5}, 1e-4)


@query
def impute_zero_year_median(spark, folder):
    repaired = quality.repair_zeros(samples.survey(spark, folder), drop_high=False)
    return shown(repaired)


@query
def impute_zero_month_approx(spark, folder):
    return quality.repair_zeros_monthly_approx(samples.survey(spark, folder))


# Outliers ------------------------------------------------------------------------------------------------


@query
def item_quartiles(spark, folder):
    return shown(quantiles.group_quartiles(samples.survey(spark, folder), ["category", "item_name"], "price"))


@query
def group_quartiles_approx(spark, folder):
    """Whether each approximate quartile lies within its rank error, by ranks counted over all rows."""
    grouped = rows.explode_groups(samples.survey(spark, folder), groups=samples.ITEM_GROUPS)
    sketch = quantiles.approx_group_quartiles(grouped, ["item_group"], "price", rules.QUARTILE_ERROR)
    return _rank_checked(grouped, sketch, ["item_group"], {"q1": 0.25, "q3": 0.75}, rules.QUARTILE_ERROR)


def _rank_checked(df: DataFrame, sketch: DataFrame, keys: list[str], probs: dict[str, float], error: float) -> DataFrame:
    """Keys, `n_values`, and per quantile whether the rows below and up to it embrace the wanted share, give or take `error`."""
    joined = df.filter(F.col("price").isNotNull()).join(sketch, keys)
    counts = [
        f(F.col("price"), F.col(name)).alias(f"{side}_{name}")
        for name in probs
        for side, f in (("below", lambda p, q: F.count_if(p < q)), ("upto", lambda p, q: F.count_if(p <= q)))
    ]
    counted = joined.groupBy(*keys, "n_values").agg(*counts)
    near = [
        (
            (F.col(f"below_{name}") <= (p + error) * F.col("n_values") + 1)
            & (F.col(f"upto_{name}") >= (p - error) * F.col("n_values") - 1)
        ).alias(f"{name}_near")
        for name, p in probs.items()
    ]
    return counted.select(*keys, "n_values", *near)


@query
def iqr_by_item(spark, folder):
    return outliers.remove_outliers(samples.survey(spark, folder), ["category", "item_name"])


def _item_rows(spark, folder, approximate=False):
    survey = samples.survey(spark, folder)
    return plan.item_rows(survey, samples.ITEM_GROUPS, samples.UNIT_FIXES, approximate, samples.ITEM_CATEGORIES)


def _grouped_items(spark, folder):
    survey = samples.survey(spark, folder)
    return plan.grouped_items(survey, samples.ITEM_GROUPS, samples.UNIT_FIXES, samples.ITEM_CATEGORIES)


@query
def iqr_by_group(spark, folder):
    return _item_rows(spark, folder)


@query
def iqr_by_group_approx(spark, folder):
    """Per group: rows, and whether the kept ones number between those inside the tightest and the widest fences.

    A quartile off by its rank error lies between the exact quantiles of the shares around it.
    """
    every = _grouped_items(spark, folder)
    kept = profile.value_counts(_item_rows(spark, folder, approximate=True), ["item_group"]).withColumnRenamed("n_rows", "kept")
    e = rules.QUARTILE_ERROR + 0.01
    around = quantiles.exact_quantiles(
        every, ["item_group"], "price", {"q1_low": 0.25 - e, "q1_high": 0.25 + e, "q3_low": 0.75 - e, "q3_high": 0.75 + e}
    ).drop("n_values")

    def inside(q1: str, q3: str):
        reach = (F.col(q3) - F.col(q1)) * rules.FENCE_FACTOR
        return F.count_if(F.col("price").between(F.col(q1) - reach, F.col(q3) + reach))

    counted = every.join(around, "item_group").groupBy("item_group").agg(
        F.count(F.lit(1)).alias("n_rows"), inside("q1_high", "q3_low").alias("least"), inside("q1_low", "q3_high").alias("most")
    )
    near = F.col("kept").between(F.col("least"), F.col("most")) & (F.col("kept") < F.col("n_rows"))
    return counted.join(kept, "item_group").select("item_group", "n_rows", near.alias("kept_near"))


@query
def iqr_removed_counts(spark, folder):
    return outliers.removed_counts(_grouped_items(spark, folder), ["item_group"])


# Volatility ----------------------------------------------------------------------------------------------


def _volatility(level: str, clean: bool = False, zero_cv: bool = False) -> Query:
    def run(spark, folder):
        df = samples.survey(spark, folder)
        if clean:
            df = plan.without_outliers(df)
        return shown(vol.volatility(df, vol.LEVELS[level], zero_cv=zero_cv))

    return run


vol_district = _volatility("district")
QUERIES["vol_district"] = vol_district


@query
def vol_district_cv0(spark, folder):
    """One district has only zero prices, so that its mean is 0."""
    free = F.when(F.col("district_name") == "NATION_8", 0.0).otherwise(F.col("price"))
    df = samples.survey(spark, folder).withColumn("price", free)
    return shown(vol.volatility(df, vol.LEVELS["district"], zero_cv=True))


QUERIES["vol_district_year"] = _volatility("district_year")
QUERIES["vol_district_month"] = _volatility("district_month")
QUERIES["vol_category_year"] = _volatility("category_year")
QUERIES["vol_category_month"] = _volatility("category_month")
QUERIES["vol_cat_district_year"] = _volatility("category_district_year")
QUERIES["vol_cat_district_month"] = _volatility("category_district_month")
QUERIES["vol_district_year_clean"] = _volatility("district_year", clean=True)
QUERIES["vol_category_year_clean"] = _volatility("category_year", clean=True)
QUERIES["vol_category_month_clean"] = _volatility("category_month", clean=True)


@query
def vol_item_year(spark, folder):
    return shown(vol.volatility(_item_rows(spark, folder), [vol.GROUP, vol.YEAR]))


@query
def vol_item_month(spark, folder):
    return shown(vol.volatility(_item_rows(spark, folder), [vol.GROUP, vol.MONTH]))


@query
def vol_grouping_sets(spark, folder):
    return shown(vol.volatility_levels(samples.survey(spark, folder)))


# Profiles ------------------------------------------------------------------------------------------------

_PROFILED = ["market_name", "district_name", "item_name", "price", "year_month", "remark"]


@query
def distinct_values(spark, folder):
    return profile.distinct_values(samples.survey_raw(spark, folder), "year_month")


@query
def distinct_profile(spark, folder):
    return profile.distinct_profile(samples.survey_raw(spark, folder), _PROFILED)


@query
def distinct_profile_values(spark, folder):
    return profile.column_values(samples.survey_raw(spark, folder), _PROFILED)


@query
def null_profile(spark, folder):
    return profile.null_profile(columns.null_tokens(samples.survey_raw(spark, folder)))


@query
def price_quality(spark, folder):
    return profile.price_quality(columns.to_number(samples.survey_raw(spark, folder), "price"))


@query
def row_counts(spark, folder):
    """All logged stages; those that only filter rows are counted together, in one scan."""
    raw = samples.survey_raw(spark, folder)
    dated = F.col("year_month").isNotNull()
    filtered = raw.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(dated).alias("with_year_month"),
        F.count_if(dated & ~F.lower("year_month").isin("nan", "") & F.col("item_name").isNotNull()).alias("clean"),
    ).select(F.stack(F.lit(3), *[x for c in ("raw", "with_year_month", "clean") for x in (F.lit(c), F.col(c))]).alias("stage", "n_rows"))
    ready = plan.stored(prepared(spark, folder))
    priced = plan.stored(rows.drop_zero(ready))
    later = {"without_high_zero_items": ready, "without_zeros": priced, "inside_fences": plan.without_outliers(priced)}
    return rows.union_by_position(
        filtered, *[profile.row_count(df).select(F.lit(name).alias("stage"), "n_rows") for name, df in later.items()]
    )


@query
def category_counts(spark, folder):
    raw = samples.survey_raw(spark, folder).na.drop(subset=["item_name"])
    labelled = columns.assign_category(raw, ordered_rules=samples.CATEGORY_RULES, other=samples.OTHER)
    return profile.category_counts(labelled, other=samples.OTHER)


@query
def price_summary(spark, folder):
    return shown(profile.price_summary(samples.survey(spark, folder)))


@query
def describe_all(spark, folder):
    df = samples.survey(spark, folder)
    return shown(profile.describe_all(df, df.columns))


@query
def item_value_counts(spark, folder):
    counts = profile.value_counts(iqr_by_item(spark, folder), ["category", "item_name"])
    return rows.ranked(counts, "n_rows", "category", "item_name")


@query
def item_year_coverage(spark, folder):
    covered = profile.year_coverage(samples.survey(spark, folder), ["category", "item_name"])
    return covered.withColumn("years", F.array_join("years", ","))


@query
def items_all_years(spark, folder):
    named = samples.survey(spark, folder).withColumn("key", F.concat_ws("/", "market_name", "item_name"))
    return profile.keys_in_all_years(named, "key")


@query
def groups_all_years(spark, folder):
    grouped = rows.explode_groups(samples.survey(spark, folder), groups=samples.ITEM_GROUPS)
    return profile.keys_in_all_years(grouped, "item_group", years=list(range(1996, 2000)))


@query
def items_by_category(spark, folder):
    return profile.items_by_category(samples.survey(spark, folder))


@query
def item_profile(spark, folder):
    df = samples.survey(spark, folder)
    chosen = df.filter(F.col("category").isin(*samples.ITEM_CATEGORIES))
    chosen = chosen.filter(keywords.matches_any(F.col("item_name"), samples.PROFILE_ITEMS))
    return shown(profile.item_profile(chosen))


# Titles --------------------------------------------------------------------------------------------------


@query
def tfidf_weights(spark, folder):
    return shown(similarity.tfidf_weights(samples.titles(spark, folder), "listing_id", "title"))


@query
def tfidf_match(spark, folder):
    return shown(similarity.max_similarity(samples.titles(spark, folder), "listing_id", "title", samples.TARGETS))


@query
def tfidf_documents(spark, folder):
    docs = samples.documents(spark, folder)
    return shown(similarity.max_similarity(docs, "doc_id", "text", samples.DOCUMENT_TARGETS, limit=None))


# Whole jobs ----------------------------------------------------------------------------------------------


@query
def prepared_survey(spark, folder):
    return shown(prepared(spark, folder))


@query
def survey_report(spark, folder):
    return shown(plan.volatility_report(prepared(spark, folder)))


@query
def survey_report_clean(spark, folder):
    ready = plan.stored(prepared(spark, folder))
    return shown(plan.volatility_report(ready, drop_outliers=True))


@query
def item_report(spark, folder):
    ready = plan.stored(prepared(spark, folder))
    fixes, categories = [("old bolt(Brand#1) 1ea", 2, "1ea")], samples.ASSIGNED_CATEGORIES
    return shown(plan.item_report(ready, groups=samples.ITEM_GROUPS, fixes=fixes, categories=categories))
