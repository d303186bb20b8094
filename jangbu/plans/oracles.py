"""SQL over the test tables with the meaning of each catalog query."""

from __future__ import annotations

SURVEY = """
survey AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, s_name AS market_name, n_name AS district_name,
         p_type AS category, p_name AS item_name, p_brand AS sales_unit, l_returnflag AS remark,
         CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         concat(CAST(year(l_shipdate) AS VARCHAR), '-', lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0')) AS year_month,
         CASE WHEN l_discount < CASE WHEN p_name LIKE '%bolt' THEN 0.035 WHEN p_name LIKE 'hot%' THEN 0.015
                                     ELSE -1.0 END
              THEN CAST(0 AS DOUBLE) WHEN (l_orderkey * 10 + l_linenumber) % 83 = 5 THEN l_extendedprice * 40
              ELSE l_extendedprice END AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""

RAW = (
    SURVEY
    + """,
raw AS (
  SELECT CAST(id AS VARCHAR) AS id, market_name, district_name,
         CASE WHEN id % 60 = 5 THEN NULL ELSE concat(item_name, '(', sales_unit, ') 1ea') END AS item_name,
         CASE WHEN id % 40 = 3 THEN 'N/A' ELSE CAST(price AS VARCHAR) END AS price,
         CASE WHEN id % 50 = 2 THEN NULL WHEN id % 50 = 7 THEN 'nan'
              WHEN id % 50 = 14 THEN concat(CAST(year AS VARCHAR), '-xx')
              WHEN month = 3 AND id % 10 = 1 THEN concat(CAST(year AS VARCHAR), '-.3')
              ELSE year_month END AS year_month,
         CASE WHEN id % 7 = 0 THEN '' ELSE concat(remark, '";', sales_unit) END AS remark
  FROM survey
)"""
)


def _round(expression: str, digits: int = 4) -> str:
    """Rounded with the offset the queries use."""
    return f"round(({expression}) + 1e-{digits + 3}, {digits})"


def _base_name(column: str) -> str:
    return f"trim(split_part({column}, '(', 1))"


def _category(column: str) -> str:
    b = _base_name(column)

    def any_of(*words):
        return "(" + " OR ".join(f"contains({b}, '{w}')" for w in words) + ")"

    return (
        f"CASE WHEN {any_of('bolt', 'rod')} THEN 'fast' WHEN {any_of('ring', 'gear')} THEN 'ringed' "
        f"WHEN {any_of('hot', 'cold')} THEN 'heat' ELSE 'other' END"
    )


_PARSED = """CAST(TRY_CAST(substr(year_month, 1, 4) AS BIGINT) AS BIGINT) AS year,
  CAST(CASE WHEN coalesce(TRY_CAST(substr(year_month, 6, 2) AS DOUBLE), 0) = 0.3 THEN 3
       ELSE coalesce(TRY_CAST(substr(year_month, 6, 2) AS DOUBLE), 0) END AS INTEGER) AS month"""

CLEAN = (
    RAW
    + f""",
clean AS (
  SELECT market_name, district_name, item_name, TRY_CAST(price AS DOUBLE) AS price, year_month,
         nullif(split_part(remark, '";', 1), '') AS remark, {_PARSED}
  FROM raw WHERE year_month IS NOT NULL AND year_month <> 'nan' AND item_name IS NOT NULL
)"""
)


def _repaired(source: str, prefix: str) -> str:
    return f""",
{prefix}ratio AS (
  SELECT item_name, 100.0 * count(*) FILTER (WHERE price = 0) / count(price) AS r FROM {source}
  WHERE item_name IS NOT NULL GROUP BY item_name
),
{prefix}med AS (SELECT item_name, year, median(price) AS m FROM {source} GROUP BY item_name, year),
{prefix}fixed AS (
  SELECT s.* REPLACE (CASE WHEN s.price = 0 AND r > 0 AND r <= 30 THEN coalesce(m, s.price) ELSE s.price END AS price),
         r
  FROM {source} s LEFT JOIN {prefix}ratio q ON s.item_name = q.item_name
  LEFT JOIN {prefix}med d ON s.item_name = d.item_name AND s.year = d.year
)"""


PREPARED = (
    CLEAN
    + _repaired("clean", "c")
    + f""",
prepared AS (
  SELECT * EXCLUDE (r), {_category('item_name')} AS category FROM cfixed WHERE coalesce(r, 0) <= 30
)"""
)


def _kept(source: str, keys: str, name: str) -> str:
    """CTE of the rows of `source` inside the fences of their group."""
    return f""",
{name}_q AS (
  SELECT {keys}, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM {source} GROUP BY {keys}
),
{name} AS (
  SELECT s.* FROM {source} s JOIN {name}_q USING ({keys})
  WHERE price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
)"""


GROUPED = (
    SURVEY
    + """,
grouped AS (
  SELECT survey.*, g.item_group FROM survey
  JOIN (VALUES ('old'), ('hot'), ('ring')) AS g(item_group) ON contains(item_name, g.item_group)
),
fixed_units AS (
  SELECT * REPLACE (CASE WHEN item_name = 'old bolt' THEN price / 2 ELSE price END AS price,
                    CASE WHEN item_name = 'old bolt' THEN '1ea' ELSE sales_unit END AS sales_unit)
  FROM grouped WHERE category IN ('ECONOMY', 'STANDARD', 'PROMO')
)"""
)
GROUP_ROWS = GROUPED + _kept("fixed_units", "item_group", "group_rows")
ITEM_ROWS = SURVEY + _kept("survey", "category, item_name", "item_rows")


def _measures(zero_cv: bool = False) -> str:
    ratio = "CASE WHEN avg(price) <> 0 THEN stddev_samp(price) / avg(price) ELSE 0 END" if zero_cv else (
        "stddev_samp(price) / nullif(avg(price), 0)"
    )
    return (
        f"{_round('avg(price)')} AS mean, {_round('stddev_samp(price)')} AS std, count(price) AS count, "
        f"{_round(ratio, 6)} AS cv"
    )


def _vol(with_: str, source: str, keys: str, zero_cv: bool = False) -> str:
    return f"WITH {with_} SELECT {keys}, {_measures(zero_cv)} FROM {source} GROUP BY {keys}"


def _levels(with_: str, source: str, levels: dict[str, list[str]]) -> str:
    keys = list(dict.fromkeys(k for level in levels.values() for k in level))
    return f"WITH {with_} " + " UNION ALL ".join(
        f"SELECT '{name}' AS level, "
        + ", ".join(k if k in level else f"NULL AS {k}" for k in keys)
        + f", {_measures()} FROM {source} WHERE "
        + " AND ".join(f"{k} IS NOT NULL" for k in level)
        + f" GROUP BY {', '.join(level)}"
        for name, level in levels.items()
    )


_LEVELS = {
    "district": ["district_name"],
    "district_year": ["district_name", "year"],
    "district_month": ["district_name", "month"],
    "category_year": ["category", "year"],
    "category_month": ["category", "month"],
    "category_district_year": ["category", "district_name", "year"],
    "category_district_month": ["category", "district_name", "month"],
}
_ITEM_LEVELS = {"item_year": ["item_group", "year"], "item_month": ["item_group", "month"]}

_RATIO = _round("coalesce(100.0 * count(*) FILTER (WHERE price = 0) / nullif({total}, 0), 0)", 6) + " AS zero_ratio"
_ZEROS = "count(*) FILTER (WHERE price = 0) AS zero_count"
_BANDS = (
    SURVEY
    + f""",
ratio AS (
  SELECT item_name, count(price) AS total_count, {_ZEROS},
         100.0 * count(*) FILTER (WHERE price = 0) / count(price) AS r FROM survey GROUP BY item_name
),
bands AS (SELECT *, CASE WHEN r > 30 THEN 'high' WHEN r > 0 THEN 'low' ELSE 'none' END AS band FROM ratio)"""
)

_TOKENS = r"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def _tfidf(texts: str, key: str, targets: list[str]) -> str:
    """CTEs `weights` (key, gram, weight) and `scores` (key, max_similarity)."""
    values = ", ".join(f"('{t}')" for t in targets)

    def grams(source: str, k: str, text: str) -> str:
        return f"""
  SELECT {k}, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS gram
  FROM (SELECT {k}, {_TOKENS.format(text=text)} AS w FROM {source} WHERE {text} IS NOT NULL)"""

    return f"""
texts AS ({texts}),
tf AS (SELECT {key}, gram, count(*) AS tf FROM ({grams('texts', key, 'body')}) GROUP BY ALL),
idf AS (
  SELECT gram, ln((1.0 + (SELECT count(*) FROM texts WHERE body IS NOT NULL)) / (1.0 + count(*))) + 1 AS idf
  FROM tf GROUP BY gram
),
w0 AS (SELECT {key}, gram, tf * idf AS w FROM tf JOIN idf USING (gram)),
weights AS (SELECT {key}, gram, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM w0),
targets AS (SELECT * FROM (VALUES {values}) AS t(target)),
t0 AS (
  SELECT target, gram, count(*) * any_value(idf) AS w
  FROM ({grams('targets', 'target', 'target')}) JOIN idf USING (gram) GROUP BY ALL
),
tw AS (SELECT target, gram, w / sqrt(sum(w * w) OVER (PARTITION BY target)) AS tweight FROM t0),
sims AS (SELECT {key}, target, sum(weight * tweight) AS s FROM weights JOIN tw USING (gram) GROUP BY ALL),
scores AS (SELECT {key}, max(s) AS max_similarity FROM sims GROUP BY ALL)"""


_TITLES = "SELECT p_partkey AS listing_id, concat(p_name, ' ', p_type) AS body FROM part"
_TITLE_ROWS = "SELECT p_partkey AS listing_id, concat(p_name, ' ', p_type) AS title FROM part"
_DOCS = "SELECT doc_id, text AS body FROM documents"
_TITLE_TARGETS = ["bolt", "ring", "hot gear"]
_DOC_TARGETS = ["the", "que les", "der und", "los de la"]


def _plain(html: str) -> str:
    out = f"regexp_replace({html}, '<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return f"trim({out})"


_LI = r"(?s)<li\b[^>]*>(.*?)</li>"
_ARTICLE = r"(?s)<article\b[^>]*>(.*?)</article>"
_H1 = r"(?s)<h1\b[^>]*>(.*?)</h1>"
_P = r"(?s)<p\b[^>]*>(.*?)</p>"
_A = r"(?s)<a\b[^>]*>(.*?)</a>"
_HREF = r'<a\b[^>]*\bhref="([^"]*)"'
_FRAGMENTS = rf"""
lists AS (SELECT page_id, regexp_extract_all(html, '{_LI}', 1) AS li FROM pages),
fragments AS (
  SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, li[i] AS frag
  FROM (SELECT page_id, li, unnest(range(1, len(li) + 1)) AS i FROM lists)
)"""
_HREF_ID = rf"split_part(list_last(string_split(regexp_extract(frag, '{_HREF}', 1), '/')), '?', 1)"

_CUSTOMERS = "c_name AS name, c_nationkey AS nation, c_acctbal AS balance"
_SUPPLIERS = "s_name AS name, s_nationkey AS nation, s_acctbal AS balance"
_SHOP_TEXTS = (
    "SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, CAST(c_acctbal AS VARCHAR) AS balance{c} "
    "FROM customer UNION ALL "
    "SELECT s_name, CAST(s_nationkey AS VARCHAR), CAST(s_acctbal AS VARCHAR){s} FROM supplier"
)

_RAW_COLUMNS = "id, market_name, district_name, item_name, price, year_month, remark"
_SURVEY_ORDER = "id, market_name, district_name, category, item_name, sales_unit, remark, year, month, year_month, price"
_PROFILED = ["market_name", "district_name", "item_name", "price", "year_month", "remark"]
_DESCRIBE = ", ".join(
    f"{_round(expression)} AS {name}"
    for name, expression in {
        "mean": "avg(price)",
        "std": "stddev_samp(price)",
        "min": "min(price)",
        "p25": "quantile_cont(price, 0.25)",
        "p50": "quantile_cont(price, 0.5)",
        "p75": "quantile_cont(price, 0.75)",
        "max": "max(price)",
    }.items()
)


def _describe_text(c: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
  (SELECT {c} FROM survey WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
  max(n) AS freq, NULL AS mean, NULL AS std, NULL AS min, NULL AS p25, NULL AS p50, NULL AS p75, NULL AS max
  FROM (SELECT {c}, count(*) AS n FROM survey WHERE {c} IS NOT NULL GROUP BY {c})"""


def _describe_number(c: str) -> str:
    measures = _DESCRIBE.replace("(price", f"({c}")
    return f"""SELECT '{c}' AS "column", count({c}) AS count, NULL AS "unique", NULL AS top, NULL AS freq, {measures}
  FROM survey"""


def _mode(c: str) -> str:
    return f"""coalesce((SELECT {c} FROM survey t WHERE t.category = s.category AND t.item_name = s.item_name
  AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), 'nan') AS {c}"""


def _all_raw(**changed: str) -> str:
    names = _RAW_COLUMNS.split(", ")
    return ", ".join(f"{changed[n]} AS {n}" if n in changed else n for n in names)


_NO_EMPTY = "nullif(remark, '')"
_CUT = """split_part(remark, '";', 1)"""

ORACLES: dict[str, str] = {
    # sources
    "scan_csv": f"WITH {RAW} SELECT {_all_raw(remark=_NO_EMPTY)} FROM raw",
    "scan_by_name": f"WITH {RAW} SELECT "
    + _all_raw(remark="concat('a \"', remark, '\",', chr(10), 'end')")
    + " FROM raw",
    "scan_csv_inferred": "SELECT * FROM part",
    "scan_dialects": _SHOP_TEXTS.format(c="", s=""),
    "scan_many": _SHOP_TEXTS.format(c=", 'customer' AS source", s=", 'supplier'"),
    "scan_unlike_headers": _SHOP_TEXTS.format(c="", s=""),
    "scan_unlike_inferred": f"SELECT {_CUSTOMERS}, false AS has_more FROM customer UNION ALL SELECT {_SUPPLIERS}, true FROM supplier",
    "scan_missing_ok": _SHOP_TEXTS.format(c="", s=""),
    "scan_whitelist": "SELECT s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation, "
    "CAST(s_acctbal AS VARCHAR) AS balance, 'supplier' AS source FROM supplier",
    "xml_rows": f"WITH {RAW} SELECT {_all_raw(remark=_NO_EMPTY)} FROM raw",
    "xml_pages": f"WITH {RAW} SELECT {_all_raw(remark=_NO_EMPTY)} FROM raw",
    "xml_quarantine": f"WITH {RAW} SELECT 'good' AS kind, {_all_raw(remark=_NO_EMPTY)} FROM raw WHERE CAST(id AS BIGINT) % 97 <> 3 "
    "UNION ALL BY NAME SELECT 'broken' AS kind, id FROM raw WHERE CAST(id AS BIGINT) % 97 = 3",
    "html_tiles": rf"""WITH {_FRAGMENTS.replace(_LI, _ARTICLE)}
SELECT page_id, pos,
       CASE WHEN regexp_matches(frag, '{_H1}') THEN {_plain(f"regexp_extract(frag, '{_H1}', 1)")} END AS name,
       CASE WHEN regexp_matches(frag, '{_P}') THEN {_plain(f"regexp_extract(frag, '{_P}', 1)")} END AS price FROM fragments""",
    "listing_job": rf"""WITH {_FRAGMENTS},
items AS (SELECT page_id, pos, {_HREF_ID} AS product_id, {_plain(f"regexp_extract(frag, '{_A}', 1)")} AS title
          FROM fragments WHERE regexp_matches(frag, '{_HREF}')),
firsts AS (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY page_id, pos) = 1)
SELECT page_id, pos, product_id, title FROM firsts
WHERE (contains(title, 'th') OR contains(title, 'en')) AND NOT contains(title, 'er')""",
    "href_product_id": "SELECT page_id, split_part(list_last(string_split(url, '/')), '?', 1) AS product_id FROM pages",
    "dedup_first": rf"""WITH {_FRAGMENTS},
items AS (SELECT page_id, pos, {_HREF_ID} AS product_id, {_plain(f"regexp_extract(frag, '{_A}', 1)")} AS title
          FROM fragments WHERE regexp_matches(frag, '{_HREF}'))
SELECT page_id, pos, product_id, title FROM items
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY page_id, pos) = 1""",
    # sinks
    "sink_csv": f"WITH {SURVEY} SELECT * FROM survey",
    "sink_csv_bom": f"WITH {SURVEY} SELECT *, true AS marked FROM survey",
    "sink_single": _vol(SURVEY, "survey", "district_name"),
    "sink_by_category": f"WITH {SURVEY} SELECT * FROM survey",
    "sink_by_group": f"WITH {GROUP_ROWS} SELECT * FROM group_rows",
    "category_tables": f"WITH {PREPARED} SELECT item_name, {_round('price')} AS price, year, month, remark, category "
    "FROM prepared WHERE category IN ('fast', 'ringed')",
    "sink_volatility": f"""WITH {GROUP_ROWS}
SELECT item_group, year AS period, {_measures()}, 'yearly' AS kind FROM group_rows GROUP BY item_group, year
UNION ALL
SELECT item_group, CAST(month AS BIGINT), {_measures()}, 'monthly' FROM group_rows GROUP BY item_group, month""",
    # columns
    "rename_map": f"WITH {RAW} SELECT id AS serial, market_name AS market, * EXCLUDE (id, market_name) FROM raw",
    "drop_cols": f"WITH {RAW} SELECT * EXCLUDE (id) FROM raw",
    "drop_cols_like": f"WITH {SURVEY} SELECT * EXCLUDE (market_name, district_name, item_name) FROM survey",
    "trim_names": f"WITH {RAW} SELECT * FROM raw",
    "align_schema": f"WITH {RAW} SELECT "
    + _all_raw(id="CAST(id AS BIGINT)", price="TRY_CAST(price AS DOUBLE)", year_month="CAST(NULL AS DOUBLE)")
    + " FROM raw",
    "common_cols": f"SELECT {_CUSTOMERS} FROM customer",
    "coerce_numeric": f"WITH {RAW} SELECT id, item_name, TRY_CAST(price AS DOUBLE) AS price FROM raw",
    "parse_year_month": f"WITH {RAW} SELECT id, item_name, year_month, {_PARSED} FROM raw "
    "WHERE year_month IS NOT NULL AND year_month <> 'nan'",
    "text_repair": f"WITH {RAW} SELECT {_all_raw(remark=_CUT)} FROM raw",
    "null_tokens": f"""WITH {RAW} SELECT * REPLACE (nullif(remark, '') AS remark, nullif(year_month, 'nan') AS year_month)
FROM raw""",
    "fill_defaults": f"""WITH {RAW} SELECT * REPLACE (coalesce(item_name, '') AS item_name,
coalesce(year_month, '') AS year_month) FROM raw""",
    "clean_item_name": f"WITH {RAW} SELECT id, item_name, {_base_name('item_name')} AS base_name FROM raw",
    "assign_category": f"WITH {RAW} SELECT id, item_name, {_category('item_name')} AS item_category FROM raw "
    "WHERE item_name IS NOT NULL",
    "unit_fix": f"""WITH {SURVEY} SELECT * REPLACE (CASE WHEN item_name = 'old bolt' THEN price / 2 ELSE price END AS price,
CASE WHEN item_name = 'old bolt' THEN '1ea' ELSE sales_unit END AS sales_unit) FROM survey""",
    "price_text": """SELECT l_orderkey, l_linenumber, format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) || '원'
AS price_text, CAST(floor(l_extendedprice) AS BIGINT) AS price FROM lineitem""",
    "unit_price_parts": """SELECT p_partkey,
'(' || p_size || 'g당 ' || format('{:,}', CAST(floor(p_retailprice) AS BIGINT)) || '원)' AS unit_price,
CAST(p_size AS DOUBLE) AS quantity, 'g' AS unit, CAST(floor(p_retailprice) AS BIGINT) AS price FROM part""",
    "item_groups": f"WITH {GROUPED} SELECT * FROM grouped",
    "rounded_view": f"""WITH {SURVEY} SELECT district_name, year, round_even(avg(price), 2) AS mean,
round_even(stddev_samp(price), 2) AS std, count(price) AS count,
round_even(stddev_samp(price) / nullif(avg(price), 0), 2) AS cv FROM survey GROUP BY district_name, year""",
    # rows
    "drop_null_keys": f"WITH {RAW} SELECT * FROM raw WHERE year_month IS NOT NULL AND item_name IS NOT NULL",
    "filter_eq": f"WITH {SURVEY} SELECT * FROM survey WHERE category = 'ECONOMY'",
    "market_isin": f"WITH {SURVEY} SELECT * FROM survey WHERE market_name IN ("
    + ", ".join(f"'Supplier#00000000{i}'" for i in range(5))
    + ")",
    "contains_keyword": f"WITH {RAW} SELECT * FROM raw WHERE contains(item_name, 'old')",
    "title_include": f"SELECT * FROM ({_TITLE_ROWS}) WHERE contains(title, 'widget') OR contains(title, 'gear')",
    "item_alternation": f"WITH {RAW} SELECT * FROM raw WHERE regexp_matches(item_name, 'bolt|ring|hot')",
    "title_include_exclude": f"SELECT * FROM ({_TITLE_ROWS}) WHERE (contains(title, 'widget') OR "
    "contains(title, 'gear')) AND NOT contains(title, 'old')",
    "date_prefix": f"WITH {RAW} SELECT * FROM raw WHERE starts_with(year_month, '1999')",
    "drop_zero_price": f"""WITH {RAW}, typed AS (SELECT * REPLACE (TRY_CAST(price AS DOUBLE) AS price) FROM raw)
SELECT * FROM typed WHERE price IS DISTINCT FROM 0""",
    "head_slice": f"""WITH {SURVEY}, numbered AS (
  SELECT *, row_number() OVER (ORDER BY {_SURVEY_ORDER}) AS rn, count(*) OVER () AS n FROM survey)
SELECT * EXCLUDE (rn, n) FROM numbered WHERE rn <= n - 500""",
    "preview_top_n": f"WITH {SURVEY} SELECT * FROM survey ORDER BY {_SURVEY_ORDER} LIMIT 10",
    "preview_last_n": f"WITH {SURVEY} SELECT * FROM survey ORDER BY "
    + ", ".join(f"{c} DESC" for c in _SURVEY_ORDER.split(", "))
    + " LIMIT 5",
    "union_position": f"SELECT {_CUSTOMERS} FROM customer UNION ALL SELECT {_SUPPLIERS} FROM supplier",
    "union_common": f"SELECT {_CUSTOMERS} FROM customer UNION ALL SELECT {_SUPPLIERS} FROM supplier",
    "union_outer": f"""SELECT c_custkey AS customer_id, {_CUSTOMERS}, c_mktsegment AS segment, NULL AS supplier_id
FROM customer UNION ALL SELECT NULL, {_SUPPLIERS}, NULL, s_suppkey FROM supplier""",
    # zero prices
    "zero_ratio_by_item": f"WITH {SURVEY} SELECT item_name, count(price) AS total_count, {_ZEROS}, "
    f"{_RATIO.format(total='count(price)')} FROM survey GROUP BY item_name",
    "zero_ratio_inner": f"WITH {SURVEY} SELECT item_name, count(*) AS total_count, {_ZEROS}, "
    f"{_RATIO.format(total='count(*)')} FROM survey GROUP BY item_name HAVING count(*) FILTER (WHERE price = 0) > 0",
    "zero_ratio_bands": f"WITH {_BANDS} SELECT item_name, total_count, zero_count, {_round('r', 6)} AS zero_ratio, band FROM bands",
    "low_zero_rows": f"WITH {_BANDS} SELECT survey.* FROM survey SEMI JOIN (SELECT * FROM bands WHERE band = 'low') b USING (item_name)",
    "drop_high_zero_items": f"WITH {_BANDS} SELECT survey.* FROM survey ANTI JOIN (SELECT * FROM bands WHERE band = 'high') b USING (item_name)",
    "item_year_median": f"WITH {SURVEY} SELECT item_name, year, {_round('median(price)')} AS median, count(price) AS n_values "
    "FROM survey GROUP BY item_name, year",
    "item_month_median_approx": f"WITH {SURVEY} SELECT item_name, year_month, count(price) AS n_values, true AS median_near "
    "FROM survey GROUP BY item_name, year_month",
    "impute_zero_year_median": f"WITH {SURVEY}{_repaired('survey', 's')} "
    f"SELECT * EXCLUDE (r) REPLACE ({_round('price')} AS price) FROM sfixed",
    "impute_zero_month_approx": f"""WITH {SURVEY}{_repaired('survey', 's')},
month_med AS (SELECT item_name, year_month, quantile_disc(price, 0.5) AS m FROM survey GROUP BY item_name, year_month)
SELECT s.* REPLACE (CASE WHEN s.price = 0 THEN CASE WHEN r > 0 AND r <= 30 THEN m END ELSE s.price END AS price)
FROM survey s JOIN sratio USING (item_name) JOIN month_med m USING (item_name, year_month) WHERE r <= 30""",
    # outliers
    "item_quartiles": f"""WITH {SURVEY} SELECT category, item_name, {_round("quantile_cont(price, 0.25)")} AS q1,
{_round("quantile_cont(price, 0.75)")} AS q3, count(price) AS n_values FROM survey GROUP BY category, item_name""",
    "iqr_by_item": f"WITH {ITEM_ROWS} SELECT * FROM item_rows",
    "group_quartiles_approx": f"WITH {GROUPED} SELECT item_group, count(price) AS n_values, true AS q1_near, true AS q3_near "
    "FROM grouped GROUP BY item_group",
    "iqr_by_group_approx": f"WITH {GROUPED} SELECT item_group, count(*) AS n_rows, true AS kept_near "
    "FROM fixed_units GROUP BY item_group",
    "iqr_by_group": f"WITH {GROUP_ROWS} SELECT * FROM group_rows",
    "iqr_removed_counts": f"""WITH {GROUP_ROWS},
kept AS (SELECT item_group, count(*) AS k FROM group_rows GROUP BY item_group)
SELECT item_group, count(*) AS n_rows, count(*) - any_value(k) AS n_removed
FROM fixed_units JOIN kept USING (item_group) GROUP BY item_group""",
    # volatility
    "vol_district": _vol(SURVEY, "survey", "district_name"),
    "vol_district_cv0": _vol(
        SURVEY + ", free AS (SELECT * REPLACE (CASE WHEN district_name = 'NATION_8' THEN 0 ELSE price END AS price) FROM survey)",
        "free", "district_name", zero_cv=True,
    ),
    "vol_district_year": _vol(SURVEY, "survey", "district_name, year"),
    "vol_district_month": _vol(SURVEY, "survey", "district_name, month"),
    "vol_category_year": _vol(SURVEY, "survey", "category, year"),
    "vol_category_month": _vol(SURVEY, "survey", "category, month"),
    "vol_cat_district_year": _vol(SURVEY, "survey", "category, district_name, year"),
    "vol_cat_district_month": _vol(SURVEY, "survey", "category, district_name, month"),
    "vol_district_year_clean": _vol(ITEM_ROWS, "item_rows", "district_name, year"),
    "vol_category_year_clean": _vol(ITEM_ROWS, "item_rows", "category, year"),
    "vol_category_month_clean": _vol(ITEM_ROWS, "item_rows", "category, month"),
    "vol_item_year": _vol(GROUP_ROWS, "group_rows", "item_group, year"),
    "vol_item_month": _vol(GROUP_ROWS, "group_rows", "item_group, month"),
    "vol_grouping_sets": _levels(SURVEY, "survey", _LEVELS),
    # profiles
    "distinct_values": f"WITH {RAW} SELECT DISTINCT year_month FROM raw",
    "distinct_profile": f"WITH {RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_distinct FROM (SELECT DISTINCT {c} FROM raw)" for c in _PROFILED
    ),
    "distinct_profile_values": f"WITH {RAW} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM raw GROUP BY {c}" for c in _PROFILED),
    "null_profile": f"""WITH {RAW}, t AS (SELECT * REPLACE (nullif(remark, '') AS remark,
nullif(year_month, 'nan') AS year_month) FROM raw) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM t" for c in _RAW_COLUMNS.split(", ")
    ),
    "price_quality": f"""WITH {RAW}, t AS (SELECT TRY_CAST(price AS DOUBLE) AS price FROM raw)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE price IS NULL) AS n_null,
count(*) FILTER (WHERE price = 0) AS n_zero FROM t""",
    "row_counts": f"""WITH {PREPARED}, priced AS (SELECT * FROM prepared WHERE price IS DISTINCT FROM 0)
{_kept('priced', 'category, item_name', 'item_rows')} SELECT 'raw' AS stage, count(*) AS n_rows FROM raw
UNION ALL SELECT 'with_year_month', count(*) FROM raw WHERE year_month IS NOT NULL
UNION ALL SELECT 'clean', count(*) FROM clean
UNION ALL SELECT 'without_high_zero_items', count(*) FROM prepared
UNION ALL SELECT 'without_zeros', count(*) FROM priced
UNION ALL SELECT 'inside_fences', count(*) FROM item_rows""",
    "category_counts": f"""WITH {RAW},
c AS (SELECT {_category('item_name')} AS category, count(*) AS n FROM raw WHERE item_name IS NOT NULL GROUP BY 1)
SELECT category, n AS n_rows FROM c
UNION ALL SELECT '(classified)', CAST(sum(n) AS BIGINT) FROM c WHERE category <> 'other'
UNION ALL SELECT '(total)', CAST(sum(n) AS BIGINT) FROM c""",
    "price_summary": f"""WITH {ITEM_ROWS}
SELECT category, 'before' AS stage, count(price) AS count, {_DESCRIBE} FROM survey GROUP BY category
UNION ALL
SELECT category, 'after' AS stage, count(price) AS count, {_DESCRIBE} FROM item_rows GROUP BY category""",
    "describe_all": f"WITH {SURVEY} "
    + " UNION ALL ".join(_describe_text(c) for c in ("market_name", "district_name", "category", "item_name", "sales_unit", "remark", "year_month"))
    + " UNION ALL "
    + " UNION ALL ".join(_describe_number(c) for c in ("id", "year", "month", "price")),
    "item_value_counts": f"WITH {ITEM_ROWS} SELECT category, item_name, count(*) AS n_rows FROM item_rows "
    "GROUP BY category, item_name",
    "item_year_coverage": f"""WITH {SURVEY} SELECT category, item_name,
string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years
FROM (SELECT DISTINCT category, item_name, year FROM survey) GROUP BY category, item_name""",
    "items_all_years": f"""WITH {SURVEY}
SELECT concat_ws('/', market_name, item_name) AS key, count(DISTINCT year) AS n_years FROM survey GROUP BY 1
HAVING count(DISTINCT year) = (SELECT count(DISTINCT year) FROM survey)""",
    "groups_all_years": f"""WITH {GROUPED} SELECT item_group, count(DISTINCT year) AS n_years FROM grouped
WHERE year BETWEEN 1996 AND 1999 GROUP BY item_group HAVING count(DISTINCT year) = 4""",
    "items_by_category": f"WITH {SURVEY} SELECT DISTINCT category, item_name FROM survey",
    "item_profile": f"""WITH {SURVEY} SELECT category, item_name, {_mode('sales_unit')}, {_mode('remark')},
{_round("avg(price)")} AS mean_price, count(*) AS n_rows FROM survey s
WHERE regexp_matches(item_name, 'bolt|ring|hot') AND category IN ('ECONOMY', 'STANDARD', 'PROMO')
GROUP BY category, item_name""",
    # titles
    "tfidf_weights": f"WITH {_tfidf(_TITLES, 'listing_id', _TITLE_TARGETS)} "
    f"SELECT listing_id, gram, {_round('weight', 6)} AS weight FROM weights",
    "tfidf_match": f"WITH {_tfidf(_TITLES, 'listing_id', _TITLE_TARGETS)} "
    f"SELECT listing_id, {_round('max_similarity', 6)} AS max_similarity FROM scores WHERE max_similarity > 0.005",
    "tfidf_documents": f"WITH {_tfidf(_DOCS, 'doc_id', _DOC_TARGETS)} "
    f"SELECT doc_id, {_round('coalesce(max_similarity, 0)', 6)} AS max_similarity FROM texts LEFT JOIN scores USING (doc_id) "
    "WHERE body IS NOT NULL",
    # whole jobs
    "prepared_survey": f"WITH {PREPARED} SELECT * REPLACE ({_round('price')} AS price) FROM prepared",
    "survey_report": _levels(PREPARED, "prepared", _LEVELS),
    "survey_report_clean": _levels(
        PREPARED + _kept("prepared", "category, item_name", "item_rows"), "item_rows", _LEVELS
    ),
    "item_report": _levels(
        PREPARED
        + """,
grouped AS (
  SELECT prepared.* REPLACE (CASE WHEN item_name = 'old bolt(Brand#1) 1ea' THEN price / 2 ELSE price END AS price),
         g.item_group
  FROM prepared JOIN (VALUES ('old'), ('hot'), ('ring')) AS g(item_group) ON contains(item_name, g.item_group)
  WHERE category IN ('fast', 'heat')
)"""
        + _kept("grouped", "item_group", "group_rows"),
        "group_rows",
        _ITEM_LEVELS,
    ),
}
