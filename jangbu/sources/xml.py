"""XML sources: records of the survey API, from files or from stored response texts."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu import schema
from jangbu.session import settle


def _empty_to_null(df: DataFrame) -> DataFrame:
    """An empty element is a missing value."""
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in df.columns])


#: Text of a record that did not parse; NULL for all others.
CORRUPT = "_corrupt_record"
#: Where a record was read, and its text.
FILE, RECORD = "file", "record"


# A record: an empty element, or an opening tag and what follows up to the closing one or, if it breaks off, the end.
_ATTRIBUTES = r"""(?:\s+[^\s=<>/]+\s*=\s*(?:"[^"<]*"|'[^'<]*'))*\s*"""
_ROW = rf"<row{_ATTRIBUTES}(?:/>|>[\s\S]*?(?:</row\s*>|\z))"
_OPENING = r"<row(?:\s[^<>]*[^<>/])?\s*>"
_COMMENT = r"<!--[\s\S]*?-->"


def _as_path(file: str) -> str:
    """A path for readers, which do not decode but expand it, of a file's name as Spark shows it."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", unquote(file))


def _open_at_end(text: Column, opening: str, closing: str) -> Column:
    return text.contains(opening) & ~F.substring_index(text, opening, -1).contains(closing)


def read_rows(
    spark: SparkSession, paths: str | list[str], columns: T.StructType = schema.API, corrupt: bool = False
) -> DataFrame:
    """Every `row` element of XML files.

    Files are cut after the closing tags of records, so a large one is read by many tasks. Only those with such a tag inside a
    comment or CDATA, or with a record inside another, are read whole, each by one task; one look at all texts finds them.
    A file packed with gzip cannot be cut either and is read by one task: who writes such files bounds their records.
    With `corrupt`, a record that does not parse is a row too, with its text (in files read whole, that of the page) in CORRUPT;
    without, it is left out. Neither costs a neighbour.
    """
    kept = T.StructType([*columns.fields, T.StructField(CORRUPT, T.StringType())])
    texts = spark.read.option("lineSep", "/row>").text(paths).select("value", F.col("_metadata.file_path").alias(FILE))
    plain = F.when(F.col("value").contains("<!--"), F.regexp_replace("value", _COMMENT, "")).otherwise(F.col("value"))
    unlike = _open_at_end(F.col("value"), "<!--", "-->") | _open_at_end(F.col("value"), "<![CDATA[", "]]>")
    last = F.substring_index(plain, "</row", -1)
    unlike |= (F.substring_index(last, "<row", 2) != last) & (F.regexp_count(last, F.lit(_OPENING)) > 1)
    # Asked first: holds for all of these, and quickly not for nearly all others.
    unlike = (F.col("value").contains("<!") | (F.substring_index("value", "<row", 2) != F.col("value"))) & unlike
    whole = [r[0] for r in texts.filter(unlike).select(FILE).distinct().collect()]
    if whole:
        texts = texts.filter(~F.col(FILE).isin(whole))
    # What the cut took off is put back; a record that breaks off with its file does not end like this.
    text = F.when(F.col("value").endswith("<"), F.concat(plain, F.lit("/row>"))).otherwise(plain)
    # Nearly all texts hold one record that begins plainly; the pattern, which is much slower, is for the others.
    before = F.substring_index("value", "<row>", 1)
    after = F.substring("value", F.length(before) + len("<row>") + 1, F.lit(2**31 - 1))
    alone = F.col("value").endswith("<") & (F.concat(before, F.lit("<row>"), after) == F.col("value"))
    alone &= ~before.contains("<row") & ~after.contains("<row") & ~F.col("value").contains("</row") & ~F.col("value").contains("<!--")
    cut = F.when(alone, F.array(F.concat(F.lit("<row>"), after, F.lit("/row>")))).otherwise(F.regexp_extract_all(text, F.lit(_ROW), 0))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    pair = lambda r: F.struct(r.alias(RECORD), F.from_xml(r, kept, options).alias("row"))
    found = F.transform(cut, pair)
    # Cut and parsed within the generator and in its outer form, so that Spark repeats neither for the cells or a filter.
    found = texts.select(F.explode_outer(found).alias("_found")).filter(F.col("_found").isNotNull())
    row = F.col("_found.row")
    broken = row.isNull() | row[CORRUPT].isNotNull()
    cells = [F.when(~broken, row[c]).alias(c) for c in columns.names]
    found = found.select(*cells, F.when(broken, F.col(f"_found.{RECORD}")).alias(CORRUPT))
    if not corrupt:
        found = found.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    if whole:
        # Spark answers no query on CORRUPT alone for these.
        mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} if corrupt else {"mode": "DROPMALFORMED"}
        reader = spark.read.format("xml").options(rowTag="row", **mode).schema(kept if corrupt else columns)
        found = found.unionByName(reader.load([_as_path(f) for f in whole]))
    return _empty_to_null(found)


def split_rows(
    spark: SparkSession, paths: str | list[str], columns: T.StructType = schema.API, row_tag: str = "row"
) -> tuple[DataFrame, DataFrame]:
    """(good, bad): the records of XML files, and (file, record) of those that do not parse, from one stored read.

    Files are cut at the opening tags of records, so a large one is read by many tasks, and a broken record costs neither its
    neighbours nor its page: it is kept with its own text. A record that breaks off with its file is bad, one without content
    is no row. Files are in UTF-8; tags inside a record may not begin with the name of its own.
    """
    start, end = f"<{row_tag}", f"</{row_tag}>"
    texts = spark.read.option("lineSep", start).text(paths).select("value", F.col("_metadata.file_path").alias(FILE))
    # What is before the first record, or a tag that only begins alike, does not go on as an opening tag does.
    texts = texts.filter(F.col("value").rlike(r"^(?:\s[^<>]*[^<>/])?\s*>"))
    close = F.when(F.col("value").contains(end), end).otherwise("")
    texts = texts.select(FILE, F.concat(F.lit(start), F.substring_index("value", end, 1), close).alias(RECORD))
    kept = T.StructType([*columns.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_xml(RECORD, kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    broken = F.col("_row").isNull() | F.col(f"_row.{CORRUPT}").isNotNull()
    cells = [F.col(f"_row.{c}").alias(c) for c in columns.names]
    stored = settle(texts.withColumn("_row", parsed).select(FILE, F.when(broken, F.col(RECORD)).alias(RECORD), *cells), "xml_rows")
    good = stored.filter(F.col(RECORD).isNull()).select(*columns.names)
    return _empty_to_null(good), stored.filter(F.col(RECORD).isNotNull()).select(FILE, RECORD)


def rows_from_pages(df: DataFrame, page: str, columns: T.StructType = schema.API) -> DataFrame:
    """Every `row` element of response texts held in a column; a page that does not parse gives no rows."""
    wrapped = T.StructType([T.StructField("row", T.ArrayType(columns))])
    parsed = F.from_xml(F.col(page), wrapped, {"mode": "PERMISSIVE"})
    return _empty_to_null(df.select(F.explode(parsed["row"]).alias("_row")).select("_row.*"))


def api_rows(df: DataFrame, date_prefix: str | None = None) -> DataFrame:
    """Records under canonical names: all, or those whose date starts with a prefix such as a year."""
    kept = df if date_prefix is None else df.filter(F.col("P_DATE").startswith(date_prefix))
    return kept.withColumnsRenamed(schema.API_TAGS)
