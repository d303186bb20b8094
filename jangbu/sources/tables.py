"""CSV sources: columns by name file by file, typed or inferred, several dialects, missing files, whitelists."""

from __future__ import annotations

import csv
import io
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu import schema


class CsvFile(NamedTuple):
    """One landed file and how it is written. `multi_line`: cells may hold line breaks; such a file is not split."""

    path: str
    sep: str = ","
    charset: str = "UTF-8"
    multi_line: bool = False


_WIDE = ("UTF-16", "UTF-32")


def _reader(spark: SparkSession, sep: str = ",", charset: str = "UTF-8", multi_line: bool = False):
    reader = spark.read.options(header=True, sep=sep, encoding=charset, quote='"', escape='"', multiLine=multi_line)
    # Lines of wide charsets are found by the encoded separator; name the byte order (UTF-16LE, UTF-16BE).
    return reader.option("lineSep", "\n") if charset.upper().startswith(_WIDE) else reader


#: Bytes of a file that hold its header, and files whose heads are read at a time.
_HEAD, _AT_ONCE = 1 << 16, 32
#: A folder named after a column and its value.
_FOLDER_COLUMN = re.compile(r"/([^/=]+)=[^/]*(?=/)")


def _listed(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files below some paths, as a scan would read them; listing them reads none."""
    listing = spark.read.schema("line string").option("recursiveFileLookup", False).csv(paths)
    return sorted(unquote(file) for file in listing.inputFiles())


def _literal(file: str) -> str:
    """A path whose characters all stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", file)


def _header(spark: SparkSession, file: str, sep: str, charset: str) -> tuple[str, ...] | None:
    """The cells of a file's first line that is not blank; None for an empty file."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    path = hadoop.fs.Path(file)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    stream = codec.createInputStream(stream) if codec else stream
    try:
        head = bytes(stream.readNBytes(_HEAD))
    finally:
        stream.close()
    text = str(spark._jvm.java.lang.String(head, charset)).removeprefix("\ufeff")
    if len(sep) == 1:
        lines = csv.reader(io.StringIO(text, newline=""), delimiter=sep)
    else:
        lines = (line.split(sep) for line in text.splitlines())
    return next((tuple(cells) for cells in lines if any(c.strip() for c in cells)), None)


class Headed(NamedTuple):
    """Files that have the same cells in their headers, and are stored under folders that name the same columns."""

    header: tuple[str, ...]
    folders: tuple[str, ...]
    base: str | None
    files: list[str]


def by_header(spark: SparkSession, paths: str | list[str], sep: str = ",", charset: str = "UTF-8", **_) -> list[Headed]:
    """The files below some paths, those of one header together; empty files are left out.

    Only the head of each file is read, many at a time, through Spark's file systems and without a job: no Spark task can
    stop after a first line, so a job would read all files a second time.
    """
    found = [(root, file) for root in ([paths] if isinstance(paths, str) else paths) for file in _listed(spark, root)]
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        headers = list(pool.map(lambda f: _header(spark, f[1], sep, charset), found))
    groups = defaultdict(list)
    for (root, file), header in zip(found, headers):
        if header is not None:
            start = file.find(root.rstrip("/"))
            folders = tuple(_FOLDER_COLUMN.findall(file[start + len(root.rstrip("/")) :])) if start >= 0 else ()
            groups[header, folders, root if folders else None].append(file)
    return [Headed(*key, files) for key, files in groups.items()]


def _scan(reader, group: Headed) -> DataFrame:
    return (reader.option("basePath", group.base) if group.base else reader).csv([_literal(f) for f in group.files])


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: T.StructType = schema.RAW,
    headers: dict[str, str] = schema.SURVEY_HEADERS,
    also: dict[str, Column] | None = None,
    **dialect,
) -> DataFrame:
    """Columns by name, whatever their order in each file: no pass over the data to infer types.

    The header of every file counts, also within a folder; `headers` renames its cells, columns that are not wanted are left
    out, absent ones are NULL. Files of one header are scanned together; without any header the result is empty. `also`
    adds texts that the scan knows, such as the file name.
    """
    wide = dialect.get("charset", "UTF-8").upper().startswith(_WIDE)
    known, also = {f.name: f.dataType for f in columns.fields}, also or {}
    frames = []
    for group in by_header(spark, paths, **dialect):
        names = [headers.get(h.strip(), h.strip()) for h in group.header]
        # With a fixed line feed a carriage return stays at the end of the last cell.
        last = names[-1] if wide else None
        # A name that occurs again is junk, as is an unknown one; a column named by folders goes before one in the files.
        read = [n if n and n not in (*names[:i], *group.folders) else f"{n}#{i}" for i, n in enumerate(names)]
        read += group.folders
        types = [known.get(n, T.StringType()) if n != last else T.StringType() for n in read]
        scan = _scan(_reader(spark, **dialect).schema(T.StructType(list(map(T.StructField, read, types)))), group)
        cells = {n: F.col(f"`{n}`") for n in known if n in read}
        if last in cells:
            cells[last] = F.nullif(F.regexp_replace(cells[last], "\r$", ""), F.lit("")).try_cast(known[last])
        chosen = [cells.get(n, F.lit(None).cast(kind)).alias(n) for n, kind in known.items()]
        frames.append(scan.select(*chosen, *[c.alias(n) for n, c in also.items()]))
    if not frames:
        return spark.createDataFrame([], T.StructType([*columns.fields, *[T.StructField(n, T.StringType()) for n in also]]))
    return reduce(DataFrame.unionByName, frames)


_WHOLE, _NUMBERS = (T.IntegerType(), T.LongType()), (T.IntegerType(), T.LongType(), T.DoubleType())


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the cells of both."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return T.LongType()
    return T.DoubleType() if a in _NUMBERS and b in _NUMBERS else T.StringType()


def read_csv_inferred(spark: SparkSession, paths: str | list[str], **dialect) -> DataFrame:
    """Scan with inferred types; costs an additional pass.

    Columns go by the header of each file, as in `read_csv`; a column that files hold with different types gets the type that
    holds all, absent ones are NULL.
    """
    groups = by_header(spark, paths, **dialect)
    if len(groups) <= 1:
        return _reader(spark, **dialect).option("inferSchema", True).csv(paths)
    scans = [_scan(_reader(spark, **dialect).option("inferSchema", True), group) for group in groups]
    inferred, types = [scan.schema for scan in scans], {}
    for scan, found in zip(scans, inferred):
        # Columns without a cell are texts to Spark; they say nothing about other files.
        silent = {f.dataType for f in found.fields} == {T.StringType()} and scan.isEmpty()
        for field in () if silent else found.fields:
            types[field.name] = _wider(types.get(field.name, field.dataType), field.dataType)
    fields = [T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in found.fields]) for found in inferred]
    frames = [_scan(_reader(spark, **dialect).schema(own), group) for own, group in zip(fields, groups)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_dialects(spark: SparkSession, files: list[CsvFile], columns: T.StructType = schema.RAW) -> DataFrame:
    """Files of different separators and charsets: one scan per dialect and header, then a union by name.

    Charsets outside UTF-8/16/32, ISO-8859-1 and US-ASCII need `spark.sql.legacy.javaCharsets=true`.
    """
    by_dialect = defaultdict(list)
    for f in files:
        by_dialect[f.sep, f.charset, f.multi_line].append(f.path)
    frames = [
        read_csv(spark, paths, columns, sep=sep, charset=charset, multi_line=multi_line)
        for (sep, charset, multi_line), paths in by_dialect.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def _stem():
    """Name of the file, or of the folder that holds its parts, without the suffix.

    The path is a URI: escaped characters are restored, a plus sign stands for itself.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.csv)?(/part-[^/]*)?$", 1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def read_many(spark: SparkSession, paths: list[str], columns: T.StructType = schema.RAW, source: str = "source") -> DataFrame:
    """All files in one scan, with the stem of the file as a column instead of one frame per file."""
    return read_csv(spark, paths, columns, also={source: _stem()})


def read_or_empty(spark: SparkSession, path: str, columns: T.StructType = schema.RAW) -> DataFrame:
    """The file, or an empty frame of the same schema where the path does not exist."""
    try:
        return read_csv(spark, path, columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], columns)


def _named(file: str) -> str:
    """Name of a file, or of the folder that holds its parts, without the suffix."""
    return re.search(r"([^/]+?)(\.csv)?(/part-[^/]*)?$", file)[1]


def read_whitelist(
    spark: SparkSession, folder: str, stems: list[str], columns: T.StructType = schema.RAW, source: str = "source"
) -> DataFrame:
    """The CSV files of a folder and those below whose stem is listed. Names are listed first, so others are not read."""
    listing = spark.read.schema("line string").options(pathGlobFilter="*.csv", recursiveFileLookup=True).csv(folder)
    wanted = set(stems)
    paths = sorted(file for file in map(unquote, listing.inputFiles()) if _named(file) in wanted)
    return read_csv(spark, [_literal(f) for f in paths], columns, also={source: _stem()})


def from_rows(spark: SparkSession, rows: list, columns: T.StructType = schema.API) -> DataFrame:
    """Small reference data held by the caller."""
    return spark.createDataFrame(rows, columns)
