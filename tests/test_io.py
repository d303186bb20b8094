"""Sources and sinks: round trips in fresh folders."""

import gzip
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu import schema
from jangbu.operators import rows
from jangbu.plans import catalog
from jangbu.plans import survey as plan
from jangbu.sinks import tables as sinks
from jangbu.sources import pages, tables, xml
from jangbu.plans import samples
from jangbu.session import scratch, scratch_root, settle


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bom_and_dialects(spark, tmp_path):
    header = ",".join(schema.SURVEY_HEADERS)
    cells = ["1", "2", "용문시장", "3", "쌀(이천쌀) 20kg 1포", "", "100", "2024-11", "", "001", "전통시장", "17", "용산구", "2024-11-01"]
    (tmp_path / "a.csv").write_text(header + "\n" + ",".join(cells) + "\n", encoding="utf-8-sig")
    (tmp_path / "b.csv").write_text(header.replace(",", ";") + "\n" + ";".join(cells) + "\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text(header + "\r\n" + ",".join(cells) + "\r\n", encoding="utf-16-le")
    files = [
        tables.CsvFile(str(tmp_path / "a.csv")),
        tables.CsvFile(str(tmp_path / "b.csv"), ";"),
        tables.CsvFile(str(tmp_path / "c.csv"), ",", "UTF-16LE"),
    ]
    got = tables.read_dialects(spark, files).collect()
    assert len(got) == 3 and len({(r["id"], r["item_name"], r["sales_unit"]) for r in got}) == 1
    assert got[0]["item_name"] == "쌀(이천쌀) 20kg 1포" and got[0]["sales_unit"] is None
    assert {r["inspection_date"] for r in got} == {"2024-11-01"}
    inferred = tables.read_csv_inferred(spark, str(tmp_path / "a.csv"))
    assert inferred.columns == list(schema.SURVEY_HEADERS) and dict(inferred.dtypes)["가격(원)"] == "int"


def test_columns_go_by_name_and_cells_keep_quotes(spark, tmp_path):
    kinds = schema._strings(["id", "name", "price"])
    (tmp_path / "a.csv").write_text('id,price,junk,name\n1,100,x,"a ""big"" one"\n', encoding="utf-8")
    (tmp_path / "채소 과일+.csv").write_text('name,id\n"two\nlines",2\n', encoding="utf-8")
    files = [tables.CsvFile(str(tmp_path / "a.csv")), tables.CsvFile(str(tmp_path / "채소 과일+.csv"), multi_line=True)]
    assert plain(tables.read_dialects(spark, files, kinds)) == [("1", 'a "big" one', "100"), ("2", "two\nlines", None)]
    listed = tables.read_whitelist(spark, str(tmp_path), ["채소 과일+"], kinds)
    assert {r["source"] for r in listed.collect()} == {"채소 과일+"}
    sinks.write_csv(spark.createDataFrame([('say "x"', 1)], "name string, id int"), str(tmp_path / "out"))
    assert 'say ""x""' in "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))


def test_corrupt_records_are_kept_on_demand(spark, tmp_path):
    rows_ = "<row><P_SEQ>1</P_SEQ></row><row><P_SEQ>x & y</P_SEQ></row><row><P_SEQ>3</P_SEQ></row>"
    (tmp_path / "p.xml").write_text(f"<list>{rows_}</list>", encoding="utf-8")
    assert {r["P_SEQ"] for r in xml.read_rows(spark, str(tmp_path / "p.xml")).collect()} == {"1", "3"}
    every = xml.read_rows(spark, str(tmp_path / "p.xml"), corrupt=True).collect()
    assert len(every) == 3 and ["x & y" in (r[xml.CORRUPT] or "") for r in every].count(True) == 1


def test_korean_charset_needs_the_legacy_switch(spark, tmp_path):
    (tmp_path / "k.csv").write_text("name\n양파\n", encoding="cp949")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        df = tables.read_csv_inferred(spark, str(tmp_path / "k.csv"), charset="MS949")
        assert plain(df) == [("양파",)]
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_headers_count_file_by_file(spark, tmp_path):
    """Three orders in one folder, one of them packed, an unknown column, a repeated one, files without rows or text."""
    import gzip

    folder = tmp_path / "mixed [1]"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name,price\n1,apple,100\n", encoding="utf-8-sig")
    (folder / "b.csv.gz").write_bytes(gzip.compress(b"\nid,price,name\r\n2,200,pear\r\n"))
    (folder / "c.csv").write_text('price,"junk, or ""not""",id,id,name\n300,x,3,9,plum\n', encoding="utf-8")
    (folder / "d.csv").write_text("name,id\n", encoding="utf-8")
    (folder / "e.csv").write_text("", encoding="utf-8")
    kinds = schema._strings(["id", "name", "price"])
    path = str(tmp_path / "mixed *")
    assert plain(tables.read_csv(spark, path, kinds)) == [("1", "apple", "100"), ("2", "pear", "200"), ("3", "plum", "300")]
    assert tables.read_csv(spark, str(folder / "e.csv").replace("[1]", "*"), kinds, also={"source": tables._stem()}).columns[-1] == "source"
    (folder / "f.csv").write_text("name,price\nfig,4.5\n", encoding="utf-8")
    (folder / "c.csv").unlink()
    inferred = tables.read_csv_inferred(spark, path)
    assert dict(inferred.dtypes)["price"] == "double" and dict(inferred.dtypes)["id"] == "int"
    assert plain(inferred.select("id", "name", "price")) == [(1, "apple", 100.0), (2, "pear", 200.0), (None, "fig", 4.5)]


def test_unlike_headers_under_named_folders(spark, tmp_path):
    for kind, text in (("x", "id,name\n1,a\n"), ("y", "name,id\nb,2\n")):
        (tmp_path / f"kind={kind}").mkdir()
        (tmp_path / f"kind={kind}" / "p.csv").write_text(text, encoding="utf-8")
    assert plain(tables.read_csv(spark, str(tmp_path), schema._strings(["id", "kind", "name"]))) == [("1", "x", "a"), ("2", "y", "b")]


def test_many_files_need_no_job_each(spark, tmp_path):
    for i in range(1000):
        header = ["id", "name"] if i % 2 else ["name", "id"]
        (tmp_path / f"f{i}.csv").write_text(",".join(header) + "\n" + ",".join(c + str(i) for c in header) + "\n", encoding="utf-8")
    kinds, sc = schema._strings(["id", "name"]), spark.sparkContext
    sc.setJobGroup("many files", "")
    try:
        found = tables.read_whitelist(spark, str(tmp_path), [f"f{i}" for i in range(0, 1000, 2)] + ["f1"], kinds)
        got = {tuple(r) for r in found.collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == {(f"id{i}", f"name{i}", f"f{i}") for i in [*range(0, 1000, 2), 1]}
    assert len(sc.statusTracker().getJobIdsForGroup("many files")) <= 6


@pytest.mark.parametrize("name", ["csv", "single", "by"])
def test_every_part_begins_with_the_mark(spark, tmp_path, name):
    df = spark.range(20).selectExpr("concat('k', id % 3) AS kind", "id", "concat('값', id) AS text").repartition(4)
    write = {"csv": sinks.write_csv, "single": sinks.write_single_csv, "by": lambda d, p, bom: sinks.write_by(d, "kind", p, bom)}[name]
    write(df, str(tmp_path / "marked"), bom=True)
    parts = list((tmp_path / "marked").rglob("part-*.csv"))
    assert parts and all(p.read_bytes()[:3] == b"\xef\xbb\xbf" and b"\xef\xbb\xbf" not in p.read_bytes()[3:] for p in parts)
    assert plain(tables.read_csv(spark, str(tmp_path / "marked"), df.schema)) == plain(df)
    assert set(tables.read_csv_inferred(spark, str(tmp_path / "marked")).columns) == set(df.columns)
    write(df, str(tmp_path / "plain"), bom=False)
    assert all(p.read_bytes()[:1] != b"\xef" for p in (tmp_path / "plain").rglob("part-*.csv"))


def test_many_whitelist_and_missing(spark, tmp_path):
    for stem in ("data_2022", "data_2023", "other"):
        (tmp_path / f"{stem}.csv").write_text(f"id\n{stem}-1\n", encoding="utf-8")
    (tmp_path / "data_2022.txt").write_text("id\nno\n", encoding="utf-8")
    id_only = schema._strings(["id"])
    paths = [str(tmp_path / f"data_{y}.csv") for y in (2022, 2023)]
    want = [("data_2022-1", "data_2022"), ("data_2023-1", "data_2023")]
    assert plain(tables.read_many(spark, paths, id_only)) == want
    assert plain(tables.read_whitelist(spark, str(tmp_path), ["data_2022", "data_2023", "gone"], id_only)) == want
    empty = tables.read_or_empty(spark, str(tmp_path / "gone.csv"), id_only)
    assert empty.schema == id_only and empty.count() == 0
    assert rows.union_by_position(empty, tables.read_or_empty(spark, paths[0], id_only)).count() == 1


def test_xml_rows_and_pages(spark, tmp_path):
    record = "<row><P_SEQ>1</P_SEQ><A_NAME>무 &amp; 배추</A_NAME><A_UNIT></A_UNIT><P_DATE>{}</P_DATE></row>"
    page = "<list><total>2</total>" + record.format("2024-11-01") + record.format("2023-11-01") + "</list>"
    (tmp_path / "p.xml").write_text(page, encoding="utf-8")
    got = xml.read_rows(spark, str(tmp_path / "p.xml"))
    assert got.columns == schema.API.fieldNames() and got.count() == 2
    first = xml.api_rows(got, "2024").first()
    assert xml.api_rows(got).count() == 2
    assert (first["id"], first["item_name"], first["sales_unit"], first["price"]) == ("1", "무 & 배추", None, None)
    held = spark.createDataFrame([(page,), ("<broken><row>",), (None,)], "page string")
    assert plain(xml.rows_from_pages(held, "page")) == plain(got)


def test_tiles(spark):
    html = (
        '<a class="x emitem_info" href="/1"><span class="mnemitem_goods_tit"> 무 <b>1개</b></span><em class="ssg_price">1,980</em></a>'
        '<a class="emitem_info"><span class="mnemitem_goods_tit">배&amp;무</span></a><a class="other">no</a>'
    )
    df = spark.createDataFrame([(1, html), (2, "<p/>"), (3, None)], "page_id int, html string")
    got = pages.tiles(df)
    assert plain(got) == [(1, 0, "무 1개", "1,980"), (1, 1, "배&무", None)]
    assert ("배&무", "N/A") in {r[2:] for r in plain(sinks.not_available(got))}


def test_list_items(spark):
    def item(href, title, price, unit=True):
        tail = '<span class="_1RLV-iAg2_">(100g당 265원)</span>' if unit else ""
        return (
            f'<li class="_3m7zfsGIZR"><a class="_3OaphyWXEP linkAnchor" href="{href}"><strong class="_1J1f1i2vk0">{title}</strong>'
            f'<span class="hDcL3_EQRC">{price}</span>{tail}</a></li>'
        )

    html = item("/p/7?x=1", "양파", "3,980원") + item("/p/7", "again", "1원") + item("/p/8", "no unit", "1원", unit=False)
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    found = pages.items(df)
    assert [r[:4] for r in plain(found)] == [(1, 0, "7", "양파"), (1, 1, "7", "again")]
    first = rows.keep_first(found, ["product_id"], ["page_id", "pos"])
    assert plain(pages.listing(first)) == [("양파", 3980, "(100g당 265원)")]


def test_partitioned_sinks(spark, tmp_path):
    df = spark.createDataFrame([("생선/해산물", 1.5, 1), ("농산물", None, 2)], "category string, price double, n int")
    sinks.write_by(df, "category", str(tmp_path / "by"))
    assert sum(p.is_dir() for p in (tmp_path / "by").iterdir()) == 2
    back = tables.read_csv(spark, str(tmp_path / "by"), df.schema).select(*df.columns)
    assert plain(back) == plain(df)
    sinks.write_single_csv(df.repartition(4), str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    sinks.write_csv(sinks.with_headers(df, {"카테고리": "category"}), str(tmp_path / "named"))
    assert tables.read_csv_inferred(spark, str(tmp_path / "named")).columns == ["카테고리", "price", "n"]


def test_a_hot_category_is_split_when_written(spark, tmp_path):
    df = spark.range(20000).selectExpr("if(id % 3 = 0, 'hot', concat('c', id % 5)) AS category", "id", "uuid() AS text")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        sinks.write_by(df, "category", str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot" / "category=hot").glob("part-*"))) > 1
    assert tables.read_csv_inferred(spark, str(tmp_path / "hot")).count() == 20000


def session_with(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))


def test_scratch_folder_comes_from_the_session(spark):
    shared = session_with(**{"spark.checkpoint.dir": "hdfs://shared/check/", "spark.master": "yarn"})
    assert scratch_root(shared) == "hdfs://shared/check"
    with pytest.raises(RuntimeError):
        scratch_root(session_with(**{"spark.master": "yarn"}))
    table = settle(spark.range(5), "five")
    assert table.count() == 5 and [p for p in Path(scratch_root(spark)).glob("five-*")]


def test_rows_held_by_the_caller(spark):
    df = tables.from_rows(spark, [("1",) + (None,) * 13])
    assert df.schema == schema.API and df.first()["P_SEQ"] == "1"
    assert df.withColumnsRenamed(schema.API_TAGS).columns[:3] == ["id", "market_id", "market_name"]
    with pytest.raises(Exception):
        tables.from_rows(spark, [("1",)]).collect()


def test_load_combines_files_and_api_pages(spark, tmp_path):
    line = ["9", "2", "시장", "3", "무", "1개", "100", "2023-11", "", "001", "전통시장", "17", "용산구", "2023-11-01"]
    (tmp_path / "s.csv").write_text(";".join(schema.SURVEY_HEADERS) + "\n" + ";".join(line) + "\n", encoding="utf-8")
    record = "<row><P_SEQ>1</P_SEQ><A_NAME>배추</A_NAME><A_PRICE>0</A_PRICE><P_YEAR_MONTH>2024-11</P_YEAR_MONTH><P_DATE>2024-11-01</P_DATE></row>"
    (tmp_path / "p.xml").write_text(f"<list>{record}</list>", encoding="utf-8")
    both = plan.load(spark, [tables.CsvFile(str(tmp_path / "s.csv"), ";")], str(tmp_path / "p.xml"))
    cleaned = {(r["item_name"], r["price"], r["year"], r["month"]) for r in plan.clean(both).collect()}
    assert cleaned == {("무", 100.0, 2023, 11), ("배추", 0.0, 2024, 11)}


def test_intermediate_tables_go_with_their_block(spark, small):
    before = set(Path(scratch_root(spark)).iterdir())
    with scratch(spark):
        report = plan.item_report(samples.survey(spark, small), groups=samples.ITEM_GROUPS, categories=samples.ITEM_CATEGORIES)
        assert report.count() > 0 and set(Path(scratch_root(spark)).iterdir()) > before
    assert set(Path(scratch_root(spark)).iterdir()) == before


def test_broken_records_are_kept_apart(spark, tmp_path):
    """A bare ampersand and a record that breaks off; neighbours, other pages and records without content are untouched."""
    folder = tmp_path / "pages"
    folder.mkdir()
    rows_ = "<row><P_SEQ>1</P_SEQ></row><row/><row a='b'><P_SEQ>x & y</P_SEQ></row><row>\n<P_SEQ>3</P_SEQ><A_NAME></A_NAME></row>"
    (folder / "p.xml").write_text(f"<?xml version='1.0'?>\n<rows><total>2</total>{rows_}</rows>", encoding="utf-8")
    (folder / "q.xml").write_text("<row ><P_SEQ>7</P_SEQ><A_NAME>무 &amp; 배</A_NAME></row><row><P_SEQ>8</P_SEQ>", encoding="utf-8")
    good, bad = xml.split_rows(spark, str(folder))
    assert plain(good.select("P_SEQ", "A_NAME")) == [("1", None), ("3", None), ("7", "무 & 배")]
    assert sorted((r.file[-5:], r.record) for r in bad.collect()) == [
        ("p.xml", "<row a='b'><P_SEQ>x & y</P_SEQ></row>"),
        ("q.xml", "<row><P_SEQ>8</P_SEQ>"),
    ]
    aside = str(tmp_path / "aside")
    for _ in range(2):
        assert plan.load(spark, [], str(folder), quarantine=aside).count() == 3
    assert spark.read.parquet(aside).count() == 4
    with pytest.warns(UserWarning, match="2 API records"):
        plan.load(spark, [], str(folder))
    (folder / "p.xml").write_text("", encoding="utf-8")
    assert [part.count() for part in xml.split_rows(spark, str(folder / "p.xml"))] == [0, 0]


def test_large_xml_files_are_read_by_many_tasks(spark, tmp_path):
    """The rows are those that Spark's own reader gives, which reads a file by one task."""
    folder, rows_ = tmp_path / "pages", "".join(f"<row n='>{i}'>\n<P_SEQ>{i}</P_SEQ><row_id>x</row_id></row>" for i in range(20000))
    folder.mkdir()
    (folder / "p.xml").write_text(f"<rows><!-- <row> --><row_count>2</row_count>{rows_}<row/></rows>", encoding="utf-8")
    odd = {
        "comment": "<!-- <row><P_SEQ>7</P_SEQ></row> <row></row> --><row><P_SEQ>a</P_SEQ></row >\n<row><P_SEQ>b</P_SEQ></row>",
        "odd [é] +%20": "<row><P_SEQ><![CDATA[</row><row>c & d]]></P_SEQ></row><row><P_SEQ>x & y</P_SEQ></row>",
        "nested": "<row><P_SEQ>e</P_SEQ><row><P_SEQ>no</P_SEQ></row></row><row><P_SEQ>f</P_SEQ></row>",
        "short": "<row><P_SEQ>g</P_SEQ></row><row><P_SEQ>no</P_SEQ>",
    }
    for name, text in odd.items():
        (folder / f"{name}.xml").write_text(f"<rows>{text}" + ("" if name == "short" else "</rows>"), encoding="utf-8")
    own = xml._empty_to_null(spark.read.format("xml").options(rowTag="row", mode="DROPMALFORMED").schema(schema.API).load(str(folder)))
    got = xml.read_rows(spark, str(folder))
    assert plain(got) == plain(own) and got.columns == own.columns and got.count() == 20007
    alone = tmp_path / "alone.xml"
    alone.write_text(f"<rows>{rows_}</rows>", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        cut = xml.read_rows(spark, str(alone))
        assert cut.rdd.getNumPartitions() > 4 and cut.filter("P_SEQ IS NOT NULL").distinct().count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r[xml.CORRUPT] for r in xml.read_rows(spark, str(folder / "short.xml"), corrupt=True).collect()} == {None, "<row><P_SEQ>no</P_SEQ>"}


def test_xml_query_packs_its_files(spark, tmp_path, monkeypatch):
    """Its files take a fraction of their text, none holds more records than the limit, and all rows come back."""
    tables_ = {
        "lineitem": "id l_orderkey, id % 50 l_partkey, id % 20 l_suppkey, 1 l_linenumber, 2D l_quantity, id * 1.25D l_extendedprice, "
        "0.1D l_discount, 0D l_tax, 'R' l_returnflag, 'O' l_linestatus, timestamp_ntz '1998-01-01' + make_interval(0, 0, 0, id % 900) l_shipdate",
        "part": "id p_partkey, '<볼트 & ' || id || '>' p_name, 'b' p_brand, 't' p_type, 1 p_size, 1D p_retailprice",
        "supplier": "id s_suppkey, 'm' || id s_name, 0 s_nationkey, 1D s_acctbal",
        "nation": "0 n_nationkey, 'n' n_name, 0 n_regionkey",
    }
    for (name, columns), n in zip(tables_.items(), (3000, 50, 20, 1), strict=True):
        spark.sql(f"SELECT {columns} FROM (SELECT CAST(id AS INT) id FROM range(0, {n}))").select(
            *[F.col(c.name).cast(c.dataType) for c in T.StructType.fromDDL(samples.SCHEMAS[name])]
        ).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(catalog, "_FILE_RECORDS", 500, raising=False)
    before = set(Path(scratch_root(spark)).iterdir())
    with scratch(spark):
        got = plain(catalog.QUERIES["xml_rows"](spark, str(tmp_path)))
        files = [f for d in set(Path(scratch_root(spark)).iterdir()) - before for f in d.glob("part-*")]
        texts = [gzip.decompress(f.read_bytes()) if f.suffix == ".gz" else f.read_bytes() for f in files]
        sizes = [f.stat().st_size for f in files]
    raw = samples.survey_raw(spark, str(tmp_path))
    assert got == plain(xml._empty_to_null(raw)) and len(got) == 3000
    records = [t.count(b"<row>") for t in texts]
    assert sum(records) == 3000 and max(records) <= 500
    assert sum(sizes) * 5 < sum(map(len, texts))


def test_packed_xml_files_are_read_like_plain_ones(spark, tmp_path):
    """Whichever way a record is told: alone in its text, beside others that begin alike, or in a file read whole."""
    texts = {
        "alone": "<row><P_SEQ>1</P_SEQ></row>\n <row><P_SEQ>2 무</P_SEQ><A_NAME></A_NAME></row>",
        "alike": "<row_count>2</row_count><row><P_SEQ>3</P_SEQ><row_id>x</row_id></row><row n='1'><P_SEQ>4</P_SEQ></row><row/><row ><P_SEQ>5</P_SEQ></row >",
        "broken": "<row><P_SEQ>x & y</P_SEQ></row><row><P_SEQ>6</P_SEQ></row>",
        "comment": "<!-- <row><P_SEQ>no</P_SEQ></row> --><row><P_SEQ>7</P_SEQ></row>",
        "nested": "<row><P_SEQ>8</P_SEQ><row><P_SEQ>no</P_SEQ></row></row><row><P_SEQ>9</P_SEQ></row>",
    }
    for name, text in texts.items():
        for kind, end in (("plain", ""), ("packed", ".gz")):
            (tmp_path / kind).mkdir(exist_ok=True)
            data = f"<rows>{text}</rows>".encode()
            (tmp_path / kind / f"{name}.xml{end}").write_bytes(gzip.compress(data) if end else data)
    for corrupt in (False, True):
        got = [plain(xml.read_rows(spark, str(tmp_path / kind), corrupt=corrupt)) for kind in ("plain", "packed")]
        assert got[0] == got[1]
        assert sorted(r[0] for r in got[1] if r[0] and (not corrupt or r[-1] is None)) == ["1", "2 무", *"3456789"]
