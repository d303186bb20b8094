"""Operators on hand-computed tables."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu import rules, schema
from jangbu.functions.measures import moments
from jangbu.operators import columns, outliers, profile, quality, rows
from jangbu.operators import volatility as vol
from jangbu.plans import samples
from jangbu.plans import survey as plan


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# volatility


def test_volatility_measures(spark):
    df = frame(spark, [("a", 1.0), ("a", 3.0), ("a", None), ("b", 5500.0), ("c", 0.0), ("c", 0.0), (None, 1.0)], "g string, price double")
    got = {r["g"]: r for r in vol.volatility(df, ["g"]).collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"]["mean"], got["a"]["count"]) == (2.0, 2)
    assert got["a"]["std"] == pytest.approx(math.sqrt(2)) and got["a"]["cv"] == pytest.approx(0.70710678)
    assert (got["b"]["std"], got["b"]["cv"], got["b"]["count"]) == (None, None, 1)
    assert got["c"]["cv"] is None
    zero = {r["g"]: r["cv"] for r in vol.volatility(df, ["g"], zero_cv=True).collect()}
    assert zero["c"] == 0.0 and zero["b"] is None and zero["a"] == pytest.approx(0.70710678)


def test_levels_equal_separate_reports(spark, small):
    df = samples.survey(spark, small)
    levels = vol.volatility_levels(df).cache()
    for name, keys in vol.LEVELS.items():
        part = {tuple(r[k] for k in keys): r for r in levels.filter(F.col("level") == name).collect()}
        alone = {tuple(r[k] for k in keys): r for r in vol.volatility(df, keys).collect()}
        assert set(part) == set(alone)
        for key, r in alone.items():
            assert part[key]["count"] == r["count"]
            for m in ("mean", "std", "cv"):
                assert part[key][m] == (None if r[m] is None else pytest.approx(r[m], rel=1e-9))


def test_levels_leave_out_missing_keys_and_prices(spark):
    df = frame(spark, [("x", 1, 2.0), ("x", None, 4.0), (None, 1, 8.0), ("x", 2, None), ("y", 1, 5.0), ("y", 1, 5.0)], "d string, y int, price double")
    got = {(r["level"], r["d"], r["y"]): (r["mean"], r["std"], r["count"]) for r in vol.volatility_levels(df, {"d": ["d"], "dy": ["d", "y"]}).collect()}
    assert got == {
        ("d", "x", None): (3.0, pytest.approx(math.sqrt(2)), 2),
        ("d", "y", None): (5.0, 0.0, 2),
        ("dy", "x", 1): (2.0, None, 1),
        ("dy", "x", 2): (None, None, 0),
        ("dy", "y", 1): (5.0, 0.0, 2),
    }


# zero prices


@pytest.fixture()
def priced(spark):
    data = (
        [("a", 2020, p) for p in (0.0, 10.0, 20.0, 30.0)]
        + [("b", 2020, p) for p in (0.0, 0.0, 5.0)]
        + [("c", 2020, 7.0), ("c", 2020, None), (None, 2020, 0.0), ("a", None, 0.0)]
        + [("a", 2021, p) for p in (40.0, 50.0, 60.0, 70.0)]
    )
    return frame(spark, data, "item_name string, year bigint, price double")


def test_zero_ratio_and_bands(priced):
    got = {r["item_name"]: r for r in quality.zero_band(quality.zero_ratio(priced)).collect()}
    assert {k: r["band"] for k, r in got.items()} == {"a": "low", "b": "high", "c": "none"}
    assert (got["c"]["total_count"], got["c"]["zero_ratio"]) == (1, 0.0)
    assert got["b"]["zero_ratio"] == pytest.approx(66.6666667)
    inner = {r["item_name"]: r["total_count"] for r in quality.zero_ratio_inner(priced).collect()}
    assert inner == {"a": 9, "b": 3}


def test_band_edge_and_logged_ratio(spark):
    df = frame(spark, [("edge", 10, 3), ("logged", 767, 214)], "item_name string, total_count bigint, zero_count bigint")
    got = {r["item_name"]: (r["zero_ratio"], r["band"]) for r in quality.zero_band(quality._ratio(df)).collect()}
    assert got["edge"] == (30.0, "low")
    assert got["logged"][0] == pytest.approx(27.900913, abs=1e-6)


def test_repair_zeros(priced):
    kept = plain(quality.repair_zeros(priced))
    assert ("a", 2020, 15.0) in kept and ("a", 2020, 0.0) not in kept
    assert ("a", None, 0.0) in kept and (None, 2020, 0.0) in kept
    assert not [r for r in kept if r[0] == "b"]
    assert len(kept) == 12
    assert len(plain(quality.repair_zeros(priced, drop_high=False))) == 15


def test_a_median_may_be_zero(spark):
    data = [("a", 2020, p) for p in (0.0, 0.0, 9.0)] + [("a", 2021, 5.0)] * 10
    got = plain(quality.repair_zeros(frame(spark, data, "item_name string, year bigint, price double")))
    assert got.count(("a", 2020, 0.0)) == 2


def test_monthly_variant(spark):
    data = [("a", "2020-01", p) for p in (0.0, 2.0, 4.0, 6.0)] + [("b", "2020-01", 0.0), ("c", "2020-01", 3.0), (None, "2020-01", 1.0), ("a", None, 0.0), ("a", "2020-02", 8.0), ("a", "2020-02", 8.0)]
    df = frame(spark, data, "item_name string, year_month string, price double")
    got = plain(quality.repair_zeros_monthly_approx(df))
    assert got.count(("a", "2020-01", 2.0)) == 2 and ("a", None, None) in got
    assert {r[0] for r in got} == {"a", "c"}


# columns


def test_rename_trim_and_drop(spark):
    df = spark.createDataFrame([("1", "2", "3")], " 일련번호 string, `x 일련번호,` string, price string".replace(" 일련번호 ", "`일련번호` "))
    assert columns.rename(df, {**schema.SURVEY_HEADERS}).columns[0] == "id"
    assert columns.drop_columns_like(df).columns == ["일련번호", "price"]
    assert columns.trim_names(df.toDF(" a ", "b", " c")).columns == ["a", "b", "c"]


def test_align_types(spark):
    df = frame(spark, [("1", "x", "2.5"), ("z", None, "nan")], "a string, b string, `c.d` string")
    got = columns.align_types(df, T.StructType.fromDDL("a bigint, `c.d` double, e int"))
    assert plain(got) == [(1, "x", 2.5), (None, None, None)]
    assert dict(got.dtypes) == {"a": "bigint", "b": "string", "c.d": "double"}


def test_common_columns_keep_the_left_order(spark):
    left, right = frame(spark, [(1, 2, 3)], "c int, a int, b int"), frame(spark, [(1, 2)], "b int, c int")
    assert columns.common_columns(left, right) == ["c", "b"]


def test_unit_fix(spark):
    df = frame(spark, [("오이 1개", 4000.0, "2개"), ("오이", 4000.0, None)], "item_name string, price double, sales_unit string")
    assert set(plain(columns.fix_units(df))) == {("오이", 4000.0, None), ("오이 1개", 2000.0, "1개")}
    assert set(plain(columns.fix_units(df.drop("sales_unit")))) == {("오이", 4000.0), ("오이 1개", 2000.0)}


def test_rounded_is_half_even(spark):
    df = frame(spark, [("a", 0.125, 1), ("b", 0.375, 2)], "k string, v double, n int")
    assert plain(columns.rounded(df)) == [("a", 0.12, 1), ("b", 0.38, 2)]


# rows


def test_drop_zero_keeps_missing(spark):
    df = frame(spark, [(0.0,), (5.0,), (None,)], "price double")
    assert plain(rows.drop_zero(df)) == [(5.0,), (None,)]


def test_unions(spark):
    first, second = frame(spark, [(1, 2)], "a int, b int"), frame(spark, [(3, 4)], "b int, c int")
    assert plain(rows.union_common(first, second)) == [(2,), (3,)]
    assert plain(rows.union_outer(first, second)) == [(1, 2, None), (None, 3, 4)]
    with pytest.raises(ValueError):
        rows.union_by_position(first, second)
    assert rows.union_by_position(first, first).count() == 2


def test_keep_first(spark):
    df = frame(spark, [("p", 2, 0, "late"), ("p", 1, 3, "second"), ("p", 1, 2, "first"), ("q", 9, 9, None)], "id string, page int, pos int, title string")
    assert plain(rows.keep_first(df, ["id"], ["page", "pos"])) == [("p", 1, 2, "first"), ("q", 9, 9, None)]


def test_global_order_with_a_hot_key_and_copies(spark):
    data = [(0, i % 7) for i in range(2000)] + [(i, 0) for i in range(1, 500)]
    df = frame(spark, data, "k int, v int").repartition(6)
    numbered = rows.global_row_number(df, ["k", "v"], "n").orderBy("n").collect()
    assert [r["n"] for r in numbered] == list(range(1, len(data) + 1))
    assert [(r["k"], r["v"]) for r in numbered] == sorted(data)
    assert plain(rows.head_slice(df, 1500, ["k", "v"])) == sorted(sorted(data)[:1500], key=repr)
    assert plain(rows.drop_tail(df, 700, ["k", "v"])) == sorted(sorted(data)[:-700], key=repr)
    assert rows.drop_tail(df, 9999, ["k", "v"]).count() == 0


def test_first_and_last_rows(spark):
    df = frame(spark, [(i,) for i in range(20)], "id int")
    assert plain(rows.first_rows(df, 3, "id")) == [(0,), (1,), (2,)]
    assert sorted(r[0] for r in rows.last_rows(df, 2, "id").collect()) == [18, 19]


# profiles


def test_item_profile_modes(spark):
    data = [("c", "i", 1.0, "b", None), ("c", "i", 3.0, "a", None), ("c", "i", None, None, None)]
    df = frame(spark, data, "category string, item_name string, price double, sales_unit string, remark string")
    assert plain(profile.item_profile(df)) == [("c", "i", "a", "nan", 2.0, 3)]


def test_missing_counts_as_a_distinct_value(spark):
    df = frame(spark, [("a", 1), ("a", None), (None, None)], "x string, y int")
    assert plain(profile.distinct_profile(df, ["x", "y"])) == [("x", 2), ("y", 2)]
    assert plain(profile.null_profile(df)) == [("x", 1), ("y", 2)]


def test_category_counts_add_up(spark):
    df = frame(spark, [("a",), ("a",), ("기타",)], "category string")
    assert plain(profile.category_counts(df)) == [("(classified)", 2), ("(total)", 3), ("a", 2), ("기타", 1)]


def test_keys_in_all_years(spark):
    df = frame(spark, [("a", 1), ("a", 2), ("b", 2), ("b", 2), ("a", None), (None, 3)], "k string, year int")
    assert plain(profile.keys_in_all_years(df, "k")) == [("a", 2)]
    assert plain(profile.keys_in_all_years(df, "k", years=[2])) == [("a", 1), ("b", 1)]
    assert plain(profile.keys_in_all_years(df, "k", years=[1, 2, 3])) == []


def test_price_summary_before_and_after(spark):
    df = frame(spark, [("c", "i", float(v)) for v in (1, 2, 3, 4, 100)] + [("c", "i", None)], "category string, item_name string, price double")
    got = {r["stage"]: r for r in profile.price_summary(df).collect()}
    assert (got["before"]["count"], got["before"]["max"], got["before"]["p50"]) == (5, 100.0, 3.0)
    assert (got["after"]["count"], got["after"]["max"], got["after"]["mean"]) == (4, 4.0, 2.5)
    assert got["after"]["std"] == pytest.approx(1.2909944487)


# whole jobs


def test_survey_job_with_the_korean_rules(spark):
    data = [
        ("1", "m", "양파(1kg)", "1000", "2023-.3", 'ok";junk', "강남구"),
        ("2", "m", "양파(1kg)", "0", "2023-04", "", "강남구"),
        ("3", "m", "양파(1kg)", "3000", "2023-04", "nan", "강남구"),
        ("4", "m", "양파(1kg)", "2000", "2023-04", None, "강남구"),
        ("5", "m", "치약", "0", "2023-04", None, "강남구"),
        ("6", "m", None, "5", "2023-04", None, "강남구"),
        ("7", "m", "무", "5", None, None, "강남구"),
        ("8", "m", "멸치액젓 1kg", "N/A", "2023-04", None, "강북구"),
    ]
    raw = frame(spark, data, "id string, market_name string, item_name string, price string, year_month string, remark string, district_name string")
    cleaned = plan.clean(raw)
    assert "id" not in cleaned.columns
    got = {(r["item_name"], r["price"], r["month"], r["remark"], r["category"]) for r in plan.prepare(cleaned).collect()}
    assert got == {
        ("양파(1kg)", 1000.0, 3, "ok", "농산물"),
        ("양파(1kg)", 1500.0, 4, None, "농산물"),
        ("양파(1kg)", 3000.0, 4, None, "농산물"),
        ("양파(1kg)", 2000.0, 4, None, "농산물"),
        ("멸치액젓 1kg", None, 4, None, "생선/해산물"),
    }
    report = plan.item_report(plan.prepare(cleaned))
    assert {(r["item_group"], r["year"], r["month"], r["count"]) for r in report.collect()} == {
        ("onion", 2023, None, 4), ("onion", None, 3, 1), ("onion", None, 4, 3),
    }


def test_required_columns(spark):
    df = frame(spark, [(1,)], "a int")
    assert schema.require_columns(df, "a") is df
    with pytest.raises(ValueError):
        schema.require_columns(df, "a", "b")


def test_rule_constants():
    assert len(rules.TITLE_EXCLUDE) == 7 and len(rules.TITLE_EXCLUDE_SHORT) == 6
    assert [c for c, _ in rules.CATEGORY_RULES] == list(rules.CATEGORY_SLUGS)


# plans


def explained(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyword_filters_reach_the_scan(spark, small):
    part = samples.table(spark, small, "part").select("p_partkey", "p_name")
    found = rows.titles_including_excluding(part, "p_name", samples.TITLE_INCLUDE, samples.TITLE_EXCLUDE)
    text = explained(found)
    assert "Or(StringContains(p_name,widget),StringContains(p_name,gear))" in text
    assert "Not(StringCont" in text and "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_facts_are_not_shuffled_to_get_their_fences(spark, small):
    line = samples.table(spark, small, "lineitem").select("l_partkey", "l_extendedprice")
    text = explained(outliers.remove_outliers(line, ["l_partkey"], "l_extendedprice"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_volatility_reads_two_columns_and_combines_before_its_shuffle(spark, small):
    line = samples.table(spark, small, "lineitem")
    text = explained(vol.volatility(line, ["l_returnflag"], "l_extendedprice"))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in text
    assert "partial_avg" in text and text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("n", [700, 1999])
@pytest.mark.parametrize("alike", [1, 900])
def test_head_is_found_by_counting(spark, monkeypatch, n, alike):
    """With few keys drawn and sorted at a time; nulls come first, equal rows on both sides of the border are counted."""
    monkeypatch.setattr(rows, "_DRAWN", 50)
    monkeypatch.setattr(rows, "_SORTED", 20)
    data = [(None if i % 7 == 0 else (i * 7919) % 2000 // alike, str(i // alike % 5)) for i in range(2000)]
    df = frame(spark, data, "k int, v string").repartition(5)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    want = sorted(data, key=order)
    assert sorted(plain(rows.head_slice(df, n, ["k"])), key=order) == want[:n]
    assert sorted(plain(rows.drop_tail(df, n, ["k"])), key=order) == want[: max(0, len(want) - n)]


def test_head_slice_moves_no_rows(spark):
    df = spark.range(100_000).selectExpr("(id * 7919) % 100003 AS k", "id")
    text = rows.drop_tail(df, 1000, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in text.split("scalar-subquery")[0] and "Join" not in text
    assert rows.drop_tail(df, 1000, ["k"]).count() == 99_000


def test_levels_equal_separate_aggregates(spark):
    """With missing keys and prices, two names for one level, and groups far apart in size."""
    data = [(None if i % 11 == 0 else f"d{i % 3}", None if i % 13 == 0 else i % 4, None if i % 5 == 0 else (1e9 if i % 3 else 1.0) + i % 7 / 10) for i in range(600)]
    df = frame(spark, data, "d string, y int, p double")
    levels = {"d": ["d"], "again": ["d"], "dy": ["y", "d"], "y": ["y"], "all": []}
    got = {(r.level, r.d, r.y): (r["mean"], r["std"], r["count"]) for r in vol.volatility_levels(df, levels, "p").collect()}
    want = {}
    for name, keys in levels.items():
        for r in vol.volatility(df, keys, "p").collect() if keys else df.agg(*moments("p")).collect():
            values = r.asDict()
            want[name, values.get("d"), values.get("y")] = (r["mean"], r["std"], r["count"])
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_shifted_sums_keep_small_spreads(spark):
    """A spread of a few tenths beside values of a billion, and beside one far value."""
    import statistics

    for far in ([], [1e9]):
        values = [1e6 + i % 10 / 10 for i in range(1000)] + far
        df = frame(spark, [("a", "x" if i < 500 else "y", v) for i, v in enumerate(values)], "category string, item_name string, price double")
        got = {r.stage: r for r in profile.price_summary(df).collect()}
        assert got["before"]["std"] == pytest.approx(statistics.stdev(values), rel=1e-7)
        assert got["after"]["std"] == pytest.approx(statistics.stdev(values[:1000]), rel=1e-7)
        assert got["after"]["mean"] == pytest.approx(statistics.mean(values[:1000])) and got["after"]["count"] == 1000


def test_zero_repair_evaluates_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = frame(spark, [("a", 2020, float(i % 4)) for i in range(100)], "item_name string, year bigint, price double")
    repaired = quality.repair_zeros(df.mapInArrow(counted, df.schema))
    assert repaired.count() == 100 and seen.value == 100
