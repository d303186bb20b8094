"""Exact quantiles, and approximate ones within their error."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jangbu.operators import outliers, quantiles
from jangbu.plans import samples
from jangbu.plans import survey as plan

PROBS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def _groups():
    rng = random.Random(7)
    return {
        "hot": [round(rng.lognormvariate(8, 2), 2) for _ in range(4000)],
        "ties": [100.0] * 500 + [99.99] * 10 + [0.0] * 20,
        "signs": [rng.uniform(-5, 5) for _ in range(301)] + [0.0, -0.0],
        "tiny": [1e-9, 3e-9, 1e300, -1e300, 10.0, 100.0, 1000.0, 999.9999999999999],
        "one": [5.0],
    }


def test_exact_quantiles_equal_numpy(spark):
    groups = _groups()
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [(None, 1.0), ("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", PROBS).collect()}
    assert set(got) == set(groups)
    for key, vs in groups.items():
        assert got[key]["n_values"] == len(vs)
        for name, p in PROBS.items():
            assert got[key][name] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12)


def test_agrees_with_the_built_in_on_the_survey(spark, small):
    df, keys = samples.survey(spark, small), ["item_name", "year"]
    built_in = df.groupBy(*keys).agg(*[F.percentile("price", p).alias(n) for n, p in PROBS.items()], F.count("price"))
    left, right = (sorted(map(tuple, w.collect())) for w in (quantiles.exact_quantiles(df, keys, "price", PROBS), built_in))
    assert len(left) == len(right) > 100
    for a, b in zip(left, right):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])


def test_all_doubles_and_a_narrow_hot_range(spark):
    inf, nan = float("inf"), float("nan")
    groups = {
        "inf": [-inf, 1.0, 2.0, inf, inf],
        "subnormal": [1e-323, 5e-324, 0.0, -1e-323],
        "narrow": [1000 + i / 1e6 for i in range(5000)],
        "nan": [nan, 1.0, 3.0],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", {"low": 0.0, "mid": 0.5, "high": 1.0}).collect()}
    assert (got["inf"]["low"], got["inf"]["mid"], got["inf"]["high"]) == (-inf, 2.0, inf)
    assert (got["subnormal"]["low"], got["subnormal"]["high"]) == (-1e-323, 1e-323)
    assert got["narrow"]["mid"] == pytest.approx(np.median(groups["narrow"]))
    assert (got["nan"]["low"], got["nan"]["mid"]) == (1.0, 3.0) and np.isnan(got["nan"]["high"])


def test_approximate_quartiles_keep_their_rank_error(spark, small):
    df = samples.survey(spark, small)
    per_item = {}
    for r in df.select("item_name", "price").collect():
        per_item.setdefault(r[0], []).append(r[1])
    for r in quantiles.approx_group_quartiles(df, ["item_name"], "price", 0.05).collect():
        prices = np.sort(per_item[r["item_name"]])
        for q, p in ((r["q1"], 0.25), (r["q3"], 0.75)):
            low, high = np.searchsorted(prices, q, "left"), np.searchsorted(prices, q, "right")
            assert low - 0.05 * len(prices) - 1 <= p * len(prices) <= high + 0.05 * len(prices) + 1


def test_approximate_outliers_are_a_part_of_the_rows(spark, small):
    df = samples.survey(spark, small)
    kept = plan.item_rows(df, samples.ITEM_GROUPS, samples.UNIT_FIXES, True, samples.ITEM_CATEGORIES)
    exact = plan.item_rows(df, samples.ITEM_GROUPS, samples.UNIT_FIXES, False, samples.ITEM_CATEGORIES)
    assert 0.9 * exact.count() <= kept.count()
    assert kept.columns == exact.columns


def test_approximate_median_takes_an_existing_value(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)], "k string, v double")
    assert quantiles.approx_group_median(df, ["k"], "v").first()["median"] == 2.0
    assert quantiles.group_median(df, ["k"], "v").first()["median"] == 2.5


def test_fences(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("a", None), (None, 2.0)], "k string, price double")
    bounds = outliers.exact_fences(df, ["k"]).first()
    assert (bounds["lower"], bounds["upper"]) == (-1.0, 7.0)
    assert sorted(r["price"] for r in outliers.remove_outliers(df, ["k"]).collect()) == [1.0, 2.0, 3.0, 4.0]
    counts = outliers.removed_counts(df, ["k"]).first()
    assert (counts["n_rows"], counts["n_removed"]) == (6, 2)


def test_outlier_rows_are_input_rows(spark, small):
    df = samples.survey(spark, small)
    kept = outliers.remove_outliers(df, ["category", "item_name"])
    assert kept.exceptAll(df).count() == 0


def test_the_survey_has_outliers_in_every_group(spark, small):
    grouped = plan.grouped_items(samples.survey(spark, small), samples.ITEM_GROUPS, samples.UNIT_FIXES, samples.ITEM_CATEGORIES)
    removed = {r["item_group"]: r["n_removed"] for r in outliers.removed_counts(grouped, ["item_group"]).collect()}
    assert set(removed) == set(samples.ITEM_GROUPS) and min(removed.values()) > 0


def test_item_groups_stay_in_their_categories(spark):
    rows = [("축산물", "돼지고기 1근", 1.0), ("가공식품", "햄(돼지고기) 1개", 9.0), ("가공식품", "만두(돼지고기,배추)", 8.0)]
    df = spark.createDataFrame(rows, "category string, item_name string, price double").withColumn("sales_unit", F.lit("x"))
    assert [r["price"] for r in plan.grouped_items(df).collect()] == [1.0]
