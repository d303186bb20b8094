"""TF-IDF against the formula written out in plain Python."""

import math
import re
from collections import Counter

import pytest

from jangbu.operators import similarity

TITLES = {
    1: "양파(1.5kg/망)",
    2: "못난이 양파(3kg/망)",
    3: "쌈용맛배추(팩)",
    4: "Red red BIG pepper",
    5: "!",
    6: None,
    7: "양파",
}
TARGETS = ["양파", "red pepper", "없음"]


def grams(text):
    words = re.findall(r"(?u)\b\w\w+\b", text.lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def vector(counts, idf):
    raw = {g: n * idf[g] for g, n in counts.items() if g in idf}
    length = math.sqrt(sum(w * w for w in raw.values()))
    return {g: w / length for g, w in raw.items()} if length else {}


def expected():
    counts = {k: Counter(grams(t)) for k, t in TITLES.items() if t is not None}
    df = Counter(g for c in counts.values() for g in c)
    idf = {g: math.log((1 + len(counts)) / (1 + n)) + 1 for g, n in df.items()}
    weights = {k: vector(c, idf) for k, c in counts.items()}
    targets = [vector(Counter(grams(t)), idf) for t in TARGETS]
    best = {k: max(sum(w * t.get(g, 0) for g, w in v.items()) for t in targets) for k, v in weights.items()}
    return weights, best


def test_grams(spark):
    df = spark.createDataFrame(list(TITLES.items()), "id int, title string")
    got = {}
    for r in similarity.gram_counts(df, "id", "title").collect():
        got.setdefault(r["id"], Counter())[r["gram"]] = r["tf"]
    assert got[1] == Counter(["양파", "5kg", "양파 5kg", ""])
    assert got[2] == Counter(["못난이", "양파", "3kg", "못난이 양파", "양파 3kg", ""])
    assert got[4]["red"] == 2 and got[5] == Counter([""]) and 6 not in got


def test_weights_and_similarity(spark):
    df = spark.createDataFrame(list(TITLES.items()), "id int, title string")
    weights, best = expected()
    got = {}
    for r in similarity.tfidf_weights(df, "id", "title").collect():
        got.setdefault(r["id"], {})[r["gram"]] = r["weight"]
    assert {k: pytest.approx(v) for k, v in weights.items() if v} == got
    scores = {r["id"]: r["max_similarity"] for r in similarity.max_similarity(df, "id", "title", TARGETS, limit=None).collect()}
    assert scores == {k: pytest.approx(v) for k, v in best.items()}
    above = {r["id"] for r in similarity.max_similarity(df, "id", "title", TARGETS).collect()}
    assert above == {k for k, v in best.items() if v > 0.005}


def test_a_thousand_targets_take_the_plan_of_three(spark):
    df = spark.createDataFrame([(i, f"word{i} word{i + 1} and more") for i in range(50)] + [(50, None), (51, "none")], "id int, title string")
    few, many = ([f"word{i}" for i in range(n)] for n in (3, 1000))
    nodes = [similarity.max_similarity(df, "id", "title", t, limit=None)._jdf.queryExecution().optimizedPlan() for t in (few, many)]
    assert nodes[0].toString().count("\n") == nodes[1].toString().count("\n")
    got = {r["id"]: r["max_similarity"] for r in similarity.max_similarity(df, "id", "title", many, limit=None).collect()}
    each = {}
    for start in range(0, 51, 17):
        for r in similarity.max_similarity(df, "id", "title", many[start : start + 17], limit=None).collect():
            each[r["id"]] = max(each.get(r["id"], 0), r["max_similarity"])
    assert got == pytest.approx(each) and got[51] == 0 and 50 not in got and min(got[i] for i in range(50)) > 0


def test_repeated_and_missing_keys_count_as_one_text(spark):
    texts = [(1, "red red pepper"), (1, "red pepper"), (None, "red"), (None, "pepper"), (2, "red pepper"), (3, None), (4, "?")]
    df = spark.createDataFrame(texts, "id int, title string")
    got = {(r["id"], r["gram"]): r["tf"] for r in similarity.gram_counts(df, "id", "title").collect()}
    once = {(2, "red"): 1, (2, "pepper"): 1, (2, "red pepper"): 1, (2, ""): 1, (4, ""): 1}
    assert got == once | {
        (1, "red"): 3, (1, "pepper"): 2, (1, "red red"): 1, (1, "red pepper"): 2, (1, ""): 2,
        (None, "red"): 1, (None, "pepper"): 1, (None, ""): 2,
    }


@pytest.mark.parametrize("limits", [(4000, 3, 1 << 17), (1, 1, 2), (4000, 1, 1)])
def test_results_do_not_depend_on_the_frequent_grams(spark, monkeypatch, limits):
    for name, value in zip(("_DRAWN", "_LEAST", "_FREQUENT"), limits):
        monkeypatch.setattr(similarity, name, value)
    texts = {i: f"red {'big ' * (i % 4)}pepper{i % 7} word{i // 2}" for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "id int, title string")
    monkeypatch.setitem(globals(), "TITLES", texts)
    monkeypatch.setitem(globals(), "TARGETS", ["red pepper3", "big big", "word4", "gone"])
    weights, best = expected()
    scores = {r["id"]: r["max_similarity"] for r in similarity.max_similarity(df, "id", "title", TARGETS, limit=None).collect()}
    assert scores == {k: pytest.approx(v) for k, v in best.items()}
    got = {}
    for r in similarity.tfidf_weights(df, "id", "title").collect():
        got.setdefault(r["id"], {})[r["gram"]] = r["weight"]
    assert got == {k: pytest.approx(v) for k, v in weights.items()}


def test_grams_are_not_aggregated_or_joined_one_by_one(spark):
    """The grams of a text are counted in its row, those of all texts are moved by gram once, and no join of them is sorted."""
    df = spark.createDataFrame([(i, f"word{i} word{i % 5} and more") for i in range(40)], "id int, title string")
    plan = similarity.max_similarity(df, "id", "title", ["word1"], limit=None)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert plan.count("hashpartitioning(gram") == 1
