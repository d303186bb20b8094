"""Top-k search and hard negatives against plain versions, and their edge cases."""

import random

import numpy as np
import pytest

from jangbu.llm import negatives, topk, vectors

SCHEMA = "vec_id long, embedding array<double>, label long, row string, score int, rank string, bar string, _i int"
NAN, INF = float("nan"), float("inf")
#: Rows that take no part.
OUT = [(None, [1.0, 1.0, 1.0], 1), (200, None, 1), (300, [1.0, None, 1.0], 1), (400, [NAN, 1.0, 1.0], 2), (500, [INF, 0.0, 0.0], 2), (600, [1e300, 0.0, 0.0], 2)]


def rows_of(seed, n=150, width=6):
    """Small whole components, so that ties are frequent; repeated ids and vectors of other lengths among them."""
    r = random.Random(seed)
    rows = [(i, [r.randrange(-2, 3) / 2 for _ in range(width)], r.randrange(3)) for i in range(n)]
    return rows + [rows[0], rows[7], (100, [1.0], 1), (100, [], 2), (n + 1, [0.0] * width, 0)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, "k", "b", 3) for r in rows], SCHEMA)


def product(a, b, scale):
    return sum(int(np.floor(x * scale)) * int(np.floor(y * scale)) for x, y in zip(a, b))


def plain_top(rows, every, k):
    out = []
    for i, (q, v, _) in enumerate(rows):
        if q % every == 0:
            order = sorted((-product(v, w, 1024), c) for j, (c, w, _) in enumerate(rows) if j != i)
            out += [(q, n, c, -s) for n, (s, c) in enumerate(order[:k], 1)]
    return sorted(out)


def plain_mine(rows, every):
    out = []
    for i, (a, v, label) in enumerate(rows):
        if a % every:
            continue
        order = sorted((-product(v, w, 256), b, other) for j, (b, w, other) in enumerate(rows) if j != i)
        for s, p, _ in [o for o in order if o[2] == label][:5]:
            inside = [(b, -t) for t, b, other in order if other != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, n, b, -s, t) for n, (b, t) in enumerate(inside[:10], 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(params=[8192, 40])
def blocks(request, monkeypatch):
    """One block, and several of either kind."""
    for f in (vectors.against_all, vectors.against_one):
        monkeypatch.setattr(f, "__defaults__", (request.param,))


def test_search_equals_the_plain_version(spark, blocks):
    rows = rows_of(1)
    assert result(topk.search(table(spark, rows + OUT), every=20)) == plain_top(rows, 20, 10)


def test_negatives_equal_the_plain_version(spark, blocks):
    rows = rows_of(2)
    got = result(negatives.mine(table(spark, [*rows, *OUT, (20, [1.0], None)]), every=20))
    assert got == plain_mine(rows, 20) and got


@pytest.mark.parametrize("operator", [topk.search, negatives.mine])
def test_empty_tables(spark, operator):
    assert operator(table(spark, [])).collect() == []
    assert operator(table(spark, OUT)).collect() == []
    assert operator(table(spark, [(100, [1.0], 1)])).collect() == []


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 2)]
    assert result(topk.search(table(spark, rows))) == plain_top(rows, 100, 10)
    assert result(negatives.mine(table(spark, rows))) == plain_mine(rows, 100)


@pytest.mark.parametrize("size", [2, 1 << 40])
def test_lists_find_all_that_may_be_first(size):
    """Whatever the place where reading stops; beyond 2^53 as below."""
    r = np.random.default_rng(3)
    block = r.integers(-size, size, (3000, 9))
    block[::3] = block[0]
    lists = topk.SortedLists(block)
    for q in range(0, 60, 7):
        exact = [int(x) for x in block.astype(object) @ (block[q].astype(object) % 1000 - 500)]
        query = np.array([int(x) % 1000 - 500 for x in block[q]], np.int64)
        kth = sorted(exact[:q] + exact[q + 1 :])[-10]
        for bar in (-np.inf, kth):
            found, scores = lists.top(query, 10, q, bar)
            assert {i for i, s in enumerate(exact) if s >= kth and i != q} <= set(found.tolist())
            assert scores.tolist() == [exact[i] for i in found]


def test_reading_stops_early():
    """With one long vector among short ones few lists are read and few scores settled."""
    r = np.random.default_rng(4)
    block = r.integers(-10, 10, (2000, 8))
    block[:20] += 1000
    found, _ = topk.SortedLists(block).top(np.full(8, 5), 10)
    assert len(found) <= topk.FEW * 10


def test_shares_are_exact(spark):
    scores = [0, 1, 9, 10, 11, 99, 100, 101, 12345678901234567, (1 << 62) + 77]
    df = spark.createDataFrame([(s,) for s in scores], "s long")
    got = df.select("s", negatives._share("s", 90).alias("u"), negatives._share("s", 30, up=True).alias("l")).collect()
    assert all(r.u == 90 * r.s // 100 and r.l == -(-30 * r.s // 100) for r in got)
