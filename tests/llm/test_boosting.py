"""Trees against plain loops: every split is the best one of its node, every leaf its Newton step, every score a walk."""

import math

import numpy as np
import pytest

from jangbu.llm import boosting

DEPTH, BINS, RATE, LEAST, RIDGE = 3, 8, 0.3, 1.5, 1.0


def chance(x):
    return 1 / (1 + math.exp(-x))


def walk(forest, t, row):
    """The leaf of a row, and the tests on the way to it."""
    at, way, tests = 0, [], forest.feature.shape[1]
    while at < tests:
        way.append(at)
        at = 2 * at + (2 if row[forest.feature[t, at]] > forest.limit[t, at] else 1)
    return at - tests, way


def score_of(forest, row, trees):
    return forest.base + sum(forest.leaf[t, walk(forest, t, row)[0]] for t in range(trees))


def data(seed, n=120):
    rng = np.random.default_rng(seed)
    rows = np.stack([rng.normal(size=n), rng.integers(0, 4, n), np.ones(n), rng.normal(size=n)], axis=1)
    return rows, ((rows[:, 0] + 0.5 * rows[:, 1] + rng.normal(size=n) * 0.5) > 0.7).astype(int)


@pytest.mark.parametrize("seed", range(4))
def test_scores_are_walks_of_all_trees(seed):
    rows, labels = data(seed)
    forest = boosting.fit(rows, labels, trees=7, depth=DEPTH, bins=BINS, rate=RATE, least=LEAST, ridge=RIDGE)
    more = np.concatenate([rows, data(seed + 100)[0], forest.limit[np.isfinite(forest.limit)][:20, None] * np.ones(4)])
    assert np.allclose(forest.scores(more), [chance(score_of(forest, r, 7)) for r in more], atol=1e-12)


@pytest.mark.parametrize("seed", range(4))
def test_splits_are_the_best_and_leaves_their_steps(seed):
    rows, labels = data(seed)
    forest = boosting.fit(rows, labels, trees=4, depth=DEPTH, bins=BINS, rate=RATE, least=LEAST, ridge=RIDGE)
    borders = [sorted({float(q) for q in np.quantile(c, [k / BINS for k in range(1, BINS)])}) for c in rows.T]
    split = 0
    for t in range(4):
        p = [chance(score_of(forest, r, t)) for r in rows]
        gradient, weight = [y - q for y, q in zip(labels, p)], [q * (1 - q) for q in p]
        worth = lambda who: sum(gradient[i] for i in who) ** 2 / (sum(weight[i] for i in who) + RIDGE)
        ways = [walk(forest, t, r) for r in rows]

        def gain(who, feature, limit):
            left = [i for i in who if rows[i][feature] <= limit]
            right = [i for i in who if rows[i][feature] > limit]
            if min(sum(weight[i] for i in left), sum(weight[i] for i in right)) < LEAST:
                return -1.0
            return worth(left) + worth(right)

        for test in range(2**DEPTH - 1):
            who = [i for i, (_, way) in enumerate(ways) if test in way]
            best = max(gain(who, f, b) for f in range(4) for b in borders[f])
            feature, limit = forest.feature[t, test], forest.limit[t, test]
            if math.isinf(limit):
                assert best <= worth(who) + 1e-6
            else:
                split += 1
                assert limit in borders[feature] and gain(who, feature, limit) == pytest.approx(best, abs=1e-9)
                assert best > worth(who)
        for leaf in range(2**DEPTH):
            who = [i for i, (at, _) in enumerate(ways) if at == leaf]
            step = RATE * sum(gradient[i] for i in who) / (sum(weight[i] for i in who) + RIDGE)
            assert forest.leaf[t, leaf] == pytest.approx(step, abs=1e-12)
    assert split > 4


def test_no_rows_and_one_label_give_the_smoothed_share():
    rows = np.arange(6.0).reshape(3, 2)
    assert boosting.fit(rows[:0], np.zeros(0)).scores(rows).tolist() == [0.5] * 3
    assert boosting.fit(rows, np.ones(3)).scores(rows) == pytest.approx([0.8] * 3)
