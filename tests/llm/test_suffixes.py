from collections import Counter

import numpy as np
import pytest

from jangbu.llm import suffixes
from jangbu.llm.suffixes import common_prefixes, repeated, suffix_order


def pieces(rng):
    out = [rng.integers(0, 2, rng.integers(0, 60)) * rng.integers(0, 2) for _ in range(rng.integers(1, 6))]
    if rng.integers(3) == 0:
        out += [out[0][:40], np.concatenate([out[0], out[-1]])]
    data = np.concatenate(out).astype(np.uint8)
    return data, np.cumsum([0] + [len(p) for p in out])


@pytest.mark.parametrize("packed", [63, 0])
@pytest.mark.parametrize("seed", range(60))
def test_order_prefixes_and_repeats(monkeypatch, seed, packed):
    monkeypatch.setattr(suffixes, "_PACKED", packed)
    rng = np.random.default_rng(seed)
    data, ends = pieces(rng)
    if not len(data):
        return
    tails = {i: data[i:b].tobytes() for a, b in zip(ends[:-1], ends[1:]) for i in range(a, b)}
    order = suffix_order(data, ends)
    assert [tails[i] for i in order] == sorted(tails.values())
    shared = common_prefixes(data, ends, order, 10)
    for k in range(1, len(order)):
        a, b = tails[order[k - 1]], tails[order[k]]
        assert shared[k] == min(10, next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b))))
    size = int(rng.integers(1, 30))
    counts = Counter(t[:size] for t in tails.values() if len(t) >= size)
    assert [counts[tails[i][:size]] > 1 and len(tails[i]) >= size for i in range(len(data))] == repeated(data, ends, size).tolist()
