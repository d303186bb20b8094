"""The texts of an Arrow batch as one byte array, with their words and lines as spans in it.

What the numpy operators share. All functions work on whole batches; nothing is sampled or cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Space and the five ASCII control characters that separate words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(max(n, 1), U64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * U64(pow(base, done, 1 << 64))
        done += step
    return out[:n]


def joined(column: pa.Array, binary: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (or all bytes), and where each ends, starting with 0; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"" if binary else "") if column.null_count else column
    column = column.cast(pa.large_binary() if binary else pa.large_string())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def small(batches: Iterator[pa.RecordBatch], column: int = 1, size: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about `size` bytes of text, one text at least, so that working arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, to - at)
            at = to


class Texts:
    """Texts side by side: `data` holds their bytes, text i reaches from ends[i] to ends[i + 1]."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data, self.ends, self.n = data, ends, len(ends) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        return cls(*joined(column))

    def lowered(self) -> Texts:
        """A-Z in lower case."""
        return Texts(LOWER[self.data], self.ends)

    @cached_property
    def space(self) -> np.ndarray:
        return SPACE[self.data]

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and the byte after the last of every word, in order."""
        return _runs(~self.space, self.ends)

    @cached_property
    def word_text(self) -> np.ndarray:
        """The text of each word."""
        return np.searchsorted(self.ends, self.words[0], "right") - 1

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.bincount(self.word_text, minlength=self.n)

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Spans between line feeds and text ends, empty ones left out."""
        return _runs(self.data != 10, self.ends)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text the sum of one value a byte."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.ends[1:]] - total[self.ends[:-1]]

    @cached_property
    def _prefix(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.data)
        total = np.zeros(n + 1, U64)
        np.cumsum((self.data.astype(U64) + U64(1)) * powers(_BASE, n), out=total[1:])
        return total, powers(_INVERSE, n + 1)

    def hashes(self, spans: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """A 64-bit hash of each span's bytes, equal for equal bytes wherever they stand."""
        starts, stops = spans
        total, back = self._prefix
        own = (total[stops] - total[starts]) * back[starts]
        return mixed(own + mixed((stops - starts).astype(U64)))

    def grams(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each run of `size` words of one text, and the number of its first word."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        first = np.flatnonzero(self.word_text[: n] == self.word_text[size - 1 :])
        own = np.zeros(len(first), U64)
        for k in range(size):
            own = own * U64(_BASE) + hashes[first + k]
        return mixed(own), first


def _runs(inside: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of each run of True, broken at the ends of texts."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    borders = ends[1:-1]
    borders = borders[(borders > 0) & (borders < n)]
    opens[borders] = inside[borders]
    closes[borders - 1] = inside[borders - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def counts_within(owner: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (owner, key), how often it occurs, and whether the same stands earlier."""
    both = mixed(keys ^ mixed(owner.astype(U64) + U64(1)))
    order = np.argsort(both, kind="stable")
    ranked = both[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    n, again = np.empty(len(ranked), np.int64), np.empty(len(ranked), bool)
    n[order], again[order] = size[group] if len(size) else 0, ~new
    return n, again
