"""URL rules looked up in a sorted digest array.

The rules become two arrays (their hosts, and host with path) of 64-bit digests in order, with the full strings beside
them, in one file that every worker maps into memory. A probe is a vectorised binary search; a hit counts only
when the stored string is the one looked for, so equal digests do no harm. The file is made from a
list that the caller holds, and is mapped rather than loaded, so its size is bounded by that list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu.llm.files import array_file, mapped_arrays, shared_file

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

Digest = Callable[[bytes], int]


def url_host(url: Column | str) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column | str) -> Column:
    """After the host up to ?, # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


class DigestArray:
    """Strings by sorted 64-bit digest, each with a number."""

    def __init__(self, digests: np.ndarray, values: np.ndarray, ends: np.ndarray, letters: np.ndarray, digest: Digest):
        self.digests, self.values, self.ends, self.letters, self.digest = digests, values, ends, letters, digest

    @staticmethod
    def laid_out(strings: dict[bytes, int], digest: Digest) -> list[np.ndarray]:
        keyed = sorted((digest(s), s, v) for s, v in strings.items())
        return [
            np.array([k for k, _, _ in keyed], np.uint64),
            np.array([v for _, _, v in keyed], np.int64),
            np.cumsum([0, *(len(s) for _, s, _ in keyed)]).astype(np.int64),
            np.frombuffer(b"".join(s for _, s, _ in keyed), np.uint8),
        ]

    def find(self, strings: list[bytes]) -> np.ndarray:
        """The number of each string, -1 where it is not stored."""
        out = np.full(len(strings), -1, np.int64)
        if not strings or not len(self.digests):
            return out
        wanted = np.fromiter(map(self.digest, strings), np.uint64, len(strings))
        at, end = np.searchsorted(self.digests, wanted, "left"), np.searchsorted(self.digests, wanted, "right")
        open_ = np.flatnonzero(at < end)
        while len(open_):
            for i in open_:
                k = at[i]
                if self.letters[self.ends[k] : self.ends[k + 1]].tobytes() == strings[i]:
                    out[i] = self.values[k]
            at[open_] += 1
            open_ = open_[(out[open_] < 0) & (at[open_] < end[open_])]
        return out


class Rules:
    """The rules in a mapped file: a number for each host, the path lengths under it, a number for each rule."""

    def __init__(self, file: str, digest: Digest):
        arrays = mapped_arrays(file)
        self.hosts, self.rules = DigestArray(*arrays[:4], digest), DigestArray(*arrays[4:8], digest)
        self.starts, self.lengths = arrays[8:10]
        self.names, self.verdicts = arrays[10:12], arrays[12:]

    @staticmethod
    def content(rules: list[tuple[str, str, str]], digest: Digest) -> bytes:
        hosts: dict[bytes, int] = {}
        full: dict[bytes, int] = {}
        lengths: list[set[int]] = []
        for i, (_, host, path) in enumerate(rules):
            at = hosts.setdefault(host.encode(), len(hosts))
            if at == len(lengths):
                lengths.append(set())
            lengths[at].add(len(path))
            full[_full(host, path)] = i
        arrays = DigestArray.laid_out(hosts, digest) + DigestArray.laid_out(full, digest)
        arrays += [
            np.cumsum([0, *map(len, lengths)]).astype(np.int64),
            np.array([n for own in lengths for n in sorted(own, reverse=True)], np.int64),
        ]
        for strings in ([(host + path).encode() for _, host, path in rules], [verdict.encode() for verdict, _, _ in rules]):
            arrays += [np.cumsum([0, *map(len, strings)]).astype(np.int64), np.frombuffer(b"".join(strings), np.uint8)]
        return array_file(arrays)

    def told(self, i: int) -> tuple[str, str]:
        """The rule of a number as host + path, and its verdict."""
        return tuple(letters[ends[i] : ends[i + 1]].tobytes().decode() for ends, letters in (self.names, self.verdicts))

    def longest(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """The number of the longest rule that fits each URL, -1 where none does."""
        owner, tails, text = [], [], []
        for i, host in enumerate(hosts):
            tail = host
            while True:
                owner.append(i)
                tails.append(tail)
                text.append(tail.encode())
                _, dot, tail = tail.partition(".")
                if not dot:
                    break
        row, full, size = [], [], []
        for k in np.flatnonzero((known := self.hosts.find(text)) >= 0):
            i, path = owner[k], paths[owner[k]]
            for n in self.lengths[self.starts[known[k]] : self.starts[known[k] + 1]]:
                if n <= len(path):
                    row.append(i)
                    full.append(_full(tails[k], path[:n]))
                    size.append((len(tails[k]) + n, len(tails[k])))
        found = self.rules.find(full)
        out, best = np.full(len(hosts), -1, np.int64), {}
        for k in np.flatnonzero(found >= 0):
            if size[k] > best.get(row[k], (-1, -1)):
                best[row[k]], out[row[k]] = size[k], found[k]
        return out


def _full(host: str, path: str) -> bytes:
    return host.encode() + b"\0" + path.encode()


def judge(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    default: str = "allow",
    url: str = "url",
    key: str = "page_id",
    digest: Digest = xxhash.xxh64_intdigest,
) -> DataFrame:
    """One row per row of `pages`: key, host, path, rule (as host + path, null if none fits), verdict.

    `rules` holds (verdict, host, path). A rule fits its host and all subdomains where the URL's path starts with the rule's;
    the longest wins, of equally long ones that with the longer host; of a rule given twice the last. URLs that no
    rule fits get `default`, so do null URLs. Repeated rows stay, null keys too; further columns are not looked at; an
    empty table gives no rows, and without rules all URLs get `default`.
    """
    lowered = str.maketrans(_UPPER, _LOWER)
    listed = [(verdict, host.translate(lowered), path) for verdict, host, path in rules]
    name = shared_file(pages.sparkSession, Rules.content(listed, digest), "url-rules")
    parts = pages.select(key, url_host(url).alias("host"), url_path(url).alias("path"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Rules(SparkFiles.get(name), digest)
        for batch in batches:
            found = known.longest(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            told = [known.told(i) if i >= 0 else (None, default) for i in found]
            columns = [pa.array([x[n] for x in told], pa.string()) for n in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [key, "host", "path", "rule", "verdict"])

    schema = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    return parts.mapInArrow(judged, schema)
