"""Remove every byte covered by a string of 200 bytes that also starts elsewhere in the corpus.

Equal texts are settled by their digest and go on as one. Of the rest, every window of 200 bytes names an anchor, the smallest
hash of the short grams in it; equal windows name the same one. Only windows whose anchor occurs
more than once can repeat. Their stretches of text (all windows of one anchor in a row) come together by anchor in
shards of bounded size, and each shard's suffix array with its common prefixes shows which windows repeat.

An anchor with very many different stretches is cut into several shards. These are merged afterwards: each hands on
SHA-256 digests of its different windows, sorted and cut at the borders of digest ranges by binary search, and the lists of one range
are searched in each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu.llm.spans import U64, Texts, joined, mixed, small
from jangbu.llm.suffixes import repeated
from jangbu.llm.text import present
from jangbu.session import settle

SIZE = 200
#: Bytes of a gram: a power of two. Smaller grams make fewer and longer stretches, longer ones repeat less by chance.
GRAM = 64
#: Windows of one stretch, stretches of one anchor in a shard, bytes that one suffix array takes in.
STRETCH, PART, SHARD = 256, 128, 1 << 20
#: Windows of one text that are looked at together.
_BLOCK = 1 << 20

#: The first 16 bytes of a SHA-256.
_DIGEST = np.dtype("S16")
_LETTERS = mixed(np.arange(1, 257, dtype=U64))


def _sliding(values: np.ndarray, width: int, extreme: np.ufunc) -> np.ndarray:
    """The extreme of each run of `width` values."""
    own, done, n = values, 1, len(values) - width + 1
    while 2 * done <= width:
        own = extreme(own[:-done], own[done:])
        done *= 2
    return extreme(own[:n], own[width - done : width - done + n])


def _grams(data: np.ndarray) -> np.ndarray:
    own, done = _LETTERS[data], 1
    while done < GRAM:
        own = own[:-done] * U64(0x9E3779B97F4A7C15 + 2 * done) + own[done:]
        done *= 2
    return mixed(own) | U64(1)


def stretches(texts: Texts, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: text, first window (a position in `data`), windows, anchor."""
    found = [[], [], [], []]
    for block in _blocks(texts, size):
        for column, values in zip(found, _of_block(texts, *block, size)[0]):
            column.append(values)
    return tuple(np.concatenate(c) if c else np.zeros(0, np.int64) for c in found[:3]) + (
        np.concatenate(found[3]) if found[3] else np.zeros(0, U64),
    )


def anchors(texts: Texts, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Text and anchor, once for each text that has it, twice if it stands in more than one place there."""
    owners, values = [], []
    for block in _blocks(texts, size):
        owner, value = _of_block(texts, *block, size)[1]
        owners.append(owner)
        values.append(value)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    owner, value = np.concatenate(owners), np.concatenate(values)
    place = np.lexsort((value, owner))
    owner, value = owner[place], value[place]
    same = np.zeros(len(owner), bool)
    same[1:] = (owner[1:] == owner[:-1]) & (value[1:] == value[:-1])
    keep = ~same
    keep[2:] |= same[2:] & ~same[1:-1]
    keep[1:2] |= same[1:2]
    return owner[keep], value[keep]


def _blocks(texts: Texts, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of `data` that together hold every window once; only texts of more than a block are cut, with an overlap."""
    n = len(texts.data)
    at = 0
    while at + size <= n:
        yield at, min(n, at + _BLOCK + size - 1)
        at += _BLOCK


def _of_block(texts: Texts, start: int, stop: int, size: int):
    data = texts.data[start:stop]
    grams = _grams(data)
    width = size - GRAM + 1
    least = _sliding(grams, width, np.minimum)
    at = start + np.arange(len(least))
    owner = np.searchsorted(texts.ends, at, "right") - 1
    whole = texts.ends[owner + 1] - at >= size
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ((at[1:] - texts.ends[owner[1:]]) % STRETCH == 0)
    last = whole.copy()
    last[:-1] &= new[1:] | ~whole[1:]
    first = np.flatnonzero(new)
    runs = owner[first], at[first], np.flatnonzero(last) - first + 1, least[first]
    held = np.zeros(len(grams) + width - 1, U64)
    held[width - 1 : width - 1 + len(least)] = np.where(whole, least, 0)
    standing = np.flatnonzero(_sliding(held, width, np.maximum) == grams)
    return runs, (np.searchsorted(texts.ends, start + standing, "right") - 1, grams[standing])


def _node(text: str = "text"):
    return F.xxhash64(F.sha2(F.col(text).cast("binary"), 256))


def _anchored(docs: DataFrame) -> DataFrame:
    """Per row of (key, node, text): key, node and its anchors."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 2, _BLOCK):
            texts = Texts.of(batch.column(2))
            owner, value = anchors(texts)
            at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts.n))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(at, pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["key", "node", "anchors"])

    schema = T.StructType([docs.schema["key"], docs.schema["node"], T.StructField("anchors", T.ArrayType(T.LongType()))])
    return docs.select("key", "node", "text").mapInArrow(rows, schema)


def _cut_out(chosen: DataFrame) -> DataFrame:
    """Per row of (node, text, anchors): the stretches of these anchors, with their text and its digest."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1, _BLOCK):
            texts = Texts.of(batch.column(1))
            lists = batch.column(2)
            wanted = lists.flatten().to_numpy(zero_copy_only=False).view(U64)
            of = np.repeat(np.arange(texts.n), np.diff(lists.offsets.to_numpy()))
            owner, at, n, anchor = stretches(texts)
            bound = lambda o, a: mixed(a ^ mixed(o.astype(U64)))
            keep = np.flatnonzero(np.isin(bound(owner, anchor), bound(of, wanted)))
            for part in np.array_split(keep, max(1, len(keep) // 4000)):
                pieces = [texts.data[a:b].tobytes() for a, b in zip(at[part], at[part] + n[part] + SIZE - 1)]
                digests = b"".join(hashlib.sha256(x).digest()[:8] for x in pieces)
                columns = [
                    batch.column(0).take(pa.array(owner[part])),
                    pa.array(anchor[part].view(np.int64)),
                    pa.array(np.frombuffer(digests, np.int64)),
                    pa.array((at[part] - texts.ends[owner[part]]).astype(np.int64)),
                    pa.array(n[part].astype(np.int64)),
                    pa.array(pieces, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "anchor", "digest", "start", "n", "bytes"])

    return chosen.select("node", "text", "anchors").mapInArrow(
        rows, "node bigint, anchor bigint, digest bigint, start bigint, n bigint, bytes binary"
    )


def _intervals(flags: np.ndarray) -> np.ndarray:
    """Borders of the runs of True: first, behind the last, and so on."""
    return np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (anchor, part) in runs of whole parts, of about SHARD bytes; a part of a split anchor is alone in its run."""
    held, size, last, alone = [], 0, None, False
    for batch in batches:
        anchor, part = batch.column("anchor").to_numpy(), batch.column("part").to_numpy()
        split, ends = batch.column("parts").to_numpy() > 1, np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy())
        heads = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
        if batch.num_rows and (anchor[0], part[0]) != last:
            heads = np.concatenate([[0], heads])
        begun = done = 0
        for at in heads.tolist():
            before = int(ends[at - 1]) if at else 0
            if size + before - done and (alone or split[at] or size + before - done >= SHARD):
                yield pa.Table.from_batches([*held, batch.slice(begun, at - begun)])
                held, size, begun, done = [], 0, at, before
            alone = bool(split[at])
        if batch.num_rows:
            held.append(batch.slice(begun))
            size += int(ends[-1]) - done
            last = anchor[-1], part[-1]
    if held:
        yield pa.Table.from_batches(held)


def _searched(different: DataFrame) -> DataFrame:
    """For rows (anchor, parts, part, digest, n, bytes), no two alike: the repeated windows of each, as offsets.

    Rows of anchors in several parts also give digests of their windows by range, to be merged.
    """
    kinds = [("anchor", pa.int64()), ("digest", pa.int64()), ("windows", pa.list_(pa.int32())), ("range", pa.int32()), ("known", pa.binary()), ("refs", pa.binary())]
    schema = pa.schema(kinds)

    def lists(shard: pa.Table, data: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Digests of the different windows of a part, each with one place, cut at the borders of ranges."""
        anchor, parts = shard.column("anchor")[0].as_py(), shard.column("parts")[0].as_py()
        n = shard.column("n").to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        raw = data.tobytes()
        known = b"".join(hashlib.sha256(raw[i : i + SIZE]).digest()[:16] for i in (ends[row] + offset).tolist())
        known = np.frombuffer(known, _DIGEST)
        known, one = np.unique(known, return_index=True)
        refs = np.stack([shard.column("digest").to_numpy()[row[one]], offset[one]], axis=1)
        borders = [(i << 64) // parts for i in range(1, parts)]
        borders = np.array([b.to_bytes(8, "big") for b in borders], _DIGEST)
        cuts = [0, *np.searchsorted(known, borders).tolist(), len(known)]
        full = [i for i in range(parts) if cuts[i] < cuts[i + 1]]
        held = [(known[cuts[i] : cuts[i + 1]].tobytes(), refs[cuts[i] : cuts[i + 1]].astype(np.int64).tobytes()) for i in full]
        whole, half = pa.array([anchor] * len(full), pa.int64()), pa.nulls(len(full), pa.int64())
        columns = [whole, half, pa.nulls(len(full), kinds[2][1]), pa.array(full, pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, *(pa.array(list(c), pa.binary()) for c in zip(*held))], schema=schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            data, ends = joined(shard.column("bytes"), binary=True)
            # Windows end with their stretch, so no run of repeated ones goes on into the next.
            edges = _intervals(repeated(data, ends, SIZE))
            row = np.searchsorted(ends, edges, "right") - 1
            hit, first = np.unique(row, return_index=True)
            windows = pa.ListArray.from_arrays(np.append(first, len(row)).astype(np.int32), pa.array((edges - ends[row]).astype(np.int32)))
            columns = [shard.column(c).combine_chunks().take(pa.array(hit)) for c in ("anchor", "digest")]
            yield pa.RecordBatch.from_arrays([*columns, windows, *(pa.nulls(len(hit), k) for _, k in kinds[3:])], schema=schema)
            if shard.column("parts")[0].as_py() > 1:
                yield from lists(shard, data, ends)

    placed = different.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return placed.mapInArrow(search, "anchor bigint, digest bigint, windows array<int>, range int, known binary, refs binary")


def _merged(lists: DataFrame) -> DataFrame:
    """Windows (anchor, digest, windows) that are in the lists of several parts of their anchor."""

    def merge(anchor: int, rows: list[dict]) -> pa.RecordBatch:
        known = [np.frombuffer(r["known"], _DIGEST) for r in rows]
        refs = [np.frombuffer(r["refs"], np.int64).reshape(-1, 2) for r in rows]
        seen, twice = known[0], []
        for own in known[1:]:
            at = np.searchsorted(seen, own)
            both = seen[np.minimum(at, len(seen) - 1)] == own
            twice.append(own[both])
            seen = np.insert(seen, at[~both], own[~both])
        twice = np.unique(np.concatenate([*twice, seen[:0]]))
        found = [refs[0][:0]]
        for own, ref in zip(known, refs):
            if len(twice):
                found.append(ref[twice[np.minimum(np.searchsorted(twice, own), len(twice) - 1)] == own])
        digest, offset = np.concatenate(found).T
        windows = pa.ListArray.from_arrays(np.arange(0, 2 * len(offset) + 1, 2, dtype=np.int32), pa.array(np.stack([offset, offset + 1], axis=1).ravel().astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array([anchor] * len(digest), pa.int64()), pa.array(digest), windows], ["anchor", "digest", "windows"])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["anchor"], row["range"]) != last and held:
                    yield merge(last[0], held)
                    held = []
                last = row["anchor"], row["range"]
                held.append(row)
        if held:
            yield merge(last[0], held)

    placed = lists.select("anchor", "range", "known", "refs").repartition("anchor", "range").sortWithinPartitions("anchor", "range")
    return placed.mapInArrow(ranges, "anchor bigint, digest bigint, windows array<int>")


def _removed(chosen: DataFrame) -> DataFrame:
    """Per row of (node, text, spans): what is left without the spans of bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1, _BLOCK):
            out = []
            for i in range(batch.num_rows):
                raw = (batch.column(1)[i].as_py() or "").encode()
                edges = np.zeros(len(raw) + 1, np.int64)
                for spans in batch.column(2)[i].as_py():
                    np.add.at(edges, spans[0::2], 1)
                    np.add.at(edges, spans[1::2], -1)
                gone = np.cumsum(edges)[:-1] > 0
                borders = _intervals(gone)
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((int(gone.sum()), len(borders) // 2, hashlib.sha256(left).hexdigest()))
            n_removed, n_spans, kept = zip(*out)
            columns = [batch.column(0), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n_removed", "n_spans", "kept_sha256"])

    return chosen.select("node", "text", "spans").mapInArrow(rows, "node bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", part: int = PART) -> DataFrame:
    """One row per row of `docs`: key, n_bytes, n_removed, n_spans, kept_sha256.

    Null counts as the empty text. Rows with equal texts, repeated rows too, are different documents, so from 200 bytes on
    nothing of them is left. Strings are judged on the input; those that overlap within one text count. Further columns
    are not looked at, an empty table gives no rows. Texts are told apart by SHA-256, the stretches of one anchor by 64 bits of it, the
    windows of an anchor in several parts by 128 bits of it; what repeats in a shard is compared byte by byte.
    """
    rows = docs.select(F.col(key).alias("key"), present(text).alias("text"))
    told = settle(
        rows.select("key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")).withColumn("node", F.xxhash64("sha")),
        "texts",
    )
    same = settle(told.groupBy("sha", "node", "n_bytes").agg(F.count("*").alias("copies"), F.min("key").alias("speaker")), "same_texts")

    long_ones = rows.where(F.octet_length("text") >= SIZE).withColumn("node", _node())
    speaks = same.where(F.col("n_bytes") >= SIZE).select("node", "speaker")
    listed = settle(_anchored(long_ones).join(speaks, "node").where(F.col("key").eqNullSafe(F.col("speaker"))).select("node", "speaker", "anchors"), "anchors")
    single = listed.select("node", "speaker", F.explode("anchors").alias("anchor"))
    often = single.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    wanted = single.join(often, "anchor").groupBy("node", "speaker").agg(F.collect_set("anchor").alias("anchors"))
    own = long_ones.join(wanted, "node").where(F.col("key").eqNullSafe(F.col("speaker")))
    chosen = settle(own.select("node", "text", "anchors"), "chosen")
    found = settle(_cut_out(chosen), "stretches")

    place = F.xxhash64("node", "start")
    kinds = settle(
        found.groupBy("anchor", "digest").agg(F.min(place).alias("one"), F.max(place).alias("other")), "kinds"
    )
    # A stretch that is alone with its anchor and stands in one place may still repeat in itself.
    by_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("m"), F.bool_and(F.col("one") != F.col("other")).alias("settled"))
    parts = by_anchor.where("m > 1 or not settled").select("anchor", F.ceil(F.col("m") / part).alias("parts"))
    shown = kinds.join(parts, "anchor").select("anchor", "digest", "one", "parts", F.pmod(F.xxhash64("digest", F.lit(3)), "parts").alias("part"))
    different = (
        found.withColumn("place", place)
        .join(shown, ["anchor", "digest"])
        .where("place = one")
        .dropDuplicates(["anchor", "digest"])
        .select("anchor", "parts", "part", "digest", "n", "bytes")
    )
    searched = settle(_searched(different), "searched")
    across = _merged(searched.where("range is not null"))
    windows = (
        searched.where("range is null").select("anchor", "digest", "windows").where(F.size("windows") > 0).union(across)
        .groupBy("anchor", "digest").agg(F.flatten(F.collect_list("windows")).alias("windows"))
    )
    whole = kinds.where("one != other").select("anchor", "digest", F.lit(True).alias("whole"))
    places = found.select("anchor", "digest", "node", "start", "n").distinct()
    hit = places.join(whole, ["anchor", "digest"], "left").join(windows, ["anchor", "digest"], "left").where("whole or windows is not null")
    offsets = F.when(F.col("whole"), F.array(F.lit(0), F.col("n").cast("int"))).otherwise(F.col("windows"))
    spans = F.transform(offsets, lambda x, i: F.col("start").cast("int") + x + F.when(i % 2 == 1, SIZE - 1).otherwise(0))
    by_text = hit.select("node", spans.alias("spans")).groupBy("node").agg(F.collect_list("spans").alias("spans"))
    left = _removed(chosen.join(by_text, "node")).dropDuplicates(["node"])

    copies = (F.col("copies") > 1) & (F.col("n_bytes") >= SIZE)
    nothing = hashlib.sha256(b"").hexdigest()
    known = same.join(left, "node", "left").select(
        "sha",
        F.when(copies, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copies, 1).otherwise(F.coalesce("n_spans", F.lit(0))).alias("n_spans"),
        F.when(copies, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
    return told.join(known, "sha").select(F.col("key").alias(key), "n_bytes", "n_removed", F.col("n_spans").cast("long").alias("n_spans"), "kept_sha256")
