"""Near duplicates: MinHash bands propose pairs, signatures and then full shingle sets decide them.

1. Every text becomes a set of hashed shingles (runs of words). Texts with equal sets form a class, of which only the one
   with the smallest key goes on; copies are never paired.
2. Bands of minimum hashes put classes into buckets. Each member of a bucket is compared with one small
   member of its buckets, which links most of a group in as many comparisons as it has members.
3. Buckets whose members are then still in different components are searched whole, but only across components:
   the members outside the bucket's largest component meet all others, in blocks of bounded size.

A comparison looks at the signatures batch by batch and ends when the chance that the similarity reaches the limit,
given the agreement so far, falls below `miss`; what survives is compared on the full sets. Bands are chosen for the limit: a pair
at it shares no bucket with a chance below UNMET.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu.llm.graph import components
from jangbu.llm.spans import U64, Texts, mixed, small
from jangbu.session import settle

SHINGLE = 5
LIMIT = Fraction(85, 100)
HASHES = 192
UNMET = 3e-7
MISS = 1e-9
BATCH = 24
#: Members of one block when a bucket is searched whole.
BLOCK = 1000

_A = mixed(np.arange(1, HASHES + 1, dtype=U64)) | U64(1)
_B = mixed(np.arange(1001, 1001 + HASHES, dtype=U64))


def banding(limit: Fraction) -> tuple[int, int]:
    """Bands and rows in each: as many rows as let a pair at the limit miss all buckets with a chance of UNMET at most."""
    for size in range(HASHES, 1, -1):
        if (1 - float(limit) ** size) ** (HASHES // size) <= UNMET:
            return HASHES // size, size
    return HASHES, 1


def shingled(texts: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in ascending order, one text after the other, and where each text's end.

    A text with fewer words has its whole sequence as one shingle; a text without words has none.
    """
    texts = texts.lowered()
    words = texts.hashes(texts.words)
    grams, first = texts.grams(words, size)
    owner = [texts.word_text[first]]
    found = [grams]
    short = (texts.n_words > 0) & (texts.n_words < size)
    if short.any():
        at = np.concatenate([[0], np.cumsum(texts.n_words)])
        own = np.zeros(texts.n, U64)
        for k in range(size - 1):
            has = short & (texts.n_words > k)
            own[has] = own[has] * U64(0x9E3779B97F4A7C15) + words[at[:-1][has] + k]
        found.append(mixed(own[short] + texts.n_words[short].astype(U64)))
        owner.append(np.flatnonzero(short))
    owner, found = np.concatenate(owner), np.concatenate(found)
    place = np.lexsort((found, owner))
    owner, found = owner[place], found[place]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    owner, found = owner[new], found[new]
    return found, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts.n))])


def signatures(found: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The minimum hashes of each set, a row of 32-bit numbers; sets must not be empty."""
    out = np.empty((len(ends) - 1, len(_A)), np.uint32)
    if len(out):
        for k in range(len(_A)):
            out[:, k] = np.minimum.reduceat(((found * _A[k] + _B[k]) >> U64(32)).astype(np.uint32), ends[:-1])
    return out


def least_agreement(limit: float, miss: float, steps: list[int]) -> np.ndarray:
    """For each number of compared hashes, how many must agree for the pair to go on.

    With a flat prior the similarity has a Beta(m + 1, n - m + 1) posterior after m of n agree; its mass above the limit is
    taken from a fine grid.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in steps:
        m = np.arange(n + 1)[:, None]
        log = m * np.log(grid) + (n - m) * np.log1p(-grid)
        mass = np.exp(log - log.max(axis=1, keepdims=True))
        above = mass[:, grid >= limit].sum(axis=1) / mass.sum(axis=1)
        out.append(int(np.argmax(above >= miss)))
    return np.array(out)


class Verifier:
    """Decides pairs: signature batches first, then the sets."""

    def __init__(self, limit: Fraction = LIMIT, miss: float = MISS, batch: int = BATCH):
        self.limit = limit
        self.cuts = [(s, min(s + batch, len(_A))) for s in range(0, len(_A), batch)]
        self.least = least_agreement(float(limit), miss, [stop for _, stop in self.cuts])

    def alike(self, mine: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Rows of `others` whose similarity to `mine` may reach the limit."""
        alive = np.arange(len(others))
        agree = np.zeros(len(others), np.int64)
        for (start, stop), least in zip(self.cuts, self.least):
            agree += (others[alive, start:stop] == (mine[start:stop] if mine.ndim == 1 else mine[alive, start:stop])).sum(axis=1)
            on = agree >= least
            alive, agree = alive[on], agree[on]
            if not len(alive):
                break
        return alive

    def reaches(self, shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether shared / (a + b - shared) is at least the limit, in whole numbers."""
        return self.limit.denominator * shared >= self.limit.numerator * (a + b - shared)


def _lists(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Binary cells as one array of numbers, and where each cell's end."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind), (ends - ends[0]) // size


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(values).view(np.uint8).tobytes()
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())


def sketched(docs: DataFrame, text: str, key: str, limit: Fraction = LIMIT) -> DataFrame:
    """Per row: key, set size, a 128-bit fingerprint of the set (low, high) and a number for each band; none for an empty set."""
    n_bands, band_rows = banding(limit)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found, ends = shingled(Texts.of(batch.column(1)))
            size = np.diff(ends)
            full = np.flatnonzero(size)
            sums = [np.zeros(len(size), U64), np.zeros(len(size), U64)]
            bands = np.zeros((len(full), n_bands), U64)
            if len(full):
                for salt, out in enumerate(sums):
                    out[full] = np.add.reduceat(mixed(found + U64(salt * 0x9E3779B97F4A7C15 + 1)), ends[:-1][full])
                signed = signatures(found, np.append(ends[:-1][full], ends[-1]))[:, : n_bands * band_rows]
                rows = signed.astype(U64).reshape(len(full), n_bands, band_rows)
                bands += np.arange(n_bands, dtype=U64)
                for k in range(band_rows):
                    bands = mixed(bands ^ rows[:, :, k])
            at = np.concatenate([[0], np.cumsum(np.where(size > 0, n_bands, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(at, pa.array(bands.ravel().view(np.int64)))
            columns = [pa.array(size), *(pa.array(s.view(np.int64)) for s in sums), lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [key, "n_shingles", "low", "high", "bands"])

    long = T.LongType()
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), *(T.StructField(c, long) for c in ("n_shingles", "low", "high")), T.StructField("bands", T.ArrayType(long))]
    )
    return docs.select(key, text).mapInArrow(sketch, schema)


def _with_sets(docs: DataFrame, text: str) -> DataFrame:
    """Per row of (node, text): node, signature and set, as bytes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found, ends = shingled(Texts.of(batch.column(1)))
            keep = np.flatnonzero(np.diff(ends))
            if not len(keep):
                continue
            ends = np.append(ends[:-1][keep], ends[-1])
            signed = signatures(found, ends)
            columns = [_binary(signed.ravel(), np.arange(len(keep) + 1) * signed.shape[1]), _binary(found, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), *columns], ["node", "signature", "shingles"])

    schema = T.StructType([docs.schema["node"], T.StructField("signature", T.BinaryType()), T.StructField("shingles", T.BinaryType())])
    return docs.select("node", text).mapInArrow(sets, schema)


def _pairs_linked(pairs: DataFrame, sets: DataFrame, limit: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets reach the limit."""
    of = lambda c: sets.select(F.col("node").alias(c), F.col("signature").alias(f"{c}_sign"), F.col("shingles").alias(f"{c}_set"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verify = Verifier(limit)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                signs = [_lists(columns[f"{c}_sign"], np.uint32)[0].reshape(batch.num_rows, -1) for c in "ab"]
                (left, left_ends), (right, right_ends) = (_lists(columns[f"{c}_set"], U64) for c in "ab")
                linked = []
                for i in verify.alike(signs[0], signs[1]):
                    x, y = left[left_ends[i] : left_ends[i + 1]], right[right_ends[i] : right_ends[i + 1]]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if verify.reaches(shared, len(x), len(y)):
                        linked.append(i)
                yield pa.RecordBatch.from_arrays([columns["a"].take(pa.array(linked, pa.int64())), columns["b"].take(pa.array(linked, pa.int64()))], ["a", "b"])

    joined = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "a_sign", "b_sign", "a_set", "b_set")
    kind = sets.schema["node"].dataType
    return joined.mapInArrow(decide, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))


def _searched(members: DataFrame, sets: DataFrame, limit: Fraction) -> DataFrame:
    """Links between members of a bucket that are in different components, for rows (bucket, node, component).

    A block holds up to BLOCK members of the bucket's largest component and up to BLOCK others, which are
    compared with all of the first and, in one block for each two parts, with each other.
    """
    of_component = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    most = of_component.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n"))
    plan = most.select(
        "bucket",
        F.col("most.component").alias("main"),
        F.ceil(F.col("most.n") / BLOCK).cast("int").alias("n_main"),
        F.ceil((F.col("n") - F.col("most.n")) / BLOCK).cast("int").alias("n_rest"),
    )
    told = members.join(plan, "bucket").withColumn("is_rest", F.col("component") != F.col("main"))
    part = F.pmod(F.xxhash64("node"), F.when(F.col("is_rest"), F.col("n_rest")).otherwise(F.col("n_main"))).cast("int")
    told = told.withColumn("part", part)
    every = lambda n: F.sequence(F.lit(0), n - 1)
    # Blocks are (part of the rest, part of the main component, or -1 - part of the rest).
    main = told.where("not is_rest").select("*", F.explode(every(F.col("n_rest"))).alias("i")).select("*", F.col("part").alias("j"))
    rest = told.where("is_rest")
    with_main = rest.select("*", F.col("part").alias("i")).select("*", F.explode(every(F.col("n_main"))).alias("j"))
    with_rest = (
        rest.select("*", F.explode(every(F.col("n_rest"))).alias("other"))
        .withColumn("i", F.greatest("part", "other"))
        .withColumn("j", -1 - F.least("part", "other"))
    )
    columns = ["bucket", "i", "j", "node", "component", "is_rest"]
    rows = main.select(*columns).union(with_main.select(*columns)).union(with_rest.select(*columns)).distinct()
    blocks = rows.join(sets, "node").select("bucket", "i", "j", "component", "is_rest", "node", "signature", "shingles")
    placed = blocks.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verify, held = Verifier(limit), []
        for group in _groups(batches, held):
            found = _block_links(verify, group)
            if found:
                yield pa.RecordBatch.from_arrays([group.column("node").take(pa.array([x[n] for x in found], pa.int64())).combine_chunks() for n in (0, 1)], ["a", "b"])

    kind = sets.schema["node"].dataType
    return placed.mapInArrow(search, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))


def _groups(batches: Iterator[pa.RecordBatch], held: list[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one (bucket, i, j) at a time, from batches sorted by it."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            if last is not None and (keys[start] != last).any():
                yield pa.Table.from_batches(held)
                held.clear()
            last = keys[start]
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)
        held.clear()


def _block_links(verify: Verifier, group: pa.Table) -> list[tuple[int, int]]:
    """Positions of linked rows in different components; rows already joined by links of this block are passed over."""
    group = group.combine_chunks()
    signs = _lists(_one(group, "signature"), np.uint32)[0].reshape(group.num_rows, -1)
    sets, ends = _lists(_one(group, "shingles"), U64)
    _, component = np.unique(_one(group, "component").to_numpy(zero_copy_only=False), return_inverse=True)
    sizes = np.diff(ends)
    out = []
    for x in np.flatnonzero(_one(group, "is_rest").to_numpy(zero_copy_only=False)):
        others = np.flatnonzero(component != component[x])
        others = others[verify.alike(signs[x], signs[others])]
        mine = sets[ends[x] : ends[x + 1]]
        for y in others:
            if component[y] == component[x]:
                continue
            theirs = sets[ends[y] : ends[y + 1]]
            at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            shared = int((mine[at] == theirs).sum())
            if verify.reaches(shared, sizes[x], sizes[y]):
                out.append((int(x), int(y)))
                component[component == component[y]] = component[x]
    return out


def _one(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", limit: Fraction = LIMIT) -> DataFrame:
    """One row per row of `docs`: key, n_shingles, component_id (the smallest key reachable by links), kept.

    A-Z count as a-z. Texts without words, null ones included, have no set and are linked with nothing. Rows of a repeated
    key are one node with several sets; rows that repeat altogether get equal answers, all kept if one is. A row
    without a key takes the component of an equal set that has one, and is linked with nothing else. Further columns
    are not looked at; an empty table gives no rows.
    """
    sketch = settle(sketched(docs, text, key, limit), "sketches")
    classes = settle(sketch.where("n_shingles > 0").groupBy("low", "high").agg(F.min(key).alias("node")), "classes")
    speaker = sketch.join(classes, ["low", "high"]).where(F.col(key) == F.col("node"))
    members = settle(speaker.select("node", F.explode("bands").alias("bucket")).distinct(), "members")
    buckets = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("root")).where("n > 1")
    shared = settle(members.join(buckets, "bucket").select("bucket", "node", "root"), "buckets")
    nodes = shared.select("node").distinct()
    sets = settle(_with_sets(docs.select(F.col(key).alias("node"), F.col(text).alias("text")).join(nodes, "node"), "text"), "sets")

    first = shared.where("node != root").groupBy(F.col("node").alias("a")).agg(F.min("root").alias("b"))
    links = settle(_pairs_linked(first, sets, limit), "first_links")
    apart = settle(_still_apart(shared, components(links)), "apart")
    more = settle(_searched(apart, sets, limit), "more_links")
    reached = components(links.union(more))

    of_class = classes.join(reached, "node", "left").select("low", "high", F.coalesce("component", "node").alias("component_id"))
    alone = sketch.where("n_shingles = 0").select(key, "n_shingles", F.col(key).alias("component_id"))
    told = sketch.where("n_shingles > 0").join(of_class, ["low", "high"]).select(key, "n_shingles", "component_id").union(alone)
    return told.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", limit: Fraction = LIMIT) -> DataFrame:
    """One row of `docs`, with all columns, of each component: that with the smallest key, a present one before none.

    Each different (key, text) is a node of its own, told apart by 64 bits, so rows without a key and rows of one key are
    linked and dropped like others, and of rows that repeat altogether one stays. Rows without words are linked with
    nothing and all stay. Columns of `docs` may have any names; an empty table gives no rows.
    """
    node = F.xxhash64(F.col(key), F.col(text))
    rows = docs.select(node.alias("_node"), F.col(key).alias("_key"), F.col(text).alias("_text"))
    told = settle(near_duplicates(rows, "_text", "_node", limit).where("n_shingles > 0").select("_node", "component_id"), "told")
    each = told.groupBy("_node", "component_id").agg(F.count("*").alias("n"))
    groups = each.groupBy("component_id").agg(F.count("*").alias("nodes")).where("nodes > 1")
    members = settle(each.join(groups, "component_id").select("_node", "component_id"), "members")
    order = F.struct(F.col("_key").isNull(), "_key", "_node")
    first = rows.select("_node", "_key").join(members, "_node").groupBy("component_id").agg(F.min_by("_node", order).alias("_node"))
    gone = settle(members.join(first, ["component_id", "_node"], "left_anti").select(F.col("_node").alias("_gone")), "gone")
    kept = docs.join(gone, node == F.col("_gone"), "left_anti")
    repeated = settle(each.where("n > 1").select(F.col("_node").alias("_again")), "repeated")
    if repeated.isEmpty():
        return kept
    again = kept.withColumn("_again", node).join(repeated, "_again", "left_semi").dropDuplicates(["_again"])
    return kept.join(repeated, node == F.col("_again"), "left_anti").union(again.select(*docs.columns))


def _still_apart(shared: DataFrame, reached: DataFrame) -> DataFrame:
    """Rows (bucket, node, component) of buckets with several components; of buckets with equal members one is enough."""
    known = shared.join(reached, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed_ones = (
        known.groupBy("bucket")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        )
        .where("low != high")
        .groupBy("n", "x", "y")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket")
    )
    return known.join(mixed_ones, "bucket")
