"""Prefix trie of conversations: which turns conversations begin with in common.

A turn is named by 128 bits of the SHA-256 of its role and text, a conversation by these names one after the other, as
bytes of fixed width. Conversations are put in order over the tasks by range, so that a frequent beginning spreads over
many. Each task builds an adaptive radix tree of its keys; only depths that are whole turns become nodes. Nodes on the
paths to a task's first and last key may continue in other tasks: their parts are added up afterwards, all others are
final. A task holds the names of its conversations, 16 bytes a turn, never their texts; one conversation is never split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jangbu.llm.radix import Tree
from jangbu.llm.text import present
from jangbu.session import settle

WIDTH = 16
#: Ids in one piece of a list that several tasks hold parts of.
_PIECE = 1024
_ROWS = 4096


def turn_name(role: Column, text: Column) -> Column:
    """128 bits of a turn's role and text as 32 hexadecimal digits; null counts as empty."""
    role = present(role)
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, present(text)), 256), 1, 2 * WIDTH)


def turn_lists(conversations: DataFrame, family: int = 1) -> DataFrame:
    """(first, conv_id, turns): the turns of each conversation in order, each (turn, name, size in UTF-8 bytes), and
    the first id of its family, conv_id - conv_id % family.

    A null turn comes first, turns of one number by their name. Rows without a conv_id are left out. One shuffle, of
    names instead of texts, brings a whole family together.
    """
    each = F.struct("turn", turn_name(F.col("role"), F.col("text")).alias("name"), F.octet_length(present("text")).cast("long").alias("size"))
    first = F.col("conv_id") - F.col("conv_id") % family
    rows = conversations.where("conv_id IS NOT NULL").select(first.alias("first"), "conv_id", each.alias("each"))
    return rows.repartition("first").groupBy("first", "conv_id").agg(F.sort_array(F.collect_list("each")).alias("turns"))


def regrown(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, turns): conversation c begins with the first h turns of conversation c - c % family, then come its own
    turns after its first h, where h is the unsigned crc32 of the decimal c modulo `heads`.
    """
    lists = turn_lists(conversations, family)
    head = F.when(F.col("conv_id") == F.col("first"), F.slice("turns", 1, heads - 1))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    given = F.coalesce(F.first(head, ignorenulls=True).over(Window.partitionBy("first")), F.slice("turns", 1, 0))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return lists.select("conv_id", F.concat(F.slice(given, 1, h), own).alias("turns"))


_PARTS = pa.schema(
    [
        ("node", pa.binary()),
        ("above", pa.binary()),
        *[(n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "size")],
        ("turn_name", pa.string()),
        ("ends", pa.string()),
    ]
)
_PARTS_SQL = (
    "node binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, size long, turn_name string, ends string"
)


def turn_nodes(tree: Tree) -> tuple[list[int], list[int], list[bytes], list[list[int]]]:
    """Parent, depth, name and ending conversations of each node at a whole number of turns, each after its parent."""
    parents, depths, names, ends = [-1], [0], [b""], [[]]
    open_ = [(tree.root, 0, b"")] if tree.root else []
    while open_:
        node, top, rest = open_.pop()
        data = rest + node.path
        whole = len(data) - len(data) % WIDTH
        for at in range(0, whole, WIDTH):
            parents.append(top)
            depths.append(depths[top] + 1)
            names.append(data[at : at + WIDTH])
            ends.append([])
            top = len(parents) - 1
        if node.values:
            ends[top] = node.values
        open_ += [(kid, top, data[whole:] + bytes([byte])) for byte, kid in reversed(list(node.kids()))]
    return parents, depths, names, ends


def _joined(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def task_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one task's conversations, which come in the order of (key, conv_id).

    Three kinds of rows: final nodes (no `node`); parts of nodes on the paths to the first and last key, which are named by a
    digest of their turns; pieces of the ids that end at such nodes (no `depth`).
    """
    tree, sizes, first = Tree(), {}, None
    for batch in batches:
        for conv, key, own in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "sizes"))):
            first = key if first is None else first
            tree.insert(key, conv)
            sizes.update(zip((key[at : at + WIDTH] for at in range(0, len(key), WIDTH)), own))
    if first is None:
        return
    parents, depths, names, ends = turn_nodes(tree)
    n = len(parents)
    # Names of the nodes that other tasks may have too. The first key's path comes first, the last node ends the last key.
    shared = {0: b""}
    last, path = n - 1, []
    while last > 0:
        path.append(last)
        last = parents[last]
    for i in [*range(1, len(first) // WIDTH + 1), *reversed(path)]:
        shared[i] = hashlib.sha256(shared[parents[i]] + names[i]).digest()[:WIDTH]
    members = [len(e) for e in ends]
    least = [e[0] if e else None for e in ends]
    kids, leaves, saved = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        above = parents[i]
        if i not in shared:
            leaves[i] += not kids[i]
            saved[i] += (members[i] - 1) * sizes[names[i]]
            kids[above] += 1
            leaves[above] += leaves[i]
            saved[above] += saved[i]
        if i:
            members[above] += members[i]
            least[above] = least[i] if least[above] is None else min(least[above], least[i])
    rows = []
    for i in range(n):
        above = parents[i]
        mine, held = shared.get(i), shared.get(above)
        rows.append(
            {
                "node": mine,
                "above": held,
                "conv_id": least[i],
                "depth": depths[i],
                "parent_conv_id": least[above] if i and held is None else None,
                "n_convs": members[i],
                "n_children": kids[i],
                "n_leaves": leaves[i],
                "saved_tokens": saved[i],
                "size": sizes[names[i]] if i else 0,
                "turn_name": names[i].hex() if i else None,
                "ends": hashlib.sha256(_joined(ends[i]).encode()).hexdigest() if mine is None else None,
            }
        )
        if mine is not None:
            pieces = (ends[i][at : at + _PIECE] for at in range(0, len(ends[i]), _PIECE))
            rows += [{"node": mine, "conv_id": piece[0], "ends": _joined(piece)} for piece in pieces]
        if len(rows) >= _ROWS or i == n - 1:
            yield pa.RecordBatch.from_pylist(rows, _PARTS)
            rows = []


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids from its pieces in order, one piece after the other."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, digest = None, None
    for batch in batches:
        done = []
        for mine, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if mine != node:
                if digest:
                    done.append((node, digest.hexdigest()))
                node, digest = mine, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d)) for d in done], schema)
    if digest:
        yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": digest.hexdigest()}], schema)


def _merged(parts: DataFrame) -> DataFrame:
    """The nodes that several tasks hold parts of: counts added up, leaves and savings summed over all that is below.

    Sums over subtrees double their reach each round: what lies less than 2^k turns below a node, plus what lies less than
    2^k below its descendants 2^k further down. The rounds grow with the logarithm of the longest path.
    """
    nodes = parts.where("node IS NOT NULL AND depth IS NOT NULL").groupBy("node").agg(
        F.first("above").alias("above"),
        F.first("turn_name").alias("turn_name"),
        F.min("conv_id").alias("conv_id"),
        *[F.max(c).alias(c) for c in ("depth", "size")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    nodes = settle(nodes, "shared_nodes")
    below = nodes.groupBy(F.col("above").alias("node")).agg(F.count("*").alias("more"))
    kids = F.col("n_children") + F.coalesce("more", F.lit(0))
    full = (
        nodes.join(below, "node", "left")
        .withColumn("n_children", kids)
        .withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size"))
        .drop("more")
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = full.select("node", F.col("above").alias("far"), "n_leaves", "saved_tokens")
    for _ in range(deepest.bit_length()):
        sums = settle(sums, "subtrees")
        gained = sums.where("far IS NOT NULL").groupBy(F.col("far").alias("node"))
        gained = gained.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        further = sums.select(F.col("node").alias("far"), F.col("far").alias("further"))
        sums = sums.join(gained, "node", "left").join(further, "far", "left").select(
            "node",
            F.col("further").alias("far"),
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        )
    pieces = parts.where("node IS NOT NULL AND depth IS NULL").select("node", "conv_id", "ends")
    ends = pieces.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(_digests, "node binary, ends_sha256 string")
    return (
        full.drop("n_leaves", "saved_tokens")
        .join(sums.drop("far"), "node")
        .join(ends, "node", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    )


def trie(lists: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns, for lists (conv_id, turns) with one row per conversation.

    Columns: conv_id (the smallest member), depth, parent_conv_id (the parent's; null for the root), n_convs (members),
    n_children, n_leaves (childless nodes in the subtree, its top included), saved_tokens (over the subtree: members but
    one, times the bytes of the last turn), ends_sha256 (of the decimal ids of the conversations that end here,
    ascending, joined by commas), turn_name (of the last turn, as `turn_name` gives it; null for the root).

    An empty list of turns is a member of the root only; equal conversations share all nodes. Without a conversation there
    is no node. The ids that end at one node pass through one task as a stream, as one digest needs.
    """
    turns = F.transform("turns", lambda t: t["name"])
    keyed = lists.select(
        "conv_id",
        F.unhex(F.array_join(turns, "")).alias("key"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )
    keyed = settle(keyed, "turn_keys")
    ordered = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = settle(ordered.mapInArrow(task_nodes, _PARTS_SQL), "trie_parts")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_name"]
    common = settle(_merged(parts), "merged_nodes")
    upper = common.select(F.col("node").alias("above"), F.col("conv_id").alias("upper"))
    final = parts.where("node IS NULL").withColumnRenamed("ends", "ends_sha256")
    inner = final.where("above IS NULL").select(*columns)
    joined = final.where("above IS NOT NULL").unionByName(common.drop("node"), allowMissingColumns=True)
    joined = joined.join(upper, "above", "left").withColumn("parent_conv_id", F.col("upper"))
    return inner.unionByName(joined.select(*columns))


def prefix_trie(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """The trie of the regrown conversations (see `regrown`, `trie`).

    Rows without a conv_id are left out; null role or text counts as empty; repeated rows are turns of their own, and turns
    with the same number follow by name. An empty table has no nodes. Other columns are ignored.
    """
    return trie(regrown(conversations.select("conv_id", "turn", "role", "text"), family, heads))
