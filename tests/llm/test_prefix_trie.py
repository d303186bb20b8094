"""The prefix trie against a plain version, its edge cases, and the radix tree against a dictionary."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from oracle import differences

import duckdb
from jangbu.llm import prefix_trie, radix
from jangbu.llm.catalog import ORACLES

SCHEMA = "conv_id long, turn long, role string, text string, depth int, node string, first string, size int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
LONG = "a long text " * 50_000
ROWS = [
    (0, 1, "user", "é"),
    (0, None, None, None),
    (0, 2, "assistant", "b"),
    (0, 2, "assistant", "a"),
    (1, 5, "user", "y"),
    (2, 0, "user", LONG),
    (3, 0, "", ""),
    (7, 0, "user", "no family"),
    (12, 0, "user", "é"),
    (12, 0, "user", "é"),
    (-3, 0, "user", ""),
    (None, 1, "user", "no id"),
    (10, 0, "system", "same"),
    (11, 0, "system", "same"),
    (13, 0, "system", "same"),
]


def name(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()[:32]


def plain(rows, family=5, heads=9):
    """A dictionary of all beginnings."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, name(role, text), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % heads
        full[c] = tuple(own.get(c - int(math.fmod(c, family)), [])[:h] + own[c][h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                kids[seq[: d - 1]].add(seq[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for seq in members:
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += not kids[seq]
            saved[seq[:d]] += (len(members[seq]) - 1) * len(seq[-1][1].encode()) if seq else 0
    out = []
    for seq, of in members.items():
        ends = ",".join(map(str, sorted(c for c in of if len(full[c]) == len(seq))))
        parent = min(members[seq[:-1]]) if seq else None
        out.append((min(of), len(seq), parent, len(of), len(kids[seq]), leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", "f", 2) for r in rows], SCHEMA)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def many(seed, conversations=60):
    """Conversations with common beginnings of any length, many of them alike."""
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), r.choice("ab")) for c in range(conversations) for t in range(r.choice([0, 1, 3, 12]))]


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_plain_version(spark, parts, seed):
    """Over seven tasks, whose ranges cut equal conversations and common beginnings, as over one."""
    rows = many(seed) + ROWS
    keys = {"spark.sql.shuffle.partitions": parts, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert result(prefix_trie.prefix_trie(table(spark, rows))) == plain(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sql_handles_the_same_cases(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ROWS)
    got = prefix_trie.prefix_trie(table(spark, ROWS)).drop("turn_name")
    assert differences(got, con, ORACLES["op11_prefix_trie"]) is None


def test_empty_table_has_no_nodes(spark):
    assert prefix_trie.prefix_trie(table(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(table(spark, [(None, 1, "user", "x")])).collect() == []


def test_one_key_in_many_tasks_keeps_its_digest(monkeypatch):
    """Ids that end at a shared node come in pieces, and the digest is that of the whole list."""
    monkeypatch.setattr(prefix_trie, "_PIECE", 2)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"conv_id": list(range(7)), "key": [b"k" * 16] * 7, "sizes": [[3]] * 7})
    parts = [r for b in prefix_trie.task_nodes(iter([batch])) for r in b.to_pylist()]
    pieces = sorted((r for r in parts if r["depth"] is None), key=lambda r: (r["node"], r["conv_id"]))
    assert [p["ends"] for p in pieces] == ["0,1", "2,3", "4,5", "6"]
    out = list(prefix_trie._digests(iter([pa.RecordBatch.from_pylist([{k: p[k] for k in ("node", "conv_id", "ends")} for p in pieces])])))
    assert [r["ends_sha256"] for b in out for r in b.to_pylist()] == [hashlib.sha256(b"0,1,2,3,4,5,6").hexdigest()]


def walked(node, before=b""):
    here = before + node.path
    if node.values:
        yield here, node.values
    for byte, kid in node.kids():
        yield from walked(kid, here + bytes([byte]))


@pytest.mark.parametrize("seed", range(5))
def test_radix_tree_holds_what_was_put_in(seed):
    r = random.Random(seed)
    keys = [bytes(r.choice([r.randrange(256), 7]) for _ in range(r.choice([0, 1, 2, 3, 16]))) for _ in range(1500)]
    tree, want = radix.Tree(), defaultdict(list)
    for i, key in enumerate(keys):
        tree.insert(key, i)
        want[key].append(i)
    assert dict(walked(tree.root)) == want
    assert [k for k, _ in walked(tree.root)] == sorted(want)


def test_nodes_grow_with_their_children():
    kinds = []
    for n in (4, 5, 16, 17, 48, 49, 256):
        tree = radix.Tree()
        for byte in range(n):
            tree.insert(bytes([byte, 1, 2, 3]), byte)
        layout = tree.root.children
        kinds.append((type(layout).__name__, getattr(layout, "most", None)))
        assert tree.root.path == b"" and all(kid.path == b"\1\2\3" for _, kid in tree.root.kids())
    assert kinds == [("Sorted", 4), ("Sorted", 16), ("Sorted", 16), ("Indexed", None), ("Indexed", None), ("Full", None), ("Full", None)]
