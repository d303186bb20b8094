"""The corpus queries over the smallest tables, against SQL or brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from oracle import connect, differences
from tokenizers import Tokenizer

import __spark_entry__ as contract
from jangbu.llm.catalog import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark, small):
    return {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def rows(spark, small, name):
    out = QUERIES[name](spark, small).collect()
    return out, {r.doc_id: r for r in out}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    assert differences(QUERIES[name](spark, small), connect(small), ORACLES[name]) is None


def test_all_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


def test_bpe_equals_the_library(spark, small, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, got = rows(spark, small, "op1_bpe_round_trip")
    assert len(out) == len(docs)
    for i, doc in docs.items():
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want = len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()
        assert tuple(got[i])[1:] == want


def test_mix_is_near_its_targets(spark, small):
    out, _ = rows(spark, small, "op2_mix_sources")
    by_source = defaultdict(list)
    for r in out:
        assert r.taken <= 2 * r.size
        by_source[r.source_size, r.target].append(r)
    for (_, target), own in by_source.items():
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)


def test_quality_finds_held_out_labels(spark):
    """Over the middle tables: the smallest have 19 labels to learn nothing of and 80 to learn from."""
    folder = "/root/testdata/sf0.01"
    _, got = rows(spark, folder, "op3_quality")
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    away = [(got[r.doc_id].predicted, r.quality) for r in labels if got[r.doc_id].held_out]
    assert sum(p == q for p, q in away) >= 0.95 * len(away)


def test_repeated_strings_equal_brute_force(spark, small, docs):
    size, raw = 200, {i: (d.text or "").encode() for i, d in docs.items()}
    counts = Counter(hash(r[k : k + size]) for r in raw.values() for k in range(len(r) - size + 1))
    _, got = rows(spark, small, "op4_repeated_strings")
    for i, r in raw.items():
        gone = bytearray(len(r))
        for k in range(len(r) - size + 1):
            if counts[hash(r[k : k + size])] > 1:
                gone[k : k + size] = b"\1" * size
        kept = bytes(b for b, g in zip(r, gone) if not g)
        want = len(r), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()
        assert tuple(got[i])[1:] == want


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    again = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def test_quality_rules_equal_brute_force_and_keep_clean_texts(spark, small, docs):
    _, got = rows(spark, small, "op6_quality_rules")
    for i, d in docs.items():
        want = base(d.text)
        assert tuple(got[i])[1:6] == want
        assert got[i].base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (got[i].kept and got[i].base_failed)
    good = [got[r.doc_id] for r in spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").collect()]
    good = [r for r in good if not r.base_failed]
    assert sum(r.kept for r in good) >= 0.98 * len(good)


def test_language_of_held_out_texts(spark, small, docs):
    _, got = rows(spark, small, "op7_language")
    away = [(got[i].lang_pred, d.lang) for i, d in docs.items() if got[i].held_out]
    assert sum(p == q for p, q in away) >= 0.95 * len(away)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def components(sets):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = sorted(sets)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in sets}


def test_near_duplicates_equal_brute_force(spark, small, docs):
    sets = {i: shingles(d.text) for i, d in docs.items()}
    want = components(sets)
    _, got = rows(spark, small, "op8_near_dedup")
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in sets
    }


def test_token_counts_add_up(spark, small, docs):
    total = Counter()
    for r in QUERIES["op10_token_counts"](spark, small).collect():
        total[r.doc_id] += r.n_tokens
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert total == {i: len(library.encode(d.text or "", add_special_tokens=False).ids) for i, d in docs.items()}
