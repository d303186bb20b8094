"""The pipeline against a plain version, and its near-dedup stage against brute force."""

import hashlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from jangbu.llm import mixing, quality
from test_corpus_queries import shingles


def test_near_dedup_stage_links_from_080(spark, small):
    words = [f"w{i}" for i in range(400)]
    # 196 shingles each; n changed words far apart cost five shingles each: 186 / 206, 176 / 216 and 171 / 221 in common.
    changed = lambda n, base: " ".join(f"x{base}.{i}" if i in range(20, 20 + 12 * n, 12) else f"{base}{w}" for i, w in enumerate(words[:200]))
    rows = [(10 * k + j, changed(n, f"b{k}.")) for k, n in enumerate((2, 4, 5)) for j, n in enumerate((0, n))]
    sets = {i: shingles(t) for i, t in rows}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert alike(0, 1) > 0.85 > alike(10, 11) > 0.8 > alike(20, 21)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.unlike_texts(spark, docs, small).collect()) == [0, 10, 20, 21]


def test_run_equals_a_plain_version(spark, tmp_path, small):
    """Repeated rows, rows without a key and pairs at 0.80 to 0.85 beside texts of the smallest table."""
    words = [f"w{i}" for i in range(200)]
    near = " ".join(f"x{i}" if i in range(20, 68, 12) else w for i, w in enumerate(words))
    some = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 60")
    planted = [(9001, " ".join(words)), (9002, near), (9002, near), (None, near + " end"), (None, None), (9003, ""), (9004, " ".join(words))]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in planted]
    some.unionByName(spark.createDataFrame(rows, some.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet(f"{small}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))

    good = {(r.doc_id, r.text) for r in quality.keep_good(docs, labels).collect()}
    by_text = {}
    for r in docs.collect():
        if (r.doc_id, r.text) in good:
            by_text.setdefault(r.text or "", []).append(r)
    one = [max(same, key=lambda r: (r.doc_id is not None, r.doc_id or 0)) for same in by_text.values()]
    sets = [shingles(r.text or "") for r in one]
    group = list(range(len(one)))
    for i in range(len(one)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    kept = {}
    for g, r in zip(group, one):
        if g not in kept or (r.doc_id is None, r.doc_id or 0) < (kept[g].doc_id is None, kept[g].doc_id or 0):
            kept[g] = r
    assert len(kept) < len(one) < sum(map(len, by_text.values()))
    mixed = mixing.mixed_rows(spark.createDataFrame(list(kept.values()), docs.schema)).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [library.encode(r.text or "", add_special_tokens=False).ids for r in mixed]
    want = Counter((r.doc_id, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest()) for r, i in zip(mixed, ids))
    assert Counter(tuple(r)[:3] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want
