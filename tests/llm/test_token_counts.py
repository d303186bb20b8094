import public_tokenizers
import pytest
from tokenizers import Tokenizer

from jangbu.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    (1, "One line.\nAnother   line\n\n\nlast é\U0001f600\U0001f468 end"),
    (2, ""),
    (3, None),
    (4, "\n\n\n\n\n  \n x"),
    (None, "no key <|endoftext|>\nrest"),
    (1, "One line.\nAnother   line\n\n\nlast é\U0001f600\U0001f468 end"),
    (5, "long " * 4000 + "\n" + "日本語" * 700),
]


def brute(text, rule):
    text = text or ""
    offsets = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).offsets
    lines, at = [], 0
    for line in text.splitlines(keepends=True) if text.isascii() or " " not in text else [text]:
        lines.append((at, at + len(line)))
        at += len(line)
    lines = lines or [(0, 0)]
    counts = [0] * len(lines)
    for b, e in offsets:
        held = [max(0, min(e, r) - max(b, l)) for l, r in lines]
        owners = [i for i, h in enumerate(held) if h]
        i = {"first": owners[0], "last": owners[-1], "most": held.index(max(held))}[rule]
        counts[i] += 1
    return [(l, r, n) for (l, r), n in zip(lines, counts)]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_equal_the_library_offsets(spark, rule):
    docs = spark.createDataFrame([(k, t, 9, "x") for k, t in TEXTS], "doc_id long, text string, n_tokens int, field string")
    got = token_counts.count_tokens(docs, PATH, rule=rule).collect()
    want = sorted((k, b, e, n) for k, t in TEXTS if k for b, e, n in brute(t, rule))
    assert sorted((r.doc_id, r.begin, r.stop, r.n_tokens) for r in got if r.doc_id) == want
    assert sorted((b, e, n) for b, e, n in brute(TEXTS[4][1], rule)) == sorted((r.begin, r.stop, r.n_tokens) for r in got if r.doc_id is None)
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for rows in by_doc.values():
        assert sum(r.n_tokens for r in rows) == pytest.approx(sum(r.share for r in rows))


def test_fields_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "head", "a\nb"), (2, None, "")], "doc_id long, title string, text string")
    got = token_counts.count_tokens(docs, PATH, fields=("title", "text"), section_ends=None).orderBy("doc_id", "section").collect()
    assert [(r.doc_id, r.field, r.begin, r.stop) for r in got] == [(1, "title", 0, 5), (1, "text", 5, 8), (2, "title", 0, 1), (2, "text", 1, 1)]
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0
