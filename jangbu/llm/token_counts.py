"""Token counts of the fields and sections of documents, from one encoding of the whole document.

A document is its fields joined by a separator, encoded once: counting sections apart would give other tokens at their
borders. Tokens and sections are both intervals of character positions and are joined by binary search; a token that
crosses a border is allotted by rule:

* first: to the section of its first character, * last: of its last character,
* most: to the section that holds most of its characters, the earliest of equal ones.

Beside that, `share` splits every token by characters. A token that holds only part of a character's bytes has that character's position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from jangbu.llm.bpe import ByteBpe, vocabulary

RULES = ("first", "last", "most")
#: A section ends behind each line feed.
LINE_ENDS = r"\n"


def token_spans(bpe: ByteBpe, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one after its last."""
    ids = np.fromiter(bpe.encode(text), np.int64)
    stops = np.cumsum(sizes[ids])
    starts = stops - sizes[ids]
    if text.isascii():
        return starts, stops
    raw = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return character[starts], character[stops - 1] + 1


def section_spans(fields: list[str], ends: re.Pattern | None, separator: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Field, first character and character behind each section. Sections meet; a separator belongs to the field before it."""
    of, starts, at = [], [], 0
    for i, field in enumerate(fields):
        own = [0] + ([m.end() for m in ends.finditer(field) if m.end() > m.start()] if ends else [])
        if len(own) > 1 and own[-1] == len(field):
            own.pop()
        of += [i] * len(own)
        starts += [at + s for s in own]
        at += len(field) + (len(separator) if i + 1 < len(fields) else 0)
    starts = np.array(starts, np.int64)
    return np.array(of, np.int64), starts, np.append(starts[1:], at)


def allotted(tokens: tuple[np.ndarray, np.ndarray], sections: tuple[np.ndarray, np.ndarray], rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per section: tokens by the rule, tokens that also reach into another section, and the sum of shares."""
    (begin, stop), (left, right) = tokens, sections
    n = len(left)
    first = np.searchsorted(left, begin, "right") - 1
    last = np.searchsorted(left, stop - 1, "right") - 1
    inside = first == last
    crossing = np.flatnonzero(~inside)
    own = np.where(rule == "last", last, first)
    share = np.bincount(first[inside], minlength=n).astype(float)
    reach = np.zeros(n, np.int64)
    for t in crossing:
        over = np.arange(first[t], last[t] + 1)
        held = np.maximum(np.minimum(right[over], stop[t]) - np.maximum(left[over], begin[t]), 0)
        share[over] += held / held.sum()
        reach[over[held > 0]] += 1
        if rule == "most":
            own[t] = over[held.argmax()]
    return np.bincount(own, minlength=n), reach, share


def count_tokens(
    docs: DataFrame,
    path: str,
    fields: tuple[str, ...] = ("text",),
    section_ends: str | None = LINE_ENDS,
    rule: str = "first",
    separator: str = "\n",
    key: str = "doc_id",
) -> DataFrame:
    """One row per section: key, field, section (from 0 in the document), begin, stop, n_tokens, n_crossing, share.

    Sections end behind each match of `section_ends` (None: whole fields) and at field ends, and cover the document without
    gaps, so the n_tokens of a document add up to its tokens. A null field counts as empty; an empty field is one empty section with no tokens.
    Rows that repeat give their sections again, null keys stay, further columns are not looked at, an empty table gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    ends = re.compile(section_ends) if section_ends else None
    names = np.array(fields)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = sent.value
        sizes = np.zeros(max(bpe.strings) + 1, np.int64)
        for i, s in bpe.strings.items():
            sizes[i] = len(s)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows, columns = [], [[] for _ in range(7)]
                for i in range(batch.num_rows):
                    texts = [batch.column(1 + k)[i].as_py() or "" for k in range(len(fields))]
                    of, left, right = section_spans(texts, ends, separator)
                    counts = allotted(token_spans(bpe, separator.join(texts), sizes), (left, right), rule)
                    rows += [i] * len(left)
                    for column, values in zip(columns, (of, np.arange(len(left)), left, right, *counts)):
                        column.append(values)
                of, *rest = (np.concatenate(c) for c in columns)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(names[of], pa.string()), *map(pa.array, rest)],
                    [key, "field", "section", "begin", "stop", "n_tokens", "n_crossing", "share"],
                )

    longs = [T.StructField(c, T.LongType()) for c in ("section", "begin", "stop", "n_tokens", "n_crossing")]
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField("field", T.StringType()), *longs, T.StructField("share", T.DoubleType())]
    )
    return docs.select(key, *[docs[f].cast("string") for f in fields]).mapInArrow(count, schema)
