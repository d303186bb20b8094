"""Byte-level BPE: encode by a priority queue of merge ranks over a doubly linked symbol list, decode by
concatenating vocabulary strings.

The vocabulary file is read once, on the driver, and sent to the tasks; its size is fixed by the tokenizer.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How byte-level vocabularies of this family split text before any merge. The letters and numbers
# of Unicode 17 are none yet for the tokenizer's library; Latin-1 texts do with a plain pattern, which is faster.
NEWER = (
    r"\u0558\u058B\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A"
    r"\U00011DB0-\U00011DDB\U00011DE0-\U00011DE9\U00011DF1\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2\U00016FF3"
    r"\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191"
    r"\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81"
    r"\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4\U0001E6E5"
    r"\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E"
    r"\U0002CEA2-\U0002CEAD\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)
_FORM = r"'(?:[stmd]|re|ve|ll)| ?{L}+| ?{N}+| ?{O}+|{S}+(?!{X})|{S}+"
PIECES = _FORM.format(
    L=rf"[\p{{L}}--[{NEWER}]]", N=rf"[\p{{N}}--[{NEWER}]]", O=rf"[[^\s\p{{L}}\p{{N}}]||[{NEWER}]]", S=r"\s", X=r"\S"
)
_LETTERS, _NUMBERS, _SPACES = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r \x85\xA0"
LATIN_PIECES = _FORM.format(
    L=f"[{_LETTERS}]", N=f"[{_NUMBERS}]", O=f"[^{_SPACES}{_LETTERS}{_NUMBERS}]", S=f"[{_SPACES}]", X=f"[^{_SPACES}]"
)

#: A piece's ids are remembered up to this many characters, for this many pieces a worker.
REMEMBER_CHARS, REMEMBER = 48, 400_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class ByteBpe:
    """A vocabulary with its merges."""

    def __init__(self, content: str):
        file = json.loads(content)
        ids, letters = file["model"]["vocab"], byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in ids.items()}
        self.first = [ids[letter] for letter in letters]
        self.merges = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self._prepare()

    def _prepare(self) -> None:
        known = self
        longest_first = sorted(self.special, key=len, reverse=True)
        self._specials = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self._find = regex.compile(PIECES, regex.V1).findall
        self._find_latin = re.compile(LATIN_PIECES).findall
        self._names = {i: str(i) for i in self.strings}

        class Remembered(dict):
            def __missing__(self, piece: str) -> list[int]:
                found = known.merged(piece.encode())
                if len(piece) <= REMEMBER_CHARS:
                    if len(self) >= REMEMBER:
                        self.clear()
                    self[piece] = found
                return found

        self._seen = Remembered()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._prepare()

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one piece: the pair of lowest rank merges first, of equal ones the leftmost."""
        symbols, n, merges = [self.first[b] for b in piece], len(piece), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if (found := merges.get((symbols[i], symbols[i + 1]))) is not None:
                queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapify(queue)
        while queue:
            _, i, left, right, made = heappop(queue)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # stale: one of the two has merged since
            symbols[i], symbols[j], after[i] = made, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (found := merges.get((made, symbols[after[i]]))) is not None:
                    heappush(queue, (found[0], i, made, symbols[after[i]], found[1]))
            if (k := before[i]) >= 0 and (found := merges.get((symbols[k], made))) is not None:
                heappush(queue, (found[0], k, symbols[k], made, found[1]))
        return [s for s in symbols if s >= 0]

    def pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._find(text)
        return self._find_latin(text)

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text; the strings of special tokens become their ids."""
        if self._specials is None or not any(s in text for s in self.special):
            return list(chain.from_iterable(map(self._seen.__getitem__, self.pieces(text))))
        out: list[int] = []
        for part in self._specials.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += chain.from_iterable(map(self._seen.__getitem__, self.pieces(part)))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters, unknown ids nothing."""
        try:
            raw = b"".join(map(self.strings.__getitem__, ids))
        except KeyError:
            raw = b"".join(self.strings.get(i, b"") for i in ids)
        return raw.decode("utf-8", "replace")

    def listed(self, ids: list[int]) -> str:
        """The ids as decimal numbers joined by commas."""
        return ",".join(map(self._names.__getitem__, ids))


def vocabulary(path: str) -> ByteBpe:
    with open(path, encoding="utf-8") as file:
        return ByteBpe(file.read())


_KINDS = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "decoded": T.StringType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tokenize(
    docs: DataFrame, path: str, outputs: tuple[str, ...] = ("n_tokens", "ids"), text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of `docs`: key and the named outputs (n_tokens, ids, decoded, ids_sha256, decoded_sha256).

    Whole texts are encoded; a null text counts as empty and has no ids. Decoding starts from the ids. Rows
    that repeat stay, null keys stay, further columns of `docs` are not looked at, an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    needs_text = any(o.startswith("decoded") for o in outputs)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = sent.value
        for batch in batches:
            columns: dict[str, list] = {o: [] for o in outputs}
            for value in batch.column(1):
                ids = bpe.encode(value.as_py() or "")
                back = bpe.decode(ids) if needs_text else ""
                for name, column in columns.items():
                    if name == "n_tokens":
                        column.append(len(ids))
                    elif name == "ids":
                        column.append(ids)
                    elif name == "decoded":
                        column.append(back)
                    elif name == "ids_sha256":
                        column.append(_sha256(bpe.listed(ids)))
                    else:
                        column.append(_sha256(back))
            arrays = [pa.array(columns[o], _ARROW[o]) for o in outputs]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [key, *outputs])

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *[T.StructField(o, _KINDS[o]) for o in outputs]])
    return docs.select(key, text).mapInArrow(encoded, schema)


_ARROW = {
    "n_tokens": pa.int64(),
    "ids": pa.list_(pa.int32()),
    "decoded": pa.string(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}


def detokenize(encoded: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """One row per row of `encoded`: key and text, decoded from an array of ids; a null array gives the empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary(path))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = sent.value
        for batch in batches:
            texts = [bpe.decode(value.as_py() or []) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    schema = T.StructType([T.StructField(key, encoded.schema[key].dataType), T.StructField("text", T.StringType())])
    return encoded.select(key, F.col(ids).cast("array<int>")).mapInArrow(decoded, schema)
