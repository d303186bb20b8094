"""Language of a text by a linear-chain conditional random field over its words.

Each word gets a label; its potential sums learned weights of its affixes, its n-grams and, for words of the lexicon, itself, and
learned transitions tie it to the word before. Forward-backward gives every word its chances, also where a text
switches languages; the text has the language with the most expected words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu.llm.quality import fold
from jangbu.llm.spans import LOWER, U64, Texts, _runs, mixed, small

#: About so many texts of each language are fitted to (all where there are fewer), chosen by a hash of their key;
#: of each a run of FIT_WORDS words from a random place.
FIT_TEXTS, FIT_WORDS = 1500, 40
#: More languages than this are an error: labels of rows, not of languages. With it at most 2 * FIT_TEXTS texts of each are fitted to.
MOST_LANGUAGES = 200
FEATURE_BITS = 17
ROUNDS, RATE, BATCH = 6, 0.3, 400
#: A word of the sample belongs to the lexicon if it occurs so often there.
LEXICON_LEAST = 5
UNKNOWN = "und"
#: Words of one block of forward-backward.
BLOCK = 32

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_IS_ASCII_LETTER = _LETTER.copy()
_IS_ASCII_LETTER[128:] = False


def letter_runs(texts: Texts) -> Texts:
    """The texts in lower case with runs of letters (ASCII letters and all beyond ASCII) as their words."""
    out = Texts(LOWER[texts.data], texts.ends)
    out.words = _runs(_LETTER[texts.data], texts.ends)
    return out


def _slots(h: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(h * U64(64) + U64(kind)) >> U64(64 - FEATURE_BITS)).astype(np.int64)


def features(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, hashes: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of some words and the word of each: two- and three-letter runs with borders, affixes, lexicon."""
    size = stops - starts
    n = len(size)
    ends = np.concatenate([[0], np.cumsum(size + 2)])
    letters = np.zeros(ends[-1], U64)
    inner = np.repeat(ends[:-1] + 1 - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    letters[inner] = data[np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
    owner = np.repeat(np.arange(n), size + 2)
    found, of = [], []
    for width in (2, 3):
        at = np.flatnonzero(owner[: len(owner) - width + 1] == owner[width - 1 :])
        own = np.zeros(len(at), U64)
        for k in range(width):
            own = own * U64(256) + letters[at + k]
        found.append(_slots(own, width))
        of.append(owner[at])
    every = np.arange(n)
    for width in (1, 2, 3, 4):
        has = every[size >= width]
        head, tail = np.zeros(len(has), U64), np.zeros(len(has), U64)
        for k in range(width):
            head = head * U64(256) + letters[ends[has] + 1 + k]
            tail = tail * U64(256) + letters[ends[has + 1] - 1 - width + k]
        found += [_slots(head, 8 + width), _slots(tail, 16 + width)]
        of += [has, has]
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
        listed = np.flatnonzero(lexicon[at] == hashes)
        found.append(_slots(hashes[listed], 32))
        of.append(listed)
    found.append(_slots(np.zeros(n, U64), 33))
    of.append(every)
    return np.concatenate(found), np.concatenate(of)


@dataclass
class Field:
    """A fitted model."""

    labels: list[str]
    weights: np.ndarray  # (features, labels)
    steps: np.ndarray  # (labels, labels)
    lexicon: np.ndarray

    def potentials(self, texts: Texts) -> np.ndarray:
        """Log potentials of all words; each different word is looked up once."""
        hashes = texts.hashes(texts.words)
        _, one, of = np.unique(hashes, return_index=True, return_inverse=True)
        starts, stops = texts.words
        slot, owner = features(texts.data, starts[one], stops[one], hashes[one], self.lexicon)
        own = np.stack([np.bincount(owner, self.weights[slot, k], len(one)) for k in range(len(self.labels))], axis=1)
        return own[of]

    def shares(self, texts: Texts) -> np.ndarray:
        """Per text the expected share of its words in each language; 0 for a text without words."""
        starts, _ = texts.words
        if not len(starts):
            return np.zeros((texts.n, len(self.labels)))
        chances = chances_of_words(self.potentials(texts), self.steps, texts.n_words)
        owner = texts.word_text
        sums = np.stack([np.bincount(owner, chances[:, k], texts.n) for k in range(len(self.labels))], axis=1)
        return sums / np.maximum(texts.n_words, 1)[:, None]


def _scaled(x: np.ndarray, axes: tuple[int, ...]) -> np.ndarray:
    return x / np.maximum(x.sum(axis=axes, keepdims=True), 1e-300)


def chances_of_words(potentials: np.ndarray, steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Forward-backward over sequences of `sizes` words that follow one another: the chance of each label for each word.

    Sequences are cut into blocks. The transfer matrices of all blocks are made side by side, then carried
    from block to block along each sequence, then all blocks are filled in side by side: the number of steps does not
    grow with the length of a text, but for one small one a block.
    """
    n, k = potentials.shape
    sizes = sizes[sizes > 0]
    n_blocks = -(-sizes // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(n_blocks)])[:-1]
    seq = np.repeat(np.arange(len(sizes)), n_blocks)
    nth = np.arange(len(seq)) - first_block[seq]
    start = (np.cumsum(sizes) - sizes)[seq] + nth * BLOCK
    size = np.minimum(BLOCK, sizes[seq] - nth * BLOCK)
    move = np.exp(steps - steps.max())
    weight = np.exp(np.maximum(potentials - potentials.max(axis=1, keepdims=True), -60))
    at = np.minimum(start[:, None] + np.arange(BLOCK), n - 1)
    live = np.arange(BLOCK) < size[:, None]
    emit = np.where(live[:, :, None], weight[at], 1.0)
    whole = np.broadcast_to(np.eye(k), (len(seq), k, k)).copy()
    for t in range(BLOCK):
        new = _scaled((whole @ move) * emit[:, t, None, :], (1, 2))
        whole = np.where(live[:, t, None, None], new, whole)
    ahead, behind = np.full((len(seq), k), 1 / k), np.full((len(seq), k), 1 / k)
    for j in range(1, int(n_blocks.max())):
        b = first_block[n_blocks > j] + j
        ahead[b] = _scaled((ahead[b - 1][:, None, :] @ whole[b - 1])[:, 0], (1,))
    for j in range(int(n_blocks.max()) - 1, 0, -1):
        b = first_block[n_blocks > j] + j
        behind[b - 1] = _scaled((whole[b] @ behind[b][:, :, None])[:, :, 0], (1,))
    forward = np.empty((len(seq), BLOCK, k))
    now = ahead
    for t in range(BLOCK):
        now = np.where(live[:, t, None], _scaled((now @ move) * emit[:, t], (1,)), now)
        forward[:, t] = now
    out = np.empty((n, k))
    now = behind
    for t in range(BLOCK - 1, -1, -1):
        on = live[:, t]
        out[start[on] + t] = _scaled(forward[on, t] * now[on], (1,))
        now = np.where(on[:, None], _scaled((now * emit[:, t]) @ move.T, (1,)), now)
    return out


def fit(sample: list[tuple[str, str]], seed: int = 5) -> Field:
    """Fit to (text, language) pairs: runs of words of one text and, for the transitions, of two texts after one another."""
    labels = sorted({lang for _, lang in sample})
    k = len(labels)
    texts = letter_runs(Texts.of(pa.array([t for t, _ in sample], pa.string())))
    starts, stops = texts.words
    rng = np.random.default_rng(seed)
    bounds = np.concatenate([[0], np.cumsum(texts.n_words)])
    runs = []
    for i, (_, lang) in enumerate(sample):
        if n := int(texts.n_words[i]):
            a = int(bounds[i]) + int(rng.integers(0, max(1, n - FIT_WORDS + 1)))
            runs.append((a, min(a + FIT_WORDS, int(bounds[i + 1])), labels.index(lang)))
    if not runs or k < 2:
        return Field(labels, np.zeros((1 << FEATURE_BITS, max(k, 1))), np.zeros((max(k, 1), max(k, 1))), np.zeros(0, U64))
    hashes = texts.hashes(texts.words)
    known, often = np.unique(np.concatenate([hashes[a:b] for a, b, _ in runs]), return_counts=True)
    field = Field(labels, np.zeros((1 << FEATURE_BITS, k)), np.zeros((k, k)), known[often >= LEXICON_LEAST])
    squares, step_squares = np.full(field.weights.shape, 1e-6), np.full((k, k), 1e-6)
    for _ in range(ROUNDS):
        order = rng.permutation(len(runs))
        sequences = []
        at = 0
        while at < len(order):
            a, b, label = runs[order[at]]
            own, marks = list(range(a, b)), [label] * (b - a)
            if at + 1 < len(order) and rng.random() < 0.3:
                at += 1
                a, b, label = runs[order[at]]
                own, marks = own + list(range(a, b)), marks + [label] * (b - a)
            sequences.append((own, marks))
            at += 1
        for s in range(0, len(sequences), BATCH):
            part = sequences[s : s + BATCH]
            word = np.concatenate([p[0] for p in part])
            mark = np.concatenate([p[1] for p in part])
            sizes = np.array([len(p[0]) for p in part])
            slot, owner = features(texts.data, starts[word], stops[word], hashes[word], field.lexicon)
            potentials = np.stack([np.bincount(owner, field.weights[slot, c], len(word)) for c in range(k)], axis=1)
            chances, pairs = _with_pairs(potentials, field.steps, sizes)
            off = -chances
            off[np.arange(len(mark)), mark] += 1
            slope = np.stack([np.bincount(slot, off[owner, c], 1 << FEATURE_BITS) for c in range(k)], axis=1) / len(part)
            squares += slope**2
            field.weights += RATE * slope / np.sqrt(squares)
            inside = np.ones(len(mark), bool)
            inside[np.cumsum(sizes)[:-1]] = False
            inside[0] = False
            later = np.flatnonzero(inside)
            seen = np.bincount(mark[later - 1] * k + mark[later], minlength=k * k).reshape(k, k)
            slope = (seen - pairs) / len(part)
            step_squares += slope**2
            field.steps += RATE * slope / np.sqrt(step_squares)
    return field


def _with_pairs(potentials: np.ndarray, steps: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of words as above, and the expected number of each pair of labels, for short sequences."""
    k, longest, n = potentials.shape[1], int(sizes.max()), len(sizes)
    start = np.cumsum(sizes) - sizes
    live = np.arange(longest) < sizes[:, None]
    at = np.minimum(start[:, None] + np.arange(longest), len(potentials) - 1)
    emit = np.exp(np.maximum(potentials - potentials.max(axis=1, keepdims=True), -60))[at]
    move = np.exp(steps - steps.max())
    forward, backward = np.zeros((n, longest, k)), np.ones((n, longest, k))
    now = np.full((n, k), 1 / k)
    for t in range(longest):
        now = np.where(live[:, t, None], _scaled((now @ move) * emit[:, t], (1,)), now)
        forward[:, t] = now
    pairs = np.zeros((k, k))
    for t in range(longest - 2, -1, -1):
        on = live[:, t + 1]
        passed = emit[:, t + 1] * backward[:, t + 1]
        backward[:, t] = np.where(on[:, None], _scaled(passed @ move.T, (1,)), 1.0)
        both = forward[on, t, :, None] * move * passed[on][:, None, :]
        pairs += _scaled(both, (1, 2)).sum(axis=0)
    out = _scaled(forward * backward, (2,))
    return out[live], pairs


def learned(docs: DataFrame, fold_of: int, away: int, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Field:
    """A model of the languages in `lang`, from a hashed sample of the rows outside the fold `away`.

    At most 2 * FIT_TEXTS cut texts of each of at most MOST_LANGUAGES languages come to the driver, whatever the keys and
    however often rows repeat.
    """
    known = docs.where(F.col(lang).isNotNull() & ~F.coalesce(fold(key, fold_of) == away, F.lit(False)) & F.col(text).isNotNull())
    # Key and text, so that neither rows without a key nor those of one key are chosen or left all together.
    h = F.pmod(F.xxhash64(F.col(key), F.col(text), F.lit("fit")), F.lit(1 << 30))
    known = known.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), h.alias("h"))
    # One number a language, as the model has; with it rows are chosen where they stand. Copies count once.
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"{lang} holds more than {MOST_LANGUAGES} languages")
    if not sizes:
        return fit([])
    limit = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], FIT_TEXTS * (1 << 30) // max(1, r["n"]))])[F.col("lang")]
    chosen = known.where(F.col("h") < limit)
    # A run of words is cut out on the executors, so that long texts do not come to the driver.
    words = F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0))
    cut = F.pmod(F.col("h"), F.greatest(F.size("words") - 3 * FIT_WORDS + 1, F.lit(1))).cast("int") + 1
    rows = chosen.select("lang", "h", words.alias("words")).select("lang", "h", F.array_join(F.slice("words", cut, 3 * FIT_WORDS), " ").alias("text"))
    first = Window.partitionBy("lang").orderBy("h", "text")
    rows = rows.distinct().withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= 2 * FIT_TEXTS).toArrow()
    return fit(sorted(zip(rows.column("text").to_pylist(), rows.column("lang").to_pylist())))


def identify(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", fold_of: int = 4, away: int = 2
) -> DataFrame:
    """One row per row of `docs`: key, held_out, lang_pred, score.

    Languages are learned from `lang` of keys whose crc32 modulo `fold_of` is not `away`; a prediction comes from the
    whole text alone. A text that is null or has no letter is `und` with score 0, and so is every text if there is no
    language to learn; with one language all others have that. The score is the expected share of words in the predicted
    language, ties go to the first in alphabetical order. Repeated rows get equal answers, a null key is held out of nothing,
    further columns are not looked at, an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(learned(docs, fold_of, away, text, lang, key))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        names = np.array([*field.labels, UNKNOWN], dtype=object)
        for batch in small(batches, 2, 2 << 20):
            texts = Texts.of(batch.column(2))
            plain = texts.sums(_IS_ASCII_LETTER[texts.data]) > 0
            unsure = np.flatnonzero(~plain & (texts.sums(texts.data >= 128) > 0))
            for i in unsure:
                plain[i] = any(c.isalpha() for c in batch.column(2)[int(i)].as_py())
            if field.labels:
                shares = field.shares(letter_runs(texts))
                best = np.where(plain, shares.argmax(axis=1), len(field.labels))
                score = np.where(plain, shares.max(axis=1), 0.0)
            else:
                best, score = np.zeros(texts.n, int), np.zeros(texts.n)
            columns = [pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], [key, "held_out", "lang_pred", "score"])

    rows = docs.select(key, F.coalesce(fold(key, fold_of) == away, F.lit(False)).alias("held_out"), text)
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(predict, schema)
