"""Quality rules: plain limits on words and repeats, and perplexity bands by language.

The perplexity is that of a modified Kneser-Ney model over runs of five characters, none of them folded, so that the
model grows with the corpus. Every language has two models: texts fall into two folds by their hash, and each is measured
by the model of the other fold, so that neither a text nor its copies vouch for it. Counts, discounts and probabilities
are grouped tables of Spark. Tasks write them as hashed runs in ranges of rising hashes; Spark brings these files to the
executors, where workers map them into memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jangbu.llm.files import mapped_parts, shared_parts
from jangbu.llm.spans import U64, Texts, counts_within, mixed, small
from jangbu.session import scratch, scratch_path, settle

ORDER = 5
#: Bits of a character, characters in one number, and the probability of one that no model knows.
BITS, HALF, UNKNOWN = 21, 3, 1 / 0x110000
FOLDS = 2
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
#: A band reaches this many spreads (interquartile ranges) beyond the quartiles. 3.5 keeps 99 of 100 texts labelled good at sf0.1.
SPREADS = 3.5
#: Runs gathered in a task before they are handed on.
_HELD = 2_000_000

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def characters(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, and where each text's end, starting with 0."""
    leads = (texts.data & 0xC0) != 0x80
    at = np.flatnonzero(leads)
    first = texts.data[at]
    size = 1 + (first >= 0xC0).astype(np.uint8) + (first >= 0xE0) + (first >= 0xF0)
    out = (first & np.array([0, 0x7F, 0x1F, 0x0F, 0x07], np.uint8)[size]).astype(U64)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        out[more] = out[more] << U64(6) | (texts.data[np.minimum(at[more] + k, len(texts.data) - 1)] & 0x3F).astype(U64)
    return out, np.concatenate([[0], np.cumsum(leads)])[texts.ends]


def runs(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At each character the run that it ends, as two numbers (a, b) of up to three characters each, and where each text's end.

    Before a text there are zeros.
    """
    symbols, ends = characters(texts)
    n = len(symbols)
    at = np.arange(n) - np.repeat(ends[:-1], np.diff(ends))
    parts = [np.zeros(n, U64), symbols.copy()]
    for back in range(1, ORDER):
        shifted = np.zeros(n, U64)
        shifted[back:] = symbols[:-back] if back < n else 0
        shifted[at < back] = 0
        parts[back < HALF] |= shifted << U64(BITS * (back % HALF))
    return *parts, ends


def distinct_runs(of: np.ndarray, texts: Texts, places: bool = False) -> tuple[np.ndarray, ...]:
    """The different runs (model, a, b) of texts, and how often each occurs; with `places` which of them each character ends.

    `of` has the model of each text. Runs become single numbers over the characters that occur, which sort quickly; where
    there are too many characters for that, hashes of the runs are sorted.
    """
    symbols, ends = characters(texts)
    sizes = np.diff(ends)
    present = np.zeros(0x200000, bool)
    present[symbols] = True
    alphabet = np.flatnonzero(present).astype(U64)
    models, model = np.unique(of, return_inverse=True)
    base = len(alphabet) + 1
    if max(1, len(models)) * base**ORDER >= 1 << 63:
        of, (a, b, _) = np.repeat(of, sizes), runs(texts)
        _, first, place, n = np.unique(_key(of, ORDER, False, a, b), return_index=True, return_inverse=True, return_counts=True)
        return of[first], a[first], b[first], place if places else n
    codes = np.zeros(0x200000, np.int64)
    codes[alphabet.astype(np.int64)] = np.arange(1, base)
    code, at = codes[symbols], np.arange(len(symbols)) - np.repeat(ends[:-1], sizes)
    number = np.repeat(model.astype(np.int64), sizes)
    for back in range(ORDER - 1, -1, -1):
        number *= base
        number[back:] += np.where(at[back:] < back, 0, code[: len(code) - back])
    number, last = np.unique(number, return_inverse=places, return_counts=not places)
    parts, letters = [np.zeros(len(number), U64), np.zeros(len(number), U64)], np.concatenate([np.zeros(1, U64), alphabet])
    for back in range(ORDER):
        number, digit = np.divmod(number, base)
        parts[back < HALF] |= letters[digit] << U64(BITS * (back % HALF))
    return models[number], *parts, last


def _cut(order: int) -> tuple[int, int]:
    """What is left of (a, b) in the last `order` characters, as masks."""
    return (1 << BITS * max(order - HALF, 0)) - 1, (1 << BITS * min(order, HALF)) - 1


def _key(of: np.ndarray, order: int, context: bool, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the runs of an order, or of contexts of runs of this order, in the models `of`."""
    return mixed(a.astype(U64) ^ mixed(b.astype(U64) ^ mixed(of.astype(U64) + U64(2 * order + context + 1))))


def _before(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs without their last character."""
    return a >> U64(BITS), b >> U64(BITS) | (a & U64((1 << BITS) - 1)) << U64(BITS * (HALF - 1))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per model (own), run (a, b): how often it occurs (n). Tasks count what they read before anything is shuffled."""

    def merged(held: list[list[np.ndarray]]) -> list[np.ndarray]:
        of, a, b, n = (np.concatenate(c) for c in zip(*held))
        _, at, place = np.unique(_key(of, ORDER, False, a, b), return_index=True, return_inverse=True)
        columns = [of[at], a[at], b[at], np.bincount(place, n, len(at)).astype(np.int64)]
        order = np.lexsort(columns[2::-1])
        return [c[order] for c in columns]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in small(batches):
            held.append(list(distinct_runs(batch.column(0).to_numpy(), Texts.of(batch.column(1)))))
            if sum(len(h[0]) for h in held) > _HELD:
                held = [merged(held)]
                if len(held[0][0]) > _HELD // 2:
                    yield _rows(held.pop())
        if held:
            yield _rows(merged(held))

    def _rows(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["of", "a", "b", "n"])

    counts = docs.select("own", text).mapInArrow(count, "of bigint, a bigint, b bigint, n bigint")
    return counts.groupBy("of", "a", "b").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> DataFrame:
    """Per model what is taken off counts of 1, 2 and more; plain values where the counts of counts give none."""
    of = counts.groupBy("of").agg(*(F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)))
    n1, n2, n3, n4 = (F.col(f"n{k}").cast("double") for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    told = (n1 > 0) & (n2 > 0) & (n3 > 0)
    clip = lambda c, low, high: F.greatest(F.least(c, F.lit(high)), F.lit(low))
    return of.select(
        "of",
        F.when(told, clip(1 - 2 * y * n2 / n1, 0.05, 0.95)).otherwise(0.5).alias("d1"),
        F.when(told, clip(2 - 3 * y * n3 / n2, 0.1, 1.9)).otherwise(0.75).alias("d2"),
        F.when(told, clip(3 - 4 * y * n4 / n3, 0.1, 2.9)).otherwise(0.9).alias("d3"),
    )


def kneser_ney(counts: DataFrame) -> list[DataFrame]:
    """For each order from 1: model, run (a, b) and its probability (chance), the weight that its context leaves for the
    order below (rest), and whether the row stands for the context (first).

    The highest order has the counts, each lower one in how many ways its runs are continued to the left.
    """
    tables = [counts]
    for order in range(ORDER - 1, 0, -1):
        shorter = [F.col(c).bitwiseAND(F.lit(m)).alias(c) for c, m in zip("ab", _cut(order))]
        tables.insert(0, settle(tables[0].select("of", *shorter).groupBy("of", "a", "b").agg(F.count("*").alias("n")), "ways"))
    out: list[DataFrame] = []
    for order, own in enumerate(tables, 1):
        a, b = F.col("a"), F.col("b")
        context = [F.shiftright(a, BITS).alias("ca"), F.shiftright(b, BITS).bitwiseOR(F.shiftleft(a.bitwiseAND(F.lit((1 << BITS) - 1)), BITS * (HALF - 1))).alias("cb")]
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = own.join(discounts(own), "of").select("of", "a", "b", "n", off.alias("off"), *context)
        same = Window.partitionBy("of", "ca", "cb")
        size = F.sum("n").over(same)
        rows = rows.select("of", "a", "b", ((F.col("n") - F.col("off")) / size).alias("chance"), (F.sum("off").over(same) / size).alias("rest"), (F.min("b").over(same) == b).alias("first"))
        if out:
            shorter = [F.col(c).bitwiseAND(F.lit(m)) for c, m in zip("ab", _cut(order - 1))]
            below = out[-1].select("of", F.col("a").alias("la"), F.col("b").alias("lb"), F.col("chance").alias("lower"))
            rows = rows.withColumns({"la": shorter[0], "lb": shorter[1]}).join(below, ["of", "la", "lb"])
        else:
            rows = rows.withColumn("lower", F.lit(UNKNOWN))
        chance = F.col("chance") + F.col("rest") * F.col("lower")
        out.append(settle(rows.select("of", "a", "b", chance.alias("chance"), "rest", "first"), "chances"))
    return out


def _hashed(order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, a, b, chance, rest = (batch.column(i).to_numpy().view() for i in range(5))
            first = batch.column(5).to_numpy(zero_copy_only=False)
            a, b = a.astype(U64), b.astype(U64)
            keys = _key(of, order, False, a, b), _key(of[first], order, True, *_before(a[first], b[first]))
            values = np.concatenate([chance, rest[first]]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(values)], ["key", "value"])

    return hashed


def model_files(tables: list[DataFrame], path: str | None = None) -> list[str]:
    """Write hashed runs and contexts of all models in ranges of rising hashes; the files' names on the executors, in order."""
    spark = tables[0].sparkSession
    hashed = [t.mapInArrow(_hashed(order), "key bigint, value float") for order, t in enumerate(tables, 1)]
    path = path or scratch_path(spark, "model")
    reduce(DataFrame.union, hashed).repartitionByRange("key").sortWithinPartitions("key").write.parquet(path)
    return shared_parts(spark, path)


class Model:
    """The mapped models: hashed runs and contexts, sorted, with their values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    def _get(self, keys: np.ndarray) -> np.ndarray:
        """The values of the keys, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(keys), -1.0)
        keys = keys.view(np.int64)
        order = np.argsort(keys)
        at = np.empty(len(keys), np.int64)
        at[order] = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], -1).astype(np.float64)

    def chances(self, of: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The probability of each run's last character after the others; runs that are not known go on to shorter ones."""
        out, open_ = np.ones(len(a)), np.arange(len(a))
        for order in range(ORDER, 0, -1):
            a, b = (c & U64(m) for c, m in zip((a, b), _cut(order)))
            seen = self._get(_key(of, order, False, a, b))
            known = seen >= 0
            out[open_[known]] *= seen[known]
            open_, of, a, b = open_[~known], of[~known], a[~known], b[~known]
            rest = self._get(_key(of, order, True, *_before(a, b)))
            out[open_] *= np.where(rest >= 0, rest, 1)
        out[open_] *= UNKNOWN
        return out

    def bits(self, of: np.ndarray, texts: Texts) -> np.ndarray:
        """Per text the mean of -log2 of its characters' probabilities; 0 for an empty text."""
        *found, place = distinct_runs(of, texts, places=True)
        each, ends = -np.log2(self.chances(*found))[place], characters(texts)[1]
        total = np.concatenate([[0], np.cumsum(each)])
        return (total[ends[1:]] - total[ends[:-1]]) / np.maximum(np.diff(ends), 1)


def rule_counts(texts: Texts) -> list[np.ndarray]:
    """Per text: words, code points in words, symbols, repeated lines, words in repeated windows."""
    data, owner = texts.data, texts.word_text
    hashes = texts.hashes(texts.words)
    starts, stops = texts.lines
    seen = np.concatenate([[0], np.cumsum(~texts.space)])
    worded = seen[stops] > seen[starts]
    lines = starts[worded], stops[worded]
    line_owner = np.searchsorted(texts.ends, lines[0], "right") - 1
    again = counts_within(line_owner, texts.hashes(lines))[1]
    windows, first = texts.grams(hashes, WINDOW)
    twice = first[counts_within(owner[first], windows)[0] > 1]
    cover = np.zeros(len(owner) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    repeated = np.cumsum(cover)[:-1] > 0
    return [
        texts.n_words.astype(np.int64),
        texts.sums(~texts.space & ((data & 0xC0) != 0x80)),
        texts.sums(_SYMBOLS[data]),
        np.bincount(line_owner, again, texts.n).astype(np.int64),
        np.bincount(owner, repeated, texts.n).astype(np.int64),
    ]


RULE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """Per row of `docs`: key, language, the counts of the rules, and bits: the mean surprise of a character."""
    fold = F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(FOLDS))
    model = lambda f: F.xxhash64(F.lit(ORDER), F.col(lang).cast("string"), f)
    path = scratch_path(docs.sparkSession, "model")
    with scratch(docs.sparkSession):  # the counts are not needed any more when the model is written
        files = model_files(kneser_ney(settle(counted(docs.select(model(fold).alias("own"), text), text), "runs")), path)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*mapped_parts(files, {"key": np.int64, "value": np.float32}))
        for batch in small(batches, 3):
            texts = Texts.of(batch.column(3))
            columns = [*rule_counts(texts), model.bits(batch.column(2).to_numpy(), texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, columns)], [key, "lang", *RULE_COLUMNS, "bits"])

    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField("lang", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in RULE_COLUMNS]
        + [T.StructField("bits", T.DoubleType())]
    )
    own = docs.select(F.col(key), F.col(lang).cast("string").alias("lang"), model(F.lit(FOLDS - 1).cast("long") - fold).alias("_other"), F.col(text))
    return own.mapInArrow(measure, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _away() -> Column:
    """How far the bits are from the centre, in a unit that does not shrink with a text's length."""
    return (F.col("bits") - F.col("centre")) * F.sqrt(F.col("word_chars"))


def bands(rows: DataFrame, spreads: float = SPREADS) -> DataFrame:
    """Per language the median of bits (centre), and how far from it the lowest and highest are that are kept.

    The mean of a text's bits varies with the root of its length, so distances are scaled by it. Their exact quartiles are
    widened by spreads. Texts of equal size and bits count once, so that copies do not narrow a band. Bits are counted
    in steps of 1/1000 and distances of 1/100, which leaves some thousand counts a language.
    """
    apart = rows.select("lang", "bits", "n_words", "word_chars").distinct()
    steps = apart.groupBy("lang", F.round("bits", 3).alias("step")).agg(F.count("*").alias("n"))
    centres = steps.groupBy(F.col("lang").alias("of_lang")).agg(F.percentile("step", F.lit(0.5), F.col("n")).alias("centre"))
    centres = settle(centres, "centres")
    told = apart.join(centres, F.col("lang").eqNullSafe(F.col("of_lang")))
    steps = told.groupBy("of_lang", "centre", F.round(_away(), 2).alias("step")).agg(F.count("*").alias("n"))
    quartiles = steps.groupBy("of_lang", "centre").agg(F.percentile("step", F.array(F.lit(0.25), F.lit(0.75)), F.col("n")).alias("q"))
    # A step at least, so that rounding rejects nothing.
    reach = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(0.01)) * spreads
    return quartiles.select("of_lang", "centre", (F.col("q")[0] - reach).alias("low"), (F.col("q")[1] + reach).alias("high"))


def rules(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """One row per row of `docs`: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, bits.

    A text that passes the limits is kept if its bits a character (log2 of its perplexity) lie in the band of its
    language. A null text counts as empty and fails, a null language is one of its own. The counts of the model and the bands
    cover all rows; bands come from texts that pass the limits. Repeated rows get equal answers, null keys stay, further columns
    are not looked at, an empty table gives no rows.
    """
    rows = settle(measured(docs, text, key, lang), "measured")
    failed = rows.withColumn("base_failed", base_failed())
    limits = bands(failed.where("not base_failed"))
    told = failed.join(limits, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    kept = ~F.col("base_failed") & _away().between(F.col("low"), F.col("high"))
    return told.select(key, *RULE_COLUMNS, "base_failed", F.coalesce(kept, F.lit(False)).alias("kept"), "bits")
