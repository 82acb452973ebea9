"""Quality rules as a short-circuit cascade.

A rule rejects a document by features of its text.  On a sample, tasks measure
what each feature costs and which rules reject each document; the rules are then
ordered by rejection per cost, each given those before it: a rule's gain is the
documents that no earlier rule rejects, its cost the features that no earlier rule
has computed.  The cascade computes a rule's features only for documents that
passed all rules before it.  A document stays if no rule rejects it, so the order,
which follows measured times, changes the work and never the verdict.

Features in ``reported`` are computed for every document, as columns of the
result; rules that only need those cost nothing more.

Defined cases: a null text is empty and has no words; the features of a text
without words are 0, and it fails ``few_words``; repeated rows are judged one by
one; an empty table gives an empty result (the rules then keep their written
order); other columns pass through, and one named like a result is replaced."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainwatch.llm._common import text_slices, unused, with_text_columns

#: Fixed values of the contract: symbols, window of the repeated words.
SYMBOLS, WINDOW = "#*$%&|<>", 8
#: Documents on which costs and rejections are estimated (a bounded sample; it orders the rules only).
SAMPLE = 2_000
SPACE = " \t\n\x0b\x0c\r"
#: A word from its first letter on: A-Z, a-z or any character from U+00C0.
LETTERS = re.compile("[A-Za-zÀ-\U0010ffff][^\x20\x09-\x0d]*")


class Texts:
    """Some documents' texts, and their words once a feature needs them."""

    def __init__(self, texts: list[str | None]):
        self.texts = [t or "" for t in texts]
        self._words: list[list[bytes] | None] = [None] * len(texts)

    def words(self, at) -> list[list[bytes]]:
        for i in at:
            if self._words[i] is None:  # bytes split at ASCII white space only
                self._words[i] = self.texts[i].encode().split()
        return [self._words[i] for i in at]

    def pick(self, at) -> list[str]:
        return [self.texts[i] for i in at]


def _n_words(docs: Texts, at):
    return [len(w) for w in docs.words(at)]


def _word_chars(docs: Texts, at):
    return [len(t) - sum(map(t.count, SPACE)) for t in docs.pick(at)]


def _n_symbols(docs: Texts, at):
    return [sum(map(t.count, SYMBOLS)) for t in docs.pick(at)]


def _lines(text: str) -> list[str]:
    return [x for x in text.split("\n") if x.strip(SPACE)]


def _n_lines(docs: Texts, at):
    return [len(_lines(t)) for t in docs.pick(at)]


def _n_dup_lines(docs: Texts, at):
    return [len(x) - len(set(x)) for x in map(_lines, docs.pick(at))]


def _n_repeat_words(docs: Texts, at):
    return repeated_words(docs.words(at), WINDOW)


def _n_letter_words(docs: Texts, at):
    return [len(LETTERS.findall(t)) for t in docs.pick(at)]


def _n_digits(docs: Texts, at):
    return [sum(map(t.count, "0123456789")) for t in docs.pick(at)]


def _longest_word(docs: Texts, at):
    return [max(map(len, w), default=0) for w in docs.words(at)]


def repeated_words(docs: list[list[bytes]], width: int) -> np.ndarray:
    """For each list of words, how many lie in a window of ``width`` words that
    stands at two or more places of the list."""
    number: dict[bytes, int] = {}
    size = np.array([len(w) for w in docs], np.int64)
    out = np.zeros(len(docs), np.int64)
    ids = np.array([number.setdefault(w, len(number)) for words in docs for w in words], np.int64)
    doc = np.repeat(np.arange(len(docs)), size)
    end = np.repeat(np.cumsum(size), size)
    start = np.flatnonzero(np.arange(len(ids)) + width <= end)
    if not len(start):
        return out
    # windows are told apart by a hash first; those that meet are compared in full
    key = doc[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(width):
        key = (key ^ (key >> np.uint64(29)) ^ ids[start + j].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    met = start[order][np.r_[False, same] | np.r_[same, False]]
    if not len(met):
        return out
    rows = np.column_stack([doc[met], *(ids[met + j] for j in range(width))])
    _, which, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    again = met[count[which.ravel()] > 1]
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + width, -1)
    return np.bincount(doc, weights=np.cumsum(cover)[:-1] > 0, minlength=len(docs)).astype(np.int64)


FEATURES = {
    "n_words": _n_words,
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_lines": _n_lines,
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
    "n_letter_words": _n_letter_words,
    "n_digits": _n_digits,
    "longest_word": _longest_word,
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes the named features as arrays and gives a truth array."""

    name: str
    features: tuple[str, ...]
    rejects: object


#: The two rules of the contract's ``base_failed``, then common rules for web text.
BASE_RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 20),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 30 * n),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 3 * n) | (c > 12 * n)),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 2 * d > n),
    Rule("few_letters", ("n_letter_words", "n_words"), lambda a, n: 10 * a < 7 * n),
    Rule("digits", ("n_digits", "word_chars"), lambda d, c: 10 * d > 3 * c),
    Rule("long_word", ("longest_word",), lambda n: n > 1000),
)


class Cascade:
    """Applies rules in an order to some texts, computing what is needed."""

    def __init__(self, rules=RULES, reported=()):
        self.rules, self.reported = rules, reported

    def run(self, texts: list[str | None]):
        """Features reported, and whether each text stays."""
        docs = Texts(texts)
        known: dict[str, np.ndarray] = {}
        have: dict[str, np.ndarray] = {}

        def need(feature, at):
            if feature not in known:
                known[feature], have[feature] = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
            missing = at[~have[feature][at]]
            if len(missing):
                known[feature][missing] = FEATURES[feature](docs, missing.tolist())
                have[feature][missing] = True
            return known[feature][at]

        alive = np.arange(len(texts))
        columns = [need(f, alive) for f in self.reported]
        stays = np.ones(len(texts), bool)
        for rule in self.rules:
            if not len(alive):
                break
            out = rule.rejects(*(need(f, alive) for f in rule.features))
            stays[alive[out]] = False
            alive = alive[~out]
        return columns, stays


def best_order(rules, cost: dict[str, float], patterns: dict[int, int], free=()) -> list[Rule]:
    """Rules by rejection per cost, each given those before it.  ``patterns`` has the
    number of documents for each set of rejecting rules (bit i: ``rules[i]``)."""
    left, out, done = list(range(len(rules))), [], set(free)
    alive = dict(patterns)
    while left:

        def gain(i):
            rejected = sum(n for bits, n in alive.items() if bits >> i & 1)
            price = sum(cost.get(f, 0.0) for f in rules[i].features if f not in done)
            return rejected / (price + 1e-9)

        best = max(left, key=lambda i: (gain(i), -i))
        left.remove(best)
        out.append(rules[best])
        done |= set(rules[best].features)
        alive = {bits: n for bits, n in alive.items() if not bits >> best & 1}
    return out


def estimate(docs: DataFrame, text: str = "text", rules=RULES, sample: int = SAMPLE) -> tuple[dict[str, float], dict[int, int]]:
    """Seconds of each feature and the number of documents for each set of
    rejecting rules, on a sample of about ``sample`` documents spread over the
    table; texts stay in the tasks, which return sums."""
    every = max(1, docs.count() // max(sample, 1))
    key = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(every)) == 0
    drawn = docs.select(F.col(text).alias("text")).where(key)
    features = list(dict.fromkeys(f for r in rules for f in r.features))

    def measure(batches):
        spent, patterns = dict.fromkeys(features, 0.0), {}
        for whole in batches:
            for b in text_slices(whole, "text"):
                docs, at = Texts(b.column("text").to_pylist()), list(range(b.num_rows))
                values = {}
                for f in features:
                    began = time.perf_counter()
                    values[f] = np.asarray(FEATURES[f](docs, at), np.int64)
                    spent[f] += time.perf_counter() - began
                bits = np.zeros(b.num_rows, np.int64)
                for i, r in enumerate(rules):
                    bits |= r.rejects(*(values[f] for f in r.features)).astype(np.int64) << i
                for k, n in zip(*np.unique(bits, return_counts=True)):
                    patterns[int(k)] = patterns.get(int(k), 0) + int(n)
        rows = [(f, None, s) for f, s in spent.items()] + [(None, k, float(n)) for k, n in patterns.items()]
        columns = zip(*rows)
        types = [pa.string(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["feature", "bits", "sum"])

    made = drawn.mapInArrow(measure, "feature string, bits bigint, sum double").groupBy("feature", "bits").agg(F.sum("sum").alias("sum")).collect()
    return {r.feature: r.sum for r in made if r.feature}, {r.bits: int(r.sum) for r in made if r.feature is None}


def judge(docs: DataFrame, text: str = "text", rules=RULES, reported=(), sample: int = SAMPLE, kept: str = "kept") -> DataFrame:
    """``docs`` with the ``reported`` features and the verdict ``kept``."""
    cost, patterns = estimate(docs, text, rules, sample)
    cascade = Cascade(best_order(rules, cost, patterns, reported), reported)

    def make():
        def compute(texts):
            columns, stays = cascade.run(texts)
            return [*(pa.array(c) for c in columns), pa.array(stays)]

        return compute

    fields = [*(T.StructField(f, T.LongType(), False) for f in reported), T.StructField(kept, T.BooleanType(), False)]
    return with_text_columns(docs, text, make, fields)


def drop_poor(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    kept = unused(docs, "kept")
    return judge(docs, text, rules, kept=kept).where(F.col(kept)).drop(kept)
