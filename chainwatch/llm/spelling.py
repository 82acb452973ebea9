"""Spelling variants: words that differ by one code point, found with PartEnum
signatures of their letter multisets.

A word's letter multiset is a binary vector with one dimension per (letter, how
many-th of its kind).  One inserted or deleted letter changes one dimension, one
replaced letter two, so near words lie within a Hamming distance of two.

1. Words are counted over all texts, in the JVM, aggregated before the shuffle.
2. Partition: the dimensions are dealt to ``PARTS`` parts of like information by
   the vocabulary's own counts.  Enumerate: every choice of ``PARTS - 2`` parts
   is a signature (the word's dimensions in them); two vectors within a distance
   of two differ in at most two parts, so they share one.
3. An equi-join on signatures brings candidates together: rows are shuffled and
   sorted by signature, and the pairs of a group are made and verified inside a
   task, so that only near pairs become rows.  In a group only words with one half
   in common are compared, as one edit leaves a half of a word alone.  A pair is
   reported by the first signature that it shares, so once.
4. A group of more than ``GROUP`` words is not held: its rows are passed on and
   joined anew under signature, length and half together, which loses no pair.
5. A word's form is its near word of largest count, if that is at least
   ``RATIO`` times its own; roots follow by doubling the pointers.

Defined cases: null and empty texts have no words; repeated rows count as often
as they stand; words of a row with a null id are counted as they are written
(there is no id to vary them by); equal counts are settled by code-point order;
a word of any length is taken whole; an empty table, or one without frequent
words, gives no rows; other columns are not read."""

from __future__ import annotations

import itertools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainwatch.llm._common import written

#: A run of letters (the fixed pattern of the contract).
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: Parts of the dimensions; a signature leaves out as many as words may differ in.
PARTS, APART = 5, 2
#: Signatures: the parts of each.
CHOSEN = list(itertools.combinations(range(PARTS), PARTS - APART))
#: Letters of one kind whose dimensions are dealt by count; further ones by hash.
COUNTED = 8
#: Words of one signature that a task holds; rows that it verifies at a time.
GROUP, ROWS = 1 << 17, 1 << 16
#: A form's count is at least this many times the word's.
RATIO = 2
STEP = np.uint64(0x9E3779B97F4A7C15)


def count_words(docs: DataFrame, id: str = "doc_id", text: str = "text", vary: int | None = None, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of the words with at least ``shortest`` code points and ``least``
    occurrences.  ``vary`` deletes one letter of about one in so many runs, told
    by the crc32 of id and run, as slips of the pen would."""
    runs = docs.select(F.col(id).cast("string").alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    # only A-Z are lowered; lower() does just that where all letters are ASCII
    plain = F.octet_length("run") == F.char_length("run")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = runs.select("id", F.when(plain, F.lower("run")).otherwise(F.translate("run", upper, upper.lower())).alias("word"))
    if vary:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = (F.col("h") % F.char_length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
        word = word.withColumn("h", h).select(F.when(F.col("h") % vary == 0, cut).otherwise(F.col("word")).alias("word"))
    counts = word.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (fixed constants of that public generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and each word's length."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64), size


def _dimensions(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word's index, letter, how many-th of its kind) of every dimension set."""
    letter, size = _letters(words)
    row = np.repeat(np.arange(len(words)), size)
    order = np.lexsort((letter, row))
    letter, row = letter[order], row[order]
    start = np.flatnonzero(np.r_[True, (np.diff(letter) != 0) | (np.diff(row) != 0)]) if len(letter) else np.zeros(0, np.int64)
    nth = np.arange(len(letter)) - np.repeat(start, np.diff(np.r_[start, len(letter)]))
    return row, letter, nth


def dealt_parts(vocabulary: DataFrame) -> dict[tuple[int, int], int]:
    """Part of each frequent (letter, nth) dimension: heaviest first, to the part
    with the least information so far.  At most COUNTED dimensions a letter."""

    def count(batches):
        for b in batches:
            _, letter, nth = _dimensions(b.column("word").to_pylist())
            keep = nth < COUNTED
            key, n = np.unique(letter[keep] * COUNTED + nth[keep], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

    counted = vocabulary.select("word").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    rows = sorted(((r.n, r.key) for r in counted.collect()), key=lambda r: (-r[0], r[1]))
    words = max(vocabulary.count(), 1)

    def information(n):
        p = n / words
        return 0.0 if p >= 1 else -p * math.log2(p) - (1 - p) * math.log2(1 - p)

    load, part = [0.0] * PARTS, {}
    for weight, key in sorted(((information(n), key) for n, key in rows), key=lambda r: (-r[0], r[1])):
        least = load.index(min(load))
        part[divmod(key, COUNTED)] = least
        load[least] += weight
    return part


class Signatures:
    """PartEnum signatures of words under a deal of dimensions to parts."""

    def __init__(self, part: dict[tuple[int, int], int]):
        keys = sorted(part)
        self.keys = np.array([c * COUNTED + k for c, k in keys], np.int64)
        self.part = np.array([part[k] for k in keys], np.int64)

    def parts(self, words: list[str]) -> np.ndarray:
        """One hash per word and part, of the word's dimensions in the part."""
        row, letter, nth = _dimensions(words)
        value = _mix((letter * (1 << 32) + nth).astype(np.uint64) + STEP)
        part = (value % np.uint64(PARTS)).astype(np.int64)
        if len(self.keys):
            key = letter * COUNTED + nth
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (nth < COUNTED) & (self.keys[at] == key)
            part[known] = self.part[at[known]]
        made = np.zeros(len(words) * PARTS, np.uint64)
        np.add.at(made, row * PARTS + part, value)
        return made.reshape(-1, PARTS)

    def all(self, words: list[str]) -> np.ndarray:
        """One value per word and signature."""
        own = self.parts(words)
        out = np.empty((len(words), len(CHOSEN)), np.uint64)
        for s, chosen in enumerate(CHOSEN):
            value = np.full(len(words), s + 1, np.uint64)
            for p in chosen:
                value = _mix(value * STEP + own[:, p])
            out[:, s] = value
        return out.view(np.int64)


def _halves(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Four keys per word: for the shorter length l of a pair, which is the
    word's own or one less, the hash of its first l // 2 code points and of its last
    l - l // 2; and the hashes of all prefixes with each word's start in them.

    One edit leaves either the first l // 2 code points or the last l - l // 2 alone."""
    letter, size = _letters(words)
    start = np.cumsum(size) - size
    power = np.ones(int(size.max(initial=0)) + 2, np.uint64)
    np.multiply.accumulate(np.full(len(power) - 1, STEP, np.uint64), out=power[1:])
    # prefix sums of letter * STEP^place give a substring's hash up to a power of STEP
    place = np.arange(len(letter)) - np.repeat(start, size)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_mix(letter.astype(np.uint64)) * power[place], dtype=np.uint64)]
    keys = []
    for l in (size, size - 1):
        half = l // 2
        first = sums[start + half] - sums[start]
        # scaled to the highest power, so that equal suffixes of words of any length agree
        from_ = size - (l - half)
        last = sums[start + size] - sums[start + from_]
        keys += [_mix(first + _mix(2 * l.astype(np.uint64) + STEP)), _mix(_unshift(last, from_) + _mix((2 * l + 1).astype(np.uint64) + STEP))]
    return np.stack(keys), sums, start


#: Inverse of STEP modulo 2^64 (STEP is odd), to shift a hash to place 0.
_INVERSE = pow(int(STEP), -1, 1 << 64)


def _unshift(value: np.ndarray, places: np.ndarray) -> np.ndarray:
    most = int(places.max(initial=0)) + 1
    power = np.ones(most + 1, np.uint64)
    np.multiply.accumulate(np.full(most, _INVERSE, np.uint64), out=power[1:])
    return value * power[places]


def one_edit(a: str, b: str) -> bool:
    """Whether a and b differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def near_pairs(words: list[str], group: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs of near words that have one ``group`` value (uint64)."""
    if len(words) < 2:
        return []
    keys, sums, start = _halves(words)
    size = np.diff(np.r_[start, len(sums) - 1])
    found = set()
    for key in (np.concatenate([keys[0], keys[2]]), np.concatenate([keys[1], keys[3]])):
        who = np.tile(np.arange(len(words)), 2)
        key = _mix(key ^ np.tile(_mix(group), 2))
        order = np.argsort(key, kind="stable")
        key, who = key[order], who[order]
        at, apart = np.arange(len(key)), 0
        while len(at):  # entries and those ``apart`` behind them, while the key lasts
            apart += 1
            at = at[at < len(key) - apart]
            at = at[key[at] == key[at + apart]]
            x, y = who[at], who[at + apart]
            likely = (np.abs(size[x] - size[y]) <= 1) & (x != y) & (group[x] == group[y])
            x, y = x[likely], y[likely]
            # one edit: common prefix and suffix cover all but one place
            likely = _shared(sums, start, size, x, y) >= np.maximum(size[x], size[y]) - 1
            found.update((min(i, j), max(i, j)) for i, j in zip(x[likely].tolist(), y[likely].tolist()))
    return [(i, j) for i, j in sorted(found) if one_edit(words[i], words[j])]


def _shared(sums, start, size, x, y):
    """Common prefix plus common suffix of each two words, at most the shorter
    length, by binary search over prefix hashes; never less than the truth."""
    least = np.minimum(size[x], size[y])

    def longest(equal):
        low, high = np.zeros(len(x), np.int64), least + 1
        while True:
            open_ = high - low > 1
            if not open_.any():
                return low
            middle = (low + high) // 2
            same = equal(np.where(open_, middle, 0))
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle, high)

    prefix = longest(lambda k: sums[start[x] + k] - sums[start[x]] == sums[start[y] + k] - sums[start[y]])

    def suffix_hash(w, k):
        return _unshift(sums[start[w] + size[w]] - sums[start[w] + size[w] - k], size[w] - k)

    suffix = longest(lambda k: suffix_hash(x, k) == suffix_hash(y, k))
    return np.minimum(prefix + suffix, least)


def _near(rows: DataFrame, sign: Signatures, limit: int | None) -> DataFrame:
    """(word, near, n, key) of the near pairs, in both directions, among rows
    (key, which, word, n) with one key; n is the count of ``near``.  Rows of a key
    with more than ``limit`` come back with a null ``near`` instead."""
    rows = rows.select("key", "which", "word", "n").repartition("key").sortWithinPartitions("key")

    def run(batches):
        held, size, over = [], 0, None
        for b in batches:
            if over is not None:  # the rest of a key that is passed on
                rest = int(np.searchsorted((b.column("key").to_numpy() != over).astype(np.int8), 1))
                yield passed(b.slice(0, rest))
                b = b.slice(rest)
                if not b.num_rows:
                    continue
                over = None
            held.append(b)
            size += b.num_rows
            if size < ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield verified(table.slice(0, cut))
                table = table.slice(cut)
            held, size = table.to_batches(), table.num_rows
            if limit is not None and size > limit:
                over = key[-1]
                for part in held:
                    yield passed(part)
                held, size = [], 0
        if size:
            yield verified(pa.Table.from_batches(held))

    def passed(b):
        none = pa.nulls(b.num_rows, pa.string())
        return pa.RecordBatch.from_arrays([b.column("word"), none, b.column("n"), b.column("key"), b.column("which")], names=names)

    def verified(table):
        table = table.combine_chunks()
        key = table.column("key").to_numpy()
        change = np.r_[True, np.diff(key) != 0, True]
        several = ~(change[1:] & change[:-1])
        table = table.filter(pa.array(several))
        words, n = table.column("word").to_pylist(), table.column("n").to_pylist()
        which = table.column("which").to_numpy()
        pairs = near_pairs(words, table.column("key").to_numpy().view(np.uint64))
        if pairs:
            pairs = np.array(pairs)
            used, at = np.unique(pairs, return_inverse=True)
            at = at.reshape(-1, 2)
            own = sign.parts([words[i] for i in used.tolist()])
            same = own[at[:, 0]] == own[at[:, 1]]
            # the first signature that the pair shares reports it
            first = np.argmax(np.stack([same[:, list(c)].all(axis=1) for c in CHOSEN]), axis=0)
            pairs = pairs[first == which[pairs[:, 0]]].tolist()
        both = [p for i, j in pairs for p in ((i, j), (j, i))]
        columns = [[words[i] for i, _ in both], [words[j] for _, j in both], [n[j] for _, j in both]]
        none = [pa.nulls(len(both), pa.int64()), pa.nulls(len(both), pa.int32())]
        types = [pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types)), *none], names=names)

    names = ["word", "near", "n", "key", "which"]
    return rows.mapInArrow(run, "word string, near string, n bigint, key bigint, which int")


def _signed(vocabulary: DataFrame, sign: Signatures) -> DataFrame:
    """(key, which, word, n): every word under each of its signatures."""

    def run(batches):
        for b in batches:
            keys = sign.all(b.column("word").to_pylist())
            at = pa.array(np.repeat(np.arange(b.num_rows), len(CHOSEN)))
            which = pa.array(np.tile(np.arange(len(CHOSEN), dtype=np.int32), b.num_rows))
            columns = [pa.array(keys.ravel()), which, b.column("word").take(at), b.column("n").take(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "which", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(run, "key bigint, which int, word string, n bigint")


def _refined(rows: DataFrame) -> DataFrame:
    """Rows (key, which, word, n) under key, length and half together.  A pair whose
    halves agree at both ends comes back twice."""

    def run(batches):
        for b in batches:
            keys = _halves(b.column("word").to_pylist())[0]
            group = _mix(b.column("key").to_numpy().view(np.uint64))
            for k in keys:
                key = pa.array(_mix(k ^ group).view(np.int64))
                yield pa.RecordBatch.from_arrays([key, b.column("which"), b.column("word"), b.column("n")], names=["key", "which", "word", "n"])

    return rows.select("key", "which", "word", "n").mapInArrow(run, "key bigint, which int, word string, n bigint")


def near_words(vocabulary: DataFrame, limit: int = GROUP) -> DataFrame:
    """(word, n_near, best, best_n) of each word of ``vocabulary`` (word, n; words
    unique) that has a near word; best is the one of largest count."""
    sign = Signatures(dealt_parts(vocabulary))
    found = written(_near(_signed(vocabulary, sign), sign, limit), "spelling-near")
    pairs = found.where("near is not null").select("word", "near", "n")
    large = found.where("near is null")
    if not large.isEmpty():
        again = _near(_refined(large), sign, None).select("word", "near", "n")
        pairs = pairs.union(again.distinct())
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("near").alias("near"))).alias("best")
    return pairs.groupBy("word").agg(F.count("*").alias("n_near"), best).select(
        "word", "n_near", F.col("best.near").alias("best"), (-F.col("best.m")).alias("best_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word of ``forms`` (word, form; no cycles): the last one
    reached.  Pointers are doubled; words that are at their root move no more."""
    done, open_ = [], written(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        every = reduce(DataFrame.union, done, open_).select(F.col("word").alias("root"), F.col("root").alias("next"))
        last = F.col("next").isNull().alias("last")
        moved = written(open_.join(every, "root", "left").select("word", F.coalesce("next", "root").alias("root"), last), "spelling-roots")
        done.append(moved.where("last").select("word", "root"))
        open_ = moved.where("not last").select("word", "root")
        if open_.isEmpty():
            return reduce(DataFrame.union, done)


def spelling_variants(docs: DataFrame, id: str = "doc_id", text: str = "text", vary: int | None = None, shortest: int = 5, least: int = 3, limit: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per frequent word."""
    vocabulary = written(count_words(docs, id, text, vary, shortest, least), "spelling-words")
    near = written(near_words(vocabulary, limit), "spelling-best")
    known = vocabulary.join(near, "word", "left")
    is_form = F.col("best_n") >= RATIO * F.col("n")
    known = known.select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    known = written(known, "spelling-known")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
