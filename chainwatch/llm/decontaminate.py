"""Benchmark decontamination: BM25 inverted index with block-max WAND.

The test items are the indexed side; every passage of every training document
is a query.  A posting's impact is its BM25 weight divided by the item's score
against its own text, so one threshold fits items of any length.  Items stand
in blocks, and a term's largest impact in each block bounds what it can add.

For a chunk of documents the bounds of all passages and blocks are summed in
numpy; passages without a block that reaches the threshold are done.  The others
run block-max WAND over the posting lists: the pivot is the first item whose
preceding terms' largest impacts reach the threshold, blocks whose bound does
not are skipped, and what is left is scored.  All items above the threshold are
returned, and each is verified: the share of its five-word shingles that the
passage holds must reach ``OVERLAP``; of an item with a question and an answer
column, the question's and the answer's share must both.

Passages are two neighbouring pieces of as many words as the longest item, so
each place of an item's length lies whole in one passage.  The index goes to the
tasks in shards of at most ``SHARD_ITEMS`` items and ``SHARD_BYTES`` of text.
Document frequencies, their number and the lengths are those of all items, so
scores and passages do not depend on the shards.  One shard is scanned without a
shuffle; of more, each one's matches are written before the next is built, and
then joined to the documents by a digest of the text.

Defined cases: null or empty documents match nothing; items without words are
left out; items with equal texts are all reported; without a question and an
answer column an item is one part, whose share stands for both overlaps;
shorter parts are one shingle; rows are independent, other columns pass
through."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainwatch.llm._common import HOT, joined, text_slices, unused, with_text_columns, written

#: BM25's usual parameters.
K1, B = 1.2, 0.75
#: Part of an item's own score that a passage must reach; share of its shingles.
THRESHOLD, OVERLAP, SHINGLE = 0.6, 0.8, 5
#: Blocks of an index, at most, and fewest words of half a passage.
BLOCKS, LEAST_WORDS = 64, 64
SHARD_ITEMS, SHARD_BYTES = 10_000, 8 << 20

MATCHES = "array<struct<item_id:bigint,bm25:double,question_overlap:double,answer_overlap:double,first_word:bigint,last_word:bigint>>"


def _byte_map() -> bytes:
    """ASCII letters and digits in lower case, and bytes beyond ASCII; else spaces."""
    return bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None, table: bytes) -> list[bytes]:
    return (text or "").encode().translate(table).split()


def _shingles(words: list) -> set[tuple]:
    n = min(len(words), SHINGLE)
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class ItemIndex:
    """Inverted index of items: (id, question words, answer words), or (id, words,
    None) for items that are one part.  ``whole`` has the number of all items, of
    their words, the longest one's words and {term: items}, if these are a shard."""

    def __init__(self, items: list[tuple[int, list[bytes], list[bytes] | None]], threshold: float = THRESHOLD, whole: tuple | None = None):
        self.threshold = threshold
        self.items = [x for x in items if x[1] or x[2]]
        n = len(self.items)
        words = [q + (a or []) for _, q, a in self.items]
        counts = [{} for _ in words]
        for c, w in zip(counts, words):
            for t in w:
                c[t] = c.get(t, 0) + 1
        df: dict[bytes, int] = {}
        for c in counts:
            for t in c:
                df[t] = df.get(t, 0) + 1
        self.terms = {t: i for i, t in enumerate(sorted(df))}
        size = list(map(len, words))
        number, total, longest, df = whole or (n, sum(size), max(size, default=0), df)
        self.half = max(LEAST_WORDS, longest)
        mean = total / max(number, 1)
        self.per_block = max(1, -(-n // BLOCKS))
        self.postings: list[tuple[list[int], list[float]]] = [([], []) for _ in self.terms]
        self.block_max = np.zeros((len(self.terms), max(1, -(-n // self.per_block))), np.float32)
        for i, (c, w) in enumerate(zip(counts, words)):
            norm = K1 * (1 - B + B * len(w) / mean)
            weight = {t: np.log(1 + (number - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + norm) for t, f in c.items()}
            own = sum(weight.values())
            for t, v in weight.items():
                at, impact = self.terms[t], v / own
                self.postings[at][0].append(i)
                self.postings[at][1].append(impact)
                block = i // self.per_block
                # bounds are rounded up, so that float32 never hides an item
                self.block_max[at, block] = max(self.block_max[at, block], np.float32(impact * 1.000001))
        self.most = self.block_max.max(axis=1) if n else np.zeros(0, np.float32)
        self.parts = [[_shingles(x) for x in parts if x is not None] for _, *parts in self.items]

    # -- retrieval

    def candidates(self, ids: np.ndarray, piece: np.ndarray, pieces: int) -> list[int]:
        """Pieces k for which the passage of k and k + 1 may reach the threshold;
        ids: term of each known word, piece: the piece it stands in."""
        if not len(ids):
            return []
        width = len(self.terms)
        key = np.unique(piece * width + ids)
        piece, ids = key // width, key % width
        bound = np.zeros((pieces + 1, self.block_max.shape[1]), np.float32)
        start = np.flatnonzero(np.r_[True, np.diff(piece) > 0])
        step = max(1, (1 << 22) // self.block_max.shape[1])  # rows gathered at a time
        cut = [0]
        for s in start[1:]:
            if s - cut[-1] >= step:
                cut.append(int(s))
        for a, b in zip(cut, [*cut[1:], len(ids)]):
            mine = start[(start >= a) & (start < b)]
            bound[piece[mine]] = np.add.reduceat(self.block_max[ids[a:b]], mine - a, axis=0)
        both = bound[:-1] + bound[1:]
        return np.flatnonzero(both.max(axis=1) >= self.threshold).tolist()

    def search(self, terms: set[int]) -> list[tuple[int, float]]:
        """(item, score) of all items whose score reaches the threshold."""
        terms = sorted(terms)
        bound = self.block_max[terms].sum(axis=0)
        live = np.flatnonzero(bound >= self.threshold).tolist()
        if not live:
            return []
        end = len(self.items)
        cursors = [[self.postings[t][0], self.postings[t][1], 0, float(self.most[t])] for t in terms]
        found = []

        def item(c):
            return c[0][c[2]] if c[2] < len(c[0]) else end

        while True:
            cursors.sort(key=item)
            total, pivot = 0.0, end
            for c in cursors:
                total += c[3]
                if total >= self.threshold:
                    pivot = item(c)
                    break
            if pivot == end:
                return found
            block = pivot // self.per_block
            at = bisect_left(live, block)
            if at == len(live):
                return found
            if live[at] != block:  # no item of this block can reach the threshold
                goal = live[at] * self.per_block
            elif item(cursors[0]) == pivot:
                impacts = []
                for c in cursors:
                    if item(c) != pivot:
                        break
                    impacts.append(c[1][c[2]])
                    c[2] += 1
                score = fsum(impacts)  # the same in any order of the cursors
                if score >= self.threshold - 1e-9:
                    found.append((pivot, score))
                continue
            else:
                goal = pivot
            for c in cursors:
                if item(c) >= goal:
                    break
                c[2] = bisect_left(c[0], goal, c[2])

    # -- whole documents

    def matches(self, texts: list[list[bytes]]) -> list[list[tuple]]:
        """For each text's words: (item id, score, overlaps, first and last word)."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        pieces = np.maximum(1, -(-size // self.half))
        first = np.r_[0, np.cumsum(pieces + 1)[:-1]]  # an empty piece after each text
        get = self.terms.get
        ids = np.fromiter((get(w, -1) for words in texts for w in words), np.int64, int(size.sum()))
        place = np.arange(len(ids)) - np.repeat(np.r_[0, np.cumsum(size)[:-1]], size)
        piece = np.repeat(first, size) + place // self.half
        known = ids >= 0
        out: list[list[tuple]] = [[] for _ in texts]
        for k in self.candidates(ids[known], piece[known], int((pieces + 1).sum())):
            doc = int(np.searchsorted(first, k, side="right")) - 1
            begin = (k - int(first[doc])) * self.half
            words = texts[doc][begin : begin + 2 * self.half]
            hits = self.search({get(w) for w in words} - {None})
            if not hits:
                continue
            held: dict[tuple, int] = {}
            for n in {min(SHINGLE, len(x)) for i, _ in hits for x in self.items[i][1:] if x}:
                for i in range(len(words) - n + 1):
                    held.setdefault(tuple(words[i : i + n]), i)
            for i, score in hits:
                shares = [len(p & held.keys()) / len(p) if p else 1.0 for p in self.parts[i]]
                if min(shares) >= OVERLAP:
                    at = [(held[s], held[s] + len(s) - 1) for p in self.parts[i] for s in p if s in held]
                    row = (self.items[i][0], score, shares[0], shares[-1], begin + min(x for x, _ in at), begin + max(y for _, y in at))
                    out[doc].append(row)
        return [_best(rows) for rows in out]


def _best(rows: list[tuple]) -> list[tuple]:
    """One row per item: the one with the highest score, then the first place."""
    best: dict = {}
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0], -r[1], r[4])):
        best.setdefault(r[0], r)
    return list(best.values())


def _items(benchmark: DataFrame, id: str, text: str, question: str | None, answer: str | None) -> DataFrame:
    """(row, id, q, a) of the items that have words; q and a: their words, a is
    null for items that are one part."""
    one = F.lit(None).cast("string")
    rows = benchmark.select(F.col(id).cast("bigint").alias("id"), F.col(question or text).alias("q"), (F.col(answer) if question else one).alias("a"))

    def run(batches):
        table, kind = _byte_map(), pa.list_(pa.binary())
        for whole in batches:
            for b in text_slices(whole, "q"):
                q, a = ([terms_of(t, table) for t in b.column(c).to_pylist()] for c in ("q", "a"))
                a = pa.array(a if question else [None] * len(q), kind)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(q, kind), a], names=["id", "q", "a"])

    items = rows.mapInArrow(run, "id bigint, q array<binary>, a array<binary>")
    return written(items.where(_words() > 0).withColumn("row", F.monotonically_increasing_id()), "decontaminate-items")


def _words():
    return F.size("q") + F.coalesce(F.array_size("a"), F.lit(0))


def item_shards(
    benchmark: DataFrame, id: str = "item_id", text: str = "text", question: str | None = None, answer: str | None = None
) -> Iterator[tuple[ItemIndex, bool]]:
    """Indexes of the items, in shards of bounded size; and whether each is the last."""
    items = _items(benchmark, id, text, question, answer)
    n, total, longest = items.select(_words().alias("w")).agg(F.count("*"), F.sum("w"), F.max("w")).first()
    empty = F.array().cast("array<binary>")
    terms = items.select("row", F.explode(F.array_distinct(F.concat("q", F.coalesce("a", empty)))).alias("term"))
    counts = written(terms.groupBy("term").agg(F.count("*").alias("n")), "decontaminate-terms")
    known = joined(terms, counts, ["term"], F.col("n") > n / HOT).groupBy("row").agg(F.collect_list(F.struct("term", "n")).alias("known"))
    held, size, df, seen = [], 0, {}, 0
    for r in items.join(known, "row").orderBy("id", "row").toLocalIterator():
        held.append((r.id, list(map(bytes, r.q)), None if r.a is None else list(map(bytes, r.a))))
        df.update((bytes(x.term), x.n) for x in r.known)
        size += sum(map(len, r.q)) + sum(map(len, r.a or []))
        seen += 1
        if len(held) >= SHARD_ITEMS or size >= SHARD_BYTES or seen == n:
            yield ItemIndex(held, whole=(n, total, longest, df)), seen == n
            held, size, df = [], 0, {}


def find_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "matches", **columns) -> DataFrame:
    """Append the verified matches of every document, an array of item_id, bm25,
    question_overlap, answer_overlap, first_word and last_word."""
    kind = T._parse_datatype_string(MATCHES)
    base = docs.withColumn(out, F.array().cast(kind))
    parts = []
    for shard, last in item_shards(benchmark, **columns):
        if last and not parts:
            return _scan(base, shard, text, out, kind)
        found = _scan(docs.select(F.col(text).alias("t"), F.array().cast(kind).alias("m")), shard, "t", "m", kind)
        parts.append(written(found.select(F.sha2("t", 256).alias("key"), F.explode("m").alias("m")), "decontaminate-matches"))
    if not parts:
        return base
    # equal texts have equal matches; an item's best row as in _best
    best = F.max_by("m", F.struct("m.bm25", -F.col("m.first_word")))
    found = reduce(DataFrame.union, parts).groupBy("key", "m.item_id").agg(best.alias("m"))
    key, new = unused(base, "key"), unused(base, "found")
    ordered = F.array_sort(F.collect_list(F.struct(F.col("m.item_id").isNull().alias("last"), "m")))
    found = found.groupBy(F.col("key").alias(key)).agg(F.transform(ordered, lambda x: x["m"]).alias(new))
    more = base.withColumn(key, F.sha2(text, 256)).join(found, key, "left")
    return more.withColumn(out, F.coalesce(new, out)).select(base.columns)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **columns) -> DataFrame:
    """The documents without a verified match, with their columns."""
    out = unused(docs, "matches")
    return find_matches(docs, benchmark, text, out, **columns).where(F.size(out) == 0).select(docs.columns)


def _scan(docs: DataFrame, index: ItemIndex, text: str, out: str, kind) -> DataFrame:
    table = _byte_map()
    names = [f.name for f in kind.elementType.fields]

    def make():
        def compute(texts):
            found = index.matches([terms_of(t, table) for t in texts])
            return [[[dict(zip(names, m)) for m in rows] for rows in found]]

        return compute

    new = unused(docs, "found")
    more = with_text_columns(docs, text, make, [T.StructField(new, kind, False)])
    return more.withColumn(out, F.concat(out, new)).drop(new)
