"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed byte trigrams of letters; a uniform
background explains what no language does.  For every document expectation-
maximisation estimates the proportions of the languages; sets of the largest
one, two, ... languages are refitted and the set with the best penalised
likelihood is chosen.  All documents of a chunk are fitted together in numpy;
nothing is shuffled.

The distributions are learned from a bounded sample: about ``SAMPLE`` labelled
documents of each language, chosen by a hash of the id; or from all of them, if
``fit`` is called with ``sample=None``.

Defined cases: a null text, or one without a letter, is ``und`` with score 0,
as is every text if no labelled document exists; other rows always get a
learned language; ``rejected`` marks ``und`` and texts that the background
alone explains better than any language; rows are independent, other columns
pass through."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainwatch.llm._common import text_slices, vector_sums, with_text_columns

#: Labelled documents of each language to learn from, about.
SAMPLE = 400
#: Hash buckets of trigrams; pseudo-count of each.
BUCKETS, ALPHA = 1 << 16, 0.05
#: EM steps for all languages, and for each refitted set.
STEPS, REFIT = 12, 6
#: The proportion from which a language may join a set.
LEAST_SHARE = 0.02
UNKNOWN = "und"


def _byte_map() -> bytes:
    """Lower-case letters and bytes beyond ASCII stay; all else becomes a space."""
    return bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


class Trigrams:
    """Hashed trigram counts of texts."""

    def __init__(self):
        self.map = _byte_map()

    def _codes(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The texts' bytes, at which of them (but the first and last) a trigram
        has its middle, and the buckets of those trigrams."""
        data = [b" " + t.encode().translate(self.map) + b" " for t in texts]
        whole = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
        mid = whole[1:-1]
        code = (whole[:-2] << np.uint32(16)) | (mid << np.uint32(8)) | whole[2:]
        code = (code * np.uint32(2654435761)) >> np.uint32(16)
        inside = mid != 32  # a space ends every text, so no such trigram spans two
        return data, inside, code[inside]

    def total(self, texts: list[str]) -> np.ndarray:
        """Counts by bucket over all the texts."""
        return np.bincount(self._codes(texts)[2], minlength=BUCKETS)

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, bucket, count), ordered by document."""
        data, inside, code = self._codes(texts)
        size = np.fromiter(map(len, data), np.int64, len(data))
        doc = np.repeat(np.arange(len(data), dtype=np.uint64), size)
        key = (doc[1:-1][inside] << np.uint64(16)) | code
        key.sort()
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.r_[start, len(key)])
        key = key[start]
        return (key >> np.uint64(16)).astype(np.int64), (key & np.uint64(BUCKETS - 1)).astype(np.int64), count


class LanguageModel:
    """Languages and, for each bucket, its probability in every language and
    (last column) the background."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        made = [(c + ALPHA) / (c.sum() + ALPHA * BUCKETS) for c in (counts[x] for x in self.languages)]
        self.p = np.stack([*made, np.full(BUCKETS, 1 / BUCKETS)], axis=1).astype(np.float32)
        self.trigrams = Trigrams()
        self.letter = r"\p{L}"

    def best(self, texts: list[str | None]) -> np.ndarray:
        """Index of the most likely single language of each text, -1 for none."""
        return self._single(*self.trigrams.counts([t or "" for t in texts]), len(texts))[0]

    def _single(self, doc, bucket, count, n):
        total = np.zeros((n, self.p.shape[1]))
        if len(doc):
            start = np.flatnonzero(np.r_[True, np.diff(doc) > 0])
            total[doc[start]] = np.add.reduceat(np.log(self.p)[bucket] * count[:, None].astype(np.float32), start, axis=0)
        has = np.bincount(doc, minlength=n) > 0
        top = total[:, :-1].argmax(axis=1) if self.languages else np.zeros(n, np.int64)
        return np.where(has & bool(self.languages), top, -1), total

    def _em(self, p, weight, start, share, steps):
        """Proportions after some EM steps, and the log-likelihood of the last
        proportions but one; rows of ``share`` are documents."""
        size = np.diff(np.r_[start, len(p)])
        n = np.add.reduceat(weight, start)
        for _ in range(steps):
            mixed = p * np.repeat(share, size, axis=0)
            total = mixed.sum(axis=1)
            mixed *= (weight / total)[:, None]
            share = np.add.reduceat(mixed, start, axis=0) / n[:, None]
        return share, np.add.reduceat(np.log(total) * weight, start)

    def infer(self, texts: list[str | None]):
        """(language or und, score, {language: proportion}, rejected) of each text."""
        n, k = len(texts), len(self.languages)
        out = [(UNKNOWN, 0.0, {}, True)] * n
        letter = regex.compile(self.letter)
        some = [i for i, t in enumerate(texts) if t and letter.search(t)]
        if not some or not k:
            return out
        doc, bucket, count = self.trigrams.counts([texts[i] for i in some])
        start = np.flatnonzero(np.r_[True, np.diff(doc) > 0])
        p, weight = self.p[bucket], count.astype(np.float32)
        size = np.diff(np.r_[start, len(doc)])
        total = np.add.reduceat(weight, start)
        share, _ = self._em(p, weight, start, np.full((len(some), k + 1), 1 / (k + 1), np.float32), STEPS)
        order = np.argsort(-share[:, :k], axis=1, kind="stable")
        best = np.full(len(some), np.inf)
        chosen = np.zeros_like(share)
        for m in range(1, k + 1):
            # the set of the m largest; beyond one only where its last has a share
            rows = np.flatnonzero(np.take_along_axis(share, order[:, m - 1 : m], 1)[:, 0] >= (LEAST_SHARE if m > 1 else 0))
            if not len(rows):
                break
            first = np.zeros((len(rows), k + 1), np.float32)
            np.put_along_axis(first, order[rows, :m], 1.0, axis=1)
            first[:, k] = 0.1
            first /= first.sum(axis=1, keepdims=True)
            part = np.concatenate([np.arange(start[r], start[r] + size[r]) for r in rows]) if len(rows) < len(some) else slice(None)
            begin = np.r_[0, np.cumsum(size[rows])[:-1]]
            fitted, fit = self._em(p[part], weight[part], begin, first, REFIT)
            cost = -fit + 0.5 * (m + 1) * np.log(total[rows] + 1)
            better = cost < best[rows]
            best[rows[better]] = cost[better]
            chosen[rows[better]] = fitted[better]
        background = total * np.log(BUCKETS)
        known = chosen[:, :k] / np.maximum(chosen[:, :k].sum(axis=1, keepdims=True), 1e-9)
        top = known.argmax(axis=1)
        for at, i in enumerate(some):
            parts = {self.languages[j]: float(known[at, j]) for j in np.flatnonzero(known[at] > 0.005)}
            out[i] = (self.languages[top[at]], float(known[at, top[at]]), parts, bool(best[at] > background[at]))
        return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", sample: int | None = SAMPLE) -> LanguageModel:
    """Learn from about ``sample`` documents of each non-null language, from all if it is None."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(id).alias("id"))
    if sample is None:
        chosen = rows.select("lang", "text")
    else:
        sizes = rows.groupBy("lang").count()
        place = F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1 << 20))
        # one row per language
        chosen = rows.join(F.broadcast(sizes), "lang").where(place * F.col("count") < sample * (1 << 20)).select("lang", "text").repartition(8)

    def run(batches):
        trigrams, held = Trigrams(), {}
        for whole in batches:
            for b in text_slices(whole, "text"):
                langs, texts = b.column("lang").to_pylist(), b.column("text").to_pylist()
                for x in set(langs):
                    held[x] = held.get(x, 0) + trigrams.total([t for t, y in zip(texts, langs) if y == x])
        columns = [pa.array(list(held), pa.string()), pa.array([v.astype("<f8").tobytes() for v in held.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "vector"])

    sums = vector_sums(chosen.mapInArrow(run, "lang string, vector binary"), "lang").collect()
    return LanguageModel({r.lang: np.frombuffer(r.vector) for r in sums})


FIELDS = [
    T.StructField("lang_pred", T.StringType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("proportions", T.MapType(T.StringType(), T.DoubleType()), False),
    T.StructField("rejected", T.BooleanType(), False),
]


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", prefix: str = "") -> DataFrame:
    """Append lang_pred, score, proportions and rejected, their names after ``prefix``."""

    def make():
        def compute(texts):
            found = model.infer(texts)
            parts = pa.array([list(x[2].items()) for x in found], pa.map_(pa.string(), pa.float64()))
            return [x[0] for x in found], [x[1] for x in found], parts, [x[3] for x in found]

        return compute

    return with_text_columns(docs, text, make, [T.StructField(prefix + f.name, f.dataType, False) for f in FIELDS])


def drop_rejected(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The documents whose language is told, with their columns."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    return identify(docs, model, text, prefix).where(f"not {prefix}rejected").select(docs.columns)
