"""Toxicity by a convolutional text classifier trained in numpy.

A word's embedding is the sum of three hashed ones: of the word, of its first
four and of its last four letters.  Filters of widths 1, 2 and 3 run over the
whole text, each keeps its maximum, and a logistic layer scores the maxima.
For scoring the embedding table is multiplied with the filters once, so that a
word costs one row look-up.  The logit threshold is calibrated for each
language, which is told from the text by the trigram model of ``langid``; the
score is shifted so that it stands at 0.5.

The model and the thresholds are learned from every labelled document.  Their
word ids are dealt by id to shards of about ``SHARD_ROWS``; in each epoch a task trains a
copy of the model on its shard, and the copies are averaged by a shuffle, an
embedding over the shards that changed it.  The thresholds are exact over the
logits of all those documents.  Every document is then scored in its own task,
without a shuffle.

Defined cases: null and empty texts have no words and are scored from the bias;
null labels are not learned from; a class without labelled documents gives the
other class to all; rows are independent; other columns pass through."""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainwatch.llm import langid
from chainwatch.llm._common import text_slices, vector_sums, with_text_columns, written

#: Labelled documents of a shard, about; documents of a training step.
SHARD_ROWS, STEP_ROWS = 16_384, 16
#: Embedding buckets and dimensions, filter widths, filters of each width.
BUCKETS, DIMENSIONS, WIDTHS, FILTERS = 1 << 16, 12, (1, 2, 3), 6
EPOCHS, RATE, SEED = 8, 0.08, 7
#: Part of a text's words that a training step sees, so that no word can hide behind another.
KEPT = 0.5
#: Rows of each class that a language needs for its own threshold; the key of all languages' one.
LEAST_ROWS, ALL = 15, -2
#: Equal parts of the range of logits in which thresholds are looked for.
BINS = 4_096
#: Most flags of the bitmap of labelled ids (8 MB).
BITS = 1 << 26
#: Embeddings averaged in one row.
BLOCK_ROWS = 1_024
#: Words whose projections a worker remembers, and words projected at a time.
CACHE_WORDS, BLOCK_WORDS = 150_000, 100_000


def _byte_map() -> bytes:
    return bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def word_buckets(word: bytes) -> tuple[int, int, int]:
    h = xxhash.xxh3_64_intdigest
    text = word.decode("utf-8", "replace")
    return h(word) % BUCKETS, h("<" + text[:4]) % BUCKETS, h(text[-4:] + ">") % BUCKETS


def split_words(text: str | None, table: bytes) -> list[bytes]:
    return (text or "").encode().translate(table).split()


class TextCNN:
    """Weights, training and scoring."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        self.embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
        self.filters = [rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)
        # sums of squared gradients (Adagrad), of an embedding their mean
        self.seen_embed = np.full(BUCKETS, 0.1, np.float32)
        self.seen_filters = [np.full_like(f, 0.1) for f in self.filters]
        self.seen_out = np.full_like(self.out, 0.1)
        self.thresholds: dict[int, float] = {}
        self.threshold = 0.0

    # -- one document, plainly

    def _forward(self, ids: np.ndarray):
        x = self.embed[ids].sum(axis=1) if len(ids) else np.zeros((0, DIMENSIONS), np.float32)
        pooled, at = [], []
        for w, weights, bias in zip(WIDTHS, self.filters, self.bias):
            if len(x) < w:
                pooled.append(np.zeros(FILTERS, np.float32))
                at.append(None)
                continue
            a = sum(x[j : len(x) - w + 1 + j] @ weights[j] for j in range(w)) + bias
            best = a.argmax(axis=0)
            pooled.append(np.maximum(a[best, np.arange(FILTERS)], 0))
            at.append(best)
        pooled = np.concatenate(pooled)
        return x, pooled, at, float(pooled @ self.out + self.out_bias[0])

    # -- training, some documents at a time; only the maxima's windows have gradients

    def maxima(self, ids: np.ndarray, size: np.ndarray):
        """Word embeddings, pooled maxima and their places for documents of
        ``size`` words, which stand one after the other in ``ids``."""
        x = self.embed.take(ids[:, 0], axis=0)
        x += self.embed.take(ids[:, 1], axis=0)
        x += self.embed.take(ids[:, 2], axis=0)
        pooled = np.zeros((len(size), FILTERS * len(WIDTHS)), np.float32)
        at = np.zeros(pooled.shape, np.int64)
        some = np.flatnonzero(size)
        if len(some):
            pooled[some], at[some] = _window_maxima(x @ self.by_place(), size[some], self.bias, places=True)
        return x, pooled, at

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.out + self.out_bias[0]

    def step(self, ids: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray, touched: np.ndarray) -> None:
        """Adagrad on the logistic loss; counts the gradients of each embedding in ``touched``."""
        ids = ids.astype(np.intp)
        x, pooled, at = self.maxima(ids, size)
        z = self.logits(pooled)
        g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight[y]).astype(np.float32)
        g[np.abs(g) < 1e-3] = 0
        if not g.any():
            return
        back = g[:, None] * self.out * (pooled > 0)
        grad = g @ pooled
        self.seen_out += grad**2
        self.out -= RATE * grad / np.sqrt(self.seen_out)
        self.out_bias -= 0.02 * RATE * g.sum()
        rows, grads = [], []
        for k, w in enumerate(WIDTHS):
            mine = back[:, k * FILTERS : (k + 1) * FILTERS]
            doc, col = np.nonzero(mine)
            if not len(doc):
                continue
            d, p = mine[doc, col], at[doc, k * FILTERS + col]
            of_filter = np.zeros((len(d), FILTERS), np.float32)
            of_filter[np.arange(len(d)), col] = d
            for j in range(w):
                to_word = d[:, None] * self.filters[k][j][:, col].T
                to_filter = x[p + j].T @ of_filter
                self.seen_filters[k][j] += to_filter**2
                self.filters[k][j] -= RATE * to_filter / np.sqrt(self.seen_filters[k][j])
                for part in ids[p + j].T:
                    rows.append(part)
                    grads.append(to_word)
            self.bias[k] -= 0.02 * RATE * mine.sum(axis=0)
        if rows:
            rows, grads = np.concatenate(rows), np.concatenate(grads)
            np.add.at(self.seen_embed, rows, (grads**2).mean(axis=1))
            np.add.at(touched, rows, np.float32(1))
            moves = -RATE * grads / np.sqrt(self.seen_embed[rows])[:, None]
            np.add.at(self.embed.reshape(-1), (rows[:, None] * DIMENSIONS + np.arange(DIMENSIONS)).ravel(), moves.ravel())

    # -- averaging

    def _dense(self) -> list[np.ndarray]:
        return [*self.filters, *self.bias, self.out, self.out_bias, *self.seen_filters, self.seen_out]

    def parts(self, touched: np.ndarray, n: int) -> tuple[list[int], list[np.ndarray]]:
        """What ``merge`` needs, as vectors to be summed: embeddings by block,
        weighted by their gradients, and the rest, weighted by documents."""
        table = np.column_stack([self.embed, self.seen_embed, np.ones_like(touched)]) * touched[:, None]
        blocks = [b for b in range(0, BUCKETS, BLOCK_ROWS) if touched[b : b + BLOCK_ROWS].any()]
        rest = np.concatenate([v.ravel() for v in self._dense()] + [np.ones(1)]) * n
        return [-1, *blocks], [rest, *(table[b : b + BLOCK_ROWS].ravel() for b in blocks)]

    def merge(self, sums: dict[int, np.ndarray]) -> None:
        for block, v in sums.items():
            if block < 0:
                v, at = v[:-1] / v[-1], 0
                for mine in self._dense():
                    mine[...] = v[at : at + mine.size].reshape(mine.shape)
                    at += mine.size
                continue
            v = v.reshape(BLOCK_ROWS, -1)
            some = np.flatnonzero(v[:, -1])
            mean = v[some, :-1] / v[some, -1:]
            self.embed[block + some], self.seen_embed[block + some] = mean[:, :-1], mean[:, -1]

    # -- scoring

    def by_place(self) -> np.ndarray:
        """The filters' columns for the first place of a window, then those for the second, ..."""
        return np.concatenate([weights[j] for j in range(max(WIDTHS)) for weights in self.filters if j < len(weights)], axis=1)

    def projection(self) -> np.ndarray:
        """For each bucket, its part in every filter at every place of a window."""
        return self.embed @ self.by_place()

    def score(self, pooled: np.ndarray, languages: np.ndarray) -> np.ndarray:
        z = self.logits(pooled)
        t = np.array([self.thresholds.get(l, self.threshold) for l in languages.tolist()])
        return 1 / (1 + np.exp(-np.clip(z - t, -30, 30)))


def _window_maxima(x: np.ndarray, size: np.ndarray, bias: list[np.ndarray], places: bool = False):
    """Pooled maxima of documents of ``size`` words (none is 0), whose projected
    words are ``x``, and with ``places`` the first word of each one's window."""
    start = np.r_[0, np.cumsum(size)[:-1]]
    n = FILTERS * len(WIDTHS)
    a, at = x[:, :n].copy(), n
    for j in range(1, max(WIDTHS)):
        wider = FILTERS * sum(w <= j for w in WIDTHS)  # WIDTHS ascend
        a[: max(0, len(a) - j), wider:] += x[j:, at : at + n - wider]
        at += n - wider
    for j in range(1, max(WIDTHS)):  # windows that reach past the end of their text
        a[(start + size - j)[size >= j], FILTERS * sum(w <= j for w in WIDTHS) :] = -np.inf
    most = np.maximum.reduceat(a, start, axis=0)
    out = np.maximum(most + np.concatenate(bias), 0)
    if not places:
        return out
    row, col = np.divmod(np.flatnonzero(a == np.repeat(most, size, axis=0)), n)
    first = np.zeros(out.shape, np.int64)
    first[np.repeat(np.arange(len(size)), size)[row[::-1]], col[::-1]] = row[::-1]  # the last one written is the first place
    return out, first


def _threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The threshold with the fewest errors, in the middle of the gap that has
    it; ``thresholds`` finds the same for tables."""
    if not len(z) or y.min() == y.max():
        return 0.0
    order = np.argsort(z, kind="stable")
    z, y = z[order], y[order]
    # errors if everything from place i on counts as toxic
    clean = np.r_[0, np.cumsum(1 - y)]
    cost = np.r_[0, np.cumsum(y)] + clean[-1] - clean
    i = int(np.argmin(cost))
    low = z[i - 1] if i else z[0] - 1
    high = z[i] if i < len(z) else z[-1] + 1
    return float((low + high) / 2)


class Scorer:
    """Pooled filter maxima of whole texts, many documents at a time."""

    def __init__(self, model: TextCNN):
        self.model, self.table, self.map = model, model.projection(), _byte_map()
        self.known: dict[bytes, int] = {}
        self.rows = np.zeros((0, self.table.shape[1]), np.float32)

    def pooled(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), FILTERS * len(WIDTHS)), np.float32)
        split = [split_words(t, self.map) for t in texts]
        block, size = [], 0
        for i, words in enumerate(split):
            if words:
                block.append(i)
                size += len(words)
            if block and (size >= BLOCK_WORDS or i == len(split) - 1):
                self._block(split, block, out)
                block, size = [], 0
        return out

    def _block(self, split, block, out) -> None:
        words = [w for i in block for w in split[i]]
        if len(self.known) > CACHE_WORDS:
            self.known, self.rows = {}, self.rows[:0]
        new = list(set(words) - self.known.keys())
        if new:
            made = self.table[np.array([word_buckets(w) for w in new])].sum(axis=1)
            self.known.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.rows = np.concatenate([self.rows, made])
        x = self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]
        out[block] = _window_maxima(x, np.array([len(split[i]) for i in block]), self.model.bias)


def thresholds(rows: DataFrame) -> dict[int, float]:
    """For each language (and ALL), the logit threshold with the fewest errors,
    in the middle of the gap that has it, of rows (language, z, y).  Errors below
    a logit are counted by bin first, then inside each bin."""
    every = rows.select(F.explode(F.array("language", F.lit(ALL).cast("long"))).alias("language"), "z", "y")
    at = every.groupBy("language", "z").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
    ends = at.groupBy("language").agg(
        F.min("z").alias("low"), F.max("z").alias("high"), F.sum("toxic").alias("all_toxic"), F.sum("clean").alias("all_clean")
    )
    # one row per language
    ends = ends.where(F.least("all_toxic", "all_clean") >= F.when(F.col("language") == ALL, 1).otherwise(LEAST_ROWS))
    place = F.floor((F.col("z") - F.col("low")) / (F.col("high") - F.col("low")) * BINS)
    binned = at.join(F.broadcast(ends), "language").withColumn("bin", F.when(F.col("high") > F.col("low"), place).otherwise(0).cast("long"))
    before = Window.partitionBy("language").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy("language", "bin").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    bins = bins.select("language", "bin", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("toxic", "clean")))
    inside = Window.partitionBy("language", "bin").orderBy("z").rowsBetween(Window.unboundedPreceding, -1)
    toxic, clean = (F.col(f"{c}_before") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in ("toxic", "clean"))
    cuts = binned.join(bins, ["language", "bin"]).withColumn("errors", toxic + F.col("all_clean") - clean)
    best = cuts.groupBy("language").agg(F.min(F.struct("errors", "z")).alias("best"), F.first("all_toxic").alias("all_toxic"))
    # the cut is below z, or above all
    best = best.select("language", F.when(F.col("best.errors") <= F.col("all_toxic"), F.col("best.z")).alias("cut"))
    below = F.max(F.when(F.col("cut").isNull() | (F.col("z") < F.col("cut")), F.col("z"))).alias("below")
    found = at.join(F.broadcast(best), "language").groupBy("language").agg(below, F.first("cut").alias("cut")).collect()
    out = {}
    for r in found:
        low = r.cut - 1 if r.below is None else r.below
        out[r.language] = (low + (low + 1 if r.cut is None else r.cut)) / 2
    return out


def _documents(batch: pa.RecordBatch, order: np.ndarray):
    """(ids, size, y) of STEP_ROWS documents at a time, in that order."""
    ids = [np.frombuffer(b.as_buffer(), "<u2").reshape(-1, 3) for b in batch.column("ids")]
    y = batch.column("y").to_numpy()
    for i in range(0, len(order), STEP_ROWS):
        part = order[i : i + STEP_ROWS]
        yield np.concatenate([ids[j] for j in part]), np.array([len(ids[j]) for j in part]), y[part]


def _train(rows: DataFrame, model: TextCNN, weight: np.ndarray) -> None:
    """EPOCHS times over all ``rows`` (ids, y), each shard by its own task."""
    for epoch in range(EPOCHS):

        def run(batches, epoch=epoch):
            mine, touched, n = copy.deepcopy(model), np.zeros(BUCKETS, np.float32), 0
            rng = np.random.default_rng([SEED, epoch, TaskContext.get().partitionId()])
            for batch in batches:
                for ids, size, y in _documents(batch, rng.permutation(batch.num_rows)):
                    kept = rng.random(len(ids)) < KEPT
                    size = np.diff(np.r_[0, np.cumsum(kept)][np.r_[0, np.cumsum(size)]])
                    mine.step(ids[kept], size, y, weight, touched)
                n += batch.num_rows
            if n:
                for block, v in zip(*mine.parts(touched, n)):
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([v.astype("<f4").tobytes()])], names=["block", "vector"])

        model.merge({r.block: np.frombuffer(r.vector) for r in vector_sums(rows.select("ids", "y").mapInArrow(run, "block int, vector binary"), "block", "<f4").collect()})


def _logits(rows: DataFrame, model: TextCNN) -> DataFrame:
    """(language, z, y) of all ``rows``."""

    def run(batches):
        for batch in batches:
            z = [model.logits(model.maxima(ids, size)[1]) for ids, size, _ in _documents(batch, np.arange(batch.num_rows))]
            z = np.concatenate(z).astype(np.float64) if z else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("language"), pa.array(z), batch.column("y")], names=["language", "z", "y"])

    return rows.select("ids", "language", "y").mapInArrow(run, "language long, z double, y int")


def _with_word_ids(texts: DataFrame, known: DataFrame, n: int, languages: langid.LanguageModel) -> DataFrame:
    """(id, ids, language) of at least the documents whose id is one of the ``n``
    in ``known``, by a bitmap of at most BITS."""
    table = _byte_map()
    same = texts.schema["id"].dataType == known.schema["id"].dataType  # else equal ids may hash apart
    bits = min(BITS, 1 << max(15, (16 * n).bit_length()))
    slot = F.pmod(F.xxhash64("id"), F.lit(bits))
    flags = np.zeros((bits >> 15, 4_096), np.uint8)
    if same:
        parts = known.groupBy(F.bitmap_bucket_number(slot + 1).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("bits"))
        for r in parts.collect():
            flags[r["at"] - 1] = np.frombuffer(r.bits, np.uint8)
    flags = flags.ravel()

    def run(batches):
        held: dict[bytes, bytes] = {}
        for whole in batches:
            if same:
                slots = whole.column("slot").to_numpy()
                whole = whole.filter(pa.array((flags[slots >> 3] >> (slots & 7) & 1).astype(bool)))
            for batch in text_slices(whole, "text"):
                texts = batch.column("text").to_pylist()
                split = [split_words(t, table) for t in texts]
                if len(held) > CACHE_WORDS:
                    held.clear()
                for w in {w for words in split for w in words} - held.keys():
                    held[w] = np.array(word_buckets(w), "<u2").tobytes()
                ids = pa.array([b"".join(map(held.__getitem__, words)) for words in split], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), ids, pa.array(languages.best(texts), pa.int64())], names=["id", "ids", "language"])

    schema = T.StructType([texts.schema["id"], T.StructField("ids", T.BinaryType()), T.StructField("language", T.LongType())])
    return texts.withColumn("slot", slot).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, languages: langid.LanguageModel, id: str = "doc_id", text: str = "text", label: str = "toxic") -> TextCNN:
    """Learn from every document with a label of 0 or 1."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null")
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).where("id is not null")
    n = known.count()
    # the join's rows are ids of labelled texts; few others pass the bitmap
    found = _with_word_ids(texts, known, n, languages).hint("shuffle_merge").join(known, "id")
    rows = found.coalesce(-(-n // SHARD_ROWS) or 1).sortWithinPartitions(F.xxhash64("id", F.lit("toxicity")), "y").persist(StorageLevel.DISK_ONLY)
    model = TextCNN()
    try:
        counts = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
        if counts:
            weight = np.array([0.5 / max(1, counts.get(y, 0)) * sum(counts.values()) for y in (0, 1)])
            _train(rows, model, weight)
            model.thresholds = thresholds(written(_logits(rows, model), "toxicity-logits"))
            model.threshold = model.thresholds.pop(ALL, 0.0)
    finally:
        rows.unpersist()
    return model


def score(docs: DataFrame, model: TextCNN, languages: langid.LanguageModel, text: str = "text") -> DataFrame:
    """Append score (0 to 1) and predicted (score of 0.5 or more)."""

    def make():
        scorer = Scorer(model)

        def compute(texts):
            s = model.score(scorer.pooled(texts), languages.best(texts))
            return pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))

        return compute

    return with_text_columns(docs, text, make, [T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)])
