import numpy as np
import pytest
from pyspark.sql import functions as F

from chainwatch.llm import langid, toxicity
from chainwatch.llm._common import crc_bucket

from .conftest import EDGES


@pytest.fixture(scope="module")
def fitted(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("held_out", crc_bucket("doc_id", 5) == 0)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = docs.where("not held_out")
    languages = langid.fit(seen)
    return docs, labels, languages, toxicity.fit(seen, labels, languages)


def test_held_out(fitted):
    docs, labels, languages, model = fitted
    held = docs.where("held_out").join(labels, "doc_id")
    scored = toxicity.score(held, model, languages)
    clean, right_clean, toxic, right_toxic = scored.agg(
        F.sum((F.col("toxic") == 0).cast("int")),
        F.sum(((F.col("toxic") == 0) & (F.col("predicted") == 0)).cast("int")),
        F.sum((F.col("toxic") == 1).cast("int")),
        F.sum(((F.col("toxic") == 1) & (F.col("predicted") == 1)).cast("int")),
    ).first()
    assert right_clean / clean > 0.97 and right_toxic / toxic > 0.85
    assert scored.where("score < 0 or score > 1 or (score >= 0.5) <> (predicted = 1)").count() == 0


def test_edges(fitted, make_docs):
    _, _, languages, model = fitted
    rows = toxicity.score(make_docs(EDGES), model, languages).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[0] == by[1] == by[2]  # null, empty and blank: no words
    assert toxicity.score(make_docs([]), model, languages).count() == 0


def test_pooled_maxima_equal_the_plain_ones(fitted, corpus, monkeypatch):
    _, _, _, model = fitted
    texts = [*EDGES, "one", "one two", *(t for _, t, _ in corpus[0][:30])]
    table = toxicity._byte_map()
    plain = [model._forward(np.array([toxicity.word_buckets(w) for w in toxicity.split_words(t, table)], np.int64).reshape(-1, 3))[1] for t in texts]
    for block, cache in ((100_000, 100_000), (7, 20)):
        monkeypatch.setattr(toxicity, "BLOCK_WORDS", block)
        monkeypatch.setattr(toxicity, "CACHE_WORDS", cache)
        assert np.allclose(toxicity.Scorer(model).pooled(texts), plain, atol=1e-4)


def test_threshold():
    z, y = np.array([-3.0, -2.0, 0.0, 1.0, 4.0]), np.array([0, 0, 1, 0, 1])
    assert toxicity._threshold(z, y) in (-1.0, 2.5)
    assert toxicity._threshold(z, np.ones(5, int)) == 0.0


def test_nothing_to_learn(spark, make_docs):
    docs = make_docs(["a b c", "d e"])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    languages = langid.fit(docs)
    model = toxicity.fit(docs, none, languages)
    assert toxicity.score(docs, model, languages).count() == 2
    one = spark.createDataFrame([(0, 1), (1, None), (None, 0)], "doc_id bigint, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, one, languages), languages).count() == 2


def test_learns_from_every_labelled_document(spark, make_docs, monkeypatch):
    """Some toxic words stand only in documents that a hash sample of 1,500 a class leaves out."""
    rng = np.random.default_rng(1)
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    last = {r.doc_id for r in spark.range(1_800).toDF("doc_id").orderBy(order, "doc_id").collect()[1_500:]}
    plain = [" ".join(f"w{i}" for i in rng.integers(0, 300, 12)) for _ in range(3_600)]
    docs = make_docs([(i, t if i >= 1_800 else f"{t} {'zorkish' if i in last else 'blargen'} {t}") for i, t in enumerate(plain)])
    labels = spark.createDataFrame([(i, int(i < 1_800)) for i in range(3_600)], "doc_id bigint, toxic int")
    languages = langid.fit(docs)
    asked = make_docs(["w1 w2 zorkish w3 w4", "w1 w2 blargen w3 w4", "w1 w2 w3 w4"])
    for rows in (100_000, 1_000):  # one shard, and several
        monkeypatch.setattr(toxicity, "SHARD_ROWS", rows)
        scored = toxicity.score(asked, toxicity.fit(docs, labels, languages), languages)
        assert [r.predicted for r in scored.orderBy("doc_id").collect()] == [1, 1, 0]


def test_thresholds_use_every_row(spark, monkeypatch):
    rng = np.random.default_rng(2)
    sizes = {0: 3_000, 1: 400, 2: 20, -1: 90, 5: 50, 7: 60}
    rows = [(l, float(z), int(z + rng.normal(0, 1.5) > l)) for l, n in sizes.items() for z in rng.normal(l, 2, n)]
    rows += [(8, float(i), int(i < 20)) for i in range(40)]  # toxic below clean: the best cut is above or below all
    rows += [(9, 1.5, i % 2) for i in range(60)]  # a single logit
    rows += [(10, float(i), i % 2) for i in range(20)]  # too few of a class
    table = spark.createDataFrame(rows, "language long, z double, y int").repartition(7)
    for bins in (4_096, 5):
        monkeypatch.setattr(toxicity, "BINS", bins)
        found = toxicity.thresholds(table)
        for l in (0, 1, -1, 5, 7, 8, toxicity.ALL):
            z, y = (np.array([r[k] for r in rows if l in (r[0], toxicity.ALL)]) for k in (1, 2))
            if l != toxicity.ALL and min((y == 0).sum(), (y == 1).sum()) < toxicity.LEAST_ROWS:
                assert l not in found
            elif l == toxicity.ALL:  # the plain form does not keep equal logits together
                costs = {c: int((y[z < c] == 1).sum() + (y[z >= c] == 0).sum()) for c in [*set(z), np.inf]}
                t = found[l]
                assert (y[z < t] == 1).sum() + (y[z >= t] == 0).sum() == min(costs.values())
            else:
                assert found[l] == toxicity._threshold(z, y)
        assert found[9] in (1.0, 2.0) and 10 not in found
    assert toxicity.thresholds(table.limit(0)) == {}


def test_batches_equal_single_documents(fitted, corpus):
    _, _, _, model = fitted
    table = toxicity._byte_map()
    texts = ["", "one", "one two", "a b c a b c", *(t for _, t, _ in corpus[0][:30])]
    ids = [np.array([toxicity.word_buckets(w) for w in toxicity.split_words(t, table)], np.int64).reshape(-1, 3) for t in texts]
    size = np.array([len(i) for i in ids])
    _, pooled, at = model.maxima(np.concatenate(ids), size)
    start = np.r_[0, np.cumsum(size)[:-1]]
    for i, doc in enumerate(ids):
        _, plain, places, z = model._forward(doc)
        assert np.allclose(pooled[i], plain, atol=1e-4) and abs(model.logits(pooled[i : i + 1])[0] - z) < 1e-3
        for k, w in enumerate(toxicity.WIDTHS):
            for c in range(toxicity.FILTERS):
                if places[k] is not None and plain[k * toxicity.FILTERS + c] > 0:
                    window = lambda p: doc[p : p + w].tolist()
                    assert window(at[i, k * toxicity.FILTERS + c] - start[i]) == window(places[k][c])


def test_gradients(corpus):
    """The steps' directions are those of numeric differences of the loss."""
    table = toxicity._byte_map()
    ids = [np.array([toxicity.word_buckets(w) for w in toxicity.split_words(t, table)], np.int64).reshape(-1, 3) for _, t, _ in corpus[0][:4]]
    size, y, weight = np.array([len(i) for i in ids]), np.array([0, 1, 1, 0]), np.array([1.0, 2.0])
    ids = np.concatenate(ids)

    def loss(model):
        z = model.logits(model.maxima(ids, size)[1]).astype(np.float64)
        return float((weight[y] * (np.log1p(np.exp(z)) - y * z)).sum())

    def double(model):
        for name in ("embed", "out"):
            setattr(model, name, getattr(model, name).astype(np.float64))
        model.filters = [f.astype(np.float64) for f in model.filters]
        return model

    model, touched = double(toxicity.TextCNN()), np.zeros(toxicity.BUCKETS, np.float32)
    before = loss(model)
    moved = toxicity.TextCNN()
    moved.step(ids, size, y, weight, touched)
    assert loss(moved) < before
    start = toxicity.TextCNN()
    # Adagrad's first step is -RATE * g / sqrt(0.1 + g ** 2)
    for get in (lambda m: m.out, lambda m: m.filters[0][0], lambda m: m.filters[2][1]):
        move = (get(moved) - get(start)).astype(np.float64).ravel() / -toxicity.RATE
        g = move * np.sqrt(0.1 / (1 - np.minimum(move**2, 0.999999)))
        flat = get(model).reshape(-1)
        for i in np.argsort(-np.abs(flat))[:4]:
            old, eps = flat[i], 1e-4
            flat[i] = old + eps
            up = loss(model)
            flat[i] = old - eps
            down = loss(model)
            flat[i] = old
            want = (up - down) / (2 * eps)
            if abs(want) < 3:  # larger ones are lost in the rounding of the step
                assert abs(g[i] - want) < 0.02 + 0.05 * abs(want)
