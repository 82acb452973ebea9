import numpy as np

from chainwatch.llm import langid
from chainwatch.llm._common import crc_bucket
from pyspark.sql import functions as F

from .conftest import EDGES, SF001
from ..conftest import SF01


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").withColumn("held_out", crc_bucket("doc_id", 4) == 2)
    model = langid.fit(docs.where("not held_out"))
    found = langid.identify(docs, model).where("held_out")
    n, right, rejected = found.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("rejected").cast("int"))).first()
    assert n > 200 and right / n > 0.97 and rejected == 0
    kept = langid.drop_rejected(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_mixtures_and_edges(spark, make_docs):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.fit(docs)
    by = {r.lang: r.text for r in docs.where("length(text) between 1500 and 4000 and lang is not null").dropDuplicates(["lang"]).collect()}
    mixed = by["en"][:1400] + " " + by["fr"][:700]
    rows = langid.identify(make_docs([*EDGES, mixed, "12 34 ..."]), model).orderBy("doc_id").collect()
    for r in rows:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letter) and 0 <= r.score <= 1
        assert letter or (r.rejected and r.score == 0 and r.proportions == {})
    parts = rows[len(EDGES)].proportions
    assert rows[len(EDGES)].lang_pred == "en" and set(parts) == {"en", "fr"} and 0.5 < parts["en"] < 0.8
    assert abs(sum(parts.values()) - 1) < 0.02


def test_chunks_do_not_matter(corpus):
    rows, docs = corpus
    model = langid.fit(docs)
    texts = [t for _, t, _ in rows[:60]]
    whole = model.infer(texts)
    single = [model.infer([t])[0] for t in texts]
    assert [w[0] for w in whole] == [s[0] for s in single]
    assert np.allclose([w[1] for w in whole], [s[1] for s in single], atol=1e-3)


def test_trigram_counts():
    doc, bucket, count = langid.Trigrams().counts(["Ab ab", "", "x"])
    # " ab" twice, "ab " twice in the first text, " x " in the last
    assert doc.tolist() == [0, 0, 2] and sorted(count[:2]) == [2, 2] and count[2] == 1
    again = langid.Trigrams().counts(["aB\tAB!"])
    assert sorted(again[1]) == sorted(bucket[:2])


def test_nothing_to_learn(make_docs):
    model = langid.fit(make_docs([]))
    assert {r.lang_pred for r in langid.identify(make_docs(EDGES), model).collect()} == {"und"}
    assert langid.drop_rejected(make_docs(EDGES), model).count() == 0
    assert langid.identify(make_docs([]), model).count() == 0


def test_mixture_of_all_languages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.fit(docs)
    by = {r.lang: r.text for r in docs.where("length(text) between 1500 and 4000 and lang is not null").dropDuplicates(["lang"]).collect()}
    assert set(by) == set(model.languages) and len(by) > 3
    lang, _, parts, rejected = model.infer([" ".join(t[:1400] for t in by.values())])[0]
    assert set(parts) == set(by) and min(parts.values()) > 0.1 and lang in by and not rejected
    assert abs(sum(parts.values()) - 1) < 0.02


def test_learns_from_all_documents(corpus, monkeypatch):
    rows, df = corpus
    monkeypatch.setattr(langid, "SAMPLE", 1)
    model = langid.fit(df.repartition(5), sample=None)
    counts: dict = {}
    for _, text, lang in rows:
        if lang is not None and text is not None:
            _, bucket, count = model.trigrams.counts([text])
            counts[lang] = counts.get(lang, 0) + np.bincount(bucket, count, langid.BUCKETS)
    assert np.array_equal(model.p, langid.LanguageModel(counts).p)
