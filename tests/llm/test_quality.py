"""The quality cascade: features against plain definitions, order, verdicts."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chainwatch.llm import quality, queries

from ..conftest import SF001
from .conftest import EDGES

WORD = re.compile("[^\x20\x09-\x0d]+")


def repeats(words, width=8):
    windows = Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    inside = {j for i in range(len(words) - width + 1) if windows[tuple(words[i : i + width])] > 1 for j in range(i, i + width)}
    return len(inside)


def plain(text):
    """The contract's four counts and number of words, from the definitions."""
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        repeats(words),
    )


def test_features_of_the_table_and_of_edges(spark, make_docs):
    judged = queries.op11_quality(spark, SF001)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = judged.collect()
    assert {r.doc_id: tuple(r[c] for c in queries.BASE) for r in rows} == {i: plain(t) for i, t in texts.items()}
    for r in rows:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    got = quality.judge(make_docs(EDGES), reported=queries.BASE).collect()
    assert {r.doc_id: tuple(r[c] for c in queries.BASE) for r in got} == {i: plain(t) for i, t in enumerate(EDGES)}


def test_repeated_windows_overlap_and_do_not_cross_documents():
    rng = random.Random(5)
    docs = [[rng.choice([b"a", b"b"]) for _ in range(n)] for n in (0, 1, 7, 8, 9, 16, 40, 300)] + [[b"x"] * 8, [b"x"] * 9]
    docs += [[bytes([65 + i]) for i in range(8)]] * 2  # equal, each without a repeat of its own
    assert quality.repeated_words(docs, 8).tolist() == [repeats(d) for d in docs]


def test_order_is_by_rejection_per_cost_given_earlier_rules():
    rules = [quality.Rule(n, (f,), None) for n, f in (("a", "dear"), ("b", "cheap"), ("c", "cheap"), ("d", "mid"))]
    cost = {"dear": 10.0, "cheap": 1.0, "mid": 2.0}
    # a rejects 60; b 10; c 10, among them all of b's; d 30, all of which a rejects too
    patterns = {0b0001: 30, 0b1001: 30, 0b0110: 10, 0: 30}
    assert [r.name for r in quality.best_order(rules, cost, patterns)] == ["d", "b", "a", "c"]
    # a feature that is computed anyway costs nothing
    assert quality.best_order(rules, cost, patterns, free=("dear",))[0].name == "a"


@pytest.mark.parametrize("turn", [0, 3, 5])
def test_the_verdict_does_not_depend_on_the_order(turn):
    texts = [*EDGES, "good words here " * 9, "### $$$ " * 30, "1234 5678 " * 20, "x" * 2000 + " word" * 40, "ok line of text\n" * 9, "a b c d " * 20]
    rules = list(quality.RULES)
    _, stays = quality.Cascade(rules[turn:] + rules[:turn]).run(texts)
    docs, at = quality.Texts(texts), list(range(len(texts)))
    for i, text in enumerate(texts):
        rejected = [r.name for r in rules if r.rejects(*(quality.np.array([quality.FEATURES[f](docs, at)[i]]) for f in r.features))[0]]
        assert stays[i] == (not rejected), (text, rejected)


def test_later_rules_see_only_what_earlier_ones_left():
    seen = []
    quality.FEATURES["_spy"] = lambda docs, at: seen.append(list(at)) or [0] * len(at)
    try:
        rules = [quality.BASE_RULES[0], quality.Rule("spy", ("_spy",), lambda n: n > 0)]
        quality.Cascade(rules).run(["few words", "many words " * 20, None, "again many " * 20])
    finally:
        del quality.FEATURES["_spy"]
    assert seen == [[1, 3]]


def test_estimate_counts_the_sample(spark, make_docs):
    texts = ["few words"] * 30 + ["plain words that stay here " + " ".join("abc" + chr(97 + i % 26) * (i // 26 + 1) for i in range(40))] * 20
    cost, patterns = quality.estimate(make_docs(texts), sample=1_000)
    assert sum(patterns.values()) == 50 and patterns.get(0) == 20
    assert set(cost) == {f for r in quality.RULES for f in r.features}


def test_clashing_names_repeats_and_empty_tables(spark, make_docs):
    good = "these are words of a text that may stay because nothing in it is odd and it has more than twenty words here"
    docs = make_docs([(1, good), (1, good), (None, good), (2, "short")]).withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit("x"))
    left = quality.drop_poor(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.kept, r.n_words) for r in left.collect()) == [(0, "mine", "x"), (1, "mine", "x"), (1, "mine", "x")]
    assert quality.judge(make_docs([]), reported=queries.BASE).count() == 0
    labelled = quality.judge(docs, reported=queries.BASE)
    assert {r.n_words for r in labelled.collect()} == {1, len(good.split())}


def test_clean_documents_stay(spark):
    sf = SF001.replace("0.001", "0.1")
    kept = queries.op11_quality(spark, sf).where("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = {r.quality: r.share for r in kept.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] == 1.0 and share[0] < 0.2
