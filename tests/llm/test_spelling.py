"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainwatch.llm import queries, spelling

from ..conftest import SF001
from .conftest import EDGES


def near(a, b):
    """One edit, from the definition."""
    cut = {b[:i] + b[i + 1 :] for i in range(len(b))}
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return a in cut or b in {a[:i] + a[i + 1 :] for i in range(len(a))}


def expected(rows, vary=None, shortest=5, least=3):
    count = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{id}:{w}".encode())
            if vary and id is not None and h % vary == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= shortest:
                count[w] += 1
    n = {w: k for w, k in count.items() if k >= least}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    out, form = {}, {}
    for w in n:
        close = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
        out[w] = [form[w], None, n[w], len(close), n.get(form[w])]
    for w in n:
        end = w
        while form[end]:
            end = form[end]
        out[w][1] = end
    return {w: tuple(v) for w, v in out.items()}


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_whole_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert found(queries.op13_spelling(spark, SF001)) == expected([tuple(r) for r in docs], vary=97)


def some_words(n, letters, seed, sizes=(5, 9)):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(n)]


@pytest.mark.parametrize("letters", ["ab", "abcde", "aéè÷xyz"])
def test_dense_words_and_small_groups(spark, make_docs, letters):
    """Groups above the limit are joined anew and lose no pair."""
    rows = [" ".join(some_words(700, letters, s)) for s in range(3)]
    docs = make_docs(rows)
    want = expected(list(enumerate(rows)), least=1)
    for limit in (spelling.GROUP, 20):
        assert found(spelling.spelling_variants(docs, least=1, limit=limit)) == want


def test_every_near_pair_shares_a_signature():
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyzéèà"
    words, pairs = [], []
    for w in some_words(3000, letters, 2, (1, 14)):
        i, c = rng.randrange(len(w) + 1), rng.choice(letters)
        words += [w, rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])]
    words = [w or "x" for w in words]
    sign = spelling.Signatures({(ord(c), k): (j + k) % spelling.PARTS for j, c in enumerate(letters) for k in range(3)})
    keys = sign.all(words)
    for k in range(0, len(words), 2):
        if near(words[k], words[k + 1]):
            assert (keys[k] == keys[k + 1]).any()


def test_pairs_of_long_and_odd_words():
    words = ["a" * 30_000, "a" * 29_999, "a" * 29_999 + "b", "b" + "a" * 29_999, "ab", "a", "b", "ba", "÷×é", "÷×è"]
    got = spelling.near_pairs(words, np.zeros(len(words), np.uint64))
    assert got == [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if spelling.one_edit(words[i], words[j])]
    assert (0, 1) in got and (8, 9) in got and all(spelling.one_edit(words[i], words[j]) == near(words[i], words[j]) for i in range(4, 10) for j in range(4, 10))


def test_chains_end_at_the_root(spark):
    chain = [f"w{i}" for i in range(23)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:])) + [(f"x{i}", "w0") for i in range(50)], "word string, form string")
    assert {(r.word, r.root) for r in spelling.roots(forms).collect()} == {(w, "w22") for w in [*chain[:-1], *(f"x{i}" for i in range(50))]}


def test_edge_cases(spark, make_docs):
    rows = [*enumerate(EDGES), (50, "thing thing thing things"), (50, "thing thing thing things"), (None, "things Things THINGS tHinks")]
    docs = make_docs(rows).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("form", F.lit("y"))
    assert found(spelling.spelling_variants(docs, vary=3)) == expected(rows, vary=3)
    assert found(spelling.spelling_variants(make_docs([]))) == {}
    assert spelling.spelling_variants(make_docs(["one two"])).count() == 0
