"""Whitening against numpy's own eigenvectors, and the spectral splits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainwatch.llm import queries, whitening

from ..conftest import SF001


def expected(rows, components=4):
    """From the definitions: {(id, component): values}, with numpy's eigh."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in usable]
    fit = np.array(sorted({x for _, x in xs}))
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    white = centred @ u / np.sqrt(e)
    error = np.abs(white.T @ white / n - np.eye(len(e))).max()
    out = {}
    for i, x in xs:
        deviation = sum((n * int(c) - int(t)) ** 2 for c, t in zip(x, s))
        for k in range(len(e)):
            out[i, k + 1] = (n, deviation, (x - s / n) @ u[:, k] / np.sqrt(e[k]), e[k] / np.trace(v))
    return out, error


def check(got, rows):
    want, error = expected(rows)
    got = {(r.vec_id, r.component): r for r in got}
    assert got.keys() == want.keys()
    for k in {k for _, k in want}:
        ours = np.array([got[key].whitened for key in want if key[1] == k])
        theirs = np.array([want[key][2] for key in want if key[1] == k])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-8
    for key, (n, deviation, _, explained) in want.items():
        r = got[key]
        assert (r.n, r.deviation) == (n, deviation) and abs(r.explained - explained) < 1e-10
        assert r.identity_error < 1e-10 and error < 1e-9


def test_whole_query_equals_numpy(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.op12_whitening(spark, SF001).collect(), rows)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def test_repeated_rows_count_once_in_the_fit(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6).round(3).tolist()) for i in range(60)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(2000, rows[1][1])]
    docs = table(spark, rows).withColumn("component", F.lit("x")).withColumn("x", F.lit(1))
    got = whitening.whiten(docs)
    assert got.columns == "vec_id component n deviation whitened explained identity_error".split()
    assert got.count() == 4 * len(rows)
    check(got.collect(), [(i, [float(np.float32(c)) for c in v]) for i, v in rows])
    assert {r.n for r in got.collect()} == {60}


def test_unusable_rows_and_degenerate_tables(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [nan, 1.0, 2.0]), (5, [1.0, inf, 0.0]), (6, [-inf, 0.0, 0.0]), (7, [1.0, 2.0])]
    good = [(10, [0.0, -0.0, 0.5]), (11, [1.0, 0.25, -0.5]), (None, [0.1, 0.2, 0.3]), (12, [0.7, -0.4, 0.2]), (13, [-0.3, 0.9, 0.1])]
    got = whitening.whiten(table(spark, bad + good)).collect()
    assert sorted({r.vec_id or 0 for r in got}) == [0, 10, 11, 12, 13] and {r.component for r in got} == {1, 2, 3}
    check(got, [(i, None if v is None else [float(np.float32(c)) for c in v]) for i, v in good])
    assert whitening.whiten(table(spark, bad[:6])).count() == 0
    assert whitening.whiten(table(spark, [])).count() == 0
    same = whitening.whiten(table(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect()
    assert len(same) == 4 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in same)
    # two distinct vectors: one component has variance, the others none
    two = whitening.whiten(table(spark, [(1, [0.5, 0.5, 0.0]), (2, [1.0, 0.25, 0.0])])).collect()
    first = [r for r in two if r.component == 1]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and abs(r.explained - 1) < 1e-12 for r in first)
    assert all(r.whitened is None for r in two if r.component > 1)


def test_large_entries_are_exact_or_null(spark):
    rows = [(1, [1e15, 1.0]), (2, [0.0, 3.0]), (3, [1e300, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r.deviation for r in got} == {None} and len(got) == 6
    small = np.array([[3, -5], [1 << 20, 7]])
    assert whitening.deviations(small, 2, (5, 1)) == [sum((2 * int(c) - s) ** 2 for c, s in zip(row, (5, 1))) for row in small]


@pytest.mark.parametrize("d", [1, 2, 3, 7, 40])
def test_spectral_splits_give_numpys_eigenpairs(d):
    x = np.random.default_rng(d).standard_normal((5 * d + 3, d))
    a = x.T @ x
    for most in (1, 4, d):
        e, q = whitening.eigenpairs(a, most)
        w, u = np.linalg.eigh(a)
        k = min(most, d)
        assert e.shape == (k,) and q.shape == (d, k)
        assert np.allclose(e, w[::-1][:k], rtol=1e-12)
        assert np.abs(np.abs((q * u[:, ::-1][:, :k]).sum(axis=0)) - 1).max() < 1e-10


@pytest.mark.parametrize("values", [[1, 1, 1, 1], [0, 0, 0], [5, 5, 1, 1, 0], [3, 2, 1, 0, 0, 0], [1e12, 1, 1e-6], [-2, -1, 3]])
def test_equal_nil_and_wide_spread_eigenvalues(values):
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((len(values), len(values))))[0]
    a = (q * np.array(values, float)) @ q.T
    e, v = whitening.eigenpairs((a + a.T) / 2, len(values))
    scale = max(np.abs(values).max(), 1)
    assert np.allclose(e, sorted(values, reverse=True), atol=1e-13 * scale)
    assert np.abs(v.T @ v - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ v - v * e).max() < 1e-13 * scale


def test_the_polar_factor_is_the_sign():
    q = np.linalg.qr(np.random.default_rng(2).standard_normal((5, 5)))[0]
    a = (q * np.array([4, 1e-9, -1e-7, -3, 2])) @ q.T
    want = (q * np.sign([4, 1e-9, -1e-7, -3, 2])) @ q.T
    assert np.abs(whitening.polar_factor((a + a.T) / 2) - want).max() < 1e-6
