import hashlib
import re

from chainwatch.llm import exact_dedup

from .conftest import EDGES


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def _brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(_norm(t), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        done = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not done, hashlib.sha256(t.encode()).hexdigest()))
            done = done or i == keep
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def test_groups_and_hot_texts(make_docs):
    hot = [(500 + i, "hot   text" if i % 2 else "hot\ttext") for i in range(60)]
    rows = [*enumerate(EDGES), *hot, (3, "a"), (3, "a"), (None, "a"), (None, None), (None, "only null"), (None, "only null")]
    docs = make_docs(rows).repartition(5)
    for hot_rows in (1_000, 7, 1):  # 7 and 1 salt the hot text
        assert _got(exact_dedup.exact_groups(docs, hot_rows=hot_rows)) == _brute(rows)


def test_rows_that_stay(spark, make_docs):
    rows = [*enumerate(EDGES), *((600 + i, "copy of a text") for i in range(40)), (600, "copy of a text"), (None, "x"), (None, "x")]
    docs = make_docs(rows).withColumnRenamed("lang", "_norm")
    want = sorted(((i, t) for (i, _, _, kept, h), t in ((b, _find(rows, b)) for b in _brute(rows)) if kept), key=str)
    for hot_rows in (1_000, 5):
        kept = exact_dedup.drop_exact(docs, hot_rows=hot_rows)
        assert kept.columns == ["doc_id", "text", "_norm"]
        assert sorted(((r.doc_id, _norm(r.text)) for r in kept.collect()), key=str) == want


def _find(rows, b):
    return next(_norm(t) for _, t in rows if hashlib.sha256(_norm(t).encode()).hexdigest() == b[4])


def test_empty(make_docs):
    assert exact_dedup.exact_groups(make_docs([])).count() == 0
    assert exact_dedup.drop_exact(make_docs([])).count() == 0


def test_native_plan(make_docs):
    df = exact_dedup.drop_exact(make_docs(["a", "b"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
