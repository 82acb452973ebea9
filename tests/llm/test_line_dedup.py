import re

from chainwatch.llm import line_dedup

from .conftest import EDGES


def _key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({c: c + 32 for c in range(65, 91)})


def _brute(rows):
    big = 1 << 63
    owner = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = _key(x)
            if len(k) >= 10:
                owner[k] = min(owner.get(k, big), big - 1 if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(_key(x)) < 10 or owner[_key(x)] == (big - 1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()), key=str)


ROWS = [
    *enumerate(EDGES),
    (20, "A repeated line here\nshort\nfirst of its own kind"),
    (21, "  a REPEATED line here\t\nshort\nA repeated line here\nown line number two"),
    (22, "nine char\nnine char\nÀÉÎÕÜàéîõü\nàÉÎÕÜàéîõü"),
    (23, "ÀÉÎÕÜàéîõü \nnine char\nown line number two\n\n"),
    (None, "A repeated line here\nline of a row without id"),
    (None, "line of a row without id"),
    (24, "line of a row without id"),
    (25, "twice within one\ntwice within one"),
    (25, "twice within one\nother row, same id"),
    *((30 + i, f"common line of many\nline that only {i} has") for i in range(40)),
]


def test_against_brute_force(make_docs):
    docs = make_docs(ROWS).repartition(4)
    for batches, fanout in ((1, 3), (6, 3), (9, 2)):
        assert _got(line_dedup.dedup_lines(docs, batches=batches, fanout=fanout)) == _brute(ROWS)


def test_supplied_documents(corpus):
    rows, docs = corpus
    assert _got(line_dedup.dedup_lines(docs)) == _brute([(i, t) for i, t, _ in rows])


def test_runs_are_compacted(spark):
    runs = line_dedup.Runs(spark, fanout=2)
    for n in range(4):
        runs.add(spark.createDataFrame([(bytes([n]), n)], "key binary, owner bigint"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert sorted(r.owner for r in runs.read().collect()) == [0, 1, 2, 3]


def test_empty(make_docs):
    assert line_dedup.dedup_lines(make_docs([])).count() == 0
