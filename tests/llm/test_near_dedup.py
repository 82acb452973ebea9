import random

import pyarrow as pa
import pytest

from chainwatch.llm import near_dedup
from chainwatch.llm.components import components

from .conftest import EDGES


def _set(text, w):
    words = (text or "").encode().lower().split()
    n = min(len(words), w)
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def brute(rows, words=4, percent=80):
    """Components by comparing all pairs."""
    sets = [_set(t, words) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i), root(i) == i) for (i, _), s in zip(rows, sets))


def _got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def _family(rnd, base, n, edits):
    out = []
    for _ in range(n):
        w = base[:]
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def _texts():
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(4000)}"
    passage = [word() for _ in range(60)]
    texts = list(EDGES)
    for size in (2, 3, 25):
        texts += _family(rnd, [word() for _ in range(rnd.randrange(20, 120))], size, 4)
    texts += _family(rnd, [word() for _ in range(100)], 60, 6)  # links near the limit
    texts += [" ".join([word() for _ in range(80)] + passage + [word() for _ in range(50)]) for _ in range(40)]
    texts += [texts[12]] * 5
    return texts


def test_against_all_pairs(make_docs, monkeypatch):
    rows = list(enumerate(_texts()))
    want = brute(rows)
    assert _got(near_dedup.near_groups(make_docs(rows).repartition(3))) == want
    # small blocks: lists are refined, lists and clusters dealt out by pairs of blocks
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    assert _got(near_dedup.near_groups(make_docs(rows).repartition(3))) == want


def test_supplied_documents(corpus):
    rows, docs = corpus
    assert _got(near_dedup.near_groups(docs)) == brute([(i, t) for i, t, _ in rows])
    kept = near_dedup.drop_near(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [i for i, _, _, k in brute([(i, t) for i, t, _ in rows], 5) if k]


def test_repeated_ids_and_nulls(make_docs):
    docs = make_docs([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "a b c d e"), (None, None)])
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(docs).collect()}
    assert got == {(1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True), (None, 0, None, True)}
    assert near_dedup.drop_near(docs).count() == 4
    assert near_dedup.near_groups(make_docs([])).count() == 0


def test_components(spark):
    rnd = random.Random(9)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    mixed = [(rnd.randrange(1000, 1060), rnd.randrange(1000, 1060)) for _ in range(40)]
    edges = [*chain, *star, *mixed, (7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    rnd.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in list(parent)}


def test_short_texts_of_common_shingles(make_docs, monkeypatch):
    """Sets of which every value is very common are still linked."""
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    rnd = random.Random(11)
    words = [f"s{i}" for i in range(9)]
    texts = [" ".join(words[a:b]) for a in range(9) for b in range(a + 5, 10)]
    texts += [" ".join(words[:6] + words[rnd.randrange(6) :]) for _ in range(25)]
    rows = list(enumerate(texts))
    assert _got(near_dedup.near_groups(make_docs(rows).repartition(3))) == brute(rows)


@pytest.mark.parametrize("runs", [0, 1, near_dedup.RUNS])
def test_many_strays_under_common_values(make_docs, monkeypatch, runs):
    """Texts of one pool of very common shingles: dense groups, and many texts that
    are near no other; by strays and by runs."""
    monkeypatch.setattr(near_dedup, "BLOCK", 6)
    monkeypatch.setattr(near_dedup, "RUNS", runs)
    rnd = random.Random(12)
    pool = [[f"p{i}{c}" for c in "abcdefghijkl"] for i in range(14)]
    texts = [" ".join(w for i in sorted(rnd.sample(range(14), 7)) for w in pool[i]) for _ in range(50)]
    texts += _family(rnd, [w for i in range(10) for w in pool[i]], 30, 2)
    rows = list(enumerate(texts))
    assert _got(near_dedup.near_groups(make_docs(rows).repartition(3))) == brute(rows)


def test_contracted_edges_keep_components(spark, monkeypatch):
    from chainwatch.llm import components as module

    monkeypatch.setattr(module, "ROWS", 16)
    rnd = random.Random(3)
    edges = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(50)]
    got = {r.node: r.component for r in module.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(4)).collect()}
    a, b = (module.np.array([e[i] for e in edges]) for i in (0, 1))
    root, node = module.forest(a, b)
    want = dict(zip(node.tolist(), root.tolist()))
    assert {n: c for n, c in got.items() if n != c} == want


def test_classes_with_common_values_are_listed_more(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    for common, keys in ((0, 8), (1, 9), (2, 10), (4, 11), (5, 11)):
        same = [*range(common), *range(100, 140)]
        rows = [(1, same), (2, same), (3, [*range(common), *range(200, 240)])]
        listed = near_dedup._lists(spark.createDataFrame(rows, "rep bigint, sketch array<bigint>")).collect()
        assert sorted(r.key for r in listed if r.rep == 1) == sorted(range(100, 100 + keys))
    same = [*range(6), *range(100, 140)]
    rows = [(1, same), (2, same), (3, [*range(6), *range(200, 240)])]
    listed = near_dedup._lists(spark.createDataFrame(rows, "rep bigint, sketch array<bigint>")).collect()
    assert len({r.key for r in listed if r.rep == 1}) == 10 + 6  # rare values and, with other wide classes, the common ones
    runs = near_dedup._run_keys(spark.createDataFrame(rows, "rep bigint, sketch array<bigint>")).collect()
    assert len({r.key for r in runs if r.rep == 1}) == len(same) - 2


def test_estimate_leaves_room_below_the_limit():
    shared = [*range(0, 450, 10), 1000]
    a, b = (sorted(shared + [x + i for x in range(0, 180, 10)]) for i in (1, 2))
    assert len(a) == len(b) == near_dedup.SKETCH and 0.5 < 46 / 82 < 0.6
    found = near_dedup._estimated(0.8)(pa.chunked_array([[1000, 1000]]), pa.chunked_array([[a, b]], pa.list_(pa.int64())))
    assert list(found) == [(0, 1)]


def test_edges_are_contracted_where_they_are_found(monkeypatch):
    """Whatever the number of edges held at a time, the stars a task returns join
    what its edges joined, and are no more than they."""
    import numpy as np

    from chainwatch.llm import components as module

    rng = np.random.default_rng(5)
    found = [[(int(min(x, y)), int(max(x, y))) for x, y in rng.integers(0, 300, (n, 2)) if x != y] for n in (0, 40, 0, 90, 1, 60)]
    flat = np.array([e for edges in found for e in edges])
    want = dict(zip(*(x.tolist() for x in module.forest(flat[:, 0], flat[:, 1])[::-1])))
    for rows in (1, 7, 50, 1 << 20):
        monkeypatch.setattr(module, "ROWS", rows)
        made = [r for batch in module.contracted(iter(found)) for r in zip(*(c.to_pylist() for c in batch.columns))]
        assert len(made) <= len(flat)
        a, b = np.array(made).T
        assert (a < b).all()
        assert dict(zip(*(x.tolist() for x in module.forest(a, b)[::-1]))) == want
    assert [b.num_rows for b in module.contracted(iter([]))] == [0]
