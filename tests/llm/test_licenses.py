import random

from chainwatch.llm import licenses

from .conftest import EDGES

INDEX = licenses.TemplateIndex(licenses.TEMPLATES)


def _names(text):
    return [(r[0], text[r[3] : r[4]]) for r in INDEX.scan(text)]


def test_exact_and_changed_notices():
    for name, template in licenses.TEMPLATES:
        found = INDEX.scan(f"début. some words before\n{template.upper()}\nand after it")
        assert (name, 1.0) in [(r[0], r[1]) for r in found]
    assert _names("x released UNDER the, MIT\n license y") == [("MIT", "released UNDER the, MIT\n license")]
    changed = "This work is licensed by the GNU General Public License, version 3"
    assert _names("é " + changed + ".") == [("GPL-3.0", changed)]
    assert _names("Licensed under CC BY-NC 4.0. Later: Licensed under CC BY-NC 4.0.") == [("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0")] * 2
    assert _names("under the license of the software and the public") == []


def test_alignment_against_plain_lcs():
    rnd = random.Random(3)
    for _ in range(60):
        t = rnd.randrange(len(INDEX.ids))
        words = INDEX.ids[t].tolist()
        text = words[:]
        for _ in range(rnd.randrange(1 + len(words) // 8)):
            text[rnd.randrange(len(text))] = 0
        before = rnd.randrange(5)
        got = INDEX._align(t, licenses.np.array([0] * before + text + [0, 0]), before, licenses.LEAST_BAND)
        same = sum(a == b for a, b in zip(words, text))
        want = same / len(words)
        assert (got[0][1] if got else 0.0) == (want if want >= licenses.COVERAGE else 0.0)


def test_winnowing_guarantee():
    rnd = random.Random(8)
    for _ in range(50):
        run = licenses.np.array([rnd.randrange(1, 50) for _ in range(licenses.GRAM + licenses.WINDOW - 1)])
        sides = [licenses.np.array([rnd.randrange(1, 50) for _ in range(rnd.randrange(12))], dtype=int) for _ in range(4)]
        prints = []
        for a, b in (sides[:2], sides[2:]):
            grams = INDEX.grams(licenses.np.concatenate([a, run, b]))
            prints.append(set(grams[licenses.winnow(grams)].tolist()))
        assert prints[0] & prints[1]


def test_supplied_documents(corpus):
    rows, docs = corpus
    lines = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.",
             "This work is licensed under the GNU General Public License, version 3."]
    want = sorted((i, t.count(x)) for i, t, _ in rows for x in lines if x in t)
    got = licenses.find_licenses(docs).selectExpr("doc_id", "inline(licenses)")
    assert sorted((r.doc_id, r["count"]) for r in got.groupBy("doc_id", "license").count().collect()) == want


def test_edges(make_docs):
    found = licenses.find_licenses(make_docs([*EDGES, "Released under the MIT License."]))
    assert [r.doc_id for r in found.where("size(licenses) > 0").collect()] == [len(EDGES)]
    assert licenses.find_licenses(make_docs([])).count() == 0
    assert licenses.find_licenses(make_docs(["x"]), [("none", "")]).where("size(licenses) > 0").count() == 0


def test_kept_reports_equal_pairwise_comparison():
    """Best first, and none that overlaps a kept one, in time that many reports can bear."""
    r = licenses.np.random.default_rng(8)
    index, text = licenses.TemplateIndex(licenses.TEMPLATES), "word " * 6000
    for n, most in ((0, 9), (40, 60), (3000, 5900)):
        first = r.integers(0, most, n)
        found = [(int(r.integers(0, 5)), float(r.integers(80, 101)) / 100, int(r.integers(5, 9)), int(a), int(a + r.integers(0, 12))) for a in first]
        want: list = []
        for f in sorted(set(found), key=lambda f: (-f[1], -f[2], f[3], f[0])):
            if all(f[4] < k[3] or k[4] < f[3] for k in want):
                want.append(f)
        got = index._best(found, text)
        assert [(c, m, a // 5, b // 5) for _, c, m, a, b in got] == [f[1:] for f in sorted(want, key=lambda f: f[3])]
