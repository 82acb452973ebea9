import math
import random
import re
import time

from chainwatch.llm import pii

from .conftest import EDGES

IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def _brute(t):
    """The patterns taken literally."""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        odd = [int(c) for c in d[-1::-2]]
        even = [sum(divmod(2 * int(c), 10)) for c in d[-2::-2]]
        return (sum(odd) + sum(even)) % 10 == 0

    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(t)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), m.end(), 2) for m in pii.CARD.finditer(t) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), m.end(), 3) for m in pii.PHONE.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_patterns(corpus):
    rnd = random.Random(6)
    texts = [t or "" for t in EDGES] + [t for _, t, _ in corpus[0]]
    texts += ["".join(rnd.choice("a.@-+1 20()5é%9") for _ in range(rnd.randrange(1, 50))) for _ in range(4000)]
    texts += ["a@b.c@d.e", "x@@y.z", "4111 1111 1111 1111", "+1 (555) 010-9999", "1.2.3.4.5", "0001.02.3.256", "999.1.1.1", "a.b@c.d.", "9" * 5000]
    for t in texts:
        assert pii.base_spans(t) == _brute(t)


def _fixture():
    texts = [f"{w} text {i} of anna the cellist at harrow mill, mail anna.k@arden.example today" for i, w in enumerate(["first", "second", "third", "fourth"])]
    texts += ["today the mill at harrow is closed", "the text of today", "cellist wanted today", "today and tomorrow", "of the"]
    return texts * 1


def test_disclosure_against_brute_force(make_docs):
    texts = _fixture()
    rows = [*enumerate(texts), *((100 + i, t) for i, t in enumerate(EDGES)), (0, texts[0])]
    docs = make_docs(rows)
    found = pii.find_base(docs)
    got = {(r.entity, r.term): (round(r.disclosure, 9), r.action) for r in pii.disclosures(docs, found).collect()}
    table = pii._byte_map()
    held = [(i, t or "", pii.contexts(t or "", pii.base_spans(t or ""))) for i, t in rows]
    total, want = len(rows), {}
    pairs = {}
    for n, (i, t, c) in enumerate(held):
        for e, w, _, _ in c:
            pairs.setdefault((e, w), set()).add((i, t))
    entity = {}
    for i, t, c in held:
        for e, *_ in c:
            entity.setdefault(e, set()).add((i, t))
    for (e, w), seen in pairs.items():
        if len({t for _, t in seen}) < pii.SUPPORT:
            continue
        n_term = sum(w in {pii._hash(x) for x in t.encode().translate(table).split()} for _, t, _ in held)
        information = math.log(total / len(entity[e]))
        share = math.log(total * len(seen) / (len(entity[e]) * n_term)) / information
        if share >= pii.GENERALISE:
            want[e, w] = (round(share, 9), 5 if share >= pii.REMOVE else 4)
    assert got == want and want


def test_spans_and_sanitised_text(make_docs):
    texts = _fixture()
    docs = make_docs([*texts, *EDGES])
    spans = pii.find_spans(docs)
    rows = {r.doc_id: r for r in spans.collect()}
    assert len(rows) == len(texts) + len(EDGES)
    for i in range(4):
        base = [tuple(s) for s in rows[i].base]
        assert base == _brute(texts[i]) and set(base) <= {tuple(s) for s in rows[i].spans}
        added = {texts[i][a:b] for a, b, k in rows[i].spans if k >= 4}
        assert "anna" in added and "today" not in added
        assert [s.start for s in rows[i].spans] == sorted(s.start for s in rows[i].spans)
    assert all(rows[i].spans == [] for i in range(4, len(rows)))
    shown = {r.doc_id: r.sanitised for r in pii.sanitise(docs, spans).collect()}
    assert "anna" not in shown[0] and "[EMAIL]" in shown[0] and "today" in shown[0]
    assert all(shown[i] == r for i, r in list(enumerate([*texts, *EDGES]))[4:])
    text = spans.select("doc_id", pii.span_text("base").alias("b"), pii.span_text("spans").alias("s")).where("doc_id = 0").first()
    assert text.b == f"email:{texts[0].index('anna.k')}:{texts[0].index(' today')}" and "remove:" in text.s and text.b in text.s


def test_long_runs_take_linear_time():
    began = time.perf_counter()
    zeros = "0" * 5000 + "1.2.3.4"
    assert pii.base_spans(zeros) == [(0, len(zeros), 1)]
    million = 1_000_000
    assert pii.base_spans("7" * million) == []
    assert pii.base_spans("7" * million + ".1.2.3") == []
    assert pii.base_spans("a" * million + "@x") == []
    assert pii.base_spans("a" * million + "@x.y") == [(0, million + 4, 0)]
    assert len(pii.base_spans("1." * million)) == million // 4
    assert time.perf_counter() - began < 5
    many = " ".join(f"p{i}@x.y word" for i in range(5000))
    spans = pii.base_spans(many)
    began = time.perf_counter()
    assert len(spans) == 5000 and len(pii.contexts(many, spans)) > 15_000
    assert time.perf_counter() - began < 3


def test_masked_words_are_no_terms():
    rnd = random.Random(9)
    for _ in range(300):
        text = " ".join(rnd.choice(["a@b.cd", "name", "1.2.3.4.5", "+49 30 1234567", "4111 1111 1111 1111", "other"]) for _ in range(12))
        spans = pii.base_spans(text)
        for _, _, a, b in pii.contexts(text, spans):
            assert not any(a < y and x < b for x, y, _ in spans)


def test_clashing_names(make_docs):
    docs = make_docs(["mail a@b.cd", "b"])
    wide = docs.selectExpr("*", "1 as _id", "2 as _spans")
    got = pii.sanitise(wide, pii.find_spans(docs))
    assert got.columns == [*wide.columns, "sanitised"] and sorted(r.sanitised for r in got.collect()) == [" [EMAIL]", "b"]


def test_nothing(make_docs):
    assert pii.find_spans(make_docs([])).count() == 0
    assert pii.find_spans(make_docs([None, None])).count() == 2


def test_supplied_documents_get_terms(corpus):
    """Each entity there is in one text, so only pairs of one text can be judged."""
    rows, docs = corpus
    texts = {i: t for i, t, _ in rows}
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_spans(docs).collect()}
    table = pii._byte_map()
    words = {i: set((t or "").encode().translate(table).split()) for i, t in texts.items()}
    n_term = {}
    for w in words.values():
        for x in w:
            n_term[pii._hash(x)] = n_term.get(pii._hash(x), 0) + 1
    near = {i: pii.contexts(t, pii.base_spans(t)) for i, t in texts.items() if t}
    held, pairs = {}, {}
    for i, c in near.items():
        for e, w, _, _ in c:
            held.setdefault(e, set()).add(i)
            pairs.setdefault((e, w), set()).add(i)
    want = {i: {} for i in texts}
    for i, c in near.items():
        for e, w, a, b in c:
            share = math.log(len(rows) * len(pairs[e, w]) / (len(held[e]) * n_term[w])) / math.log(len(rows) / len(held[e]))
            if share >= pii.GENERALISE:
                want[i][a, b] = max(want[i].get((a, b), 0), 5 if share >= pii.REMOVE else 4)
    added = {i: {(a, b): k for a, b, k in s if k >= 4} for i, s in got.items()}
    assert added == want and any(added.values())
    assert any(len(x) == 1 for x in held.values())


def test_window_counts_words_however_long():
    long = [c * 90 for c in "abcdefghi"]
    text = f"{' '.join(long)} anna.k@arden.example {' '.join(reversed(long))}"
    near = pii.contexts(text, pii.base_spans(text))
    assert [text[a:b] for _, _, a, b in near] == long[-pii.WINDOW :] + long[::-1][: pii.WINDOW]
    assert len({e for e, *_ in near}) == 1
