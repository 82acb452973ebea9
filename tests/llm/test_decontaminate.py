import random

import numpy as np

from chainwatch.llm import decontaminate as d

from .conftest import EDGES, SF001


def _index(items, threshold=d.THRESHOLD):
    table = d._byte_map()
    return d.ItemIndex([(i, *_parts(d.terms_of(t, table))) for i, t in items], threshold)


def _parts(words):
    cut = max(0, len(words) - max(d.SHINGLE, len(words) // 4))
    return words[:cut], words[cut:]


def _bm25(index, terms):
    score = np.zeros(len(index.items))
    for t in terms:
        for i, impact in zip(*index.postings[t]):
            score[i] += impact
    return score


def test_wand_finds_all_above_threshold():
    rnd = random.Random(2)
    items = [(i, " ".join(f"w{int(rnd.paretovariate(0.7)) % 300}" for _ in range(rnd.randrange(1, 40)))) for i in range(150)]
    for threshold in (0.15, 0.3, 0.6):
        index = _index(items, threshold)
        for _ in range(150):
            terms = set(rnd.choices(range(len(index.terms)), k=rnd.randrange(1, 60)))
            want = {i: s for i, s in enumerate(_bm25(index, terms)) if s >= threshold}
            got = dict(index.search(terms))
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)
            # the bound of a piece never lies below a score
            ids = np.array(sorted(terms))
            assert not want or index.candidates(ids, np.zeros(len(ids), np.int64), 1) == [0]


def test_supplied_documents(spark, corpus):
    rows, docs = corpus
    benchmark = spark.read.parquet(f"{SF001}/benchmark.parquet")
    table = d._byte_map()
    plain = lambda t: b" " + b" ".join(d.terms_of(t, table)) + b" "
    want = {(i, r.item_id) for i, t, _ in rows for r in benchmark.collect() if plain(r.text) in plain(t)}
    found = d.find_matches(docs, benchmark).selectExpr("doc_id", "inline(matches)").collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and want
    for r in found:
        words = d.terms_of(dict((i, t) for i, t, _ in rows)[r.doc_id], table)
        item = d.terms_of({x.item_id: x.text for x in benchmark.collect()}[r.item_id], table)
        assert words[r.first_word : r.last_word + 1] == item
    kept = d.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _ in rows} - {i for i, _ in want}


ITEM = "which of the seven rivers runs past the old mill town of arden before it meets the sea the answer is the river lowen"


def test_changes_places_and_shards(spark, make_docs, monkeypatch):
    monkeypatch.setattr(d, "SHARD_ITEMS", 2)
    filler = [f"f{i}" for i in range(500)]
    texts = [" ".join(filler[:k]) + " " + ITEM.upper().replace(" ", ", ") + " " + " ".join(filler[k:]) for k in (0, 1, 60, 63, 64, 65, 127, 500)]
    texts += [" ".join(ITEM.split()[:18]), ITEM.replace("the answer is the river lowen", "nobody knows that any more now"), " ".join(reversed(ITEM.split()))]
    benchmark = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "tiny"), (5, ITEM), (6, "some other item that no document has at all")], "item_id bigint, text string")
    found = d.find_matches(make_docs([*texts, *EDGES, "a tiny text"]), benchmark).selectExpr("doc_id", "inline(matches)").collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == {(i, j) for i in range(8) for j in (1, 5)} | {(len(texts) + len(EDGES), 4)}
    assert d.drop_contaminated(make_docs([]), benchmark).count() == 0
    assert d.drop_contaminated(make_docs(EDGES), benchmark.limit(0)).count() == len(EDGES)


def test_question_and_answer_columns(spark, make_docs):
    rows = [(1, "what colour has the sky on a clear day", "it is blue as everyone can see")]
    benchmark = spark.createDataFrame(rows, "item_id bigint, q string, a string")
    docs = make_docs([" ".join(rows[0][1:]), rows[0][1], rows[0][2]]).withColumnRenamed("lang", "matches")
    kept = d.drop_contaminated(docs, benchmark, question="q", answer="a")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2] and kept.columns == ["doc_id", "text", "matches"]


def test_one_edited_word_at_each_place(spark, make_docs):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join([*words[:k], "edited", *words[k + 1 :]]) for k in range(40)]
    texts += [" ".join(words[9:]), " ".join(words[:24] + words[32:])]  # 27 of 36 and 20 + 4 of 36 shingles
    benchmark = spark.createDataFrame([(7, " ".join(words))], "item_id bigint, text string")
    found = d.find_matches(make_docs(texts), benchmark).selectExpr("doc_id", "inline(matches)").collect()
    share = {r.doc_id: r.question_overlap for r in found}
    # shingle i, of words i to i + 4, is lost if it holds word k
    assert share == {k: sum(not i <= k <= i + 4 for i in range(36)) / 36 for k in range(40)}
    assert all(r.answer_overlap == r.question_overlap and r.item_id == 7 for r in found)


def test_shards_change_nothing(spark, corpus, monkeypatch):
    rows, docs = corpus
    benchmark = spark.read.parquet(f"{SF001}/benchmark.parquet")
    again = benchmark.unionByName(benchmark.where("item_id % 3 = 0"))  # equal ids in two shards
    docs = docs.unionByName(docs.limit(50))  # equal rows
    # edited items: their scores hang on the document frequencies
    edited = benchmark.selectExpr("-item_id AS doc_id", "concat('edited ', substring_index(text, ' ', size(split(text, ' ')) - 1)) AS text")
    docs = docs.unionByName(edited, allowMissingColumns=True)
    shown = lambda df: sorted(map(str, df.drop("text").collect()))
    whole = d.find_matches(docs, again)
    want, columns = shown(whole), whole.columns
    monkeypatch.setattr(d, "SHARD_ITEMS", again.count() // 4)
    parts = d.find_matches(docs, again)
    assert len(list(d.item_shards(again))) > 3 and parts.columns == columns
    assert shown(parts) == want and any("item_id" in x for x in want)
