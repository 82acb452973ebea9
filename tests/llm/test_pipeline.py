"""The pipeline's stages and the registered queries on the smallest tables."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from chainwatch.llm import queries

from .conftest import EDGES, SF001
from .test_near_dedup import brute


def test_whole_run(spark, corpus):
    """Against the stages done by hand."""
    rows, docs = corpus
    got = corpus_pipeline.run(spark, SF001)
    seen, left = set(), []
    for i, t, _ in sorted(rows):
        n = " ".join(t.replace("\n", " ").replace("\t", " ").split(" "))
        import re

        n = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if n not in seen:
            seen.add(n)
            left.append((i, t))
    left = [r for r, b in zip(left, brute(left, 5)) if b[3]]
    from chainwatch.llm import decontaminate as d

    table = d._byte_map()
    plain = lambda t: b" " + b" ".join(d.terms_of(t, table)) + b" "
    items = [plain(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in left if not any(x in plain(t) for x in items)]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, t in left:
        ids = np.array(tok.encode(t, add_special_tokens=False).ids, "<u4")
        want[i] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()} == want


def test_stages_keep_columns(spark, make_docs):
    """Edge rows, an empty table and columns with clashing names."""
    more = make_docs([*EDGES, (None, "no id"), (1, "")])
    names = {"_norm": "lang", "matches": "lang", "_rejected": "lang", "ids": "lang", "n_tokens": "lang", "found": "lang"}
    docs = more.select("*", *[more[c].alias(n) for n, c in names.items()])
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, SF001)
            assert out.columns == docs.columns
            out.collect()
        last = corpus_pipeline.STAGES[-1][1](spark, rows, SF001)
        assert last.columns[-3:] == ["n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == rows.count()


def test_names():
    assert [s[0] for s in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "decontaminate", "bpe"]
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))
    assert queries.queries().keys() < E.queries().keys() and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF001}/documents.parquet')")
    got = queries.queries()[name](spark, SF001)
    want = con.sql(queries.oracle_sql()[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    # plain values: pandas would make floats of nullable integers on one side only
    ours = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str)
    assert ours == sorted(want.select(*columns).fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql()) - {"op5_licenses", "op6_decontaminate", "op12_whitening"}))
def test_one_row_per_document(spark, corpus, name):
    got = queries.queries()[name](spark, SF001)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(i for i, _, _ in corpus[0])
