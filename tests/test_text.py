"""Text edges: transaction lines, sequence lines, dense model text."""

import pytest
from pyspark.errors import PySparkException

from chainwatch.config import MarkovConfig
from chainwatch.functions.text import parse_sequence_lines, parse_transaction_lines
from chainwatch.operators.model import dense, train
from chainwatch.operators.sequences import lines_to_long, transitions
from chainwatch.session import work_path
from chainwatch.sources.model_io import parse_model_text, read_model_text, write_model_text

CFG = MarkovConfig()


def test_transaction_lines(spark):
    df = spark.createDataFrame([("c1,t1,NNL",), ("c2,t2,NNN,extra",)], "value string")
    rows = parse_transaction_lines(df).collect()
    assert [(r.customer_id, r.transaction_id, r.token) for r in rows] == [("c1", "t1", "NNL"), ("c2", "t2", "NNN")]
    bad = spark.createDataFrame([("c1,t1",)], "value string")
    with pytest.raises(PySparkException, match="malformed"):
        parse_transaction_lines(bad).collect()
    p = parse_transaction_lines(bad, mode="permissive").collect()
    assert p[0].malformed and p[0].token is None


def test_sequence_lines(spark):
    df = spark.createDataFrame([("c1,NNL,NNN,",), ("c2",)], "value string")
    rows = {r.customer_id: r.tokens for r in parse_sequence_lines(df).collect()}
    assert rows == {"c1": ["NNL", "NNN"], "c2": []}
    long = lines_to_long(df)
    assert sorted((r.customer_id, r.pos, r.token) for r in long.collect()) == [("c1", 1, "NNL"), ("c1", 2, "NNN")]


def test_model_text_roundtrip(spark, seq_df):
    t = seq_df({"a": ["NNL", "NNN", "NNL", "NNS", "LNL", "HHS", "NNL"]})
    m = train(transitions(t, "customer_id", CFG), CFG)
    path = work_path(spark, "test-model-text")
    write_model_text(m, CFG, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == CFG.n_states and all(x.endswith(",") for x in lines)
    assert lines[0] == ",".join(["0.0"] * (CFG.n_states - 1) + ["1.0"]) + ","  # LNL → HHS
    assert lines[1] == ",".join(["0.0"] * CFG.n_states) + ","  # LNN never left
    back = dense(read_model_text(spark, path, CFG), CFG)
    a = {(r.src_idx, r.dst_idx): r.p for r in dense(m, CFG).collect()}
    b = {(r.src_idx, r.dst_idx): r.p for r in back.collect()}
    assert a == b


@pytest.mark.parametrize("width", [17, 19])
def test_model_text_bad_width(spark, width):
    text = "\n".join([",".join(["0.0"] * width) + ","] * 2)
    df = spark.createDataFrame([(text,)], "value string")
    with pytest.raises(PySparkException, match="width"):
        parse_model_text(df, CFG).collect()


def test_model_text_too_many_rows(spark):
    text = "\n".join([",".join(["0.0"] * 18) + ","] * 19)
    df = spark.createDataFrame([(text,)], "value string")
    with pytest.raises(PySparkException, match="more rows"):
        parse_model_text(df, CFG).collect()
