"""Nothing is lost between the jobs: cut sequences, order types, NULLs, rejects,
outputs, slices and settings."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from chainwatch.__main__ import main
from chainwatch.config import MarkovConfig, config_from_properties
from chainwatch.functions.states import read_states, state_index
from chainwatch.functions.text import history_message
from chainwatch.operators.model import transition_counts
from chainwatch.operators.ordering import sequence_positions
from chainwatch.operators.scoring import score_windows
from chainwatch.operators.sequences import build_sequences, sequence_tails, token_windows, transitions
from chainwatch.plans.jobs import train_model
from chainwatch.session import work_path
from chainwatch.sources.events import load_tokens
from chainwatch.sources.model_io import model_table, save_model
from chainwatch.sources.transactions import (
    read_reject_stream,
    read_rejects,
    read_sequence_lines,
    read_sequences,
    read_transaction_stream,
    read_transactions,
    write_sequence_lines,
    write_sequences,
)
from chainwatch.streaming.detect import detect_stream, read_alerts, read_history

from .conftest import SF001

CFG = MarkovConfig(zero_cell="limit")
ALGORITHMS = ["MissProbability", "MissRate", "EntropyReduction"]


@pytest.mark.parametrize("form", ["text", "parquet"])
def test_cut_sequences_come_back_whole(spark, form):
    tokens = load_tokens(spark, SF001)
    model = train_model(tokens, CFG, key="user_id")
    path = work_path(spark, "test-cut")
    pieces = build_sequences(tokens, "user_id", CFG.with_(chunk=7))
    if form == "text":
        write_sequence_lines(pieces, path, key="user_id")
        long, key = read_sequence_lines(spark, path).repartition(5), ["customer_id", "line_id"]
    else:
        write_sequences(pieces, path)
        long, key = read_sequences(spark, path, key="user_id"), "user_id"
    assert transitions(long, key, CFG).count() == 985
    assert token_windows(long, key, CFG).count() == 940
    name = key[0] if form == "text" else key
    for a in ALGORITHMS:
        want = {(str(r.user_id), r.pos): r.score for r in score_windows(tokens, model, CFG, "user_id", algorithm=a).collect()}
        got = {(str(r[name]), r.pos): r.score for r in score_windows(long, model, CFG, key, algorithm=a).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_short_sequences_keep_the_plain_form(spark, seq_df):
    path = work_path(spark, "test-plain")
    write_sequence_lines(build_sequences(seq_df({"a": ["NNL", "NNN"], "b": ["HHS"]}), "customer_id", CFG), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a,NNL,NNN", "b,HHS"]


LINES = [f"a,{i},{t}" for i, t in zip(range(7, 12), ["NNL", "NNN", "NNS", "NHL", "NHN"])]


@pytest.mark.parametrize("order", ["bigint", "string"])
def test_order_type_of_the_stream(spark, seq_df, order):
    src, model, out = (work_path(spark, n) for n in ("test-ids", "test-ids-model", "test-ids-out"))
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(src)
    save_model(train_model(seq_df({"a": ["NNL", "NNN", "NNS", "NHL", "NHN", "NNL"]}), CFG), model)
    assert main(["stream", "--source", "text", "--path", src, "--model", model, "--threshold", "-1", "--order-type", order,
                 "--alerts-out", f"{out}/alerts", "--checkpoint", f"{out}/ck", "--available-now"]) == 0
    (r,) = read_alerts(spark, f"{out}/alerts").collect()
    want = ["NNL", "NNN", "NNS", "NHL", "NHN"] if order == "bigint" else ["NHL", "NHN", "NNL", "NNN", "NNS"]
    assert [r.t0, r.t1, r.t2, r.t3, r.t4] == want


def _null_events(spark):
    return load_tokens(spark, SF001).select(F.when(F.col("user_id") > 4, F.col("user_id")).alias("user_id"), "ts", "event_id", "token")


def test_null_customer_that_is_hot(spark):
    rows = _null_events(spark)
    n = rows.where("user_id is null").count()
    assert n > 200
    plain = sequence_positions(rows, "user_id", ["ts", "event_id"])
    hot = sequence_positions(rows, "user_id", ["ts", "event_id"], hot_rows=50)
    key = lambda df: sorted((r.event_id, r.pos) for r in df.collect())
    assert key(hot) == key(plain)
    # its rows are numbered in several partitions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is tiny
    try:  # (the positions must be asked for, else nothing is numbered)
        spread = hot.where("user_id is null").groupBy(F.spark_partition_id()).agg(F.count("*").alias("count"), F.max("pos")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 1 and max(r["count"] for r in spread) < n
    model = train_model(plain, CFG, key="user_id")
    for a in ALGORITHMS:
        scored = score_windows(hot, model, CFG.with_(chunk=60), "user_id", algorithm=a)
        assert scored.where("user_id is null").count() == n - 4
    tails = {r.user_id: (r.n_tokens, r.tail) for r in sequence_tails(hot, "user_id", 4, chunk=60).collect()}
    last = [r.token for r in plain.where("user_id is null").orderBy(F.desc("pos")).limit(4).collect()][::-1]
    assert tails[None] == (n, last)


def test_tails_need_no_join_and_one_scan(spark):
    plan = sequence_tails(load_tokens(spark, SF001), "user_id", 4)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1


def test_null_token_is_unknown(spark, seq_df):
    tokens = seq_df({"a": ["NNL", None, "NNL", "NNN", "NNL", "NNN"], "b": ["NNL", "NNN"]})
    assert [r.i for r in tokens.orderBy("customer_id", "pos").select(state_index("token", CFG.states).alias("i")).collect()][:2] == [6, -1]
    with pytest.raises(Exception, match="unknown"):
        transition_counts(transitions(tokens, "customer_id", CFG), CFG).collect()
    kept = transition_counts(transitions(tokens, "customer_id", CFG), CFG.with_(on_unknown="drop_sequence"), key="customer_id")
    assert [(r.src, r.dst, r.n) for r in kept.collect()] == [("NNL", "NNN", 1)]
    model = train_model(seq_df({"b": ["NNL", "NNN", "NNL"]}), CFG)
    with pytest.raises(Exception, match="unknown"):
        score_windows(tokens, model, CFG, "customer_id").collect()
    lenient = score_windows(tokens, model, CFG.with_(on_unknown="null"), "customer_id").orderBy("pos").collect()
    assert [r.score for r in lenient] == [None, None]  # both windows read NULL as a current state
    last = seq_df({"c": ["NNL", "NNN", "NNL", "NNN", None]})
    assert [r.score for r in score_windows(last, model, CFG.with_(algorithm="MissRate"), "customer_id").collect()] == [0.25]


def test_dropping_the_sequence_of_a_null_customer(seq_df):
    tokens = seq_df({None: ["NNL", "XXX", "NNL"], "b": ["NNL", "NNN"]})
    kept = transition_counts(transitions(tokens, "customer_id", CFG), CFG.with_(on_unknown="drop_sequence"), key="customer_id")
    assert [(r.src, r.dst, r.n) for r in kept.collect()] == [("NNL", "NNN", 1)]


def test_rejects_and_formats(spark):
    src = work_path(spark, "test-rejects")
    spark.createDataFrame([("a,1,NNL",), ("a,2",), ("b,3,NNN,more",), ("",)], "value string").write.text(src)
    for fmt in ("text", "csv"):
        with pytest.raises(Exception, match="malformed"):
            read_transactions(spark, src, fmt).collect()
        good = read_transactions(spark, src, fmt, mode="permissive")
        assert sorted(tuple(r) for r in good.collect()) == [("a", "1", "NNL"), ("b", "3", "NNN")]
        assert sorted(r.value for r in read_rejects(spark, src, fmt).collect()) == ["", "a,2"]
    quoted = work_path(spark, "test-quoted")
    spark.createDataFrame([('"a","1","NNL"',)], "value string").write.text(quoted)
    assert [tuple(r) for r in read_transactions(spark, quoted, "csv").collect()] == [("a", "1", "NNL")]


def test_stream_rejects(spark, seq_df):
    src, model, out = (work_path(spark, n) for n in ("test-sr", "test-sr-model", "test-sr-out"))
    good = [f"a,{i},{t}" for i, t in enumerate(["NNL", "NNN", "NNL", "NNS", "NNL", "NNN"])]
    spark.createDataFrame([(x,) for x in [*good, "broken", "b,2"]], "value string").write.text(src)
    save_model(train_model(seq_df({"a": ["NNL", "NNN", "NNL", "NNS", "NNL", "NNN"]}), CFG), model)
    common = ["stream", "--source", "text", "--path", src, "--model", model, "--threshold", "0.2", "--order-type", "bigint", "--available-now"]
    with pytest.raises(Exception, match="malformed"):
        main([*common, "--alerts-out", f"{out}/a1", "--checkpoint", f"{out}/ck1"])
    assert main([*common, "--alerts-out", f"{out}/a2", "--checkpoint", f"{out}/ck2", "--rejects-out", f"{out}/rejects"]) == 0
    assert read_alerts(spark, f"{out}/a2").count() == 2
    assert sorted(r.value for r in spark.read.text(f"{out}/rejects").collect()) == ["b,2", "broken"]
    assert read_reject_stream(spark, "text", path=src).isStreaming
    # the stored histories, as the command lists them
    assert main(["history", "--checkpoint", f"{out}/ck2", "--out", f"{out}/history", "--limit", "5"]) == 0
    assert [(r.customer_id, r.history) for r in spark.read.parquet(f"{out}/history").collect()] == [("a", "NNL,NNS,NNL,NNN")]


def test_every_alert_is_printed(spark, seq_df, capsys):
    tokens = ["NNL", "NNN"] * 20
    src, model = work_path(spark, "test-print"), work_path(spark, "test-print-model")
    rows = [("a", i, t) for i, t in enumerate(tokens)]
    schema = "customer_id string, transaction_id bigint, token string"
    spark.createDataFrame(rows, schema).write.parquet(src)
    save_model(train_model(seq_df({"a": tokens}), CFG), model)
    stream = read_transaction_stream(spark, "parquet", path=src)
    q = detect_stream(stream, model, CFG.with_(threshold=-1.0), checkpoint=work_path(spark, "test-print-ck"), sink_format="console", trigger={"availableNow": True})
    q.awaitTermination(300)
    shown = [x for x in capsys.readouterr().out.splitlines() if x.startswith("a : ")]
    assert len(shown) == len(tokens) - 4


def test_alerts_need_a_place(spark):
    stream = spark.readStream.format("rate").load()
    for sink in ("parquet", "nowhere"):
        with pytest.raises(ValueError):
            detect_stream(stream, "model", CFG, checkpoint="ck", sink_format=sink)


def test_slices_over_two_months(spark):
    """Day 31 and a second month belong to slices of their own, in order."""
    days = ["2024-01-01", "2024-01-31", "2024-02-01", "2024-02-05", "2024-03-01"]
    t = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp_ntz").alias("ts"))
    sliced, n = E._sliced(t)
    assert [r.slice for r in sliced.orderBy("ts").collect()] == [0, 6, 6, 7, 12] and n == 13
    assert E._sliced(t.limit(0))[1] == 0


def test_settings(spark, tmp_path):
    text = "\n".join([
        "scorer.algorithm=MissRate", "state.seq.windowSize=4", "metric.threshold=0.5", "batch.duration=7",
        "kafka.inputtopic=in", "kafka.xacttopic=hist", "kafka.fraudtopic=alerts", "model.path=/m", "sequence.file=/s",
        "transaction.file=/t", "metadata.broker.list=h:1", "kafka.port=9092",
    ])
    cfg = config_from_properties(text)
    assert (cfg.algorithm, cfg.window, cfg.threshold, cfg.batch_interval) == ("MissRate", 4, 0.5, "7 seconds")
    assert (cfg.input_topic, cfg.history_topic, cfg.alerts_topic, cfg.brokers) == ("in", "hist", "alerts", "h:1")
    assert (cfg.model_path, cfg.sequences_path, cfg.transactions_path) == ("/m", "/s", "/t")
    path = str(tmp_path / "states.txt")
    with open(path, "w") as f:
        f.write("X,Y,Z\n")
    assert read_states(spark, path) == ("X", "Y", "Z")
    tx, props, out = str(tmp_path / "tx"), str(tmp_path / "p"), str(tmp_path / "out")
    spark.createDataFrame([(f"a,{i},{t}",) for i, t in enumerate("XYXZX")], "value string").write.text(tx)
    with open(props, "w") as f:
        f.write(f"transaction.file={tx}\nmodel.path={out}/model.txt\nsequence.file={out}/sequences\n")
    assert main(["train", "--config", props, "--states", path, "--order-type", "bigint", "--model-out", f"{out}/model"]) == 0
    assert model_table(spark, f"{out}/model").count() == 4
    assert [r.value for r in spark.read.text(f"{out}/sequences").collect()] == ["a,X,Y,X,Z,X"]
    assert main(["score", "--config", props, "--states", path, "--order-type", "bigint", "--threshold", "0.2", "--scores-out", f"{out}/scores",
                 "--alerts-out", f"{out}/alerts"]) == 0
    assert spark.read.parquet(f"{out}/scores").count() == 1 and spark.read.parquet(f"{out}/alerts").count() == 1
    with pytest.raises(SystemExit):
        main(["train", "--model-out", f"{out}/none"])


def test_history_message_of_nulls(spark):
    df = spark.createDataFrame([(None, ["NNL", None])], "c string, t array<string>")
    assert df.select(history_message("c", "t").alias("m")).first().m == "NULL.NNL,NULL"


def test_a_loaded_model_is_checked(spark, seq_df):
    from chainwatch.operators.model import dense
    from chainwatch.sources.model_io import load_model, read_model_text, write_model_text

    model, text, big = (work_path(spark, n) for n in ("test-lm", "test-lm-text", "test-lm-big"))
    save_model(train_model(seq_df({"a": ["NNL", "NNN", "NNL"]}), CFG), model)
    loaded = load_model(spark, model, CFG)
    assert loaded.count() == 2
    write_model_text(loaded, CFG, text)
    cells = dense(read_model_text(spark, text, CFG), CFG)
    assert [r.n for r in cells.where("p > 0").collect()] == [None, None] and dense(loaded, CFG).where("n = 1").count() == 2
    loaded.withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("x").write.parquet(big)
    with pytest.raises(ValueError):
        load_model(spark, big, CFG)
