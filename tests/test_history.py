"""The history table, joint commits and model versions of the stream."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import replay_slices
from chainwatch.config import MarkovConfig
from chainwatch.operators.ordering import sequence_positions
from chainwatch.operators.scoring import detect, score_windows
from chainwatch.plans.jobs import train_model
from chainwatch.session import work_path
from chainwatch.sources.commits import KEPT, CommitLog, Files
from chainwatch.sources.events import load_tokens
from chainwatch.sources.model_io import load_model, model_table, model_version, save_model
from chainwatch.streaming import detect as streaming
from chainwatch.streaming.detect import ModelTerms, detect_stream, read_alerts, read_history, read_output, with_history
from chainwatch.streaming.history import HistoryTable, commit_log

from .conftest import SF001

CFG = MarkovConfig(threshold=-1.0)


def sliced(spark, n):
    t = load_tokens(spark, SF001).select("user_id", "event_id", "ts", "token")
    t = t.withColumn("user_id", F.when(F.col("user_id") > 3, F.col("user_id")))  # NULL is a customer
    return t.withColumn("slice", F.floor((F.dayofmonth("ts") - 1) / (31 / n)).cast("int"))


def whole(rows, model):
    t = sequence_positions(rows, "user_id", ["ts", "event_id"])
    s = detect(score_windows(t, model, CFG, "user_id"), CFG, "user_id").collect()
    tails = {}
    for r in t.orderBy("pos").collect():
        tails.setdefault(r.user_id, []).append(r.token)
    return sorted(((r.user_id or -1), r.pos, r.message) for r in s), tails


def alerts(spark, paths):
    return sorted(((r.user_id or -1), r.pos, r.message) for r in read_alerts(spark, paths["alerts"]).collect())


@pytest.fixture(scope="module")
def trained(spark):
    rows = sliced(spark, 5)
    path = work_path(spark, "test-history-model")
    save_model(train_model(sequence_positions(rows, "user_id", ["ts", "event_id"]), CFG, key="user_id"), path)
    return rows, path


def test_compacted_history_equals_the_whole(spark, trained):
    rows, path = trained
    paths = replay_slices(rows, "slice", range(5), path, CFG, work_path(spark, "test-compact"), key="user_id", order=["ts", "event_id"], compact=2)
    want, tokens = whole(rows, load_model(spark, path, CFG))
    assert alerts(spark, paths) == want
    got = {r.user_id: (r.history, r.n_seen) for r in read_history(spark, paths["checkpoint"], key="user_id").collect()}
    assert got == {c: (",".join(t[-4:]), len(t)) for c, t in tokens.items()}
    number, entry = commit_log(spark, paths["checkpoint"]).latest()
    folders = Files(spark, f"{paths['checkpoint']}/chainwatch/history").names()
    assert any(f.startswith("base-") for f in entry["history"]) and len(entry["history"]) <= 2
    assert set(entry["history"]) <= set(folders) and len(folders) < 5


def test_stored_batches_come_in_pieces(spark, trained):
    """``retain="batch"`` keeps the carried and the batch's tokens, cut like any
    sequence; a customer's history is in no row longer than a chunk."""
    rows, path = trained
    cfg = CFG.with_(chunk=16)
    paths = replay_slices(rows, "slice", range(2), path, cfg, work_path(spark, "test-pieces"), key="user_id", order=["ts", "event_id"], retain="batch")
    tokens = whole(rows.where("slice < 2"), load_model(spark, path, CFG))[1]
    last = {r.user_id: r.n for r in rows.where("slice < 2").groupBy("user_id", "slice").agg(F.count("*").alias("n")).orderBy("slice").collect()}
    table = HistoryTable(spark, paths["checkpoint"], cfg, "user_id", "batch")
    pieces = table.read(commit_log(spark, paths["checkpoint"]).latest()[1]["history"]).orderBy("first_pos").collect()
    assert max(len(r.tokens) for r in pieces) <= 16
    got = {}
    for r in pieces:
        got.setdefault(r.user_id, []).extend(r.tokens)
    assert got == {c: t[max(0, len(t) - last[c] - 4) :] for c, t in tokens.items()}


@pytest.mark.parametrize("where", ["messages", "history", "commit"])
def test_a_crash_leaves_no_part_of_a_batch(spark, trained, monkeypatch, where):
    rows, path = trained
    out = work_path(spark, f"test-crash-{where}")
    options = {"key": "user_id", "order": ["ts", "event_id"]}
    real = {"messages": streaming.history_messages, "history": HistoryTable.write, "commit": CommitLog.add}

    def failing(kind, position):
        def run(*a, **k):
            value = real[kind](*a, **k) if kind == "history" else None
            if commit_log(spark, f"{out}/checkpoint").latest()[1].get("rows"):  # slice 0 is committed
                raise RuntimeError("lost the driver")
            return value if kind == "history" else real[kind](*a, **k)

        return run

    target = {"messages": (streaming, "history_messages"), "history": (HistoryTable, "write"), "commit": (CommitLog, "add")}[where]
    monkeypatch.setattr(*target, failing(where, 0))
    with pytest.raises(Exception, match="lost the driver"):
        replay_slices(rows, "slice", [0, 1], path, CFG, out, **options)
    first = whole(rows.where("slice = 0"), load_model(spark, path, CFG))[0]
    paths = {n: f"{out}/{n}" for n in ("alerts", "history", "checkpoint", "input")}
    assert alerts(spark, paths) == first
    committed = commit_log(spark, paths["checkpoint"]).latest()[0]
    assert {r.batch_id for r in read_output(spark, paths["history"]).select("batch_id").distinct().collect()} == {committed}
    seen = read_history(spark, paths["checkpoint"], key="user_id").agg(F.sum("n_seen")).first()[0]
    assert seen == rows.where("slice = 0").count()
    monkeypatch.undo()
    schema = rows.drop("slice").schema
    q = detect_stream(spark.readStream.schema(schema).parquet(paths["input"]), path, CFG, alerts_path=paths["alerts"],
                      history_path=paths["history"], checkpoint=paths["checkpoint"], trigger={"availableNow": True}, **options)
    q.awaitTermination(300)
    assert alerts(spark, paths) == whole(rows.where("slice < 2"), load_model(spark, path, CFG))[0]


def test_retraining_during_a_stream(spark, trained):
    """The next batch takes the new version; files of the old one are not replaced."""
    rows, first = trained
    path, out = work_path(spark, "test-retrain-model"), work_path(spark, "test-retrain")
    model = load_model(spark, first, CFG)
    save_model(model, path)
    lazy = model_table(spark, path)
    options = {"key": "user_id", "order": ["ts", "event_id"]}
    replay_slices(rows, "slice", [0], path, CFG, out, **options)
    before = model_version(spark, path)
    other = model.withColumn("n", F.col("n") + 1).withColumn("row_total", F.sum("n").over(streaming_window()))
    save_model(other.withColumn("p", F.col("n") / F.col("row_total")), path)
    assert model_version(spark, path) != before and lazy.count() == model.count()
    paths = replay_slices(rows, "slice", [1], path, CFG, out, **options)
    last, entry = commit_log(spark, paths["checkpoint"]).latest()
    assert entry["model"] == model_version(spark, path)
    two = whole(rows.where("slice < 2"), load_model(spark, path, CFG))[0]
    second = sorted(((r.user_id or -1), r.pos, r.message) for r in read_alerts(spark, paths["alerts"]).where(F.col("batch_id") == last).collect())
    assert second and set(second) <= set(two)


def streaming_window():
    from pyspark.sql import Window

    return Window.partitionBy("src_idx")


def test_terms_are_read_once_per_version(spark, trained, monkeypatch):
    _, path = trained
    calls = []
    real = streaming.load_model
    monkeypatch.setattr(streaming, "load_model", lambda *a: calls.append(1) or real(*a))
    terms = ModelTerms(path, CFG)
    a, b = terms.current(spark), terms.current(spark)
    assert a["terms"] is b["terms"] and len(calls) == 1


def test_one_customers_batch_is_several_tasks_without_python(spark):
    rows = load_tokens(spark, SF001).select((F.col("user_id") * 0 + 7).cast("int").alias("user_id"), "ts", "event_id", "token")
    tails = spark.createDataFrame([(7, 100, ["NNL", "NNN", "NNS", "NHL"])], "user_id int, n_seen bigint, tail array<string>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        long = with_history(rows, tails, key="user_id", order=["ts", "event_id"], hot_rows=100)
        spread = long.where("is_new").groupBy(F.spark_partition_id()).agg(F.count("*").alias("count"), F.max("pos")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    n = rows.count()
    assert len(spread) > 3 and max(r["count"] for r in spread) < n / 2
    assert [r.pos for r in long.orderBy("pos").collect()] == list(range(97, 101 + n))
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_commit_log(spark):
    log = CommitLog(spark, work_path(spark, "test-log"))
    assert log.latest() == (-1, {})
    for n in range(KEPT + 3):
        log.add(n, {"n": n, "text": "é"})
    assert log.latest() == (KEPT + 2, {"n": KEPT + 2, "text": "é"}) and len(log.numbers()) == KEPT
    with pytest.raises(RuntimeError, match="exists"):
        log.add(KEPT + 2, {})
    assert log.latest()[1]["n"] == KEPT + 2 and not [n for n in log.files.names() if n.startswith(".") and not n.endswith(".crc")]
