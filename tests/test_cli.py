"""The command line composes the same jobs: train from raw transaction text,
score the written sequence lines with the dense text model."""

from pyspark.sql import functions as F

from chainwatch.__main__ import main
from chainwatch.session import work_path
from chainwatch.sources.events import load_tokens
from chainwatch.sources.model_io import model_table
from chainwatch.sources.transactions import write_transactions_text

from .conftest import SF001


def test_train_then_score(spark):
    tok = load_tokens(spark, SF001)
    tx = work_path(spark, "cli-tx")
    write_transactions_text(tok, tx, customer="user_id", transaction="event_id")
    seqs, model, model_txt, alerts = (work_path(spark, n) for n in ("cli-seq", "cli-model", "cli-model-txt", "cli-alerts"))
    assert main(["train", "--transactions", tx, "--numeric-order", "--sequences-out", seqs,
                 "--model-out", model, "--model-text-out", model_txt]) == 0
    assert model_table(spark, model).count() == 157
    assert spark.read.text(seqs).count() == 15
    assert main(["score", "--model", model_txt, "--model-format", "text", "--sequences", seqs,
                 "--alerts-out", alerts, "--threshold", "0.9"]) == 0
    got = spark.read.parquet(alerts)
    assert got.count() > 0 and got.where(F.col("score") <= 0.9).count() == 0


def test_stream_command(spark, seq_df):
    from chainwatch.config import MarkovConfig
    from chainwatch.plans.jobs import train_model
    from chainwatch.sources.model_io import save_model
    from chainwatch.streaming.detect import read_alerts

    toks = {"a": ["NNL", "NNN", "NNL", "NNS", "NNL", "NNN"]}
    src = work_path(spark, "cli-stream-in")
    rows = [("a", i + 1, t) for i, t in enumerate(toks["a"])]
    spark.createDataFrame(rows, "customer_id string, transaction_id bigint, token string").write.parquet(src)
    model = work_path(spark, "cli-stream-model")
    save_model(train_model(seq_df(toks), MarkovConfig()), model)
    out = work_path(spark, "cli-stream-out")
    assert main(["stream", "--source", "parquet", "--path", src, "--model", model, "--threshold", "0.2",
                 "--alerts-out", f"{out}/alerts", "--history-out", f"{out}/history",
                 "--checkpoint", f"{out}/ck", "--available-now"]) == 0
    got = sorted((r.customer_id, r.pos, r.score) for r in read_alerts(spark, f"{out}/alerts").collect())
    assert got == [("a", 1, 0.25), ("a", 2, 0.25)]
