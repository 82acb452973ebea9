"""Physical-plan properties that the scale design relies on."""

from pyspark.sql import functions as F

from chainwatch.config import MarkovConfig
from chainwatch.operators.scoring import score_windows
from chainwatch.operators.sequences import transitions
from chainwatch.operators.model import transition_counts
from chainwatch.plans.jobs import train_model
from chainwatch.sources.events import event_tokens, load_tokens, read_table

from .conftest import SF001

CFG = MarkovConfig()


def _final_plan(df) -> str:
    """The plan AQE settled on, after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_scoring_is_one_shuffle_without_joins(spark):
    tok = load_tokens(spark, SF001)
    s = score_windows(tok, train_model(tok, CFG, key="user_id"), CFG, "user_id")
    plan = _final_plan(s)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan and "BroadcastExchange" not in plan
    assert plan.count("Window [") == 2


def test_scan_reads_only_used_columns(spark):
    tok = load_tokens(spark, SF001)
    plan = tok.select("user_id", "pos", "token")._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan  # pruned at the parquet scan


def test_transition_counts_aggregate_map_side(spark):
    tok = load_tokens(spark, SF001)
    c = transition_counts(transitions(tok, "user_id", CFG), CFG)
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_hot_key_windows_shuffle_on_key_and_chunk(spark):
    ev = read_table(spark, SF001, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    )
    tok = event_tokens(ev, hot_rows=100)
    n = tok.where("user_id = -1").count()
    cut = CFG.with_(chunk=32)
    s = score_windows(tok, train_model(tok, CFG, key="user_id"), cut, "user_id").where("user_id = -1")
    # the hot customer's windows come out of several partitions, a chunk or a few each
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is tiny
    try:
        parts = [r["count"] for r in s.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(parts) == n - 4 and len(parts) > 1 and max(parts) < n / 2
