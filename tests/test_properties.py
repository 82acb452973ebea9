"""Properties of the model and configuration on the supplied data."""

import pytest
from pyspark.sql import functions as F

from chainwatch.config import DEFAULT_STATES, MarkovConfig, config_from_properties
from chainwatch.operators.model import dense
from chainwatch.plans.jobs import train_model
from chainwatch.session import work_path
from chainwatch.sources.events import load_tokens
from chainwatch.sources.transactions import read_transactions, write_transactions_text

from .conftest import SF001

CFG = MarkovConfig()


def test_seen_rows_sum_to_one(spark):
    m = train_model(load_tokens(spark, SF001), CFG, key="user_id")
    sums = [r.s for r in dense(m, CFG).groupBy("src_idx").agg(F.sum("p").alias("s")).collect()]
    assert len(sums) == CFG.n_states
    assert all(s == pytest.approx(1.0) or s == 0.0 for s in sums)
    assert m.count() == 157  # FIXTURES: model cells at sf0.001


def test_config_from_properties():
    text = """model.path=/data/model.txt
scorer.algorithm=MissRate
state.seq.windowSize=6
metric.threshold=0.9
batch.duration=10
kafka.host=localhost
"""
    cfg = config_from_properties(text, ",".join(DEFAULT_STATES))
    assert (cfg.algorithm, cfg.window, cfg.threshold, cfg.batch_interval) == ("MissRate", 6, 0.9, "10 seconds")
    assert cfg.states == DEFAULT_STATES
    with pytest.raises(ValueError):
        config_from_properties("metric.threshold=high")


def test_transactions_csv_and_text(spark):
    t = load_tokens(spark, SF001)
    path = work_path(spark, "test-tx")
    write_transactions_text(t, path, customer="user_id", transaction="event_id")
    a = read_transactions(spark, path, "text")
    b = read_transactions(spark, path, "csv")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(a) == rows(b) and len(rows(a)) == 1000


def test_recommended_conf_sizes_partitions():
    from chainwatch.session import recommended_conf

    conf = recommended_conf(100 * (1 << 40))  # 100 TiB
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 4096
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(recommended_conf(1 << 20)["spark.sql.shuffle.partitions"]) == 200
