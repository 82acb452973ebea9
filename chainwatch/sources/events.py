"""Adapter for the supplied ``events`` table: events → ordered tokens.

The table has no Markov tokens, so a token is derived per event (customer =
``user_id``, order = ``(ts, event_id)``): amount class from ``value``, item
price class from ``props.k`` and time-lapse class from the gap to the same
customer's previous event.  This mapping belongs to the test data, not to the
anomaly model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import sequence_positions

# Fixed class boundaries of the token mapping (test-data contract).
AMOUNT_LOW = 20.0  # value < 20 → L
AMOUNT_NORMAL = 105.0  # value < 105 → N, else H
PRICE_NORMAL = 85  # props.k < 85 → N, else H
LAPSE_SHORT_US = 7_200_000_000  # gap < 2 h → S
LAPSE_NORMAL_US = 86_400_000_000  # gap < 24 h → N, else L; first event → N


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def token_expr(value: Column, k: Column, gap_us: Column) -> Column:
    amount = F.when(value < AMOUNT_LOW, "L").when(value < AMOUNT_NORMAL, "N").otherwise("H")
    price = F.when(k < PRICE_NORMAL, "N").otherwise("H")
    lapse = (
        F.when(gap_us.isNull(), "N")
        .when(gap_us < LAPSE_SHORT_US, "S")
        .when(gap_us < LAPSE_NORMAL_US, "N")
        .otherwise("L")
    )
    return F.concat(amount, price, lapse)


def event_tokens(events: DataFrame, **kw) -> DataFrame:
    """``(user_id, event_id, ts, pos, token)``, one row per event, ``pos``
    dense 1..n per user in ``(ts, event_id)`` order."""
    ev = events.select(
        "user_id",
        "event_id",
        "ts",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    pos = sequence_positions(ev, "user_id", ["ts", "event_id"], carry=["ts"], **kw)
    gap = F.expr("timestampdiff(MICROSECOND, prev_ts, ts)")
    return pos.select(
        "user_id",
        "event_id",
        "ts",
        "pos",
        token_expr(F.col("value"), F.col("k"), gap).alias("token"),
    )


def load_tokens(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return event_tokens(read_table(spark, sf_dir, "events"), **kw)
