"""The skew-safe paths give the same results as the plain ones.

Small ``hot_rows`` forces every customer through the range-sliced numbering;
small ``chunk`` forces every window and prefix sum across chunk halos."""

from pyspark.sql import functions as F

from chainwatch.config import MarkovConfig
from chainwatch.operators.scoring import score_windows
from chainwatch.plans.jobs import train_model
from chainwatch.sources.events import load_tokens

from .conftest import SF001

CFG = MarkovConfig()


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_hot_key_slices_match_plain_positions(spark):
    a = load_tokens(spark, SF001)
    b = load_tokens(spark, SF001, hot_rows=9)
    cols = ["user_id", "event_id", "pos", "token"]
    assert _rows(a, cols) == _rows(b, cols)


def test_small_chunks_match(spark):
    tok = load_tokens(spark, SF001).cache()
    model = train_model(tok, CFG, key="user_id")
    small = CFG.with_(chunk=7)
    model_small = train_model(tok, small, key="user_id")
    cols = ["user_id", "pos", "t0", "t4", "score"]
    for alg, cfg_mode in [("MissProbability", {}), ("MissRate", {}), ("EntropyReduction", {"zero_cell": "limit"})]:
        a = score_windows(tok, model, CFG.with_(**cfg_mode), "user_id", algorithm=alg)
        b = score_windows(tok, model_small, small.with_(**cfg_mode), "user_id", algorithm=alg)
        ra = [(r[:-1], round(r[-1], 9) if r[-1] is not None else None) for r in _rows(a, cols)]
        rb = [(r[:-1], round(r[-1], 9) if r[-1] is not None else None) for r in _rows(b, cols)]
        assert ra == rb, alg
    tok.unpersist()


def test_window_count_property(spark):
    tok = load_tokens(spark, SF001)
    from chainwatch.operators.sequences import token_windows

    n = tok.groupBy("user_id").count()
    expected = n.select(F.sum(F.greatest(F.col("count") - F.lit(CFG.window - 1), F.lit(0)))).first()[0]
    assert token_windows(tok, "user_id", CFG).count() == expected


def test_miss_rate_values(spark):
    tok = load_tokens(spark, SF001)
    s = score_windows(tok, train_model(tok, CFG, key="user_id"), CFG, "user_id", algorithm="MissRate")
    assert {r.score for r in s.select("score").distinct().collect()} <= {0.0, 0.25, 0.5, 0.75, 1.0}


def test_one_customer_with_a_third_of_all_rows(spark):
    """Every third event is re-assigned to customer -1, so one key holds a
    third of the table; its history is cut into several time blocks and
    several position chunks, and everything must equal a plain
    one-group-per-customer computation."""
    from pyspark.sql import Window

    from chainwatch.sources.events import event_tokens, read_table
    from .conftest import SF01

    ev = read_table(spark, SF01, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    )
    hot = event_tokens(ev, hot_rows=500)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = ev.select("user_id", "event_id", F.row_number().over(w).cast("bigint").alias("pos"))
    cols = ["user_id", "event_id", "pos"]
    assert _rows(hot, cols) == _rows(plain, cols)
    assert hot.where("user_id = -1").count() > 3000

    cfg_small = CFG.with_(chunk=97)
    tok = hot.cache()
    model = train_model(tok, CFG, key="user_id")
    a = score_windows(tok, model, CFG, "user_id")
    b = score_windows(tok, train_model(tok, cfg_small, key="user_id"), cfg_small, "user_id")
    c2 = ["user_id", "pos", "t0", "t1", "t2", "t3", "t4", "score"]
    assert _rows(a, c2) == _rows(b, c2)
    tok.unpersist()


def test_burst_inside_a_hot_key_is_split_again(spark):
    """Half of the hot customer's events are squeezed into one day, far
    narrower than its first-level blocks: the heavy block is cut again, and
    positions still equal the plain computation."""
    from pyspark.sql import Window

    from chainwatch.sources.events import event_tokens, read_table
    from .conftest import SF01

    ev = read_table(spark, SF01, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    )
    burst = F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00' + make_dt_interval(0, 0, 0, event_id * 8.64)")
    ev = ev.withColumn("ts", F.when(F.col("event_id") % 6 == 0, burst).otherwise(F.col("ts")))
    hot = event_tokens(ev, hot_rows=200)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = ev.select("user_id", "event_id", F.row_number().over(w).cast("bigint").alias("pos"))
    cols = ["user_id", "event_id", "pos"]
    assert _rows(hot, cols) == _rows(plain, cols)


def test_hot_key_with_one_timestamp(spark):
    """A third of all events belong to one customer and share one instant:
    the slices split them by the next order column."""
    from pyspark.sql import Window

    from chainwatch.sources.events import event_tokens, read_table
    from .conftest import SF01

    ev = read_table(spark, SF01, "events")
    same = F.col("event_id") % 3 == 0
    ev = ev.withColumn("user_id", F.when(same, F.lit(-1)).otherwise(F.col("user_id"))).withColumn(
        "ts", F.when(same, F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'")).otherwise(F.col("ts"))
    )
    hot = event_tokens(ev, hot_rows=200)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = ev.select("user_id", "event_id", F.row_number().over(w).cast("bigint").alias("pos"))
    cols = ["user_id", "event_id", "pos"]
    assert _rows(hot, cols) == _rows(plain, cols)
