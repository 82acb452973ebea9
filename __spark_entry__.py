"""

Every query reads the supplied ``events`` table (tokens are derived from it,
see ``chainwatch.sources.events``) and runs over the whole table.  Each
``oracle_sql`` entry recomputes the same result in DuckDB from the raw
tables, starting from the token CTE of FIXTURES.md."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainwatch.config import DEFAULT_STATES, MarkovConfig
from chainwatch.functions.states import read_states, state_index
from chainwatch.functions.text import parse_transaction_lines, transaction_line
from chainwatch.operators.arrays import score_sequences
from chainwatch.operators.ordering import sequence_positions
from chainwatch.operators.model import best_successor, dense, row_entropy, row_totals, train, transition_counts
from chainwatch.operators.scoring import detect, score_windows
from chainwatch.operators.sequences import (
    build_sequences,
    lines_to_long,
    sequence_lines,
    sequence_tails,
    token_windows,
    transitions,
    window_token_cols,
)
from chainwatch.plans.jobs import holdout_split, train_model, transactions_to_tokens
from chainwatch.session import work_path
from chainwatch.sources.events import load_tokens
from chainwatch.sources.model_io import read_model_text, save_model, write_model_text
from chainwatch.sources.transactions import (
    read_sequence_lines,
    read_sequences,
    read_transaction_stream,
    read_transactions,
    write_sequence_lines,
    write_sequences,
    write_transactions_text,
)
from chainwatch.streaming.detect import detect_stream, history_messages, read_alerts, read_history, read_output

CFG = MarkovConfig()
KEY = "user_id"
WINDOW_COLS = window_token_cols(CFG.window)
HOLDOUT_TS = "2024-01-16 00:00:00"
SLICE_DAYS = 5


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_tokens(spark, sf_dir)


def _model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_model(_tokens(spark, sf_dir), CFG, key=KEY)


def _sliced(tokens: DataFrame) -> tuple[DataFrame, int]:
    """Tokens with the stream slice of each: spans of five days since the first
    event, however long the table runs; and the number of slices."""
    first, last = tokens.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    if first is None:
        return tokens.withColumn("slice", F.lit(0)), 0
    days = F.datediff(F.to_date("ts"), F.lit(first))
    return tokens.withColumn("slice", F.floor(days / SLICE_DAYS).cast("int")), (last - first).days // SLICE_DAYS + 1


# --------------------------------------------------------------------------
# queries


def q_tokens(spark, sf_dir):
    t = _tokens(spark, sf_dir)
    return t.select(KEY, "event_id", "pos", "token", state_index("token", CFG.states).alias("state_idx"))


def q_parse_transactions(spark, sf_dir):
    t = _tokens(spark, sf_dir)
    path = work_path(spark, "transactions-text")
    t.select(transaction_line(KEY, "event_id", "token").alias("value")).write.mode("overwrite").text(path)
    parsed = parse_transaction_lines(spark.read.text(path), mode="strict")
    return parsed.select("customer_id", "transaction_id", "token")


def q_transactions_to_sequences(spark, sf_dir):
    """Raw transaction lines → text → parse → order by transaction id →
    sequence lines (the training-set builder)."""
    t = _tokens(spark, sf_dir)
    path = work_path(spark, "raw-transactions")
    write_transactions_text(t, path, customer=KEY, transaction="event_id", token="token")
    tx = read_transactions(spark, path).withColumn("txn", F.col("transaction_id").cast("bigint"))
    long = transactions_to_tokens(tx, key="customer_id", order=["txn"])
    out = work_path(spark, "sequence-lines")
    write_sequence_lines(build_sequences(long, "customer_id", CFG), out)
    return spark.read.text(out).select(
        F.substring_index("value", ",", 1).alias("customer_id"),
        (F.size(F.split("value", ",")) - 1).cast("bigint").alias("n_tokens"),
        F.col("value").alias("line"),
    )


def q_sequence_lines(spark, sf_dir):
    return sequence_lines(build_sequences(_tokens(spark, sf_dir), KEY, CFG), KEY).select(F.col("value").alias("line"))


def q_sequence_pieces(spark, sf_dir):
    """Sequences cut into pieces of 7 tokens, through text lines and back: all
    transitions, as if nothing had been cut."""
    small = CFG.with_(chunk=7)
    path = work_path(spark, "sequence-pieces")
    write_sequence_lines(build_sequences(_tokens(spark, sf_dir), KEY, small), path, key=KEY)
    long = read_sequence_lines(spark, path)
    return transitions(long, ["customer_id", "line_id"], CFG).select("customer_id", "pos", "src", "dst")


def q_sequence_table_scores(spark, sf_dir):
    """The parquet hand-off, cut into pieces of 7 tokens: scores of all windows."""
    t = _tokens(spark, sf_dir)
    path = work_path(spark, "sequence-table")
    write_sequences(build_sequences(t, KEY, CFG.with_(chunk=7)), path)
    s = score_windows(read_sequences(spark, path, key=KEY), train_model(t, CFG, key=KEY), CFG, KEY)
    return s.select(KEY, "pos", *WINDOW_COLS, "score")


def _stored(spark, sf_dir, cfg):
    """The tokens, and their sequences read back from parquet."""
    t = _tokens(spark, sf_dir)
    path = work_path(spark, "stored-sequences")
    write_sequences(build_sequences(t, KEY, cfg), path)
    return t, spark.read.parquet(path)


def q_array_scores(spark, sf_dir):
    """Windows scored inside the stored arrays: one row a customer."""
    t, stored = _stored(spark, sf_dir, CFG)
    return score_sequences(stored, train_model(t, CFG, key=KEY), CFG, KEY).select(KEY, "pos", *WINDOW_COLS, "score")


def q_array_scores_pieces(spark, sf_dir):
    """The same with sequences cut into pieces of 7 tokens, by miss rate."""
    t, stored = _stored(spark, sf_dir, CFG.with_(chunk=7))
    s = score_sequences(stored, train_model(t, CFG, key=KEY), CFG, KEY, algorithm="MissRate")
    return s.select(KEY, "pos", *WINDOW_COLS, "score")


def q_array_entropy_pieces(spark, sf_dir):
    """Entropy needs the sums of all earlier pieces."""
    cfg = CFG.with_(chunk=7, zero_cell="limit")
    t, stored = _stored(spark, sf_dir, cfg)
    s = score_sequences(stored, train_model(t, cfg, key=KEY), cfg, KEY, algorithm="EntropyReduction")
    return s.select(KEY, "pos", *WINDOW_COLS, F.round("score", 9).alias("score"))


def _null_tokens(spark, sf_dir):
    """Every seventh customer is NULL; their tokens are one sequence."""
    t = _tokens(spark, sf_dir).select(F.when(F.col(KEY) % 7 != 0, F.col(KEY)).alias(KEY), "ts", "event_id", "token")
    return sequence_positions(t, KEY, ["ts", "event_id"], hot_rows=500)


def q_null_token_pieces(spark, sf_dir):
    """NULL tokens, and NULL and empty customers, cut into pieces of 7 tokens,
    through text lines and back."""
    who = F.when(F.col(KEY) % 7 == 1, F.lit("")).when(F.col(KEY) % 7 != 0, F.col(KEY).cast("string"))
    token = F.when(F.col("event_id") % 11 != 0, F.col("token"))
    t = _tokens(spark, sf_dir).select(who.alias("customer"), "ts", "event_id", token.alias("token"))
    t = sequence_positions(t, "customer", ["ts", "event_id"])
    path = work_path(spark, "null-pieces")
    write_sequence_lines(build_sequences(t, "customer", CFG.with_(chunk=7)), path, key="customer")
    long = read_sequence_lines(spark, path)
    return transitions(long, ["customer_id", "line_id"], CFG).select("customer_id", "pos", "src", "dst")


def q_null_customer_scores(spark, sf_dir):
    """A NULL customer that is also hot keeps all its windows, in order."""
    t = _null_tokens(spark, sf_dir)
    s = score_windows(t, train_model(t, CFG, key=KEY), CFG.with_(zero_cell="limit", chunk=300), KEY, algorithm="EntropyReduction")
    return s.select(KEY, "pos", *WINDOW_COLS, F.round("score", 9).alias("score"))


def q_states_file(spark, sf_dir):
    """The state dictionary read from a file, and each token's index in it."""
    path = work_path(spark, "states")
    spark.createDataFrame([(",".join(DEFAULT_STATES),)], "value string").write.text(path)
    states = read_states(spark, path)
    return _tokens(spark, sf_dir).select(KEY, "pos", "token", state_index("token", states).alias("state_idx"))


def q_transitions(spark, sf_dir):
    return transitions(_tokens(spark, sf_dir), KEY, CFG).select(KEY, "pos", "src", "dst")


def q_transition_counts(spark, sf_dir):
    return transition_counts(transitions(_tokens(spark, sf_dir), KEY, CFG), CFG)


def q_row_totals(spark, sf_dir):
    return row_totals(_model(spark, sf_dir))


def q_transition_probabilities(spark, sf_dir):
    return _model(spark, sf_dir)


def q_dense_model(spark, sf_dir):
    return dense(_model(spark, sf_dir), CFG)


def q_model_text_roundtrip(spark, sf_dir):
    path = work_path(spark, "model-text")
    write_model_text(_model(spark, sf_dir), CFG, path)
    back = read_model_text(spark, path, CFG)
    return dense(back, CFG).select("src_idx", "dst_idx", "p")


def q_sequence_text_model(spark, sf_dir):
    path = work_path(spark, "sequence-text")
    sequence_lines(build_sequences(_tokens(spark, sf_dir), KEY, CFG), KEY).write.mode("overwrite").text(path)
    long = lines_to_long(spark.read.text(path))
    model = train(transitions(long, ["customer_id", "line_id"], CFG), CFG)
    return model.select("src", "dst", "n", "row_total", "p")


def q_score_text_model(spark, sf_dir):
    """Score with a model that went through the dense text file (it carries
    probabilities only, so the miss probability is the row sum minus the
    cell)."""
    t = _tokens(spark, sf_dir)
    path = work_path(spark, "score-model-text")
    write_model_text(train_model(t, CFG, key=KEY), CFG, path)
    s = score_windows(t, read_model_text(spark, path, CFG), CFG, KEY)
    return s.select(KEY, "pos", *WINDOW_COLS, F.round("score", 9).alias("score"))


def q_carry_tails(spark, sf_dir):
    tails = sequence_tails(_tokens(spark, sf_dir), KEY, CFG.window - 1)
    return tails.select(KEY, "n_tokens", F.array_join("tail", ",").alias("tail"))


def q_best_successor(spark, sf_dir):
    return best_successor(_model(spark, sf_dir), CFG)


def q_row_entropy(spark, sf_dir):
    e = row_entropy(_model(spark, sf_dir), CFG)
    return e.select(
        "src_idx",
        "src",
        F.round("entropy_limit", 9).alias("entropy_limit"),
        F.round("entropy_reference", 9).alias("entropy_reference"),
    )


def q_token_windows(spark, sf_dir):
    return token_windows(_tokens(spark, sf_dir), KEY, CFG).select(KEY, "pos", *WINDOW_COLS)


def _scored(spark, sf_dir, algorithm, cfg=CFG):
    t = _tokens(spark, sf_dir)
    return score_windows(t, train_model(t, cfg, key=KEY), cfg, KEY, algorithm=algorithm)


def q_score_miss_probability(spark, sf_dir):
    return _scored(spark, sf_dir, "MissProbability").select(KEY, "pos", *WINDOW_COLS, "score")


def q_detect_miss_probability(spark, sf_dir):
    s = _scored(spark, sf_dir, "MissProbability")
    return detect(s, CFG, KEY).select(KEY, "pos", *WINDOW_COLS, "score")


def q_score_miss_rate(spark, sf_dir):
    return _scored(spark, sf_dir, "MissRate").select(KEY, "pos", *WINDOW_COLS, "score")


def q_detect_miss_rate(spark, sf_dir):
    s = _scored(spark, sf_dir, "MissRate")
    return detect(s, CFG, KEY).select(KEY, "pos", *WINDOW_COLS, "score")


def q_score_entropy_reference(spark, sf_dir):
    s = _scored(spark, sf_dir, "EntropyReduction", CFG.with_(zero_cell="undefined"))
    return s.select(KEY, "pos", *WINDOW_COLS, F.round("score", 9).alias("score"))


def q_score_entropy_limit(spark, sf_dir):
    s = _scored(spark, sf_dir, "EntropyReduction", CFG.with_(zero_cell="limit"))
    return s.select(KEY, "pos", *WINDOW_COLS, F.round("score", 9).alias("score"))


def q_detect_holdout(spark, sf_dir):
    t = _tokens(spark, sf_dir)
    before, after = holdout_split(t, "ts", F.lit(HOLDOUT_TS).cast("timestamp_ntz"), key=KEY)
    model = train_model(before, CFG, key=KEY)
    s = score_windows(after, model, CFG, KEY)
    return detect(s, CFG, KEY).select(KEY, "pos", *WINDOW_COLS, "score")


def q_history_messages(spark, sf_dir):
    t, _ = _sliced(_tokens(spark, sf_dir))
    return history_messages(t.withColumn("is_new", F.lit(True)), key=KEY, by=["slice"])


def replay_slices(rows: DataFrame, slice_col: str, slices, model_path: str, cfg: MarkovConfig, workdir: str, **options) -> dict[str, str]:
    """Feed the stream from a table: one query runs all the time, and each slice is
    appended to its input folder once the one before is done, so slices are
    consumed strictly in order."""
    spark = rows.sparkSession
    paths = {n: f"{workdir}/{n}" for n in ("input", "checkpoint", "alerts", "history")}
    source = rows.persist()
    try:
        source.limit(0).drop(slice_col).write.mode("append").parquet(paths["input"])
        stream = spark.readStream.schema(rows.drop(slice_col).schema).parquet(paths["input"])
        outputs = {"alerts_path": paths["alerts"], "history_path": paths["history"], "checkpoint": paths["checkpoint"]}
        q = detect_stream(stream, model_path, cfg, **outputs, trigger={"processingTime": "0 seconds"}, **options)
        try:
            for s in slices:
                source.where(F.col(slice_col) == F.lit(s)).drop(slice_col).write.mode("append").parquet(paths["input"])
                q.processAllAvailable()
        finally:
            q.stop()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    finally:
        source.unpersist()
    return paths


def _replayed(spark, sf_dir):
    t, slices = _sliced(_tokens(spark, sf_dir))
    model_path = work_path(spark, "stream-model")
    save_model(train_model(t, CFG, key=KEY), model_path)
    # history rows as the original stores them: carry + last batch
    return replay_slices(t, "slice", range(slices), model_path, CFG, work_path(spark, "stream"), key=KEY, order=["ts", "event_id"], retain="batch")


def q_stream_detect(spark, sf_dir):
    paths = _replayed(spark, sf_dir)
    return read_alerts(spark, paths["alerts"]).select(KEY, "pos", *WINDOW_COLS, "score")


def q_stream_history(spark, sf_dir):
    paths = _replayed(spark, sf_dir)
    return read_history(spark, paths["checkpoint"], key=KEY)


def q_stream_history_messages(spark, sf_dir):
    """What the stream wrote to its history output."""
    paths = _replayed(spark, sf_dir)
    return read_output(spark, paths["history"]).select(KEY, "message")


def q_text_stream_detect(spark, sf_dir):
    """Transaction lines as a text stream, ordered by ids of unequal length."""
    t = _tokens(spark, sf_dir)
    src, model, out = (work_path(spark, n) for n in ("text-stream", "text-stream-model", "text-stream-out"))
    save_model(train_model(t, CFG, key=KEY), model)
    # ids in time order, as a feed would number them
    numbered = t.select(KEY, F.col("pos").alias("txn"), "token")
    write_transactions_text(numbered, src, customer=KEY, transaction="txn")
    stream = read_transaction_stream(spark, "text", path=src).withColumn("_order", F.col("transaction_id").cast("bigint"))
    q = detect_stream(stream, model, CFG, alerts_path=f"{out}/alerts", checkpoint=f"{out}/ck", order=["_order"], trigger={"availableNow": True})
    q.awaitTermination()
    return read_alerts(spark, f"{out}/alerts").select("customer_id", "pos", *WINDOW_COLS, "score")


def q_byte_records_detect(spark, sf_dir):
    """A recorded topic of byte records, ordered by (partition, offset)."""
    t = _tokens(spark, sf_dir)
    src, model, out = (work_path(spark, n) for n in ("records", "records-model", "records-out"))
    save_model(train_model(t, CFG, key=KEY), model)
    t = t.withColumn("partition", F.pmod(F.xxhash64(KEY), F.lit(4)).cast("int"))
    t = sequence_positions(t.drop("pos"), "partition", ["ts", "event_id"], pos="offset")
    line = transaction_line(KEY, "event_id", "token").cast("binary")
    t.select(F.col(KEY).cast("string").cast("binary").alias("key"), line.alias("value"), "partition", "offset").write.parquet(src)
    stream = read_transaction_stream(spark, "records", path=src)
    order = ["kafka_partition", "kafka_offset"]
    q = detect_stream(stream, model, CFG, alerts_path=f"{out}/alerts", checkpoint=f"{out}/ck", order=order, trigger={"availableNow": True})
    q.awaitTermination()
    return read_alerts(spark, f"{out}/alerts").select("customer_id", "pos", *WINDOW_COLS, "score")


def q_stream_rejects(spark, sf_dir):
    """Every fifth line has lost its token: one read of the source gives alerts and
    histories from the good lines and the others as rejects."""
    t = _tokens(spark, sf_dir)
    src, model, out = (work_path(spark, n) for n in ("torn-lines", "torn-model", "torn-out"))
    save_model(train_model(t, CFG, key=KEY), model)
    line = F.when(F.col("event_id") % 5 == 0, F.concat_ws(",", KEY, "event_id")).otherwise(transaction_line(KEY, "event_id", "token"))
    t.select(line.alias("value")).write.text(src)
    stream = read_transaction_stream(spark, "text", path=src, mode="mark").withColumn("_order", F.col("transaction_id").cast("bigint"))
    outputs = {"alerts_path": f"{out}/alerts", "history_path": f"{out}/history", "rejects_path": f"{out}/rejects", "checkpoint": f"{out}/ck"}
    detect_stream(stream, model, CFG, **outputs, order=["_order"], trigger={"availableNow": True}).awaitTermination()
    rejects = read_output(spark, f"{out}/rejects", "text").select(F.lit("reject").alias("kind"), F.col("value").alias("line"))
    seen = read_output(spark, f"{out}/history").select(F.lit("history").alias("kind"), F.col("message").alias("line"))
    return rejects.union(seen)


def q_read_history_limit(spark, sf_dir):
    """A listing capped at 20 customers: how many rows it has, and how many of them
    are rows of the whole listing."""
    t, _ = _sliced(_tokens(spark, sf_dir))
    model = work_path(spark, "limit-model")
    save_model(train_model(t, CFG, key=KEY), model)
    paths = replay_slices(t.withColumn("slice", F.lit(0)), "slice", [0], model, CFG, work_path(spark, "limit-stream"), key=KEY, order=["ts", "event_id"])
    some = read_history(spark, paths["checkpoint"], key=KEY, limit=20)
    known = read_history(spark, paths["checkpoint"], key=KEY).withColumn("known", F.lit(1))
    return some.join(known, [KEY, "history", "n_seen"], "left").agg(F.count("*").alias("n_rows"), F.count("known").alias("n_known"))


def q_alert_text(spark, sf_dir):
    """Alert messages in full, with the score's text."""
    return detect(_scored(spark, sf_dir, "MissProbability"), CFG, KEY).select(KEY, "pos", "message")


def q_alert_messages(spark, sf_dir):
    s = detect(_scored(spark, sf_dir, "MissProbability"), CFG, KEY)
    head = F.expr("substring(message, 1, length(message) - length(cast(score as string)))")
    # the score text is left out of the compared columns: it is printed by
    # the JVM's double formatting, which SQL engines do not share
    return s.select(KEY, "pos", head.alias("message_head"), F.round("score", 9).alias("score"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tokens": q_tokens,
    "parse_transactions": q_parse_transactions,
    "transactions_to_sequences": q_transactions_to_sequences,
    "sequence_lines": q_sequence_lines,
    "sequence_pieces": q_sequence_pieces,
    "sequence_table_scores": q_sequence_table_scores,
    "array_scores": q_array_scores,
    "array_scores_pieces": q_array_scores_pieces,
    "array_entropy_pieces": q_array_entropy_pieces,
    "null_token_pieces": q_null_token_pieces,
    "null_customer_scores": q_null_customer_scores,
    "states_file": q_states_file,
    "transitions": q_transitions,
    "transition_counts": q_transition_counts,
    "row_totals": q_row_totals,
    "transition_probabilities": q_transition_probabilities,
    "dense_model": q_dense_model,
    "model_text_roundtrip": q_model_text_roundtrip,
    "sequence_text_model": q_sequence_text_model,
    "score_text_model": q_score_text_model,
    "carry_tails": q_carry_tails,
    "best_successor": q_best_successor,
    "row_entropy": q_row_entropy,
    "token_windows": q_token_windows,
    "score_miss_probability": q_score_miss_probability,
    "detect_miss_probability": q_detect_miss_probability,
    "score_miss_rate": q_score_miss_rate,
    "detect_miss_rate": q_detect_miss_rate,
    "score_entropy_reference": q_score_entropy_reference,
    "score_entropy_limit": q_score_entropy_limit,
    "detect_holdout": q_detect_holdout,
    "history_messages": q_history_messages,
    "stream_detect": q_stream_detect,
    "stream_history": q_stream_history,
    "stream_history_messages": q_stream_history_messages,
    "text_stream_detect": q_text_stream_detect,
    "byte_records_detect": q_byte_records_detect,
    "stream_rejects": q_stream_rejects,
    "read_history_limit": q_read_history_limit,
    "alert_text": q_alert_text,
    "alert_messages": q_alert_messages,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: miss-probability alerts on sf0.001 (train + score + detect)."""
    return q_detect_miss_probability(spark, "/root/testdata/sf0.001")


def _text_operators():
    """Queries and SQL of the text-corpus operators, which are optional: without
    ``chainwatch/llm``, ``corpus_pipeline.py`` or a library that only they need,
    everything else works."""
    own = {"corpus_pipeline", "public_tokenizers", "tokenizers", "xxhash", "zstandard", "regex", "numpy", "pyarrow"}
    try:
        import corpus_pipeline
        from chainwatch.llm import queries as text
    except ModuleNotFoundError as e:
        if e.name not in own and not (e.name or "").startswith("chainwatch.llm"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**text.queries(), "pipeline": corpus_pipeline.run}, {**text.oracle_sql(), **sql}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_text_operators()[0]}


# --------------------------------------------------------------------------
# DuckDB oracles

_S = "[" + ",".join(f"'{s}'" for s in DEFAULT_STATES) + "]"
_N = len(DEFAULT_STATES)

_TOK = f"""
g as (
  select *, epoch_us(ts) - lag(epoch_us(ts)) over w as gap,
         row_number() over w as pos
  from events window w as (partition by user_id order by ts, event_id)),
tok as (
  select user_id, event_id, ts, cast(pos as bigint) as pos,
    (case when value < 20 then 'L' when value < 105 then 'N' else 'H' end) ||
    (case when cast(json_extract_string(props, '$.k') as int) < 85 then 'N' else 'H' end) ||
    (case when gap is null then 'N' when gap < 7200000000 then 'S'
          when gap < 86400000000 then 'N' else 'L' end) as token
  from g)"""


def _model_ctes(tok: str = "tok") -> str:
    return f"""
tr as (
  select user_id, pos, token as src, lead(token) over (partition by user_id order by pos) as dst from {tok}),
counts as (select src, dst, count(*)::bigint as n from tr where dst is not null group by src, dst),
model as (
  select src, dst, (list_position({_S}, src) - 1)::bigint as src_idx,
         (list_position({_S}, dst) - 1)::bigint as dst_idx, n,
         (sum(n) over (partition by src))::bigint as row_total,
         n::double / (sum(n) over (partition by src))::bigint as p
  from counts),
grid as (select (i // {_N})::bigint as src_idx, (i % {_N})::bigint as dst_idx from range({_N * _N}) t(i)),
dense as (
  select g.src_idx, g.dst_idx, {_S}[g.src_idx + 1] as src, {_S}[g.dst_idx + 1] as dst,
         coalesce(m.n, 0)::bigint as n, coalesce(m.p, 0.0) as p
  from grid g left join model m on m.src_idx = g.src_idx and m.dst_idx = g.dst_idx),
tgrid as (select (i // {_N + 1})::bigint as src_idx, (i % {_N + 1} - 1)::bigint as dst_idx
          from range({_N * (_N + 1)}) t(i)),
mrows as (select src_idx, max(row_total) as row_total from model group by src_idx),
mp as (
  select g.src_idx, g.dst_idx,
         case when r.row_total is null then 0.0
              else (r.row_total - coalesce(m.n, 0))::double / r.row_total end as term
  from tgrid g left join model m on m.src_idx = g.src_idx and m.dst_idx = g.dst_idx
  left join mrows r on r.src_idx = g.src_idx),
best as (
  select src_idx, dst_idx as best_idx, p as best_p from (
    select *, row_number() over (partition by src_idx order by p desc, dst_idx) as rn from dense) where rn = 1),
mr as (
  select g.src_idx, g.dst_idx, case when g.dst_idx = b.best_idx then 0.0 else 1.0 end as term
  from tgrid g left join best b on b.src_idx = g.src_idx),
cells as (
  select g.src_idx, g.dst_idx,
         case when g.dst_idx >= 0 and d.p > 0 then -d.p * ln(d.p) else 0.0 end as h_cell,
         case when g.dst_idx >= 0 and coalesce(d.p <= 0, true) then 1 else 0 end as zero_cell
  from tgrid g left join dense d on d.src_idx = g.src_idx and d.dst_idx = g.dst_idx),
erows as (select src_idx, sum(h_cell) as h_row, sum(zero_cell) as zeros from cells group by src_idx),
et as (
  select c.src_idx, c.dst_idx, e.h_row - c.h_cell as num, e.h_row as den, e.zeros > 0 as undefined
  from cells c join erows e on e.src_idx = c.src_idx)"""


def _win_ctes(tok: str = "tok") -> str:
    return f"""
w0 as (
  select user_id, pos, token as t0,
         lead(token, 1) over w as t1, lead(token, 2) over w as t2,
         lead(token, 3) over w as t3, lead(token, 4) over w as t4
  from {tok} window w as (partition by user_id order by pos)),
win as (
  select *, (list_position({_S}, t0) - 1)::bigint as i0, (list_position({_S}, t1) - 1)::bigint as i1,
         (list_position({_S}, t2) - 1)::bigint as i2, (list_position({_S}, t3) - 1)::bigint as i3,
         coalesce(list_position({_S}, t4) - 1, -1)::bigint as i4
  from w0 where t4 is not null)"""


def _scored_sql(table: str) -> str:
    return f"""
select w.user_id, w.pos, w.t0, w.t1, w.t2, w.t3, w.t4,
       (a.term + b.term + c.term + d.term) / 4.0 as score
from win w
left join {table} a on a.src_idx = w.i0 and a.dst_idx = w.i1
left join {table} b on b.src_idx = w.i1 and b.dst_idx = w.i2
left join {table} c on c.src_idx = w.i2 and c.dst_idx = w.i3
left join {table} d on d.src_idx = w.i3 and d.dst_idx = w.i4"""


def _entropy_sql(limit: bool) -> str:
    und = "false" if limit else "{x}.undefined"
    def u(x):
        return f"coalesce({und.format(x=x)}, true)::int"
    return f"""
ew as (
  select w.user_id, w.pos, w.t0, w.t1, w.t2, w.t3, w.t4,
         a.num as n0, b.num as n1, c.num as n2, d.num as n3,
         a.den as d0, b.den as d1, c.den as d2, d.den as d3,
         {u('a')} as b0, {u('b')} as b1, {u('c')} as b2, {u('d')} as b3
  from win w
  left join et a on a.src_idx = w.i0 and a.dst_idx = w.i1
  left join et b on b.src_idx = w.i1 and b.dst_idx = w.i2
  left join et c on c.src_idx = w.i2 and c.dst_idx = w.i3
  left join et d on d.src_idx = w.i3 and d.dst_idx = w.i4),
ep as (
  select *, coalesce(sum(n0) over p, 0) as pn, coalesce(sum(d0) over p, 0) as pd,
         coalesce(sum(b0) over p, 0) as pb
  from ew window p as (partition by user_id order by pos rows between unbounded preceding and 1 preceding))
select user_id, pos, t0, t1, t2, t3, t4,
       round(case when pb + b0 + b1 + b2 + b3 > 0 then null
                  else (pn + n0 + n1 + n2 + n3) / nullif(pd + d0 + d1 + d2 + d3, 0) / 4.0 end, 9) as score
from ep"""


_SLICE = f"cast(date_diff('day', (select min(cast(ts as date)) from events), cast(ts as date)) // {SLICE_DAYS} as int)"

_SQL: dict[str, str] = {
    "tokens": f"""with {_TOK}
select user_id, event_id, pos, token, (list_position({_S}, token) - 1)::bigint as state_idx from tok""",
    "parse_transactions": f"""with {_TOK}, l as (select user_id || ',' || event_id || ',' || token as line from tok)
select split_part(line, ',', 1) as customer_id, split_part(line, ',', 2) as transaction_id,
       split_part(line, ',', 3) as token from l""",
    "transactions_to_sequences": f"""with {_TOK}
select cast(user_id as varchar) as customer_id, count(*)::bigint as n_tokens,
       user_id || ',' || string_agg(token, ',' order by event_id) as line
from tok group by user_id""",
    "sequence_lines": f"""with {_TOK}
select user_id || ',' || string_agg(token, ',' order by pos) as line from tok group by user_id""",
    "null_customer_scores": f"""with {_TOK}, tokn as (
  select customer as user_id, event_id, ts, token,
         cast(row_number() over (partition by customer order by ts, event_id) as bigint) as pos
  from (select *, case when user_id % 7 <> 0 then user_id end as customer from tok)),
{_model_ctes('tokn')}, {_win_ctes('tokn')}, {_entropy_sql(True)}""",
    "transitions": f"""with {_TOK}, {_model_ctes()}
select user_id, pos, src, dst from tr where dst is not null""",
    "transition_counts": f"""with {_TOK}, {_model_ctes()}
select src, dst, src_idx, dst_idx, n from model""",
    "row_totals": f"""with {_TOK}, {_model_ctes()}
select src_idx, src, max(row_total)::bigint as row_total from model group by src_idx, src""",
    "transition_probabilities": f"""with {_TOK}, {_model_ctes()}
select src, dst, src_idx, dst_idx, n, row_total, p from model""",
    "dense_model": f"""with {_TOK}, {_model_ctes()}
select src_idx, dst_idx, src, dst, n, p from dense""",
    "model_text_roundtrip": f"""with {_TOK}, {_model_ctes()}
select src_idx, dst_idx, p from dense""",
    "sequence_text_model": f"""with {_TOK}, {_model_ctes()}
select src, dst, n, row_total, p from model""",
    "score_text_model": f"""with {_TOK}, {_model_ctes()}, {_win_ctes()},
prow as (select src_idx, sum(p) as row_p from model group by src_idx),
tm as (
  select g.src_idx, g.dst_idx, case when r.row_p is null then 0.0 else r.row_p - coalesce(m.p, 0.0) end as term
  from tgrid g left join model m on m.src_idx = g.src_idx and m.dst_idx = g.dst_idx
  left join prow r on r.src_idx = g.src_idx),
s as ({_scored_sql('tm')})
select user_id, pos, t0, t1, t2, t3, t4, round(score, 9) as score from s""",
    "carry_tails": f"""with {_TOK}, n as (select user_id, max(pos) as n_tokens from tok group by user_id)
select t.user_id, n.n_tokens, string_agg(t.token, ',' order by t.pos) as tail
from tok t join n on n.user_id = t.user_id where t.pos > n.n_tokens - {CFG.window - 1}
group by t.user_id, n.n_tokens""",
    "best_successor": f"""with {_TOK}, {_model_ctes()}
select src_idx, {_S}[src_idx + 1] as src, best_idx, {_S}[best_idx + 1] as best, best_p from best""",
    "row_entropy": f"""with {_TOK}, {_model_ctes()}
select src_idx, {_S}[src_idx + 1] as src,
       round(sum(case when p > 0 then -p * ln(p) else 0.0 end), 9) as entropy_limit,
       round(case when sum(case when p <= 0 then 1 else 0 end) = 0
                  then sum(case when p > 0 then -p * ln(p) else 0.0 end) end, 9) as entropy_reference
from dense group by src_idx""",
    "token_windows": f"""with {_TOK}, {_win_ctes()}
select user_id, pos, t0, t1, t2, t3, t4 from win""",
    "score_miss_probability": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}\n{_scored_sql('mp')}",
    "detect_miss_probability": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}, s as ({_scored_sql('mp')})\n"
    "select * from s where score > 0.96",
    "score_miss_rate": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}\n{_scored_sql('mr')}",
    "detect_miss_rate": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}, s as ({_scored_sql('mr')})\n"
    "select * from s where score > 0.96",
    "score_entropy_reference": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}, {_entropy_sql(False)}",
    "score_entropy_limit": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}, {_entropy_sql(True)}",
    "detect_holdout": f"""with {_TOK}, tb as (select * from tok where ts < TIMESTAMP '{HOLDOUT_TS}'),
ta as (select * from tok where ts >= TIMESTAMP '{HOLDOUT_TS}'), {_model_ctes('tb')}, {_win_ctes('ta')},
s as ({_scored_sql('mp')})
select * from s where score > 0.96""",
    "history_messages": f"""with {_TOK}
select slice, user_id, user_id || '.' || string_agg(token, ',' order by pos) as message
from (select *, {_SLICE} as slice from tok) group by slice, user_id""",
    "stream_history_messages": f"""with {_TOK}
select user_id, user_id || '.' || string_agg(token, ',' order by pos) as message
from (select *, {_SLICE} as slice from tok) group by slice, user_id""",
    "sequence_pieces": f"""with {_TOK}, tr as (
  select user_id::varchar as customer_id, pos, token as src, lead(token) over (partition by user_id order by pos) as dst from tok)
select customer_id, pos, src, dst from tr where dst is not null""",
    "sequence_table_scores": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}\n{_scored_sql('mp')}",
    "array_scores": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}\n{_scored_sql('mp')}",
    "array_scores_pieces": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}\n{_scored_sql('mr')}",
    "array_entropy_pieces": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}, {_entropy_sql(True)}",
    "states_file": f"""with {_TOK}
select user_id, pos, token, (list_position({_S}, token) - 1)::bigint as state_idx from tok""",
    "text_stream_detect": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}, s as ({_scored_sql('mp')})\n"
    "select user_id::varchar as customer_id, * exclude (user_id) from s where score > 0.96",
    "byte_records_detect": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}, s as ({_scored_sql('mp')})\n"
    "select user_id::varchar as customer_id, * exclude (user_id) from s where score > 0.96",
    "stream_rejects": f"""with {_TOK}
select 'reject' as kind, user_id || ',' || event_id as line from tok where event_id % 5 = 0
union all
select 'history' as kind, user_id || '.' || string_agg(token, ',' order by event_id) as line
from tok where event_id % 5 <> 0 group by user_id""",
    "read_history_limit": """
select least(20, count(distinct user_id)) as n_rows, least(20, count(distinct user_id)) as n_known from events""",
    "alert_text": f"""with {_TOK}, {_model_ctes()}, {_win_ctes()}, s as ({_scored_sql('mp')})
select user_id, pos, user_id || ' : ' || t0 || ' ' || t1 || ' ' || t2 || ' ' || t3 || ' ' || t4 || ' : ' || cast(score as varchar) as message
from s where score > 0.96""",
    "null_token_pieces": f"""with {_TOK}, tokn as (
  select case when user_id % 7 = 1 then '' when user_id % 7 <> 0 then user_id::varchar end as customer_id, ts, event_id,
         case when event_id % 11 <> 0 then token else 'NULL' end as token from tok),
tr as (
  select customer_id, (row_number() over w)::bigint as pos, token as src, lead(token) over w as dst
  from tokn window w as (partition by customer_id order by ts, event_id))
select * from tr where dst is not null""",
    "stream_detect": f"with {_TOK}, {_model_ctes()}, {_win_ctes()}, s as ({_scored_sql('mp')})\n"
    "select * from s where score > 0.96",
    "stream_history": f"""with {_TOK}, t as (select *, {_SLICE} as slice from tok),
last as (select user_id, max(slice) as ls, count(*)::bigint as n_seen from t group by user_id),
fp as (select t.user_id, min(t.pos) as fp from t join last l on l.user_id = t.user_id and t.slice = l.ls
       group by t.user_id)
select t.user_id, string_agg(t.token, ',' order by t.pos) as history, l.n_seen
from t join fp on fp.user_id = t.user_id join last l on l.user_id = t.user_id
where t.pos >= fp.fp - {CFG.window - 1}
group by t.user_id, l.n_seen""",
    "alert_messages": f"""with {_TOK}, {_model_ctes()}, {_win_ctes()}, s as ({_scored_sql('mp')})
select user_id, pos, user_id || ' : ' || t0 || ' ' || t1 || ' ' || t2 || ' ' || t3 || ' ' || t4 || ' : ' as message_head,
       round(score, 9) as score
from s where score > 0.96""",
}


def oracle_sql() -> dict[str, str]:
    return {**{k: v for k, v in _SQL.items() if k in _QUERIES}, **_text_operators()[1]}
