"""Streaming detection: stream → history lookup → score → joint commit.

A micro-batch's rows are numbered after the tokens that its customers had before
(read from the history table), their last ``W - 1`` tokens are put in front, and the
batch plan scores the result.  Because at most ``W - 1`` tokens are carried, every
window contains a new token, so each window is scored once, in the batch that
completes it.

Alerts, history messages and the history table's delta are written first; then one
entry of the commit log makes the batch visible in all of them.  A batch that is
replayed before its commit overwrites its own folders; one that is replayed after
it is left alone.  Readers go by the log.

The model's terms are kept as long as its version is the latest, so a retrained
model is picked up by the next batch without a restart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import MarkovConfig
from ..functions.text import history_message
from ..operators.ordering import MAX_BROADCAST_KEYS, join_keys, sequence_positions
from ..operators.scoring import detect, model_terms, score_windows
from ..sources.commits import Files
from ..sources.model_io import load_model, model_version
from .history import HistoryTable, commit_log

#: Names, in an output folder, the checkpoint whose commit log its readers go by.
STREAM_FILE = "_stream"


def with_history(batch: DataFrame, tails: DataFrame | None, *, key: str, order: Sequence[str], token: str = "token", batch_rows: int | None = None, **kw) -> DataFrame:
    """Long form ``(key, pos, token, is_new)`` of a micro-batch: the customers' last
    tokens, then the new rows numbered after all that the customer had before.

    ``tails`` has one row (key, n_seen, tail) per earlier customer of the batch;
    ``batch_rows``, when known, bounds every key and their number."""
    ranked = sequence_positions(batch.select(key, *order, F.col(token).alias("token")), key, list(order), pos="_rank", max_rows=batch_rows, **kw)
    if tails is None:
        return ranked.select(key, F.col("_rank").alias("pos"), "token", F.lit(True).alias("is_new"))
    seen = tails.select(key, "n_seen")
    if batch_rows is not None and batch_rows <= MAX_BROADCAST_KEYS:
        seen = F.broadcast(seen)  # at most one row per row of the batch
    new = join_keys(ranked, seen, [key], "left").select(
        key, (F.coalesce("n_seen", F.lit(0)) + F.col("_rank")).cast("bigint").alias("pos"), "token", F.lit(True).alias("is_new")
    )
    first = F.col("n_seen") - F.size("tail") + 1
    carried = tails.select(key, first.alias("_first"), F.posexplode("tail").alias("_i", "token"))
    return carried.select(key, (F.col("_first") + F.col("_i")).cast("bigint").alias("pos"), "token", F.lit(False).alias("is_new")).unionByName(new)


def history_messages(batch: DataFrame, *, key: str = "customer_id", by: Sequence[str] = ()) -> DataFrame:
    """``customerId.tok1,tok2`` of the tokens new in this batch, one message per
    customer (and value of ``by``, where several batches lie in one table).  The
    trigger's bound on a batch is the bound on a message."""
    new = batch.where(F.col("is_new"))
    agg = new.groupBy(*by, key).agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("_s"))
    return agg.select(*by, key, history_message(F.col(key), F.transform("_s", lambda x: x["token"])).alias("message"))


class ModelTerms:
    """The latest model version, read when it changes: the scorer's terms, or the
    model table where the dictionary is too large for them."""

    def __init__(self, path: str, cfg: MarkovConfig):
        self.path, self.cfg, self.version, self.model, self.terms = path, cfg, None, None, None

    def current(self, spark: SparkSession) -> dict:
        version = model_version(spark, self.path)
        if version != self.version:
            self.model = load_model(spark, self.path, self.cfg)
            self.terms = model_terms(self.model, self.cfg) if self.cfg.dense else None
            self.version = version
        return {"model": self.model, "terms": self.terms}


def detect_stream(
    stream: DataFrame,
    model_path: str,
    cfg: MarkovConfig,
    *,
    checkpoint: str,
    alerts_path: str | None = None,
    history_path: str | None = None,
    key: str = "customer_id",
    order: Sequence[str] = ("transaction_id",),
    token: str = "token",
    retain: str = "tail",
    trigger: dict | None = None,
    query_name: str | None = None,
    sink_format: str = "parquet",
    kafka_options: dict | None = None,
    alerts_topic: str | None = None,
    history_topic: str | None = None,
    rejects_path: str | None = None,
    compact: int | None = None,
) -> StreamingQuery:
    """Start the detection query.  ``trigger`` defaults to the configured
    processing-time interval; pass ``{"availableNow": True}`` to drain the
    input and stop.

    ``sink_format``: ``parquet`` (``batch_id=<n>`` folders, visible once the batch
    is committed; needs ``alerts_path``), ``kafka`` (``message`` as the record
    value; needs the Kafka connector, at-least-once) or ``console`` (every message
    is printed on the driver, for debugging).

    ``rejects_path``: the ``value`` of rows whose ``malformed`` column is true goes
    there as text, out of the same read of the source, committed with the batch.

    ``compact``: history deltas after which they are rewritten as one folder."""
    if sink_format == "parquet" and not alerts_path:
        raise ValueError("the parquet sink needs alerts_path")
    if sink_format not in ("parquet", "kafka", "console"):
        raise ValueError(f"unknown sink {sink_format!r}")
    alerts_topic, history_topic = alerts_topic or cfg.alerts_topic, history_topic or cfg.history_topic
    spark = stream.sparkSession
    for path in {alerts_path if sink_format == "parquet" else None, history_path, rejects_path} - {None}:
        Files(spark, path).write(STREAM_FILE, checkpoint, overwrite=True)
    terms = ModelTerms(model_path, cfg)

    def folder(df: DataFrame, path: str, batch_id: int) -> None:
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    def write(df: DataFrame, path: str | None, topic: str, batch_id: int) -> None:
        if sink_format == "parquet":
            folder(df, path, batch_id)
        elif sink_format == "kafka":
            w = df.select(F.col(key).cast("string").alias("key"), F.col("message").alias("value")).write.format("kafka")
            for k, v in (kafka_options or {}).items():
                w = w.option(k, v)
            w.option("topic", topic).save()
        else:
            for row in df.select("message").toLocalIterator():
                print(row.message)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = commit_log(spark, checkpoint)
        done, entry = log.latest()
        if batch_id <= done:  # committed before the stream itself could note it
            return
        folders = entry.get("history", [])
        table = HistoryTable(spark, checkpoint, cfg, key, retain, **({} if compact is None else {"compact": compact}))
        batch = batch.persist()
        long = None
        try:
            rows = batch
            if rejects_path:
                batch.where("malformed").select("value").write.mode("overwrite").text(f"{rejects_path}/batch_id={batch_id}")
                rows = batch.where("not malformed")
            n_rows = rows.count()
            tails = table.tails(folders, rows.select(key).distinct(), n_rows) if folders else None
            long = with_history(rows, tails, key=key, order=order, token=token, batch_rows=n_rows).persist()
            scored = score_windows(long, cfg=cfg, key=key, **terms.current(spark))
            write(detect(scored, cfg, key), alerts_path, alerts_topic, batch_id)
            if history_path or sink_format != "parquet":
                write(history_messages(long, key=key), history_path, history_topic, batch_id)
            folders = table.write(batch_id, long.select(key, "pos", "token"), folders)
        finally:
            if long is not None:
                long.unpersist()
            batch.unpersist()
        log.add(batch_id, {"history": folders, "model": str(terms.version), "key": key, "rows": n_rows})
        if folders and folders[0].startswith("base-") and len(folders) == 2:  # the one after a compaction
            table.drop_unused([{"history": folders}, entry])

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": cfg.batch_interval}))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def read_output(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The committed batches of a stream's output folder."""
    log = commit_log(spark, Files(spark, path).read(STREAM_FILE).strip())
    return spark.read.format(fmt).option("basePath", path).load(path).where(F.col("batch_id") <= log.latest()[0])


read_alerts = read_output


def read_history(spark: SparkSession, checkpoint: str, *, key: str = "customer_id", limit: int | None = None) -> DataFrame:
    """Latest stored history per customer: ``(key, history STRING, n_seen)``; a
    history longer than a chunk has a row per piece.  ``limit`` caps the number of
    rows returned, as a paged scan of the history table does."""
    entry = commit_log(spark, checkpoint).latest()[1]
    if not entry.get("history"):
        raise ValueError(f"{checkpoint} has no committed batch")
    rows = HistoryTable(spark, checkpoint, MarkovConfig(), key).read(entry["history"])
    out = rows.select(key, F.array_join("tokens", ",", "NULL").alias("history"), "n_seen")
    return out.limit(limit) if limit is not None else out
