"""Command line: ``python -m chainwatch {train,score,stream,history} ...``.

* ``train``  raw transactions → ordered sequences (+ optional sequence-line
  text) → model (parquet, + optional dense text).
* ``score``  sequence lines or transactions + a model → scored windows and
  alerts (parquet).
* ``stream`` a transaction stream + a model → alerts and history messages, the
  customers' histories beside the checkpoint.
* ``history`` the customers' stored histories of a stream's checkpoint.

A properties file (``--config``) gives scorer, window, threshold, interval,
topics, paths and brokers; options on the command line take precedence.

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings (master, ``spark.checkpoint.dir``, ...) are whatever spark-submit
provides."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from chainwatch.config import MarkovConfig, config_from_properties
from chainwatch.functions.states import read_states
from chainwatch.operators.arrays import score_sequences
from chainwatch.operators.scoring import detect, score_windows
from chainwatch.operators.sequences import build_sequences
from chainwatch.plans.jobs import train_model, transactions_to_tokens
from chainwatch.sources.model_io import load_model, read_model_text, save_model, write_model_text
from chainwatch.sources.transactions import (
    read_sequence_lines,
    read_transaction_stream,
    read_transactions,
    write_sequence_lines,
    write_sequences,
)
from chainwatch.streaming.detect import detect_stream, read_history

#: Most files, or Kafka offsets, of a micro-batch unless told otherwise.
PER_TRIGGER = {"text": 256, "parquet": 256, "records": 256, "kafka": 2_000_000}


def _config(spark, args) -> MarkovConfig:
    cfg = MarkovConfig()
    if args.config:
        with open(args.config) as fh:
            cfg = config_from_properties(fh.read())
    given = {"algorithm": args.algorithm, "threshold": args.threshold, "states": read_states(spark, args.states) if args.states else None}
    given |= {k: getattr(args, k, None) for k in ("input_topic", "history_topic", "alerts_topic")}
    kw = {k: v for k, v in given.items() if v is not None}
    return cfg.with_(**kw) if kw else cfg


def _needed(value, option: str):
    if not value:
        raise SystemExit(f"{option} is missing on the command line and in the properties file")
    return value


def _ordered(tx, args):
    """Transactions with a typed order column."""
    return tx.withColumn("_order", F.col("transaction_id").cast(args.order_type))


def _tokens_from_transactions(spark, args, cfg):
    path = _needed(args.transactions or cfg.transactions_path, "--transactions")
    tx = read_transactions(spark, path, args.format)
    return transactions_to_tokens(_ordered(tx, args), key="customer_id", order=["_order"])


def cmd_train(spark, args) -> None:
    cfg = _config(spark, args)
    tokens = _tokens_from_transactions(spark, args, cfg)
    out = args.sequences_out or cfg.sequences_path
    if out:
        write = write_sequences if args.sequences_format == "parquet" else write_sequence_lines
        write(build_sequences(tokens, "customer_id", cfg), out)
    model = train_model(tokens, cfg, key="customer_id")
    save_model(model, args.model_out)
    text = args.model_text_out or cfg.model_path
    if text:
        write_model_text(load_model(spark, args.model_out, cfg), cfg, text)


def cmd_score(spark, args) -> None:
    cfg = _config(spark, args)
    # the original's configured model is its dense text file
    text = args.model_format == "text" or not args.model
    path = _needed(args.model or cfg.model_path, "--model")
    model = read_model_text(spark, path, cfg) if text else load_model(spark, path, cfg)
    if args.sequences and args.sequences_format == "parquet":
        # stored sequences are in order already and are scored in place
        key, scored = "customer_id", score_sequences(spark.read.parquet(args.sequences), model, cfg, "customer_id")
    elif args.sequences:
        key = ["customer_id", "line_id"]
        scored = score_windows(read_sequence_lines(spark, args.sequences), model, cfg, key)
    else:
        key = "customer_id"
        scored = score_windows(_tokens_from_transactions(spark, args, cfg), model, cfg, key)
    if args.scores_out:  # the alerts are then read off the written scores
        scored.write.mode("overwrite").parquet(args.scores_out)
        scored = spark.read.parquet(args.scores_out)
    detect(scored, cfg, key).write.mode("overwrite").parquet(args.alerts_out)


def cmd_stream(spark, args) -> None:
    cfg = _config(spark, args)
    kafka = dict(kv.split("=", 1) for kv in (args.kafka_option or []))
    if cfg.brokers:
        kafka.setdefault("kafka.bootstrap.servers", cfg.brokers)
    if args.source == "kafka" and not {"subscribe", "assign", "subscribePattern"} & kafka.keys():
        kafka["subscribe"] = cfg.input_topic
    source = {"path": args.path, "kafka_options": kafka, "per_trigger": args.per_trigger or PER_TRIGGER[args.source]}
    if args.rejects_out and args.source == "parquet":
        raise SystemExit("--rejects-out is for text, records and kafka sources")
    stream = read_transaction_stream(spark, args.source, mode="mark" if args.rejects_out else "strict", **source)
    if args.source in ("kafka", "records"):
        order = ["kafka_partition", "kafka_offset"]
    else:
        stream, order = _ordered(stream, args), ["_order"]
    seconds = f"{args.trigger_seconds} seconds" if args.trigger_seconds else cfg.batch_interval
    q = detect_stream(
        stream,
        args.model,
        cfg,
        checkpoint=args.checkpoint,
        alerts_path=args.alerts_out,
        history_path=args.history_out,
        order=order,
        retain=args.retain,
        trigger={"availableNow": True} if args.available_now else {"processingTime": seconds},
        sink_format=args.sink,
        kafka_options={k: v for k, v in kafka.items() if k.startswith("kafka.")},  # connection only
        rejects_path=args.rejects_out,
    )
    q.awaitTermination()


def cmd_history(spark, args) -> None:
    rows = read_history(spark, args.checkpoint, limit=args.limit)
    if args.out:
        rows.write.mode("overwrite").parquet(args.out)
    else:
        for r in rows.toLocalIterator():
            print(f"{r.customer_id}\t{r.history}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chainwatch")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--config", help="properties file (scorer.algorithm, state.seq.windowSize, ...)")
        sp.add_argument("--states", help="state dictionary file: one comma list")
        types = ["string", "bigint", "double", "timestamp"]
        sp.add_argument("--order-type", default="string", choices=types, help="type of the transaction id by which rows are ordered")
        sp.add_argument("--numeric-order", dest="order_type", action="store_const", const="bigint", help="the same as --order-type bigint")
        sp.add_argument("--algorithm")
        sp.add_argument("--threshold", type=float)

    t = sub.add_parser("train")
    common(t)
    t.add_argument("--transactions")
    t.add_argument("--format", default="text", choices=["text", "csv", "parquet", "orc"])
    t.add_argument("--sequences-out")
    t.add_argument("--sequences-format", default="text", choices=["text", "parquet"])
    t.add_argument("--model-out", required=True)
    t.add_argument("--model-text-out")

    s = sub.add_parser("score")
    common(s)
    s.add_argument("--model")
    s.add_argument("--model-format", default="parquet", choices=["parquet", "text"])
    g = s.add_mutually_exclusive_group()
    g.add_argument("--sequences", help="sequences written by train")
    g.add_argument("--transactions")
    s.add_argument("--sequences-format", default="text", choices=["text", "parquet"])
    s.add_argument("--format", default="text", choices=["text", "csv", "parquet", "orc"])
    s.add_argument("--scores-out")
    s.add_argument("--alerts-out", required=True)

    r = sub.add_parser("stream")
    common(r)
    r.add_argument("--source", default="parquet", choices=["parquet", "text", "records", "kafka"])
    r.add_argument("--path")
    r.add_argument("--kafka-option", action="append", help="key=value, repeatable")
    r.add_argument("--model", required=True)
    r.add_argument("--alerts-out")
    r.add_argument("--history-out")
    r.add_argument("--checkpoint", required=True)
    r.add_argument("--retain", default="tail", choices=["tail", "batch"])
    r.add_argument("--sink", default="parquet", choices=["parquet", "kafka", "console"])
    r.add_argument("--trigger-seconds", type=int, help="instead of the configured batch interval")
    r.add_argument("--per-trigger", type=int, help="most files, or Kafka offsets, of a micro-batch")
    r.add_argument("--rejects-out", help="malformed lines go here; without it they fail the stream")
    for topic in ("input", "history", "alerts"):
        r.add_argument(f"--{topic}-topic")
    r.add_argument("--available-now", action="store_true")

    h = sub.add_parser("history")
    h.add_argument("--checkpoint", required=True)
    h.add_argument("--limit", type=int, help="most customers")
    h.add_argument("--out", help="parquet folder; printed without it")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"chainwatch-{args.cmd}").getOrCreate()
    {"train": cmd_train, "score": cmd_score, "stream": cmd_stream, "history": cmd_history}[args.cmd](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
