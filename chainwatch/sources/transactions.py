"""Transaction and sequence sources and sinks (batch and streaming).

Record layouts: a transaction line is ``customerId,transactionId,token``; a
sequence line is ``customerId,tok1,tok2,...``.  Columnar tables with the same
columns are read directly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parse_transaction_lines, transaction_line, well_formed
from ..operators.sequences import explode_sequences, lines_to_long, sequence_lines

def _lines(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return spark.read.text(path).withColumn("value", _unquoted("value") if fmt == "csv" else F.col("value"))


def _unquoted(col: str):
    """CSV fields without their quotes; a token or id holds no comma or quote."""
    return F.regexp_replace(col, '"', "")


def read_transactions(spark: SparkSession, path: str, fmt: str = "text", *, mode: str = "strict") -> DataFrame:
    """``(customer_id, transaction_id, token)`` from text lines, headerless
    CSV (the same lines, fields may be quoted) or a parquet/ORC table with those
    columns.  A line with fewer than three fields fails the job under ``strict``
    and is left out under ``permissive``; see :func:`read_rejects`."""
    if fmt in ("text", "csv"):
        return parse_transaction_lines(_lines(spark, path, fmt), mode=mode).where(~F.col("malformed")).drop("malformed")
    return spark.read.format(fmt).load(path).select("customer_id", "transaction_id", "token")


def read_rejects(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """The lines (``value``) that ``read_transactions(mode="permissive")`` leaves out."""
    return _lines(spark, path, fmt).where(~well_formed("value"))


def write_transactions_text(df: DataFrame, path: str, *, customer="customer_id", transaction="transaction_id", token="token") -> None:
    df.select(transaction_line(customer, transaction, token).alias("value")).write.mode("overwrite").text(path)


def write_sequence_lines(sequences: DataFrame, path: str, *, key: str = "customer_id") -> None:
    """Text lines; the pieces of a sequence that fills more than a chunk carry
    their first position, see ``operators.sequences.sequence_lines``."""
    sequence_lines(sequences, key).write.mode("overwrite").text(path)


def write_sequences(sequences: DataFrame, path: str) -> None:
    """The rows of ``build_sequences`` as parquet."""
    sequences.write.mode("overwrite").parquet(path)


def read_sequences(spark: SparkSession, path: str, *, key: str = "customer_id") -> DataFrame:
    """Long form ``(key, pos, token)`` of :func:`write_sequences`."""
    return explode_sequences(spark.read.parquet(path), key, "tokens", first_pos="first_pos")


def read_sequence_lines(spark: SparkSession, path: str) -> DataFrame:
    """Long form ``(customer_id, line_id, pos, token)``; every line is one
    sequence, except that the marked pieces of a customer are one together."""
    return lines_to_long(spark.read.text(path))


#: Columns of a recorded topic: what the broker's source delivers, in files.
RECORDS = "key binary, value binary, partition int, offset bigint"


def decoded_records(records: DataFrame) -> DataFrame:
    """Byte records ``(value BINARY, partition, offset)`` as text with their place
    in the topic.  Bytes that are no UTF-8 give their base64 text after a
    replacement character: a malformed line from which they can be had back."""
    text = F.try_validate_utf8(F.col("value").cast("string"))
    return records.select(
        F.coalesce(text, F.concat(F.lit("\ufffd"), F.base64("value"))).alias("value"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def read_records(spark: SparkSession, path: str, *, mode: str = "strict") -> DataFrame:
    """``(customer_id, transaction_id, token, kafka_partition, kafka_offset)`` of a
    recorded topic (parquet with the columns ``RECORDS``)."""
    lines = decoded_records(spark.read.schema(RECORDS).parquet(path))
    parsed = parse_transaction_lines(lines, mode=mode, keep=["kafka_partition", "kafka_offset"])
    return parsed.where(~F.col("malformed")).drop("malformed")


def _raw_stream(spark: SparkSession, source: str, path: str | None, kafka_options: dict | None, per_trigger: int | None) -> DataFrame:
    r = spark.readStream
    if source == "kafka":
        options = {**({"maxOffsetsPerTrigger": per_trigger} if per_trigger else {}), **(kafka_options or {})}
        for k, v in options.items():
            r = r.option(k, v)
        return decoded_records(r.format("kafka").load())
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    if source == "records":
        return decoded_records(r.schema(RECORDS).parquet(path))
    if source == "text":
        return r.text(path)
    if source == "parquet":
        return r.schema(spark.read.parquet(path).schema).parquet(path)
    raise ValueError(f"unknown stream source {source!r}")


def read_transaction_stream(
    spark: SparkSession,
    source: str = "parquet",
    *,
    path: str | None = None,
    kafka_options: dict | None = None,
    per_trigger: int | None = None,
    mode: str = "strict",
) -> DataFrame:
    """Streaming transactions with an order column.

    * ``parquet``: a folder of ``(customer_id, transaction_id, token, ...)``
      files; the order column is whatever the files carry.
    * ``text``: transaction lines; ``transaction_id`` is the order key.
    * ``records``: a recorded topic, parquet files with the columns ``RECORDS``; the
      order key is ``(kafka_partition, kafka_offset)``.
    * ``kafka``: the same columns from a live topic, through the same decoder
      (keyed topics keep one customer in one partition).  Needs the Kafka
      connector on the classpath; the connection is not exercised by the tests.

    ``per_trigger`` bounds a micro-batch: files, or Kafka offsets.  A malformed
    line fails the stream under ``strict`` and is left out under ``permissive``;
    ``mark`` keeps it, with its text in ``value`` and ``malformed`` true, for
    ``detect_stream(rejects_path=...)``, so that the source is read once.
    """
    raw = _raw_stream(spark, source, path, kafka_options, per_trigger)
    if source == "parquet":
        return raw
    if mode == "mark":
        return parse_transaction_lines(raw, mode="permissive", keep=raw.columns)
    parsed = parse_transaction_lines(raw, mode=mode, keep=[c for c in raw.columns if c != "value"])
    return parsed.where(~F.col("malformed")).drop("malformed")


def read_reject_stream(
    spark: SparkSession,
    source: str,
    *,
    path: str | None = None,
    kafka_options: dict | None = None,
    per_trigger: int | None = None,
) -> DataFrame:
    """The malformed lines (``value``) of a text, records or Kafka source."""
    return _raw_stream(spark, source, path, kafka_options, per_trigger).where(~well_formed("value")).select("value")
