"""Model storage.

The canonical form is the sparse model table, a folder of versions: each save
writes a new one and then commits it, so a reader finds the last whole model
whenever it comes, and a retrained one never replaces files in use.  The dense
text form (S lines of S comma-terminated probabilities, rows and columns in
dictionary order, numbers printed as the JVM prints doubles) is kept as an
import/export format.  Both are bounded by the dictionary size S."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MarkovConfig
from ..functions.states import state_name
from ..functions.text import double_text
from ..operators.model import MODEL_COLUMNS, dense
from .commits import KEPT, CommitLog, Files


def _versions(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path.rstrip('/')}/_versions")


def save_model(model: DataFrame, path: str) -> None:
    """Write the model as the next version of the folder.  Files of the versions
    before the last ``KEPT`` are deleted."""
    log = _versions(model.sparkSession, path)
    files = Files(model.sparkSession, path)
    name = f"model-{uuid.uuid4().hex[:12]}"
    model.select(*MODEL_COLUMNS).write.parquet(f"{path.rstrip('/')}/{name}")
    number, entry = log.latest()
    log.add(number + 1, {"folder": name, "folders": [*entry.get("folders", []), name][-KEPT:]})
    live = log.latest()[1]["folders"]
    for old in set(entry.get("folders", [])) - set(live):
        files.delete(old)


def model_version(spark: SparkSession, path: str) -> str:
    """What changes when the model does: the committed version, or for a plain
    parquet folder the time of its newest file."""
    number, _ = _versions(spark, path).latest()
    return f"version {number}" if number >= 0 else f"files of {Files(spark, path).newest()}"


def model_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the latest version (a plain parquet folder is its own)."""
    entry = _versions(spark, path).latest()[1]
    return spark.read.parquet(f"{path.rstrip('/')}/{entry['folder']}" if entry else path)


def load_model(spark: SparkSession, path: str, cfg: MarkovConfig) -> DataFrame:
    """A saved model.  Its size is checked, since it is broadcast: at most one
    row per pair of states."""
    model = model_table(spark, path).select(*MODEL_COLUMNS)
    most = cfg.n_states**2
    if model.limit(most + 1).count() > most:
        raise ValueError(f"{path} has more than {most} rows, so it is no model of {cfg.n_states} states")
    return model


def model_text_rows(model: DataFrame, cfg: MarkovConfig) -> DataFrame:
    """``(src_idx, value)``: one text line per state of the dense matrix."""
    d = dense(model, cfg)
    rows = d.groupBy("src_idx").agg(F.sort_array(F.collect_list(F.struct("dst_idx", "p"))).alias("_cells"))
    line = F.concat(F.array_join(F.transform("_cells", lambda c: double_text(c["p"])), ","), F.lit(","))
    return rows.select("src_idx", line.alias("value"))


def write_model_text(model: DataFrame, cfg: MarkovConfig, path: str) -> None:
    """One file, S lines in dictionary order (S rows: a single writer task is
    bounded by the dictionary, not by the data)."""
    (
        model_text_rows(model, cfg)
        .repartition(1)
        .sortWithinPartitions("src_idx")
        .select("value")
        .write.mode("overwrite")
        .text(path)
    )


def parse_model_text(text: DataFrame, cfg: MarkovConfig, col: str = "value") -> DataFrame:
    """Whole-file text (one row = one model file) → sparse model with ``p``
    only (``n`` and ``row_total`` NULL).

    Every line must hold exactly S numbers (a trailing comma is allowed) and
    there may be at most S lines; missing lines leave zero rows."""
    s = cfg.n_states
    lines = text.select(F.posexplode(F.split(F.regexp_replace(F.col(col), "\n+$", ""), "\n")).alias("src_idx", "line"))
    vals = F.split(F.regexp_replace("line", ",+$", ""), ",")
    checked = lines.select(
        F.col("src_idx").cast("bigint").alias("src_idx"),
        F.when(F.col("src_idx") >= s, F.raise_error(F.lit("model has more rows than states")))
        .when(F.size(vals) != s, F.raise_error(F.lit("model row width does not match the number of states")))
        .otherwise(vals)
        .alias("_vals"),
    )
    cells = checked.select("src_idx", F.posexplode("_vals").alias("dst_idx", "_v")).select(
        "src_idx", F.col("dst_idx").cast("bigint"), F.col("_v").cast("double").alias("p")
    )
    return cells.where(F.col("p") > 0).select(
        state_name("src_idx", cfg.states).alias("src"),
        state_name("dst_idx", cfg.states).alias("dst"),
        "src_idx",
        "dst_idx",
        F.lit(None).cast("bigint").alias("n"),
        F.lit(None).cast("bigint").alias("row_total"),
        "p",
    )


def read_model_text(spark: SparkSession, path: str, cfg: MarkovConfig) -> DataFrame:
    return parse_model_text(spark.read.text(path, wholetext=True), cfg)
