"""First-order Markov model: counts, row totals, probabilities and the small
per-state tables the scorers look up.

The model is a table, never a driver-side matrix.  Its size is bounded by the
state dictionary (at most S*S seen cells), which is what makes broadcasting it
safe; ``MarkovConfig`` checks that bound when it is built."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import MarkovConfig
from ..functions.states import checked, state_name, with_index
from .ordering import _cols, join_keys

MODEL_COLUMNS = ["src", "dst", "src_idx", "dst_idx", "n", "row_total", "p"]


def transition_counts(transitions: DataFrame, cfg: MarkovConfig, *, key: str | Sequence[str] | None = None) -> DataFrame:
    """``(src, dst, src_idx, dst_idx, n)`` — one row per observed cell.

    A hash aggregate with map-side partial counts: at most S*S groups, so a
    hot customer or a hot cell costs nothing extra."""
    t = transitions
    if cfg.on_unknown == "drop_sequence":
        if key is None:
            raise ValueError("drop_sequence needs the sequence key")
        keys = _cols(key)
        known = with_index(t, {"src": "_i", "dst": "_j"}, cfg.states)
        bad = known.where("_i < 0 or _j < 0").select(*keys).distinct()
        t = join_keys(t, bad, keys, "left_anti")
    counts = t.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    policy = "error" if cfg.on_unknown == "error" else "null"
    known = lambda t, i: F.when(F.col(t).isNotNull(), F.col(i))  # noqa: E731  NULL: no row, see checked_index
    counts = with_index(counts, {"src": "_i", "dst": "_j"}, cfg.states).select(
        "src",
        "dst",
        checked(known("src", "_i"), "src", policy, "source state in training").alias("src_idx"),
        checked(known("dst", "_j"), "dst", policy, "target state in training").alias("dst_idx"),
        "n",
    )
    # with "null"/"drop_sequence" a cell that still touches an unknown token
    # cannot be placed in the matrix
    return counts.where(F.col("src_idx").isNotNull() & F.col("dst_idx").isNotNull())


def train(transitions: DataFrame, cfg: MarkovConfig, *, key: str | Sequence[str] | None = None) -> DataFrame:
    """Row-normalised transition probabilities ``p = n / row_total``.

    No smoothing: unseen cells are absent (probability 0) and a state never
    left in training has no row at all."""
    counts = transition_counts(transitions, cfg, key=key)
    w = Window.partitionBy("src_idx")
    return counts.select(
        "src",
        "dst",
        "src_idx",
        "dst_idx",
        "n",
        F.sum("n").over(w).cast("bigint").alias("row_total"),
    ).withColumn("p", F.col("n").cast("double") / F.col("row_total"))


def row_totals(model: DataFrame) -> DataFrame:
    return model.groupBy("src_idx", "src").agg(F.max("row_total").alias("row_total"))


def _grid(spark: SparkSession, rows: int, cols: int, col_base: int = 0) -> DataFrame:
    """Index grid ``(src_idx, dst_idx)`` generated from its size (no join)."""
    return spark.range(rows * cols).select(
        F.floor(F.col("id") / cols).cast("bigint").alias("src_idx"),
        (F.col("id") % cols + col_base).cast("bigint").alias("dst_idx"),
    )


def _cells(model: DataFrame, cfg: MarkovConfig) -> DataFrame:
    """The seen cells, broadcast where the dictionary bounds their number."""
    return F.broadcast(model) if cfg.dense else model


def dense(model: DataFrame, cfg: MarkovConfig) -> DataFrame:
    """Full S×S grid ``(src_idx, dst_idx, src, dst, n, p)`` with zeros filled;
    ``n`` is NULL for the cells of an imported text model, which has no counts."""
    s = cfg.n_states
    g = _grid(model.sparkSession, s, s)
    m = _cells(model, cfg).select("src_idx", "dst_idx", "n", "p")
    return g.join(m, ["src_idx", "dst_idx"], "left").select(
        "src_idx",
        "dst_idx",
        state_name("src_idx", cfg.states).alias("src"),
        state_name("dst_idx", cfg.states).alias("dst"),
        F.when(F.col("p").isNull(), F.lit(0)).otherwise(F.col("n")).cast("bigint").alias("n"),
        F.coalesce("p", F.lit(0.0)).alias("p"),
    )


def best_successor(model: DataFrame, cfg: MarkovConfig) -> DataFrame:
    """Arg-max successor per state; the lowest index wins ties, and a row with
    no observations predicts state 0."""
    d = dense(model, cfg)
    return d.groupBy("src_idx").agg(
        F.max_by("dst_idx", F.struct(F.col("p"), -F.col("dst_idx"))).alias("best_idx"),
        F.max("p").alias("best_p"),
    ).select(
        "src_idx",
        state_name("src_idx", cfg.states).alias("src"),
        "best_idx",
        state_name("best_idx", cfg.states).alias("best"),
        "best_p",
    )


def _cell_entropy(p, zero_cell: str):
    """``-p ln p``; for p = 0 either the limit 0 or undefined (NULL)."""
    if zero_cell == "limit":
        return F.when(p > 0, -p * F.ln(p)).otherwise(F.lit(0.0))
    return F.when(p > 0, -p * F.ln(p))


def row_entropy(model: DataFrame, cfg: MarkovConfig) -> DataFrame:
    """Per state ``Σ -p ln p`` over its dense row: ``entropy_limit`` (0 ln 0 =
    0) and ``entropy_reference`` (NULL when any cell of the row is 0, as the
    JVM's 0 * -Infinity = NaN)."""
    d = dense(model, cfg)
    return d.groupBy("src_idx").agg(
        F.sum(_cell_entropy(F.col("p"), "limit")).alias("entropy_limit"),
        F.sum(F.when(F.col("p") <= 0, 1).otherwise(0)).alias("_zeros"),
    ).select(
        "src_idx",
        state_name("src_idx", cfg.states).alias("src"),
        "entropy_limit",
        F.when(F.col("_zeros") == 0, F.col("entropy_limit")).alias("entropy_reference"),
    )


def term_grid(model: DataFrame, cfg: MarkovConfig) -> DataFrame:
    """Every (current state, next state) pair a transition can have, with the
    next state -1 for an unknown token: S × (S + 1) rows, generated from the
    dictionary size, carrying the seen cell's ``n`` and ``p`` and the row's
    ``row_total``."""
    s = cfg.n_states
    g = _grid(model.sparkSession, s, s + 1, col_base=-1)
    cells = _cells(model, cfg).select("src_idx", "dst_idx", "n", "p")
    rows = F.broadcast(
        model.groupBy("src_idx").agg(F.max("row_total").alias("row_total"), F.sum("p").alias("row_p"))
    )
    return g.join(cells, ["src_idx", "dst_idx"], "left").join(rows, ["src_idx"], "left")
