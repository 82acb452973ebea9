"""Window scorers.

Every scorer is a per-transition term looked up in a small table keyed by
(current state index, next state index), then combined over the ``W - 1``
transitions of a window and divided by ``W - 1``.  The lookup table is
dense with S × (S + 1) rows (next state -1 = unknown token), bounded by the
dictionary, so it is inlined as literal arrays read by position; the window
rows never leave their ``(customer, chunk)`` partition.  A dictionary whose dense
table is too large for that is looked up by joins with the seen cells
(:func:`sparse_terms`).

=================  ==========================================================
MissProbability    Σ over the window of P(current → anything but next):
                   ``(row_total - n) / row_total``; 0 for a state never left
                   in training; 1 for an unseen cell or unknown next token.
MissRate           count of transitions whose next state is not the arg-max
                   successor of the current state.
EntropyReduction   expanding-prefix ratio Σ(H - h(next)) / Σ H over every
                   transition from the sequence start to the window end;
                   ``zero_cell="undefined"`` makes any zero cell NULL, as the
                   JVM's 0·ln 0 = NaN does; ``"limit"`` uses 0.
=================  ==========================================================
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MAX_BROADCAST_CELLS, MarkovConfig
from ..functions.states import known_token, with_index
from ..functions.text import alert_message
from .model import best_successor, term_grid
from .ordering import _cols, running_total, with_following
from .sequences import token_windows, window_token_cols


def miss_probability_terms(model: DataFrame, cfg: MarkovConfig) -> DataFrame:
    g = term_grid(model, cfg)
    # counts known (trained model): the exact ratio (row_total - n) / row_total;
    # probabilities only (imported text model): row sum minus the target cell.
    # A state never left in training has no row: every probability is 0.
    term = (
        F.when(F.col("row_p").isNull(), F.lit(0.0))
        .when(
            F.col("row_total").isNotNull(),
            (F.col("row_total") - F.coalesce(F.col("n"), F.lit(0))).cast("double") / F.col("row_total"),
        )
        .otherwise(F.col("row_p") - F.coalesce(F.col("p"), F.lit(0.0)))
    )
    return g.select("src_idx", "dst_idx", term.alias("term"))


def miss_rate_terms(model: DataFrame, cfg: MarkovConfig) -> DataFrame:
    g = term_grid(model, cfg).select("src_idx", "dst_idx")
    best = F.broadcast(best_successor(model, cfg).select("src_idx", "best_idx"))
    term = F.when(F.col("dst_idx") == F.col("best_idx"), F.lit(0.0)).otherwise(F.lit(1.0))
    return g.join(best, ["src_idx"], "left").select("src_idx", "dst_idx", term.alias("term"))


def entropy_terms(model: DataFrame, cfg: MarkovConfig) -> DataFrame:
    """``num = H(row) - h(row, next)``, ``den = H(row)`` and ``undefined``
    (the row has a zero cell and ``zero_cell == "undefined"``)."""
    g = term_grid(model, cfg)
    h = F.when(F.col("p") > 0, -F.col("p") * F.ln(F.col("p"))).otherwise(F.lit(0.0))
    real = F.col("dst_idx") >= 0
    cells = g.select(
        "src_idx",
        "dst_idx",
        F.when(real, h).otherwise(F.lit(0.0)).alias("h_cell"),
        F.when(real & F.coalesce(F.col("p") <= 0, F.lit(True)), 1).otherwise(0).alias("zero_cell"),
    )
    rows = cells.groupBy("src_idx").agg(F.sum("h_cell").alias("h_row"), F.sum("zero_cell").alias("zeros"))
    undefined = (F.col("zeros") > 0) if cfg.zero_cell == "undefined" else F.lit(False)
    return cells.join(F.broadcast(rows), ["src_idx"]).select(
        "src_idx",
        "dst_idx",
        (F.col("h_row") - F.col("h_cell")).alias("num"),
        F.col("h_row").alias("den"),
        undefined.alias("undefined"),
    )


ALGORITHMS: dict[str, str] = {
    "MissProbability": "miss_probability",
    "MissRate": "miss_rate",
    "EntropyReduction": "entropy",
    "miss_probability": "miss_probability",
    "miss_rate": "miss_rate",
    # the original falls through to the entropy scorer for any other name;
    # here it must be asked for by one of these names
    "entropy": "entropy",
}


def resolve_algorithm(name: str) -> str:
    try:
        return ALGORITHMS[name]
    except KeyError:
        raise ValueError(f"unknown scorer {name!r}; choose one of {sorted(ALGORITHMS)}") from None


def _window_indices(cfg: MarkovConfig) -> list:
    """``idx0..idx{W-1}`` expressions: every token but the last is a current
    state (an unknown one fails the job, or gives NULL with
    ``on_unknown="null"``), the last is only ever a next state (unknown →
    -1)."""
    w = cfg.window

    def current(i: int) -> Column:
        if cfg.on_unknown == "null":
            bad = F.lit(None).cast("int")
        else:
            bad = F.raise_error(F.concat(F.lit("unknown current state: "), F.col(f"t{i}"))).cast("int")
        return F.when(F.col(f"i{i}") < 0, bad).otherwise(F.col(f"i{i}"))

    return [*(current(i) for i in range(w - 1)), F.col(f"i{w - 1}")]


def lookup_table(model: DataFrame, cfg: MarkovConfig, algorithm: str) -> DataFrame:
    """The per-transition term table of a scorer: one row per (current state,
    next state or -1), S × (S + 1) rows."""
    return SCORERS[resolve_algorithm(algorithm)](model, cfg)


def term_arrays(table: DataFrame, cfg: MarkovConfig, value_cols: Sequence[str]) -> dict[str, Column]:
    """The term table as literal arrays indexed by ``src * (S + 1) + dst + 1``.

    The table is dense and has exactly S × (S + 1) rows (checked against the
    dictionary size by ``MarkovConfig``), so it is collected once and inlined:
    every transition is then an O(1) array read inside the generated code, with
    no join, no broadcast exchange and no lineage back to training."""
    s = cfg.n_states
    rows = table.select("src_idx", "dst_idx", *value_cols).collect()
    if len(rows) != s * (s + 1):
        raise ValueError(f"term table has {len(rows)} rows, expected {s * (s + 1)}")
    types = dict(table.select(*value_cols).dtypes)
    out = {}
    for v in value_cols:
        vals = [None] * (s * (s + 1))
        for r in rows:
            vals[r["src_idx"] * (s + 1) + r["dst_idx"] + 1] = r[v]
        # JSON carries doubles exactly (shortest round-trip text both ways)
        out[v] = F.from_json(F.lit(json.dumps(vals)), f"array<{types[v]}>")
    return out


def _lookup(win: DataFrame, arrays: dict[str, Column], cfg: MarkovConfig, keep: Sequence[str]) -> DataFrame:
    """``keep`` plus ``<value><i>`` for every transition ``i`` of the window."""
    idx = _window_indices(cfg)
    width = cfg.n_states + 1
    vals = []
    for i in range(cfg.window - 1):
        at = idx[i] * F.lit(width) + idx[i + 1] + F.lit(2)  # 1-based
        for v, arr in arrays.items():
            vals.append(F.try_element_at(arr, at.cast("int")).alias(f"{v}{i}"))
    return win.select(*keep, *vals)


def model_terms(model: DataFrame, cfg: MarkovConfig, algorithm: str | None = None) -> dict[str, Column]:
    """The literal arrays that a scorer reads; they can be used for many scorings."""
    alg = resolve_algorithm(algorithm or cfg.algorithm)
    values = ["num", "den", "undefined"] if alg == "entropy" else ["term"]
    return term_arrays(lookup_table(model, cfg, alg), cfg, values)


def score_windows(
    tokens: DataFrame,
    model: DataFrame | None,
    cfg: MarkovConfig,
    key: str | Sequence[str],
    *,
    algorithm: str | None = None,
    pos: str = "pos",
    token: str = "token",
    terms: dict[str, Column] | None = None,
) -> DataFrame:
    """Score every complete window: ``(key, pos, chunk, t0..t{W-1}, score)``
    where ``pos`` is the window's first position.

    One shuffle at most (the halo window on ``(key, chunk)``; none when the
    tokens are already partitioned by the key); the model enters as literal
    arrays of S × (S + 1) terms (one small job collects them).  The entropy
    scorer's expanding prefix additionally reads the window stage a second
    time for its per-chunk totals.  ``terms`` (of :func:`model_terms`) stands for the
    model where it is at hand."""
    keys = _cols(key)
    alg = resolve_algorithm(algorithm or cfg.algorithm)
    m = cfg.window - 1
    toks = window_token_cols(cfg.window)
    base = [*keys, pos, "chunk", *toks]
    if cfg.dense:
        win = token_windows(tokens, keys, cfg, pos=pos, token=token, index=True)
        looked = _lookup(win, terms or model_terms(model, cfg, alg), cfg, base)
    else:
        looked = _lookup_sparse(tokens, model, cfg, keys, alg, pos, token)
    if alg != "entropy":
        total = reduce(lambda a, b: a + b, [F.col(f"term{i}") for i in range(m)])
        return looked.select(*base, (total / F.lit(float(m))).alias("score"))

    # a NULL lookup (unknown current state under on_unknown="null") is undefined too
    bad = [F.coalesce(F.col(f"undefined{i}"), F.lit(True)).cast("int") for i in range(m)]
    prefix = running_total(
        looked,
        keys,
        pos,
        {"_pnum": F.col("num0"), "_pden": F.col("den0"), "_pbad": bad[0]},
        inclusive=False,
    )
    num = reduce(lambda a, b: a + b, [F.col(f"num{i}") for i in range(m)], F.col("_pnum"))
    den = reduce(lambda a, b: a + b, [F.col(f"den{i}") for i in range(m)], F.col("_pden"))
    nbad = reduce(lambda a, b: a + b, bad, F.col("_pbad"))
    ratio = F.try_divide(num, den)
    score = F.when(nbad > 0, F.lit(None).cast("double")).otherwise(ratio / F.lit(float(m)))
    return prefix.select(*base, score.alias("score"))


def detect(scored: DataFrame, cfg: MarkovConfig, key: str | Sequence[str], *, threshold: float | None = None) -> DataFrame:
    """Windows whose score is strictly above the threshold (NULL never
    passes), with the alert message (it names the first key column, the
    customer)."""
    keys = _cols(key)
    t = cfg.threshold if threshold is None else threshold
    toks = window_token_cols(cfg.window)
    return scored.where(F.col("score") > F.lit(t)).select(
        "*", alert_message(F.col(keys[0]), toks, F.col("score")).alias("message")
    )


def sparse_terms(model: DataFrame, cfg: MarkovConfig, algorithm: str) -> tuple[DataFrame, DataFrame, dict[str, Column]]:
    """A scorer's terms without the dense table: those of the seen cells
    (``src_idx, dst_idx, <value>``), those of all other cells of a seen row
    (``src_idx, _row_<value>``), and those of a row never seen, as expressions of
    the transition (``_src``, ``_dst``).  At most one row per seen cell."""
    s = cfg.n_states
    rows = model.groupBy("src_idx").agg(
        F.max("row_total").alias("row_total"), F.sum("p").alias("row_p"), F.count(F.lit(1)).alias("seen"),
        F.max_by("dst_idx", F.struct(F.col("p"), -F.col("dst_idx"))).alias("best"),
        F.sum(F.when(F.col("p") > 0, -F.col("p") * F.ln("p")).otherwise(F.lit(0.0))).alias("h_row"),
    )
    cells = model.select("src_idx", "dst_idx", "n", "p").join(rows, "src_idx")
    counted = F.col("row_total").isNotNull()
    if algorithm == "miss_probability":
        term = F.when(counted, (F.col("row_total") - F.col("n")).cast("double") / F.col("row_total")).otherwise(F.col("row_p") - F.col("p"))
        cell, row = {"term": term}, {"term": F.when(counted, F.lit(1.0)).otherwise(F.col("row_p"))}
        none = {"term": F.lit(0.0)}
    elif algorithm == "miss_rate":
        cell, row = {"term": F.when(F.col("dst_idx") == F.col("best"), 0.0).otherwise(1.0)}, {"term": F.lit(1.0)}
        none = {"term": F.when(F.col("_dst") == 0, 0.0).otherwise(1.0)}  # such a row predicts state 0
    else:
        undefined = (F.col("seen") < s) if cfg.zero_cell == "undefined" else F.lit(False)
        h = F.when(F.col("p") > 0, -F.col("p") * F.ln("p")).otherwise(F.lit(0.0))
        cell = {"num": F.col("h_row") - h, "den": F.col("h_row"), "undefined": undefined}
        row = {"num": F.col("h_row"), "den": F.col("h_row"), "undefined": undefined}
        none = {"num": F.lit(0.0), "den": F.lit(0.0), "undefined": F.lit(cfg.zero_cell == "undefined")}
    cells = cells.select("src_idx", "dst_idx", *[e.alias(v) for v, e in cell.items()])
    return cells, rows.select("src_idx", *[e.alias(f"_row_{v}") for v, e in row.items()]), none


def _lookup_sparse(tokens: DataFrame, model: DataFrame, cfg: MarkovConfig, keys: list[str], algorithm: str, pos: str, token: str) -> DataFrame:
    """What ``_lookup`` gives, for a dictionary too large for literal arrays: each
    transition is joined once with its cell and its row, and a second halo window
    gathers the terms of a window.  The seen cells are counted, and broadcast only
    below MAX_BROADCAST_CELLS; the joins are left joins on unique keys, whose hot
    cells adaptive execution splits."""
    w = cfg.window
    rows = with_index(tokens.select(*keys, pos, known_token(token).alias("t")), {"t": "_src"}, cfg.states)
    rows = with_following(rows, keys, pos, ["_src"], 1, cfg.chunk).drop("chunk")
    rows = rows.withColumnRenamed("_src_next1", "_dst")
    cells, by_row, none = sparse_terms(model, cfg, algorithm)
    few = model.limit(MAX_BROADCAST_CELLS + 1).count() <= MAX_BROADCAST_CELLS
    hint = F.broadcast if few else (lambda df: df)
    cells = hint(cells.withColumnsRenamed({"src_idx": "_ci", "dst_idx": "_cj"}))
    by_row = hint(by_row.withColumnRenamed("src_idx", "_ri"))
    rows = rows.join(cells, (F.col("_src") == F.col("_ci")) & (F.col("_dst") == F.col("_cj")), "left")
    rows = rows.join(by_row, F.col("_src") == F.col("_ri"), "left")
    values = {v: F.coalesce(F.col(v), F.when(F.col("_ri").isNotNull(), F.col(f"_row_{v}")).when(F.col("_src") >= 0, e)) for v, e in none.items()}
    rows = rows.select(*keys, pos, "t", "_src", *[e.alias(v) for v, e in values.items()])
    f = with_following(rows, keys, pos, ["t", "_src", *values], w - 1, cfg.chunk).where(F.col(f"_has{w - 1}"))
    at = lambda c, i: F.col(f"{c}_next{i}" if i else c)
    looked = f.select(
        *keys, pos, "chunk", *[at("t", i).alias(f"t{i}") for i in range(w)], *[at("_src", i).alias(f"i{i}") for i in range(w)],
        *[at(v, i).alias(f"{v}{i}") for v in values for i in range(w - 1)],
    )
    if cfg.on_unknown == "null":
        return looked
    checked = _window_indices(cfg)[:-1]
    known = reduce(lambda a, b: a & b, [c >= 0 for c in checked])
    return looked.where(known)


SCORERS: dict[str, Callable] = {
    "miss_probability": miss_probability_terms,
    "miss_rate": miss_rate_terms,
    "entropy": entropy_terms,
}
