"""Scoring of stored sequences in array form, with higher-order functions.

The long form orders tokens by a shuffle and a sort.  A stored sequence
(``build_sequences``) is ordered already, so its windows are read off the array
in place: state indices, the terms of its transitions, and for the entropy scorer
their prefix sums, all inside one row.  A customer that lies in one row needs no
exchange and no sort.

The pieces of a longer sequence are scored the same way, and what crosses a cut
is scored from the edges alone: the last ``W - 1`` tokens of a piece meet the
first ``W - 1`` of the next in a shuffle of those few tokens.  The entropy scorer's
prefix additionally needs one sum per piece."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MarkovConfig
from ..functions.states import known_token, state_index
from .ordering import _cols, join_keys
from .scoring import model_terms, resolve_algorithm, score_windows
from .sequences import explode_sequences, window_token_cols

#: Entries of a block of the prefix sums: n entries cost about n * BLOCK copies.
BLOCK = 512


def sums_before(x: Column, zero: Column) -> Column:
    """For each entry of an array the sum of the entries before it.

    Sums are carried inside blocks, then over the blocks, because appending to an
    array copies it."""
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(x) / BLOCK).cast("int") - 1, F.lit(0))), lambda b: F.slice(x, b * BLOCK + 1, BLOCK))

    def running(values):
        return F.aggregate(values, F.array(zero), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))

    totals = running(F.transform(blocks, lambda b: F.aggregate(b, zero, lambda acc, v: acc + v)))
    inside = F.zip_with(blocks, totals, lambda b, t: F.transform(F.slice(running(F.coalesce(b, F.array())), 1, F.size(F.coalesce(b, F.array()))), lambda v: v + t))
    return F.flatten(inside)


def _with_terms(rows: DataFrame, arrays: dict[str, Column], cfg: MarkovConfig) -> DataFrame:
    """``rows`` with the state indices ``_idx`` of ``tokens`` and, per term, an array
    ``_<value>`` with one entry for each transition (NULL from an unknown state)."""
    width = cfg.n_states + 1
    rows = rows.withColumn("_idx", F.transform("tokens", lambda t: state_index(t, cfg.states).cast("int")))
    place = F.zip_with(
        F.slice("_idx", 1, F.greatest(F.size("_idx") - 1, F.lit(0))),
        F.slice("_idx", 2, F.greatest(F.size("_idx") - 1, F.lit(0))),
        lambda a, b: F.when(a >= 0, a * width + b + 2),
    )
    rows = rows.withColumn("_place", place)
    return rows.select("*", *[_looked_up(a).alias(f"_{v}") for v, a in arrays.items()])


def _looked_up(terms: Column) -> Column:
    return F.transform("_place", lambda at: F.try_element_at(terms, at))


def _shifted(x: Column, by: Column) -> Column:
    return F.transform(x, lambda v: v + by)


def _undefined() -> Column:
    return F.transform("_undefined", lambda u: F.coalesce(u, F.lit(True)).cast("bigint"))


def _sums(rows: DataFrame) -> dict[str, Column]:
    """The arrays that the entropy scorer adds up, without NULLs."""
    number = lambda c: F.transform(c, lambda x: F.coalesce(x, F.lit(0.0)))
    return {"num": number("_num"), "den": number("_den"), "bad": _undefined()}


#: Zero of each sum (typed: a sum of longs must start from one).
_ZERO = {"num": 0.0, "den": 0.0, "bad": 0}


def _zero(v: str) -> Column:
    return F.lit(_ZERO[v]).cast("bigint" if v == "bad" else "double")


def _windows(rows: DataFrame, keys: list[str], cfg: MarkovConfig, entropy: bool) -> DataFrame:
    """(key, pos, t0.., score) of every window of ``tokens``, whose first token
    stands at ``first_pos``."""
    w, m = cfg.window, cfg.window - 1
    n = F.size("tokens")
    starts = F.sequence(F.lit(0), F.greatest(n - w, F.lit(0)))
    if cfg.on_unknown != "null":
        odd = F.filter(F.slice("tokens", 1, F.greatest(n - 1, F.lit(0))), lambda t: state_index(t, cfg.states) < 0)
        failed = F.raise_error(F.concat(F.lit("unknown current state: "), F.get(odd, 0))).cast("array<int>")
        starts = F.when(F.size(odd) > 0, failed).otherwise(starts)
    starts = F.when(n >= w, starts).otherwise(F.array().cast("array<int>"))

    def score(p):
        add = lambda name, first=(): reduce(lambda a, b: a + b, [*first, *(F.get(name, p + i) for i in range(m))])
        if not entropy:
            return add("_term") / F.lit(float(m))
        total = {v: add(f"_{v}s", [F.get(f"_before_{v}", p)]) for v in _ZERO}
        return F.when(total["bad"] == 0, F.try_divide(total["num"], total["den"]) / F.lit(float(m)))

    def window(p):
        tokens = [F.get("tokens", p + i).alias(t) for i, t in enumerate(window_token_cols(w))]
        return F.struct((F.col("first_pos") + p).cast("bigint").alias("pos"), *tokens, score(p).alias("score"))

    return rows.select(*keys, F.inline(F.transform(starts, window)))


def score_sequences(sequences: DataFrame, model: DataFrame, cfg: MarkovConfig, key: str | Sequence[str], *, algorithm: str | None = None) -> DataFrame:
    """Every complete window of the rows of ``build_sequences``: ``(key, pos,
    t0..t{W-1}, score)``, as ``score_windows`` gives for the same tokens.

    Rows that are no pieces need no exchange.  Whether there are pieces is asked of
    the table first (one column), so that a table without any has no other plan."""
    keys = _cols(key)
    alg = resolve_algorithm(algorithm or cfg.algorithm)
    if not cfg.dense:  # a dictionary that cannot be inlined: the long form, with joins
        long = explode_sequences(sequences, keys, "tokens", first_pos="first_pos")
        return score_windows(long, model, cfg, keys, algorithm=alg).drop("chunk")
    entropy = alg == "entropy"
    arrays = model_terms(model, cfg, alg)
    rows = sequences.select(*keys, F.col("first_pos").cast("bigint").alias("first_pos"), "piece", F.transform("tokens", known_token).alias("tokens"))

    def termed(part):
        part = _with_terms(part, arrays, cfg)
        if entropy:
            part = part.withColumns({f"_{v}s": x for v, x in _sums(part).items()})
        return part

    def inside(part):
        """``part`` with the sums before each of its transitions, after ``_offset_*``."""
        if not entropy:
            return part
        before = {v: _shifted(sums_before(F.col(f"_{v}s"), _zero(v)), F.col(f"_offset_{v}")) for v in _ZERO}
        return part.withColumns({f"_before_{v}": x for v, x in before.items()})

    zero = {f"_offset_{v}": _zero(v) for v in _ZERO}
    whole = _windows(inside(termed(rows.where("not piece")).withColumns(zero)), keys, cfg, entropy)
    if sequences.where("piece").isEmpty():
        return whole

    pieces = termed(rows.where("piece"))
    edge = F.lit(cfg.window - 1)
    n = F.size("tokens")
    head = pieces.select(*keys, F.col("first_pos").alias("at"), F.slice("tokens", 1, edge).alias("head"))
    last = lambda c: F.slice(c, F.greatest(n - edge + 1, F.lit(1)), edge)
    ends = pieces.select(*keys, "first_pos", (F.col("first_pos") + n).alias("at"), last("tokens").alias("tail"))
    cut = join_keys(ends, head, [*keys, "at"])
    joined = cut.select(
        *keys, F.col("first_pos").alias("_piece"), (F.col("at") - F.size("tail")).alias("first_pos"), "at", F.size("tail").alias("_tail"), F.concat("tail", "head").alias("tokens")
    )
    joined = termed(joined)
    if not entropy:
        return whole.unionByName(_windows(pieces, keys, cfg, entropy)).unionByName(_windows(joined, keys, cfg, entropy))

    # one row per piece and per cut, in order: what the key's later windows start from
    total = lambda v: F.aggregate(f"_{v}s", _zero(v), lambda acc, x: acc + x)
    of_pieces = pieces.select(*keys, F.col("first_pos").alias("at"), F.lit(1).alias("_kind"), *[total(v).alias(v) for v in _ZERO])
    of_cuts = joined.select(*keys, "at", F.lit(0).alias("_kind"), *[F.get(f"_{v}s", F.col("_tail") - 1).alias(v) for v in _ZERO])
    earlier = Window.partitionBy(*keys).orderBy("at", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    offsets = of_pieces.union(of_cuts).select(
        *keys, F.col("at").alias("first_pos"), "_kind", *[F.coalesce(F.sum(v).over(earlier), _zero(v)).alias(f"_offset_{v}") for v in _ZERO]
    ).where("_kind = 1").drop("_kind")
    pieces = inside(join_keys(pieces, offsets, [*keys, "first_pos"]))
    # of the windows across a cut, those that start in the piece's last transitions
    # take the sums from there; the last start, at its last token, has them all
    before = pieces.select(*keys, F.col("first_pos").alias("_piece"), *[_tail_sums(v, edge).alias(f"_before_{v}") for v in _ZERO])
    joined = join_keys(joined, before, [*keys, "_piece"])
    return whole.unionByName(_windows(pieces, keys, cfg, entropy)).unionByName(_windows(joined, keys, cfg, entropy))


def _tail_sums(v: str, edge: Column) -> Column:
    """The sums before each of a piece's last tokens: before its transitions, and
    after the last of them."""
    steps = F.size(f"_before_{v}")
    end = F.when(steps > 0, F.element_at(f"_before_{v}", -1) + F.element_at(f"_{v}s", -1)).otherwise(F.col(f"_offset_{v}"))
    every = F.concat(f"_before_{v}", F.array(end))
    return F.slice(every, F.greatest(F.size(every) - edge + 1, F.lit(1)), edge)
