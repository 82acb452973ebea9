"""Sequence operators over the long form ``(key..., pos, token)``.

The long form (one row per token, dense ``pos``) is the canonical layout:
every operator partitions it by ``(key, chunk)`` so work per task is bounded.
Arrays appear only at the text and streaming edges, one array per chunk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CHUNK, MarkovConfig
from ..functions.states import known_token, state_index
from ..functions.text import sequence_line
from .ordering import _cols, chunk_of, with_following


def window_token_cols(window: int) -> list[str]:
    return [f"t{i}" for i in range(window)]


def transitions(
    tokens: DataFrame,
    key: str | Sequence[str],
    cfg: MarkovConfig,
    *,
    pos: str = "pos",
    token: str = "token",
) -> DataFrame:
    """Bigrams: ``n`` tokens give ``n - 1`` rows ``(key, pos, chunk, src,
    dst)`` with ``src`` at ``pos`` and ``dst`` at ``pos + 1``; 0 or 1 token give
    none."""
    keys = _cols(key)
    f = with_following(tokens.select(*keys, pos, known_token(token).alias(token)), keys, pos, [token], 1, cfg.chunk)
    return f.where(F.col("_has1")).select(
        *keys, pos, "chunk", F.col(token).alias("src"), F.col(f"{token}_next1").alias("dst")
    )


def token_windows(
    tokens: DataFrame,
    key: str | Sequence[str],
    cfg: MarkovConfig,
    *,
    pos: str = "pos",
    token: str = "token",
    extra: Sequence[str] = (),
    index: bool = False,
) -> DataFrame:
    """Sliding windows of ``W`` tokens, step 1: ``max(0, n - W + 1)`` rows
    ``(key, pos, chunk, t0..t{W-1})`` where ``pos`` is the window start.

    With ``index`` the tokens' state indices ``i0..i{W-1}`` (-1 for an unknown
    token) come along; each token is looked up once, before the halo window."""
    keys = _cols(key)
    k = cfg.window - 1
    rows = tokens.select(*keys, pos, known_token(token).alias(token), *extra)
    names = {token: "t"}
    if index:
        rows = rows.withColumn("_index", state_index(token, cfg.states).cast("int"))
        names["_index"] = "i"
    f = with_following(rows, keys, pos, list(names), k, cfg.chunk)
    cols = [F.col(f"{c}_next{j}" if j else c).alias(f"{n}{j}") for c, n in names.items() for j in range(k + 1)]
    return f.where(F.col(f"_has{k}")).select(*keys, pos, "chunk", *extra, *cols)


def build_sequences(
    tokens: DataFrame,
    key: str | Sequence[str],
    cfg: MarkovConfig,
    *,
    pos: str = "pos",
    token: str = "token",
) -> DataFrame:
    """Tokens per customer in order, one row per chunk of ``cfg.chunk``
    positions: ``(key, chunk, first_pos, n_tokens, piece, tokens
    ARRAY<STRING>)``.

    A customer shorter than the chunk has exactly one row; a longer history is
    cut so no row (or task) exceeds the chunk.  ``piece`` marks rows of which
    the sequence may have more (they end with a chunk, or are not the first);
    ``first_pos`` puts them together again."""
    keys = _cols(key)
    grouped = tokens.select(*keys, pos, token, chunk_of(pos, cfg.chunk).alias("chunk")).groupBy(*keys, "chunk")
    agg = grouped.agg(
        F.min(pos).alias("first_pos"),
        F.count(F.lit(1)).alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct(F.col(pos), F.col(token)))).alias("_s"),
    )
    piece = (F.col("chunk") > 0) | ((F.col("first_pos") + F.col("n_tokens") - 1) % F.lit(cfg.chunk) == 0)
    return agg.select(
        *keys, "chunk", "first_pos", "n_tokens", piece.alias("piece"), F.transform("_s", lambda x: x[token]).alias("tokens")
    )


def sequence_lines(sequences: DataFrame, key: str = "customer_id", tokens: str = "tokens") -> DataFrame:
    """Text lines, one per sequence row: ``customerId,tok1,tok2,...``, and
    ``customerId,@first_pos,tok1,...`` for the pieces of a sequence that fills
    more than a chunk, which :func:`lines_to_long` joins again."""
    piece = F.when(F.col("piece"), sequence_line(F.col(key), F.col(tokens), F.col("first_pos")))
    return sequences.select(F.coalesce(piece, sequence_line(F.col(key), F.col(tokens))).alias("value"))


def explode_sequences(
    sequences: DataFrame, key: str | Sequence[str], tokens: str = "tokens", *, first_pos: str | None = None
) -> DataFrame:
    """Array form → long form ``(key, pos, token)``.  ``pos`` starts at the
    row's ``first_pos`` when given, else at 1."""
    keys = _cols(key)
    base = F.col(first_pos) if first_pos else F.lit(1)
    return sequences.select(*keys, base.cast("bigint").alias("_b"), F.posexplode(tokens).alias("_i", "token")).select(
        *keys, (F.col("_b") + F.col("_i")).cast("bigint").alias("pos"), "token"
    )


def lines_to_long(lines: DataFrame, parsed_key: str = "customer_id") -> DataFrame:
    """Sequence lines read from text → long form ``(customer_id, line_id, pos,
    token)``.

    A plain line is an independent sequence (transitions never cross lines), so
    the key is ``(customer_id, line_id)``; ``line_id`` is stable for a given
    input.  The pieces of a longer sequence have ``line_id`` -1 and their own
    positions, so a customer's pieces are one sequence again, in any order."""
    from ..functions.text import parse_sequence_lines

    own = F.when(F.col("first_pos").isNull(), F.col("_n")).otherwise(F.lit(-1))
    parsed = parse_sequence_lines(lines).withColumn("_n", F.monotonically_increasing_id())
    parsed = parsed.select(parsed_key, own.cast("bigint").alias("line_id"), F.coalesce("first_pos", F.lit(1)).alias("first_pos"), "tokens")
    return explode_sequences(parsed, [parsed_key, "line_id"], "tokens", first_pos="first_pos")


def sequence_tails(
    tokens: DataFrame, key: str | Sequence[str], n: int, *, pos: str = "pos", token: str = "token", chunk: int = DEFAULT_CHUNK
) -> DataFrame:
    """The last ``n`` tokens of every sequence, in order: ``(key, n_tokens,
    tail ARRAY<STRING>)`` — what a stream carries into its next batch.

    A row belongs to the tail if it has no ``n``-th successor, so one halo window
    finds them without a join, and only ``n`` rows per key are ever grouped."""
    keys = _cols(key)
    ahead = with_following(tokens.select(*keys, pos, token), keys, pos, [], n, chunk)
    agg = ahead.where(~F.col(f"_has{n}")).groupBy(*keys).agg(
        F.max(pos).alias("n_tokens"), F.sort_array(F.collect_list(F.struct(F.col(pos), F.col(token)))).alias("_s")
    )
    return agg.select(*keys, "n_tokens", F.transform("_s", lambda x: x[token]).alias("tail"))
