"""End-to-end jobs a user calls: order transactions, train, split.

Each returns a DataFrame and needs no intermediate file (write one with the
``sources`` helpers when a hand-off between jobs is wanted).  Two steps run small
jobs while a plan is built: ordering counts the rows per key to find hot keys,
and scoring collects the S × (S + 1) terms of the model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MarkovConfig
from ..operators.model import train
from ..operators.ordering import sequence_positions
from ..operators.sequences import transitions


def transactions_to_tokens(
    transactions: DataFrame,
    *,
    key: str = "customer_id",
    order: Sequence[str] = ("transaction_id",),
    token: str = "token",
    **kw,
) -> DataFrame:
    """Raw transactions (one token each, with an order column) → long form
    ``(key, pos, token)``.  The transaction id is dropped after ordering."""
    pos = sequence_positions(transactions.select(key, *order, token), key, list(order), **kw)
    return pos.select(key, "pos", F.col(token).alias("token"))


def train_model(tokens: DataFrame, cfg: MarkovConfig, *, key: str | Sequence[str] = "customer_id") -> DataFrame:
    return train(transitions(tokens, key, cfg), cfg, key=key)


def holdout_split(tokens: DataFrame, split_col: str, split_value, *, key: str | Sequence[str] = "customer_id"):
    """Train on rows before ``split_value``, score the rest.  Both parts keep
    their global positions, which stay dense inside each part because the split
    follows the sequence order.  A NULL split value sorts first and counts as
    before, so that every row is in one part."""
    later = F.coalesce(F.col(split_col) >= F.lit(split_value), F.lit(False))
    return tokens.where(~later), tokens.where(later)
