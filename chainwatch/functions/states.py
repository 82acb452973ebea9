"""State dictionary lookups as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MAX_BROADCAST_CELLS, parse_states

#: How a NULL token is shown and looked up.
NULL_TOKEN = "NULL"


def states_array(states: Sequence[str]) -> Column:
    """The dictionary as a literal ``ARRAY<STRING>`` (one SQL expression)."""
    quoted = ", ".join("'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'" for s in states)
    return F.expr(f"array({quoted})")


def state_index(col: str | Column, states: Sequence[str]) -> Column:
    """Index of the token in the dictionary (first match), -1 when unknown or
    NULL.  BIGINT.  A linear probe of a literal array: no join, stays in codegen."""
    return F.coalesce(_position(col, states), F.lit(-1).cast("bigint"))


def _position(col: str | Column, states: Sequence[str]) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (F.array_position(states_array(states), c) - F.lit(1)).cast("bigint")


def known_token(col: str | Column) -> Column:
    """The token, with ``NULL_TOKEN`` for NULL.

    The ordered operators look ahead, and NULL there means that no row follows;
    a row whose token is NULL has an unknown state instead."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(NULL_TOKEN))


#: States up to which a token is probed in a literal array; more are joined.
MAX_PROBED = 256


def with_index(df: DataFrame, tokens: dict[str, str], states: Sequence[str]) -> DataFrame:
    """``df`` with the state index (BIGINT, -1 when unknown or NULL) of each token
    column, ``{token column: name of its index}``.

    A small dictionary is probed in place.  A large one is joined; it came through
    the driver, so its size is known, and it is broadcast up to MAX_BROADCAST_CELLS."""
    if len(states) <= MAX_PROBED:
        return df.withColumns({i: state_index(t, states) for t, i in tokens.items()})
    table = df.sparkSession.createDataFrame([(s, i) for i, s in enumerate(states)], "_state string, _at bigint")
    if len(states) <= MAX_BROADCAST_CELLS:
        table = F.broadcast(table)
    for t, i in tokens.items():
        joined = df.join(table, F.col(t) == F.col("_state"), "left")
        df = joined.withColumn(i, F.coalesce("_at", F.lit(-1).cast("bigint"))).drop("_state", "_at")
    return df


def state_name(idx: str | Column, states: Sequence[str]) -> Column:
    i = F.col(idx) if isinstance(idx, str) else idx
    return F.element_at(states_array(states), (i + F.lit(1)).cast("int"))


def checked_index(col: str | Column, states: Sequence[str], on_unknown: str, what: str = "state") -> Column:
    """``state_index`` that fails the job on an unknown token when
    ``on_unknown == "error"`` and yields NULL when it is ``"null"``.

    SQL's NULL stands for a row that does not exist and stays NULL: filters may
    be evaluated before it is gone (see :func:`known_token`)."""
    return checked(_position(col, states), col, on_unknown, what)


def checked(idx: Column, col: str | Column, on_unknown: str, what: str = "state") -> Column:
    """The index ``idx`` of a token, checked as :func:`checked_index` says."""
    c = F.col(col) if isinstance(col, str) else col
    if on_unknown == "error":
        msg = F.concat(F.lit(f"unknown {what}: "), F.coalesce(c, F.lit("NULL")))
        return F.when(idx < 0, F.raise_error(msg).cast("bigint")).otherwise(idx)
    if on_unknown == "null":
        return F.when(idx < 0, F.lit(None).cast("bigint")).otherwise(idx)
    return idx


def read_states(spark: SparkSession, path: str) -> tuple[str, ...]:
    """A dictionary file: one comma list, position = index."""
    lines = [r.value for r in spark.read.text(path).where("trim(value) <> ''").take(2)]
    if len(lines) != 1:
        raise ValueError(f"{path} must hold one line of states")
    return parse_states(lines[0])
