"""Text forms at the edges: transaction lines, sequence lines, alert and
history messages.  All are column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Stands for NULL in a line's field; a field that begins with one of MARKS, or an
#: empty token, is written with a backslash before it, which readers take off.
NULL_FIELD = "\\N"
MARKS = r"^[\\@]"


def field(col, empty: bool = True) -> Column:
    """A value as a field of a line.  With ``empty`` an empty one stays empty; a
    token cannot, as readers drop empty fields at the end of a line."""
    text = _c(col).cast("string")
    marked = text.rlike(MARKS) if empty else (text.rlike(MARKS) | (text == ""))
    return F.when(text.isNull(), F.lit(NULL_FIELD)).when(marked, F.concat(F.lit("\\"), text)).otherwise(text)


def unfield(text: Column) -> Column:
    """The value that :func:`field` wrote."""
    return F.when(text == NULL_FIELD, F.lit(None).cast("string")).when(text.startswith("\\"), F.substring(text, 2, 1 << 30)).otherwise(text)


def transaction_line(customer, transaction, token) -> Column:
    """``customerId,transactionId,token``; NULL fields are written as ``\\N``."""
    return F.concat_ws(",", field(customer), field(transaction), field(token))


def well_formed(col) -> Column:
    """Whether a transaction line has its three fields (further ones are ignored)."""
    return F.coalesce(F.size(F.split(_c(col).cast("string"), ",")) >= 3, F.lit(False))


def parse_transaction_lines(lines: DataFrame, col: str = "value", mode: str = "strict", keep: Sequence[str] = ()) -> DataFrame:
    """Split ``customerId,transactionId,token`` lines; ``keep`` names columns to
    carry along.

    Fields beyond the third are ignored.  ``strict`` fails the job on a line
    with fewer than three fields; ``permissive`` keeps such lines with
    ``malformed = true`` and NULL fields, so callers can split them off."""
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode={mode!r}")
    line = F.col(col).cast("string")
    ok = well_formed(line)
    if mode == "strict":
        failed = F.raise_error(F.concat(F.lit("malformed transaction: "), F.coalesce(line, F.lit("NULL"))))
        ok = F.when(ok, F.lit(True)).otherwise(failed.cast("boolean"))
    parts = F.split(line, ",")
    cols = [F.when(F.col("_ok"), unfield(F.get("_p", i))).alias(name) for i, name in enumerate(("customer_id", "transaction_id", "token"))]
    return lines.select(ok.alias("_ok"), parts.alias("_p"), *keep).select(*cols, (~F.col("_ok")).alias("malformed"), *keep)


def sequence_line(customer, tokens, first_pos=None) -> Column:
    """``customerId,tok1,tok2,...`` from an array of tokens.

    With a non-NULL ``first_pos`` the line is one piece of a longer sequence:
    ``customerId,@first_pos,tok1,...``.  NULL customers and tokens are written as
    ``\\N`` and read back as NULL (see :func:`field`)."""
    mark = [] if first_pos is None else [F.concat(F.lit("@"), _c(first_pos).cast("string"))]
    return F.concat_ws(",", field(customer), *mark, F.transform(_c(tokens), lambda t: field(t, empty=False)))


def parse_sequence_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``customerId,tok1,...`` → ``(customer_id, first_pos, tokens
    ARRAY<STRING>)``; ``first_pos`` is NULL unless the line is a piece of a
    longer sequence (``customerId,@first_pos,tok1,...``).  Trailing empty fields
    are dropped, as a Java ``split`` does."""
    s = F.regexp_replace(F.col(col).cast("string"), ",+$", "")
    parts = F.split(s, ",")
    mark = F.regexp_extract(F.coalesce(F.get(parts, 1), F.lit("")), r"^@(\d+)$", 1)
    skip = F.when(mark != "", 2).otherwise(1)
    tokens = F.slice(parts, skip + 1, F.greatest(F.size(parts) - skip, F.lit(0)))
    return lines.select(
        unfield(F.get(parts, 0)).alias("customer_id"),
        F.when(mark != "", mark.cast("bigint")).alias("first_pos"),
        F.transform(tokens, unfield).alias("tokens"),
    )


def history_message(customer, tokens) -> Column:
    """``customerId.tok1,tok2`` (only the tokens of one micro-batch)."""
    return F.concat(F.coalesce(_c(customer).cast("string"), F.lit("NULL")), F.lit("."), F.array_join(_c(tokens), ",", "NULL"))


def alert_message(customer, window_tokens: Sequence, score) -> Column:
    """``<id> : t1 t2 t3 t4 t5 : <score>``: every token is followed by one
    space, and the score is printed as the JVM prints a double."""
    toks = [F.coalesce(_c(t), F.lit("NULL")) for t in window_tokens]
    return F.concat(
        F.coalesce(_c(customer).cast("string"), F.lit("NULL")),
        F.lit(" : "),
        *[F.concat(t, F.lit(" ")) for t in toks],
        F.lit(": "),
        _c(score).cast("string"),
    )


def double_text(col) -> Column:
    """A double as the JVM's ``Double.toString`` prints it."""
    return _c(col).cast("string")
