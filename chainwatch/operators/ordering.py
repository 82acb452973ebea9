"""Ordered per-key operators that never put one key's whole history in a task.

A Markov chain is read along each customer's history, so the natural plan is
``Window.partitionBy(customer).orderBy(time)``.  That plan sends every row of a
customer to a single task; with one customer holding a third of all rows it
would not finish.  The three operators here give the same results with bounded
groups:

``sequence_positions``
    Dense 1-based position of every row inside its key, plus the previous
    row's value of chosen columns.  The rows of hot keys are cut into slices at
    fixed splitters of the order, taken from a sample and stored as one small
    table; each (key, slice) is numbered by a window and shifted by the counts of
    the key's earlier slices.  No row is written.

``with_following``
    Values of the next ``k`` rows.  Positions are cut into chunks of ``chunk``
    positions; the first ``k`` rows of each chunk are copied into the previous
    chunk as a halo, so a window over ``(key, chunk)`` sees every successor.
    Duplication is ``k / chunk`` of the rows.

``running_total``
    Prefix sums along positions: a within-chunk window sum plus chunk offsets,
    which exist only for keys with more than one chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


DEFAULT_HOT_ROWS = 1 << 22
# Tables of at most this many rows are broadcast, others joined by shuffle.
MAX_BROADCAST_KEYS = 100_000
# Cells of the sketch that looks for hot keys, and sampled rows per slice.
SKETCH_CELLS = 1 << 16
SLICE_SAMPLE = 64


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the keys of ``left`` are
    kept.  (Spark plans a null-safe equality like any other join key.)"""
    other = right.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    return left.join(other, reduce(lambda a, b: a & b, on), how).drop(*[f"_k_{c}" for c in keys])


def sequence_positions(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    *,
    carry: Sequence[str] = (),
    pos: str = "pos",
    hot_rows: int = DEFAULT_HOT_ROWS,
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``pos`` (BIGINT, 1..n within each key, following ``order``) and
    ``prev_<c>`` for every column ``c`` in ``carry``.

    ``order`` must be unique within a key (add a tie-breaker column).

    Keys with at most ``hot_rows`` rows are numbered by one window per key.  The
    rows of hotter keys are cut into slices of about ``hot_rows`` rows at fixed
    splitters, whatever the distribution of their order values (ties in the first
    order column are split by the next one).  Slices are a function of the row and
    the stored splitters, so every read (task retry, lost executor, a second
    consumer) sees the same.  One window over (key, slice) numbers all rows; rows of
    hot keys are shifted by the row count of the key's earlier slices.

    Hot keys are found by a sketch: the counts of ``SKETCH_CELLS`` hash cells, one
    small aggregate.  It has no false negatives, and keys are counted only where a
    cell is hot.  A caller that knows the input has at most ``max_rows`` rows (a
    counted micro-batch) and ``max_rows <= hot_rows`` skips it.
    """
    keys = _cols(key)
    order = list(order)

    def plain(frame: DataFrame) -> DataFrame:
        w1 = Window.partitionBy(*keys).orderBy(*order)
        return frame.select(
            "*",
            F.row_number().over(w1).cast("bigint").alias(pos),
            *[F.lag(c).over(w1).alias(f"prev_{c}") for c in carry],
        )

    if max_rows is not None and max_rows <= hot_rows:
        return plain(df)
    splitters = _splitters(df, keys, order, hot_rows)
    if splitters is None:
        return plain(df)

    # a row's slice: the splitters that are not after it (0 for other keys, which have none)
    at = F.struct(*order)
    slice_ = F.coalesce(_not_after(F.col("_splitters"), at), F.lit(0))
    sliced = join_keys(df, F.broadcast(splitters), keys, "left").withColumn("_slice", slice_)
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = sliced.select(
        *df.columns,
        "_slice",
        F.row_number().over(w).alias("_lrn"),
        *[F.lag(c).over(w).alias(f"_lprev_{c}") for c in carry],
    )
    slice_aggs = [F.count(F.lit(1)).alias("_bn")]
    slice_aggs += [F.max_by(c, at).alias(f"_last_{c}") for c in carry]
    wk = Window.partitionBy(*keys).orderBy("_slice")
    offsets = sliced.where(F.col("_splitters").isNotNull()).groupBy(*keys, "_slice").agg(*slice_aggs).select(
        *keys,
        "_slice",
        F.coalesce(F.sum("_bn").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        *[F.lag(f"_last_{c}").over(wk).alias(f"_bprev_{c}") for c in carry],
    )
    return join_keys(local, F.broadcast(offsets), [*keys, "_slice"], "left").select(
        *df.columns,
        (F.coalesce("_off", F.lit(0)) + F.col("_lrn")).cast("bigint").alias(pos),
        *[F.when((F.col("_lrn") == 1) & (F.col("_slice") > 0), F.col(f"_bprev_{c}")).otherwise(F.col(f"_lprev_{c}")).alias(f"prev_{c}") for c in carry],
    )


def _splitters(df: DataFrame, keys: list[str], order: list[str], hot_rows: int) -> DataFrame | None:
    """``(key, _splitters)`` of the hot keys: blocks of ascending order structs that
    cut a key into slices of about ``hot_rows`` rows.  None without hot keys.

    The table, and the one of slices, is broadcast; its bound is the number of
    slices, which is kept below MAX_BROADCAST_KEYS by larger slices where the input
    has more rows than that many of ``hot_rows``."""
    cell = F.pmod(F.xxhash64(*[F.struct(F.col(k).isNull(), k) for k in keys]), F.lit(SKETCH_CELLS))
    cells = df.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    cells = {r["_cell"]: r["_n"] for r in cells.collect()}  # at most SKETCH_CELLS rows
    hot_rows = max(hot_rows, 2 * sum(cells.values()) // MAX_BROADCAST_KEYS)
    hot_cells = df.sparkSession.createDataFrame([(c,) for c, n in cells.items() if n > hot_rows], "_cell bigint")
    if not any(n > hot_rows for n in cells.values()):
        return None
    rows = df.withColumn("_cell", cell).join(F.broadcast(hot_cells), "_cell", "left_semi").drop("_cell")
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = checkpointed(hot)
    if hot.isEmpty():
        return None
    # a sample by hash of the whole order: the same in every run, ties apart
    every = max(1, hot_rows // SLICE_SAMPLE)
    step = max(1, min(SLICE_SAMPLE, hot_rows // every))
    drawn = join_keys(rows, F.broadcast(hot.select(*keys)), keys, "left_semi").where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0)
    ranked = drawn.select(*keys, F.struct(*order).alias("_at"), F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_r"))
    cuts = ranked.where(F.col("_r") % step == 0)
    found = cuts.groupBy(*keys).agg(F.sort_array(F.collect_list("_at")).alias("_splitters"))
    return checkpointed(found.select(*keys, _blocks("_splitters").alias("_splitters")))


#: Splitters of a block: a row is compared with one of each block, then with a block.
SPLITTER_BLOCK = 256


def _blocks(column: str) -> Column:
    starts = F.sequence(F.lit(1), F.size(column), F.lit(SPLITTER_BLOCK))
    return F.transform(starts, lambda s: F.slice(column, s, F.lit(SPLITTER_BLOCK)))


def _not_after(blocks: Column, at: Column) -> Column:
    """How many of the sorted structs in ``blocks`` are at or before ``at``."""
    full = F.size(F.filter(blocks, lambda b: F.get(b, 0) <= at)) - 1
    inside = F.size(F.filter(F.get(blocks, F.greatest(full, F.lit(0))), lambda s: s <= at))
    return F.when(full >= 0, full * SPLITTER_BLOCK + inside).otherwise(F.when(blocks.isNotNull(), F.lit(0)))


def chunk_of(pos: str | Column, chunk: int) -> Column:
    p = F.col(pos) if isinstance(pos, str) else pos
    return F.floor((p - F.lit(1)) / F.lit(chunk)).cast("bigint")


def with_following(
    df: DataFrame,
    key: str | Sequence[str],
    pos: str,
    cols: Sequence[str],
    k: int,
    chunk: int,
    *,
    chunk_col: str = "chunk",
    suffix: str = "_next",
) -> DataFrame:
    """For i in 1..k add ``<c><suffix><i>`` (value of ``c`` at ``pos + i`` of
    the same key) and ``_has<i>`` (whether that row exists).

    Positions must be dense within a key.  The result is partitioned by
    ``(key, chunk_col)`` and sorted by ``pos`` inside it, so later windows on
    the same spec add no shuffle."""
    if k < 1:
        raise ValueError("k must be positive")
    if chunk < k:
        raise ValueError("chunk must be at least k")
    keys = _cols(key)
    own = chunk_of(pos, chunk)
    offset = (F.col(pos) - F.lit(1)) - own * F.lit(chunk)
    targets = F.when((offset < k) & (own > 0), F.array(own, own - F.lit(1))).otherwise(F.array(own))
    ex = df.select("*", own.alias("_own"), F.explode(targets).alias(chunk_col))
    w = Window.partitionBy(*keys, chunk_col).orderBy(pos)
    adds = []
    for i in range(1, k + 1):
        adds.append(F.lead(F.lit(True), i).over(w).isNotNull().alias(f"_has{i}"))
        for c in cols:
            adds.append(F.lead(c, i).over(w).alias(f"{c}{suffix}{i}"))
    return ex.select(*df.columns, chunk_col, "_own", *adds).where(F.col("_own") == F.col(chunk_col)).drop("_own")


def running_total(
    df: DataFrame,
    key: str | Sequence[str],
    pos: str,
    values: dict[str, Column],
    *,
    chunk_col: str = "chunk",
    inclusive: bool = True,
) -> DataFrame:
    """Add, for each ``name -> expr``, the sum of ``expr`` over the rows of the
    same key at positions ``<= pos`` (``< pos`` when not inclusive).

    ``df`` must carry ``chunk_col`` (from ``with_following``).  Only keys with more
    than one chunk have totals and offsets; without any such key the offsets are
    an empty table, and adaptive execution drops their join."""
    keys = _cols(key)
    w = Window.partitionBy(*keys, chunk_col).orderBy(pos)
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    staged = df.select("*", *[e.alias(f"_v_{n}") for n, e in values.items()])
    within = staged.select(
        "*", *[F.coalesce(F.sum(f"_v_{n}").over(frame), F.lit(0)).alias(f"_w_{n}") for n in values]
    )
    several = df.where(F.col(chunk_col) > 0).select(*keys).distinct()
    cut = join_keys(staged, several, keys, "left_semi")
    totals = cut.groupBy(*keys, chunk_col).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    wk = Window.partitionBy(*keys).orderBy(chunk_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, chunk_col, *[F.coalesce(F.sum(f"_t_{n}").over(wk), F.lit(0)).alias(f"_o_{n}") for n in values]
    )
    out = join_keys(within, offsets, [*keys, chunk_col], "left")
    for n in values:
        out = out.withColumn(n, F.coalesce(F.col(f"_o_{n}"), F.lit(0)) + F.col(f"_w_{n}"))
    return out.drop(*[f"_{p}_{n}" for n in values for p in ("v", "w", "o")])
