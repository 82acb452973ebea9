"""Connected components of an edge table, in DataFrame operations.

Large-star and small-star steps alternate (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014) until the edges no longer change;
then every node points to the smallest node of its component.  Each step's
edges are written to the shared folder, so the lineage stays short and nothing
is collected.  Minima are aggregated before the shuffle; a hub's rows are split by
adaptive execution's skew join, as only inner joins meet them.  ``contracted`` makes
stars of a task's edges before they leave it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainwatch.llm._common import written

#: Edges that a task contracts at a time.
ROWS = 1 << 20


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a < b).  Large: each larger neighbour of a node goes to the
    smallest of the node and its neighbours.  Small: each smaller neighbour,
    and the node, go to the smallest of them."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        made = both.where("v > u").join(near, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        near = down.groupBy("u").agg(F.min("v").alias("m"))
        made = down.join(near, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        made = made.where("a <> b").union(near.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return made.where("a <> b").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, node) of every node that is not the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
        x, y = root(x), root(y)
        parent[max(x, y)] = min(x, y)
    roots = np.array([root(x) for x in range(len(nodes))], np.int64)
    moved = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[roots[moved]], nodes[moved]


def contracted(found: Iterable[list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    """Batches of edges (a < b) with the same components as the ``found`` ones.  A
    task that finds edges in Python passes them through this before it returns them:
    some ROWS at a time they become stars, so that fewer steps and fewer rows are
    left to shuffle, and no second Python worker is needed for it."""
    a = b = np.zeros(0, np.int64)
    held = [np.zeros((0, 2), np.int64)]

    def made(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def merged():
        new = np.concatenate(held)
        held[:] = [new[:0]]
        return forest(np.concatenate([a, new[:, 0]]), np.concatenate([b, new[:, 1]]))

    for edges in found:
        held.append(np.array(edges, np.int64).reshape(-1, 2))
        if len(a) + sum(map(len, held)) >= ROWS:
            a, b = merged()
            if len(a) >= ROWS // 2:
                yield made(a, b)
                a = b = np.zeros(0, np.int64)
    yield made(*merged())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b bigint): component is
    the smallest node that can be reached.  No edges give an empty table."""
    pairs = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(pairs.distinct(), "edges")
    state = _state(pairs)
    while state[0]:
        pairs = written(_star(_star(pairs, large=True), large=False), "edges")
        new = _state(pairs)
        if new == state:
            break
        state = new
    roots = pairs.select(F.col("a").alias("node")).distinct()
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots.select("node", F.col("node").alias("component")))
