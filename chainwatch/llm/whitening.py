"""Embedding whitening by QDWH spectral divide-and-conquer.

1. Vectors become integers, floor(256 c); the fit list has each distinct one once.
2. Tasks sum the fit list exactly (split integers), then the products of its
   centred vectors; what reaches the driver is one d-vector and one d x d matrix,
   with d at most ``WIDEST``, however many rows there are.
3. The covariance V is split: the polar factor U of V - s I, by the dynamically
   weighted Halley iteration (QDWH; Nakatsukasa and Higham, "Stable and Efficient
   Spectral Divide and Conquer Algorithms", 2013), gives the projector (U + I) / 2
   on the eigenvectors above the shift s.  An orthonormal basis of it and one of its
   complement reduce V to two smaller blocks, which are split in turn until a
   block is a multiple of the identity.  Blocks beyond the wanted components are
   not split.
4. The components go to the tasks with the closure (4 d numbers) and every row is
   projected; one more pass over the fit list checks the result's covariance.

Defined cases: a row whose vector is null, empty, or holds a null or non-finite
entry is dropped, as is one whose length is not the most common (ties: the
longest); 256 c outside the range of a long becomes its nearest end; rows with a null
or repeated id are rows like any other; components whose variance is nil beside the
trace (fewer distinct vectors than dimensions) have a null ``whitened`` and take no
part in ``identity_error``; without variance ``explained`` is null; a deviation
beyond a long is null; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainwatch.llm._common import written

SCALE = 256
#: Most dimensions: the driver holds a d x d matrix.
WIDEST = 2_048
EPS = np.finfo(np.float64).eps


# --------------------------------------------------------------------------
# spectral divide and conquer


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix (its sign), by QDWH."""
    n = len(a)
    x = a / max(np.linalg.norm(a, 1), np.finfo(np.float64).tiny)
    # lower bound of the least singular value, from the inverse of the triangle of x
    r = np.linalg.qr(x, mode="r")
    least = np.abs(np.diag(r)).min()
    low = EPS
    if least > n * EPS:
        low = min(max(1 / (np.linalg.norm(np.linalg.inv(r), 1) * np.sqrt(n)), EPS), 1.0)
    eye = np.eye(n)
    for _ in range(20):
        gamma = np.cbrt(4 * max(1 - low**2, 0.0) / low**4)
        a_ = np.sqrt(1 + gamma) + np.sqrt(8 - 4 * gamma + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + gamma))) / 2
        b = (a_ - 1) ** 2 / 4
        c = a_ + b - 1
        before = x
        if c > 100:  # far from orthogonal: the inverse-free step
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
            x = b / c * x + (a_ - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            x = b / c * x + (a_ - b / c) * np.linalg.solve(eye + c * (x @ x), x)
        x = (x + x.T) / 2
        low = min(low * (a_ + b * low**2) / (1 + c * low**2), 1.0)
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) < np.sqrt(EPS):
            break
    return x


def _basis(projector: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """An orthonormal basis of a projector's range."""
    q = np.random.default_rng(seed).standard_normal((len(projector), rank))
    for _ in range(3):
        q = np.linalg.qr(projector @ q)[0]
    return q


def divide(a: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of ``a``, the one of the larger
    eigenvalues first; None if all eigenvalues agree within the tolerance."""
    n = len(a)
    if n == 1 or np.linalg.norm(a - np.trace(a) / n * np.eye(n)) <= tolerance:
        return None
    radius = np.abs(a).sum(axis=1) - np.abs(np.diag(a))
    low, high = (np.diag(a) - radius).min(), (np.diag(a) + radius).max()
    shift = np.median(np.diag(a))
    for attempt in range(200):
        if not low < shift < high:
            shift = (low + high) / 2
        p = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
        rank = int(round(np.trace(p)))
        if np.linalg.norm(p @ p - p) > 1e-8:  # the shift is an eigenvalue: step aside
            shift += (high - low) * 1e-3 * (1 + attempt) * (-1) ** attempt
            continue
        if 0 < rank < n:
            upper, lower = _basis(p, rank, rank), _basis(np.eye(n) - p, n - rank, rank)
            whole = np.linalg.qr(np.hstack([upper, lower]))[0]
            return whole[:, :rank], whole[:, rank:]
        low, high = (low, shift) if rank == 0 else (shift, high)
        if high - low <= tolerance:
            return None
        shift = (low + high) / 2
    return None


def eigenpairs(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and their
    unit eigenvectors as columns."""
    tolerance = 4 * len(a) * EPS * np.linalg.norm(a)
    values, vectors = [], []

    def split(block, basis):
        if len(values) >= most:
            return
        halves = divide(block, tolerance)
        if halves is None:
            for v in basis.T:
                values.append(v @ a @ v)
                vectors.append(v)
            return
        for q in halves:
            own = basis @ q
            split((own.T @ a @ own + (own.T @ a @ own).T) / 2, own)

    if len(a):
        split((a + a.T) / 2, np.eye(len(a)))
    order = np.argsort(-np.array(values), kind="stable")[:most]
    return np.array(values)[order], np.array(vectors).reshape(-1, len(a))[order].T


# --------------------------------------------------------------------------
# the fit, in Spark


def quantised(table: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, x) of the usable rows, x the integer vector."""
    rows = table.select(F.col(id).alias("id"), F.col(vector).alias("v")).where("v is not null and size(v) > 0")
    infinite = F.lit(float("inf"))
    # a comparison with null or NaN entries must not pass: NaN is the largest in SQL
    bad = F.exists("v", lambda c: c.isNull() | ~(F.abs(c.cast("double")) < infinite))
    rows = rows.where(~bad)
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("rows"))
    width = widths.orderBy(F.desc("rows"), F.desc("width")).first()
    width = width.width if width else 0
    if width > WIDEST:
        raise ValueError(f"{width} dimensions; at most {WIDEST} are handled")
    return rows.where(F.size("v") == width).select("id", F.transform("v", lambda c: F.floor(c.cast("double") * SCALE).cast("bigint")).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


@dataclass(frozen=True)
class Model:
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def usable(self) -> np.ndarray:
        """Which components have a variance beside the trace."""
        return self.values > len(self.sums) * EPS * self.trace

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows; NaN for components that have none."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = self.vectors / np.sqrt(np.where(self.usable, self.values, np.nan))
        return (x - self.mean) @ scaled


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact column sums: each entry is summed as two halves."""

    def run(batches):
        total, n = None, 0
        for b in batches:
            if b.num_rows:
                x = _matrix(b)
                part = ((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))
                total = part if total is None else (total[0] + part[0], total[1] + part[1])
                n += b.num_rows
        if n:
            columns = [pa.array(np.arange(len(total[0]))), pa.array(total[0]), pa.array(total[1]), pa.array([n] * len(total[0]), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "high", "low", "n"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    made = fit.select("x").mapInArrow(run, "i bigint, high bigint, low bigint, n bigint").groupBy("i").agg(exact("high"), exact("low"), F.sum("n").alias("n"))
    rows = sorted(made.collect())
    return (rows[0].n, [(int(r.high) << 32) + int(r.low) for r in rows]) if rows else (0, [])


def _products(fit: DataFrame, width: int, make) -> np.ndarray:
    """Sum over the fit list of y y' for y = make(x), ``width`` numbers a row."""

    def run(batches):
        total = np.zeros((width, width))
        for b in batches:
            if b.num_rows:
                y = make(_matrix(b))
                total += y.T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    cells = fit.select("x").mapInArrow(run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    i, j, v = (cells.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j] = v
    out[j, i] = v
    return out


def fit(vectors: DataFrame, components: int = 4) -> Model | None:
    """The model of ``quantised`` rows; None without any."""
    distinct = written(vectors.select("x").distinct(), "whitening-fit")
    n, sums = _sums(distinct)
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    covariance = _products(distinct, len(sums), lambda x: x - mean) / n
    values, axes = eigenpairs(covariance, components)
    model = Model(n, tuple(sums), values, axes, float(np.trace(covariance)))
    use = np.flatnonzero(model.usable)
    if not len(use):
        return model
    # one more column of ones gives the sums beside the products
    check = _products(distinct, len(use) + 1, lambda x: np.hstack([model.project(x)[:, use], np.ones((len(x), 1))])) / n
    centre = check[:-1, -1]
    error = float(np.abs(check[:-1, :-1] - np.outer(centre, centre) - np.eye(len(use))).max())
    return Model(model.n, model.sums, values, axes, model.trace, error)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2; None beyond a long."""
    most = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums))
    if len(sums) * most**2 < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    out = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [d if d < 1 << 63 else None for d in out]


def whiten(table: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """One row per usable row of ``table`` and component: ``id``, component, n,
    deviation, whitened, explained, identity_error."""
    kind = table.schema[id].dataType.simpleString()
    name = f"`{id}`"
    schema = f"{name} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = quantised(table, id, vector)
    model = fit(rows, components)
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    explained = (model.values / model.trace).tolist() if model.trace > 0 else [None] * len(model.values)

    def run(batches):
        k = len(model.values)
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b)
            at = pa.array(np.repeat(np.arange(len(x)), k))
            white = model.project(x).ravel()
            columns = [
                b.column("id").take(at),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, model.n, np.int64)),
                pa.array(deviations(x, model.n, model.sums), pa.int64()).take(at),
                pa.array(white, mask=np.isnan(white)),
                pa.array(explained * len(x), pa.float64()),
                pa.array([model.identity_error] * (len(x) * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id, *"component n deviation whitened explained identity_error".split()])

    return rows.mapInArrow(run, schema)
