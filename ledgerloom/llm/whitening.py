"""Embedding whitening: principal components of rounded vectors, scaled to unit variance.

Entries are rounded to whole numbers, and every distinct vector counts once. Counts and sums are whole and exact; the
covariance is summed up in tasks, centred before it is multiplied. Only matrices of one row per dimension reach the driver,
which reduces the covariance to tridiagonal form by Householder reflections, finds the leading eigenvalues by bisection on
Sturm counts and their vectors by inverse iteration, orthogonal again within clusters. The components go to all tasks, which
project every vector; their number and width do not grow with the rows.
"""

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_value, ship
from ledgerloom.session import cut

SCALE = 256
COMPONENTS = 4
CLUSTER = 1e-3  # eigenvalues closer than this share of the largest count as one cluster
RESULT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, entry)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of equal width; what a shorter list lacks is zero."""
    ends = column.offsets.to_numpy(zero_copy_only=False) if len(column) else np.zeros(1, dtype=np.int32)
    flat = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=flat.dtype)
    out[np.arange(width)[None] < sizes[:, None]] = flat
    return out


def tridiagonal(symmetric: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, second diagonal, and the unit vectors of the Householder reflections that lead there."""
    a, size = symmetric.copy(), len(symmetric)
    mirrors: list[np.ndarray | None] = []
    for k in range(size - 2):
        u = a[k + 1:, k].copy()
        length = np.linalg.norm(u)
        if length == np.abs(u[0]):
            mirrors.append(None)  # nothing below the second diagonal
            continue
        target = -np.copysign(length, u[0])
        u[0] -= target
        u /= np.linalg.norm(u)
        rest = a[k + 1:, k + 1:]
        p = rest @ u
        w = 2 * (p - (u @ p) * u)
        rest -= np.outer(u, w) + np.outer(w, u)
        a[k + 1:, k] = 0
        a[k + 1, k] = target
        mirrors.append(u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def below(diagonal: np.ndarray, second: np.ndarray, x: float) -> int:
    """How many eigenvalues are less than ``x``: the negative terms of the Sturm sequence."""
    count, q = 0, 1.0
    squares = np.concatenate([[0.0], second * second])
    tiny = float(np.finfo(float).tiny * max(1.0, squares.max()))
    for d, e in zip((diagonal - x).tolist(), squares.tolist()):
        q = d - e / q
        if abs(q) < tiny:
            q = -tiny
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, second: np.ndarray, wanted: int) -> list[float]:
    """The largest ones, falling: each is bisected until no number lies between the bounds."""
    reach = np.abs(np.concatenate([[0.0], second])) + np.abs(np.concatenate([second, [0.0]]))
    found = []
    for k in range(min(wanted, len(diagonal))):
        low, high = float(np.min(diagonal - reach)), float(np.max(diagonal + reach))
        high += abs(high) * 1e-15 + np.finfo(float).tiny
        while low < (middle := low + (high - low) / 2) < high:
            if below(diagonal, second, middle) >= len(diagonal) - k:
                high = middle
            else:
                low = middle
        found.append(low + (high - low) / 2)
    return found


def shifted_solve(diagonal: np.ndarray, second: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solve (T - shift) y = b by elimination with row exchange; a pivot of zero becomes ``least``."""
    size = len(diagonal)
    d, up, up2 = (diagonal - shift).tolist(), [*second.tolist(), 0.0], [0.0] * size
    low, y = second.tolist(), b.tolist()
    for k in range(size - 1):
        if abs(low[k]) > abs(d[k]):
            d[k], low[k] = low[k], d[k]
            up[k], d[k + 1] = d[k + 1], up[k]
            up2[k], up[k + 1] = up[k + 1], up2[k]
            y[k], y[k + 1] = y[k + 1], y[k]
        d[k] = d[k] or least
        factor = low[k] / d[k]
        d[k + 1] -= factor * up[k]
        up[k + 1] -= factor * up2[k]
        y[k + 1] -= factor * y[k]
    d[-1] = d[-1] or least
    out = np.zeros(size + 2)
    for k in range(size - 1, -1, -1):
        out[k] = (y[k] - up[k] * out[k + 1] - up2[k] * out[k + 2]) / d[k]
        if abs(out[k]) > 1e200:  # only the direction counts
            out /= 1e200
            y = [v / 1e200 for v in y]
    return out[:size]


def leading_components(symmetric: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as rows."""
    size = len(symmetric)
    diagonal, second, mirrors = tridiagonal(symmetric)
    values = leading_eigenvalues(diagonal, second, wanted)
    norm = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(second).max(initial=0)))
    least = (norm or 1.0) * np.finfo(float).eps
    vectors: list[np.ndarray] = []
    start = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * abs(values[0]):
            start = k  # a new cluster
        rng = np.random.default_rng(k)
        y = rng.normal(size=size)
        for _ in range(5):
            # Within a cluster the shifts differ a little, so that the solutions do.
            y = shifted_solve(diagonal, second, value - (k - start) * 2 * least, y, least)
            y /= np.abs(y).max()
            for _ in range(2):
                for other in vectors[start:]:
                    y -= (other @ y) * other
            length = np.linalg.norm(y)
            y = y / length if length > 1e-8 else rng.normal(size=size)
        vectors.append(y / np.linalg.norm(y))
    for y in vectors:
        for k in range(len(mirrors) - 1, -1, -1):
            if mirrors[k] is not None:
                y[k + 1:] -= 2 * (mirrors[k] @ y[k + 1:]) * mirrors[k]
    return np.array(values), np.array(vectors).reshape(len(vectors), size)


@dataclass
class Whitening:
    """What is fitted: the number of distinct vectors, their sums by dimension, the trace of their covariance, and the leading
    eigenvalues and components. Components without variance are left out."""

    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T


def _whole_sums(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        total = [0] * width
        for batch in batches:
            x = matrix(batch.column(0), width)
            fits = len(x) and max(abs(int(x.max())), abs(int(x.min()))) < (1 << 62) // len(x)
            part = x.sum(axis=0).tolist() if fits else [sum(map(int, c)) for c in x.T]
            total = [a + b for a, b in zip(total, part)]
        sums = pa.array([Decimal(s) for s in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), sums], ["dim", "total"])

    return run


def _products(shipped, of: Callable[..., np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of the products of every two columns, and of the columns (``j`` is -1), of what ``of`` makes of a batch."""

    def run(batches):
        width, size = shipped.value["width"], shipped.value["size"]
        products, sums = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            rows = of(matrix(batch.column(0), width).astype(np.float64), **shipped.value)
            products += rows.T @ rows
            sums += rows.sum(axis=0)
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, np.arange(size)]).astype(np.int32)),
             pa.array(np.concatenate([j, np.full(size, -1)]).astype(np.int32)),
             pa.array(np.concatenate([products[i, j], sums]))], ["i", "j", "v"])

    return run


def _covariance(fit: DataFrame, n: int, size: int, of: Callable, **data) -> np.ndarray:
    """Divisor n. ``of`` centres the rows; what rounding leaves of their mean is taken off, too."""
    shipped = ship(fit.sparkSession, size=size, **data)
    sums = fit.select("x").mapInArrow(_products(shipped, of), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out, mean = np.zeros((size, size)), np.zeros(size)
    for r in sums.collect():  # one row for every two dimensions
        if r.j < 0:
            mean[r.i] = r.v / n
        else:
            out[r.i, r.j] = out[r.j, r.i] = r.v / n
    shipped.destroy()
    return out - np.outer(mean, mean)


def _centred(x: np.ndarray, mean: np.ndarray, **_) -> np.ndarray:
    return x - mean


def _whitened(x: np.ndarray, model: dict, **_) -> np.ndarray:
    return Whitening(**model).project(x)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, int]:
    """The model of the distinct vectors ``x``, and their width; no model where there is no vector or no entry."""
    n, width = fit.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n or not width:
        return None, width or 0
    sums = [0] * width
    for r in fit.mapInArrow(_whole_sums(width), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("s")).collect():
        sums[r.dim] = int(r.s)
    model = Whitening(n, sums, 0.0, np.zeros(0), np.zeros((0, width)))
    covariance = _covariance(fit, n, width, _centred, width=width, mean=model.mean)
    model.trace = float(np.trace(covariance))
    values, vectors = leading_components(covariance, components)
    there = values > model.trace * width * np.finfo(float).eps
    model.eigenvalues, model.components = values[there], vectors[there]
    return model, width


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sum of (n x - sum) squared of each row; None beyond 64 bits."""
    largest = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums)) if x.size else 0
    if largest * largest * x.shape[1] < 1 << 63:
        gap = x * n - np.array(sums)
        return np.einsum("ij,ij->i", gap, gap).tolist()
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
    return [d if d < 1 << 63 else None for d in exact]


def _project(shipped) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        model, width, error = Whitening(**shipped.value["model"]), shipped.value["width"], shipped.value["error"]
        size = len(model.eigenvalues)
        explained = model.eigenvalues / model.trace if size else model.eigenvalues
        for batch in batches:
            x, rows = matrix(batch.column(1), width), batch.num_rows
            again = np.repeat(np.arange(rows), size)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(again)), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * size, model.n)), pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(again)),
                pa.array(model.project(x.astype(np.float64)).ravel()), pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * size, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: every usable vector on each component.

    Vectors that are null or hold null or non-finite entries are left out. An entry beyond 64 bits after scaling counts as the
    nearest 64-bit number. Vectors shorter than the longest count as zero where they end, and
    vectors of different lengths as different. Repeated rows repeat their results
    and count once in the fit; null ids stay. Components without variance (all, if there is one distinct vector) have no rows,
    and an empty table has none. ``deviation`` is null where the exact number takes over 64 bits, which unit vectors of 256
    steps reach at twelve million distinct ones. Other columns are not looked at.
    """
    whole = F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * scale).cast("long"))
    rows = vectors.where(usable(F.col(vector))).select(F.col(id).alias("vec_id"), whole.alias("x"))
    schema = RESULT.format(id=vectors.schema[id].dataType.simpleString())
    fit = cut(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"))
    model, width = fit_whitening(fit, components)
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], schema)
    size = len(model.eigenvalues)
    spread = _covariance(fit, model.n, size, _whitened, width=width, model=asdict(model))
    error = float(np.abs(spread - np.eye(size)).max())
    return rows.mapInArrow(_project(ship(vectors.sparkSession, model=asdict(model), width=width, error=error)), schema)


by_value(__name__)
