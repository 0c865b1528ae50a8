"""Whitening of vectors: eigenvectors of their covariance by QDWH spectral divide and conquer, then one projection.

Entries become whole numbers, so that sums are exact. The covariance is gathered centred: each task multiplies
its centred rows into one matrix and only these matrices are added up, in two steps. Everything that reaches the
driver is a matrix of the vectors' dimensions, whatever the number of rows.

On the driver the polar factor of the covariance less a shift (by dynamically weighted Halley iterations) is +1 on
the eigenvectors above the shift and -1 below, which gives the projectors on both subspaces; the matrix is cut
into the two blocks and each is divided again until one dimension is left or all its eigenvalues are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches
from hexledger.llm.vectors import common_length, matrix

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
# Entries are held at plus and minus this number, so that sums of a task's rows fit into 64 bits.
LARGEST = float(1 << 30)
# Partial matrices are added up in so many groups first.
SUM_GROUPS = 64

_EPS = np.finfo(float).eps
_PARTIAL = "part int, line int, entries array<double>"


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of the polar decomposition of a symmetric matrix."""
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    eye, low = np.eye(len(a)), 1e-15  # singular values below `low` may stay short of 1; the caller checks
    for _ in range(30):
        step = np.cbrt(4 * (1 - low**2) / low**4) if low < 1 else 0.0
        root = np.sqrt(1 + step)
        p = root + np.sqrt(max(8 - 4 * step + 8 * (2 - low**2) / (low**2 * root), 0.0)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            stacked, _ = np.linalg.qr(np.vstack((np.sqrt(r) * x, eye)))
            new = (q / r) * x + (p - q / r) / np.sqrt(r) * stacked[: len(a)] @ stacked[len(a) :].T
        else:
            new = (q / r) * x + (p - q / r) * np.linalg.solve(eye + r * x.T @ x, x.T).T
        new = (new + new.T) / 2
        low = min(low * (p + q * low**2) / (1 + r * low**2), 1.0)
        moved, x = np.linalg.norm(new - x), new
        if abs(low - 1) < 10 * _EPS and moved < np.cbrt(_EPS):
            break
    return x


def _divide(a: np.ndarray, scale: float, dice: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """An orthogonal matrix whose first columns span the eigenvectors above a shift, and their number."""
    best = None
    middle = np.trace(a) / len(a)
    spread = np.linalg.norm(a - middle * np.eye(len(a))) / np.sqrt(len(a))
    # Near an eigenvalue the two sides do not come apart; then another shift is taken.
    for shift in (np.median(np.diag(a)), middle, middle + 0.1 * spread, middle - 0.1 * spread):
        above = (polar(a - shift * np.eye(len(a))) + np.eye(len(a))) / 2
        k = round(float(np.trace(above)))
        if not 0 < k < len(a):
            continue
        first, _ = np.linalg.qr(above @ dice.standard_normal((len(a), k)))
        both, _ = np.linalg.qr(above @ first, mode="complete")
        off = np.linalg.norm(both[:, k:].T @ a @ both[:, :k])
        if best is None or off < best[0]:
            best = (off, both, k)
        if off <= 20 * _EPS * scale * np.sqrt(len(a)):
            break
    return best and best[1:]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns; the largest entry is positive) of a symmetric matrix."""
    scale, dice = float(np.linalg.norm(a)), np.random.default_rng(1)
    out = np.zeros_like(a)

    def solve(block: np.ndarray, basis: np.ndarray, at: int) -> None:
        """Eigenvectors of `block`, in terms of `basis`, into the columns of `out` from `at` on."""
        size = len(block)
        equal = np.linalg.norm(block - np.trace(block) / size * np.eye(size)) <= _EPS * scale
        cut = None if size == 1 or equal else _divide(block, scale, dice)
        if cut is None:
            out[:, at : at + size] = basis
            return
        both, k = cut
        for part, start in ((both[:, :k], at), (both[:, k:], at + k)):
            inner = part.T @ block @ part
            solve((inner + inner.T) / 2, basis @ part, start)

    if len(a):
        solve(a, np.eye(len(a)), 0)
    out /= np.linalg.norm(out, axis=0)
    values = np.einsum("ij,ij->j", out, a @ out)
    order = np.argsort(-values, kind="stable")
    out = out[:, order]
    heads = out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])] if out.size else np.zeros(0)
    return values[order], out * np.where(heads < 0, -1.0, 1.0)


@dataclass(frozen=True)
class Whitening:
    length: int
    n: int
    shift: np.ndarray  # whole numbers nearest to the means
    rest: np.ndarray  # sums less n times `shift`
    values: np.ndarray  # all eigenvalues, falling
    vectors: np.ndarray  # the first components, as columns
    scales: np.ndarray  # 1 / sqrt(e), or 0 where the component has no variance
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        total = self.values.sum()
        return self.values[: self.vectors.shape[1]] / total if total > 0 else np.zeros(self.vectors.shape[1])

    def whole(self, entries: np.ndarray) -> np.ndarray:
        return _whole(entries) - self.shift

    def project(self, whole: np.ndarray) -> np.ndarray:
        return ((whole - self.rest / self.n) @ self.vectors) * self.scales

    def deviation(self, whole: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2; null where the exact sum does not fit into 64 bits."""
        most = (int(np.abs(whole).max(initial=0)) + 1) * self.n
        if self.length * most**2 < 1 << 63:
            return ((self.n * whole - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * whole.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(x) if x < 1 << 63 else None for x in exact]


def _whole(entries: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * np.clip(entries, -LARGEST, LARGEST)).astype(np.int64) + OFFSET


def _summed(vectors: DataFrame, column: str, length: int, per_batch: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the matrices that `per_batch` makes of batches of entries."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            made = per_batch(matrix(batch.column(0), length)[1])
            total = made if total is None else total + made
        if total is not None:
            lines = [pa.array(np.full(len(total), TaskContext.get().partitionId(), dtype=np.int32))]
            lines += [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(lines, ["part", "line", "entries"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # the same sum, whichever task ended first
        total = np.sum(table["entries"].to_pylist(), axis=0)
        columns = [pa.array([table[c][0].as_py()], pa.int32()) for c in ("part", "line")]
        return pa.table([*columns, pa.array([total], pa.list_(pa.float64()))], ["part", "line", "entries"])

    parts = vectors.select(column).mapInArrow(partial, _PARTIAL)
    grouped = parts.groupBy("line", F.col("part") % SUM_GROUPS).applyInArrow(lambda _, t: add(t), _PARTIAL)
    rows = grouped.groupBy("line").applyInArrow(lambda _, t: add(t), _PARTIAL).orderBy("line").collect()
    return np.array([r["entries"] for r in rows])


def _exact_sums(vectors: DataFrame, column: str, length: int) -> tuple[int, list[int]]:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, dtype=np.int64)
        for batch in batches:
            whole = _whole(matrix(batch.column(0), length)[1])
            n, total = n + len(whole), total + whole.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total], pa.list_(pa.int64()))], ["n", "sums"])

    parts = vectors.select(column).mapInArrow(partial, "n long, sums array<long>")
    rows = (
        parts.select("n", F.posexplode("sums").alias("at", "sum"))
        .groupBy("at")
        .agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
        .orderBy("at")
        .collect()
    )
    return rows[0]["n"], [int(r["sum"]) for r in rows]


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Means and components of all usable vectors; None without any vector of at least one dimension."""
    bound_batches(vectors.sparkSession)
    length = common_length(vectors, column)
    if not length:
        return None
    n, sums = _exact_sums(vectors, column, length)
    shift = [(2 * s + n) // (2 * n) for s in sums]
    rest = np.array([s - n * m for s, m in zip(sums, shift, strict=True)], dtype=np.int64)
    shift = np.array(shift, dtype=np.int64)

    def products(entries: np.ndarray) -> np.ndarray:
        centred = (_whole(entries) - shift) - rest / n
        return np.vstack((centred.T @ centred, centred.sum(axis=0)))

    gathered = _summed(vectors, column, length, products) / n
    values, vectors_of = eigen((gathered[:-1] + gathered[:-1].T) / 2)
    kept = vectors_of[:, : min(components, length)]
    e = values[: kept.shape[1]]
    real = e > 4 * length * _EPS * max(values[0], 0.0)
    scales = np.where(real, 1 / np.sqrt(np.where(real, e, 1.0)), 0.0)
    found = Whitening(length, n, shift, rest, np.maximum(values, 0.0), kept, scales)

    # The identity is measured on the whitened rows themselves, about the mean that they have.
    mean = (gathered[-1] @ kept) * scales

    def whitened_products(entries: np.ndarray) -> np.ndarray:
        w = found.project(found.whole(entries)) - mean
        return w.T @ w

    covariance = _summed(vectors, column, length, whitened_products) / n
    error = np.abs(covariance - np.eye(len(covariance)))[np.ix_(real, real)]
    return Whitening(length, n, shift, rest, found.values, kept, scales, float(error.max(initial=0.0)))


def whiten(vectors: DataFrame, fitted: Whitening | None, column: str = "embedding") -> DataFrame:
    """The usable rows of `vectors` with `whitened` (one number per component) and `deviation`.

    Rows whose vector is null, holds null or non-finite entries, or has another length than most are left out;
    repeated rows and ids stay as they are, as do all other columns but the two named. Entries beyond `LARGEST`
    are held there; a deviation over 64 bits is null. A component without variance has the value 0 and takes
    no part in the identity error. Without vectors the result is empty.
    """
    bound_batches(vectors.sparkSession)
    rest = vectors.drop("whitened", "deviation")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    state = vectors.sparkSession.sparkContext.broadcast(fitted)  # a matrix of the vectors' dimensions
    names = [*rest.columns, "whitened", "deviation"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = state.value
        for batch in batches:
            if model is None:
                return
            rows, entries = matrix(batch.column(column), model.length)
            whole = model.whole(entries)
            made = [pa.array(list(model.project(whole)), pa.list_(pa.float64())), pa.array(model.deviation(whole), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows)).columns, *made], names)

    return rest.mapInArrow(run, f"{fields}, whitened array<double>, deviation long")
