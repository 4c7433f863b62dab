"""Embedding whitening with components found by contour integration (FEAST).

Entries become integers ``x = floor(1024 c) + 100000``; sums are exact, the covariance is summed over centred
rows on the executors, and only a matrix of the square of the dimension reaches the driver. There

* inertia counts (signs of the blocks of a symmetric factorisation of V - t) place cuts below the wanted
  eigenvalues, in gaps, and say how many lie in each interval between two cuts;
* for each interval a quadrature along a circle around it sums solves with complex shifts of V. That projects
  a random block onto the interval's eigenvectors; Rayleigh-Ritz extracts them. The projection is repeated
  until residuals are at rounding level;
* an interval is accepted if it holds as many components as its inertia count; otherwise the block grows.

Vectors that are null or hold null or non-finite entries are left out, as are those of another length than
the most frequent one (ties: the greatest) and empty ones. Entries beyond 2**40 count as 2**40. Components
whose eigenvalue is at rounding level of the greatest are not given, so equal vectors alone, one vector or
an empty table give no row. Equal eigenvalues give any basis. A deviation beyond 63 bits is null. Repeated
rows and null ids count each; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata.llm.common import sum_arrays

COMPONENTS = 8
POINTS = 12
#: Residuals, against the norm of V, at which vectors are done, and eigenvalues that count as zero.
DONE, ZERO = 1e-13, 1e-11
ROUNDS, GROWTHS = 40, 6
LARGEST = 2.0**40


# ---- eigenvalue intervals -------------------------------------------------------------------


def above(matrix: np.ndarray, cut: float) -> int:
    """Eigenvalues greater than ``cut``: positive signs in a factorisation with complete pivoting.

    Each step takes the greatest diagonal entry, or a block of two where an entry off the diagonal is
    much greater; a block's two eigenvalues have the signs of its trace and determinant.
    """
    a, count = matrix - cut * np.eye(len(matrix)), 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        k, most = int(diagonal.argmax()), diagonal.max()
        off = np.abs(a - np.diag(np.diag(a)))
        if most >= 0.64 * off.max(initial=0):
            if most == 0:
                break
            count += int(a[k, k] > 0)
            rest = np.delete(np.arange(len(a)), k)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, k], a[rest, k]) / a[k, k]
        else:
            i, j = np.unravel_index(off.argmax(), off.shape)
            block, rest = a[np.ix_([i, j], [i, j])], np.delete(np.arange(len(a)), [i, j])
            det = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            count += 1 if det < 0 else 2 * int(np.trace(block) > 0)
            side = a[np.ix_(rest, [i, j])]
            a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
    return count


def bracket(matrix: np.ndarray, rank: int, low: float, high: float, steps: int = 40) -> tuple[float, float]:
    """``low < e <= high`` around the eigenvalue of a rank from 1, to about ``steps`` halvings."""
    for _ in range(steps):
        middle = (low + high) / 2
        if not low < middle < high:
            break
        low, high = (middle, high) if above(matrix, middle) >= rank else (low, middle)
    return low, high


def intervals(matrix: np.ndarray, wanted: int, high: float) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` from above, holding at least the ``wanted`` greatest eigenvalues above zero.

    Cuts lie in the middle of gaps; eigenvalues that are too close to be parted stay in one interval.
    """
    total = min(above(matrix, ZERO * high), len(matrix))
    wanted = min(wanted, total)
    if not wanted:
        return []
    ends = [bracket(matrix, 1, -high, high)]
    out, top, found = [], 1.5 * high, 0
    while found < wanted:
        rank = len(ends) + 1
        last = ends[-1]
        following = bracket(matrix, rank, -high, last[1]) if rank <= len(matrix) else (-high, -high)
        gap = last[0] - following[1]
        if gap > 1e-3 * max(last[0], 0) or rank > len(matrix):
            cut = last[0] - gap / 2
            out.append((cut, top, len(ends) - found))
            top, found = cut, len(ends)
        elif rank > wanted and gap > 1e-6 * high:
            out.append((last[0] - gap / 2, top, len(ends) - found))
            found = len(ends)
        ends.append(following)
    return out


def projected(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part in the eigenspace of an interval, nearly: Gauss quadrature on the upper half circle."""
    point, weight = np.polynomial.legendre.leggauss(POINTS)
    centre, radius = (low + high) / 2, (high - low) / 2
    total, eye = np.zeros_like(block), np.eye(len(matrix))
    for p, w in zip(point, weight):
        turn = np.exp(1j * np.pi * (1 + p) / 2)
        solved = np.linalg.solve((centre + radius * turn) * eye - matrix, block.astype(complex))
        total += w / 2 * (radius * turn * solved).real
    return total


def components_in(matrix: np.ndarray, low: float, high: float, count: int, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of an interval that holds ``count`` by inertia."""
    rng, size = np.random.default_rng(count), count + max(4, count // 2)
    for _ in range(GROWTHS):
        size = min(size, len(matrix))
        block = rng.standard_normal((len(matrix), size))
        for _ in range(ROUNDS):
            basis, held, _ = np.linalg.svd(projected(matrix, block, low, high), full_matrices=False)
            basis = basis[:, held > 1e-14 * held[0]]
            values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ turns
            inside = (values > low) & (values < high)
            vectors = block[:, inside]
            left = np.linalg.norm(matrix @ vectors - vectors * values[inside], axis=0)
            if inside.sum() == count and (left <= DONE * norm).all():
                return values[inside], vectors
            if block.shape[1] < count:
                break
        size *= 2
    raise RuntimeError(f"the interval from {low} to {high} holds {count} components, not all were found")


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues above zero, falling, and their unit vectors as columns."""
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0))
    if norm == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    scaled = matrix / norm
    found = [components_in(scaled, low, high, count, 1.0) for low, high, count in intervals(scaled, wanted, 1.0)]
    if not found:
        return np.zeros(0), np.zeros((len(matrix), 0))
    # One more Ritz step over all intervals makes their vectors orthogonal to one another.
    basis, _ = np.linalg.qr(np.concatenate([v for _, v in found], axis=1))
    values, turns = np.linalg.eigh(basis.T @ scaled @ basis)
    order = np.argsort(-values)[:wanted]
    vectors = basis @ turns[:, order]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order] * norm, vectors


# ---- rows -----------------------------------------------------------------------------------


def usable(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the vectors whose entries are all finite."""
    number = lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False))
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", number))


def numbers(batch: pa.RecordBatch, size: int) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return (np.floor(np.clip(1024 * flat, -LARGEST, LARGEST)) + 100000).astype(np.int64)


def partial(rows: DataFrame, size: int, made, kind: str) -> np.ndarray | None:
    """Sum of ``made(x)`` over batches of rows: one array a task, then sums of few arrays at a time."""

    def sums(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = made(numbers(batch, size))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": pa.array([total.tolist()], pa.list_(pa.from_numpy_dtype(total.dtype)))})

    return sum_arrays(rows.select("v").mapInArrow(sums, f"v array<{kind}>"), "v", kind)


@dataclass
class Whitening:
    """What is needed to whiten a row: count, sums, eigenvalues, unit vectors and the trace of V."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact; by 64-bit numbers where they hold, by Python's elsewhere."""
        apart = self.n * x - self.sums
        if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return pa.array((apart**2).sum(axis=1))
        exact = [sum(v * v for v in row) for row in apart.tolist()]
        return pa.array([v if v < 2**63 else None for v in exact], pa.int64())


def fit(rows: DataFrame, wanted: int = COMPONENTS) -> tuple[Whitening | None, int]:
    """The whitening of ``rows`` (see ``usable``) and their length; None without a component."""
    lengths = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("size")).limit(1).first()
    if top is None:
        return None, 0
    size, n = top["size"], top["n"]
    rows = rows.where(F.size("v") == size)
    sums = partial(rows, size, lambda x: x.sum(axis=0), "bigint")
    model = Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)

    def products(x):
        apart = model.centred(x)
        return (apart.T @ apart).ravel()

    matrix = partial(rows, size, products, "double").reshape(size, size) / n
    matrix = (matrix + matrix.T) / 2
    values, vectors = leading(matrix, wanted)
    if not len(values):
        return None, size
    found = Whitening(n, sums, values, vectors, float(np.trace(matrix)))

    def moments(x):
        w = found.whitened(x)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    k = len(values)
    total = partial(rows, size, moments, "double") / n
    spread = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    found.error = float(np.abs(spread - np.eye(k)).max())
    return found, size


RESULT = (
    "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(embeddings: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """A row for every usable vector and component."""
    rows = usable(embeddings)
    model, size = fit(rows, wanted)
    result = RESULT.format(id=rows.schema["vec_id"].dataType.simpleString())
    if model is None:
        return rows.limit(0).mapInArrow(lambda batches: iter(()), result)
    explained = model.values / model.trace

    def projections(batches):
        k = len(model.values)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                x = numbers(piece, size)
                many = len(x)
                index = pa.array(np.repeat(np.arange(many), k))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": piece.column("vec_id").take(index),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), many),
                    "n": np.full(many * k, model.n),
                    "deviation": model.deviations(x).take(index),
                    "whitened": model.whitened(x).ravel(),
                    "explained": np.tile(explained, many),
                    "identity_error": np.full(many * k, model.error),
                })

    return rows.where(F.size("v") == size).mapInArrow(projections, result)
