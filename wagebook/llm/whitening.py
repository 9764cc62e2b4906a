"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never multiplied with each other. Each step takes one product Xv and one product X'u over all rows,
reorthogonalises both sides fully, and adds a column to a small bidiagonal matrix; its singular vectors and values give the
components and their deviations. A left vector has an entry for each row, so it is never stored: it is X times a short vector
that the driver knows, and tasks make it anew from their rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagebook.llm.common import written

SCALE, OFFSET = 64, 1_000_000
LIMIT = float(2**61)  # entries beyond it count as it, so that longs hold them
GONE = 1e-13  # of the norm of all rows: a vector shorter than this has no direction of its own
RANK = 1e-11  # of the largest singular value: components under it are none


@dataclass
class Whitening:
    """rows, whole and rest: number of rows and their sums, as quotient and remainder; components: one a column."""

    rows: int
    whole: np.ndarray
    rest: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def lattice(vector: Column, width: int) -> Column:
    """floor(64 * entry) + 1000000 of each entry as double, padded with those of zeros to width."""
    x = F.transform(vector, lambda c: F.floor(F.least(F.greatest(F.lit(float(SCALE)) * c.cast("double"), F.lit(-LIMIT)), F.lit(LIMIT))) + F.lit(OFFSET))
    return F.concat(x, F.array_repeat(F.lit(OFFSET).cast("long"), F.greatest(F.lit(width) - F.size(x), F.lit(0))))


def usable(vector: Column) -> Column:
    """Not null and without null, infinite or not-a-number entries."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """Sums over all rows of what `of` gives for a matrix of rows: first in each task, then by position, so that the driver
    gets one row for each position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                got = of(_matrix(b.column(0).slice(at, 4096), width))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64() if kind == "long" else pa.float64()))], ["sums"])

    per_task = rows.select("x").mapInArrow(run, f"sums array<{kind}>")
    at = per_task.select(F.posexplode("sums").alias("at", "v")).withColumn("v", F.col("v").cast("decimal(38,0)") if kind == "long" else F.col("v"))
    return [r["v"] for r in sorted(at.groupBy("at").agg(F.sum("v").alias("v")).collect(), key=lambda r: r["at"])]


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def bidiagonal(product: Callable[[np.ndarray, np.ndarray], tuple], width: int, norm: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """V (one right vector a column) and the upper bidiagonal B with XV = UB, all `width` steps.

    product(W, w): for p = Xw and U = XW, gives U'p, p'p and X'p, in one pass over the rows. The pass is made again only where
    much of p lay along earlier left vectors. Where a vector vanishes, the process goes on with a new random one, so values
    that occur several times are found as often as they occur.
    """
    rng = np.random.default_rng(seed)
    v = rng.standard_normal(width)
    right, left, seen = [v / np.linalg.norm(v)], [], []  # left: w of each u = Xw; seen: X'u
    b, beta = np.zeros((width, width)), 0.0
    for j in range(width):
        w = right[j] - beta * left[-1] if beta else right[j]
        for _ in range(3):
            along, length, g = product(np.array(left).reshape(-1, width).T, w)
            for c, wi, gi in zip(along, left, seen):
                w, g = w - c * wi, g - c * gi
            taken = float(along @ along)
            length = max(0.0, length - taken)
            if taken <= 0.1 * length or length <= (GONE * norm) ** 2:
                break
        alpha = math.sqrt(length)
        if alpha <= GONE * norm:
            alpha, w, g = 0.0, np.zeros(width), np.zeros(width)
        else:
            w, g = w / alpha, g / alpha
        left.append(w)
        seen.append(g)
        b[j, j] = alpha
        if j + 1 == width:
            break
        r = _orthogonal(g - alpha * right[j], right)
        beta = float(np.linalg.norm(r))
        if beta <= GONE * norm:
            beta = 0.0
            r = _orthogonal(rng.standard_normal(width), right)
        b[j, j + 1] = beta
        right.append(r / np.linalg.norm(r))
    return np.array(right).T, b


def centred(x: np.ndarray, whole: np.ndarray, share: np.ndarray) -> np.ndarray:
    return (x - whole).astype(np.float64) - share


def fit(x: DataFrame, width: int, most: int = 16) -> Whitening:
    """x: column x, rows of `width` longs, each vector once. Makes `width` passes over it, and four more.

    The driver holds a few matrices of width * width numbers. Components come by falling value; those without any deviation
    are none, so there may be fewer than `most`. No rows give no components.
    """
    rows = x.count()
    if not rows or not width:
        return Whitening(rows, np.zeros(width, np.int64), [0] * width, np.zeros((width, 0)), np.zeros(0), np.zeros(0), 0.0)
    halves = _summed(x, width, lambda m: np.concatenate([(m >> 32).sum(0), (m & 0xFFFFFFFF).sum(0)]), "long")
    sums = [int(hi) * 2**32 + int(lo) for hi, lo in zip(halves[:width], halves[width:])]
    whole, rest = np.array([s // rows for s in sums], dtype=np.int64), [s % rows for s in sums]
    share = np.array([r / rows for r in rest])
    total = _summed(x, width, lambda m: np.array([np.square(centred(m, whole, share)).sum()]))[0]
    if not total:
        return Whitening(rows, whole, rest, np.zeros((width, 0)), np.zeros(0), np.zeros(0), 0.0)

    def product(many: np.ndarray, one: np.ndarray) -> tuple:
        k = many.shape[1]
        both = np.column_stack([many, one])

        def of(m: np.ndarray) -> np.ndarray:
            c = centred(m, whole, share)
            y = c @ both
            return np.concatenate([y.T @ y[:, k], c.T @ y[:, k]])

        got = np.array(_summed(x, width, of))
        return got[:k], float(got[k]), got[k + 1 :]

    v, b = bidiagonal(product, width, math.sqrt(total))
    _, sigma, turned = np.linalg.svd(b)
    k = int((sigma[:most] > RANK * sigma[0]).sum())
    components, values = v @ turned[:k].T, np.square(sigma[:k]) / rows
    scaled = components / np.sqrt(values)

    def spread(m: np.ndarray) -> np.ndarray:
        z = centred(m, whole, share) @ scaled
        return (z.T @ z).ravel()

    error = np.abs(np.array(_summed(x, width, spread)).reshape(k, k) / rows - np.eye(k)).max()
    return Whitening(rows, whole, rest, components, values, values * rows / total, float(error))


def deviations(x: np.ndarray, w: Whitening) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; none where no long holds it."""
    off = x - w.whole
    if float(np.abs(off).max(initial=0) + 1) * w.rows < 3e9 / math.sqrt(max(1, x.shape[1])):
        return np.square(off * w.rows - np.array(w.rest, dtype=np.int64)).sum(1).tolist()
    exact = [sum((w.rows * a - r) ** 2 for a, r in zip(row, w.rest)) for row in off.tolist()]
    return [e if e < 2**63 else None for e in exact]


def whitened(rows: DataFrame, w: Whitening, id_col: str) -> DataFrame:
    """A row for each of rows (id_col, x) and component: component, n, deviation, whitened, explained, identity_error."""
    k, width = len(w.values), len(w.whole)
    scaled, share = w.components / np.sqrt(w.values), np.array([r / max(1, w.rows) for r in w.rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows if k else 0, 1024):
                part = b.slice(at, 1024)
                x = _matrix(part.column(1), width)
                n, z = len(x), centred(x, w.whole, share) @ scaled
                ids = part.column(0).take(pa.array(np.repeat(np.arange(n), k)))
                spread = pa.array(deviations(x, w), pa.int64()).take(pa.array(np.repeat(np.arange(n), k)))
                columns = [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, w.rows)), spread, pa.array(z.ravel()), pa.array(np.tile(w.explained, n)), pa.array(np.full(n * k, w.identity_error))]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, "x").mapInArrow(run, f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 16) -> DataFrame:
    """Rows of vectors projected on the components of their distinct lattice vectors; see fit and whitened.

    Rows whose vector is null or holds null or non-finite entries are left out. A vector shorter than the longest counts as
    padded with zeros. Ids are of any type, null or repeated too: each row gets rows of its own. A vector that very many rows
    share is reduced in each task before the exchange. Other columns are not looked at. Empty tables, tables of one distinct
    vector and empty vectors give no rows, as they have no component. deviation is null where no long can hold it.
    """
    rows = vectors.select(F.col(id_col), F.col(vector_col).alias("_v")).where(usable(F.col("_v")))
    width = rows.agg(F.max(F.size("_v"))).first()[0] or 0
    rows = rows.select(id_col, lattice(F.col("_v"), width).alias("x"))
    return whitened(rows, fit(written(rows.select("x").distinct()), width, most), id_col)


def query(spark, vectors: DataFrame) -> DataFrame:
    return whiten(vectors)
