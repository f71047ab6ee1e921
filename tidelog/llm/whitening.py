"""Whitened embeddings: moments on Spark, components by spectral divide and conquer of one small matrix, projection on Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.text import type_of
from tidelog.session import store

SCALE = 256  # fixed-point steps of a unit
WIDEST = 2048  # dimensions at most: the driver holds a few square matrices of this side
EPS = np.finfo(np.float64).eps
LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def fixed_point(vector: Column) -> Column:
    """Entries as long, floor(256 * c); what no long can hold is the nearest long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix by QDWH: dynamically weighted Halley steps, by QR while the weights are
    large and by Cholesky after that. An eigenvalue of zero has no sign; what is returned for it must be checked by the caller."""
    n = len(a)
    x = a / np.linalg.norm(a)  # the Frobenius norm is at least the largest singular value
    try:
        low = max(1 / float(np.linalg.norm(np.linalg.inv(x))), EPS)  # at most the smallest singular value
    except np.linalg.LinAlgError:
        low = EPS
    eye = np.eye(n)
    for _ in range(50):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            step = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            half = np.linalg.cholesky(eye + wc * x.T @ x)
            step = wb / wc * x + (wa - wb / wc) * np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        step = (step + step.T) / 2
        moved = np.linalg.norm(step - x)
        x, low = step, min(low * (wa + wb * low**2) / (1 + wc * low**2), 1.0)
        if moved < EPS ** (1 / 3) and abs(1 - low) < 10 * EPS:
            break
    return x


def divide(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of a above and below a shift; None if a is a multiple of the identity.

    The mean of the eigenvalues lies between the first and the last of them, so it always parts them; shifts beside it are
    for the case that it is itself an eigenvalue.
    """
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n))
    if spread <= 8 * EPS * scale * np.sqrt(n):
        return None
    best = None
    draw = np.random.default_rng(n).normal(size=(n, n))
    for shift in (0.0, 0.05, -0.05, 0.15, -0.15, 0.3, -0.3):
        projector = (polar(a - (mean + shift * spread / np.sqrt(n)) * np.eye(n)) + np.eye(n)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < n:
            continue
        upper, _ = np.linalg.qr(projector @ draw[:, :rank])
        upper, _ = np.linalg.qr(projector @ upper)
        lower, _ = np.linalg.qr(draw[:, rank:] - projector @ draw[:, rank:])
        basis, _ = np.linalg.qr(np.hstack([upper, lower]))
        left = np.linalg.norm(basis[:, :rank].T @ a @ basis[:, rank:])
        if best is None or left < best[0]:
            best = left, basis[:, :rank], basis[:, rank:]
        if left <= 64 * EPS * scale * n:
            break
    return best and best[1:]


def spectral(a: np.ndarray, k: int, scale: float) -> np.ndarray:
    """Unit vectors (columns) that span the k leading eigenvectors of a, found by dividing its space until parts have one
    dimension, or equal eigenvalues. Parts below the first k are not divided any further."""
    n = len(a)
    parts = divide(a, scale) if n > 1 and k > 0 else None
    if parts is None:
        return np.eye(n)[:, :k]
    found = []
    for basis in parts:
        inner = basis.T @ a @ basis
        some = spectral((inner + inner.T) / 2, min(k, basis.shape[1]), scale)
        found.append(basis @ some)
        k -= some.shape[1]
    return np.hstack(found)


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix that are not zero to double precision, falling, and their unit
    eigenvectors as columns, the largest entry of each positive."""
    scale = float(np.linalg.norm(v))
    if scale == 0:
        return np.zeros(0), np.zeros((len(v), 0))
    vectors = spectral(v, min(k, len(v)), scale)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > len(v) * EPS * scale]
    vectors = vectors[:, order]
    peak = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return values[order], vectors * np.sign(peak)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def summed(rows: DataFrame, width: int, moments: Callable[[np.ndarray], dict[str, np.ndarray]], kind: str = "double") -> dict[str, np.ndarray]:
    """Sums over all rows of x of the arrays that moments(x) makes of a batch, by name: each task adds its batches and gives
    one row per entry, Spark adds the tasks'. The result has as many entries as one batch's, whatever the number of rows;
    longs are added exactly."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for name, part in moments(matrix(batch.column(0), width)).items():
                    totals[name] = totals[name] + part if name in totals else part
        for name, total in totals.items():
            flat = np.ravel(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(flat)), pa.array(np.arange(len(flat))), pa.array(flat)], ["name", "at", "value"])

    parts = rows.select("x").mapInArrow(task, f"name string, at long, value {kind}")
    value = F.col("value").cast("decimal(19,0)") if kind == "long" else F.col("value")
    sums = parts.groupBy("name", "at").agg(F.sum(value).alias("value")).toArrow()  # a few times width * width entries at most
    out = {}
    for name in sums["name"].unique().to_pylist():
        some = sums.filter(pc.equal(sums["name"], name)).sort_by("at")["value"]
        out[name] = np.array([int(v) for v in some.to_pylist()], object) if kind == "long" else some.to_numpy()
    return out


class Whitening:
    """Fitted moments and components: n and sums of the distinct vectors, mean, directions (one column per component, already
    over the root of its eigenvalue), explained shares, and the largest error of the whitened covariance."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.width = n, sums, len(sums)
        self.mean = np.array([s / n for s in sums])
        self.directions = vectors / np.sqrt(values)
        self.explained = values / trace if trace > 0 else values
        self.identity_error = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.directions

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - sum)^2, exact; null where no long can hold it."""
        largest = self.n * max(int(x.max()), -int(x.min()), 1) + max(abs(s) for s in self.sums)
        if largest**2 * self.width <= LONG:
            off = self.n * x - np.array(self.sums, np.int64)
            return np.einsum("ij,ij->i", off, off).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [e if e <= LONG else None for e in exact]


def fit(vectors: DataFrame, components: int) -> Whitening | None:
    """Learn from x of vectors(x array<long>), each distinct one once, of the width most of them have (of ties, the larger).

    Three passes over the stored distinct vectors: sums (exact), covariance (centred before multiplying), and the
    covariance of the whitened vectors. Only sums of width and width * width entries come to the driver. None without rows.
    """
    distinct = store(vectors.select("x").distinct(), "distinct")
    common = distinct.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if common is None:
        return None
    width, n = common["width"], common["count"]
    if width > WIDEST:
        raise ValueError(f"vectors of {width} entries; {WIDEST} at most")
    distinct = distinct.where(F.size("x") == width)
    halves = summed(distinct, width, lambda x: {"low": (x & 0xFFFFFFFF).sum(axis=0), "high": (x >> 32).sum(axis=0)}, "long")
    sums = [(high << 32) + low for low, high in zip(halves["low"], halves["high"])]
    mean = np.array([float(Decimal(s) / n) for s in sums])

    def products(x: np.ndarray) -> dict[str, np.ndarray]:
        off = x - mean
        return {"products": off.T @ off}

    covariance = summed(distinct, width, products)["products"].reshape(width, width) / n
    covariance = (covariance + covariance.T) / 2
    values, found = leading(covariance, components)
    fitted = Whitening(n, sums, values, found, float(np.trace(covariance)))
    if len(values):
        def white(x: np.ndarray) -> dict[str, np.ndarray]:
            y = fitted.project(x)
            return {"sum": y.sum(axis=0), "products": y.T @ y}

        told = summed(distinct, width, white)
        centre = told["sum"] / n
        spread = told["products"].reshape(len(values), -1) / n - np.outer(centre, centre)
        fitted.identity_error = float(np.abs(spread - np.eye(len(values))).max())
    return fitted


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): each usable row on the leading components.

    A row whose vector is null, empty, or holds a null or no finite number is left out, and so is one of another width
    than most distinct vectors have. Entries become fixed-point longs. Repeated rows and null ids are rows like others
    and get results each; equal vectors count once in the fit. Components with an eigenvalue of zero, as of equal vectors,
    cannot be whitened and are not given; so one distinct vector, or none, gives no rows. Other columns are not read.
    What tasks hold is the fitted matrix, at most WIDEST * components numbers.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v"))).select("id", fixed_point(F.col("v")).alias("x"))
    schema = f"`{id_col}` {type_of(vectors, id_col)}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, components)
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, names = shared.value, [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
        k = len(model.explained)
        for batch in batches:
            rows = batch.num_rows
            if rows and k:
                x = matrix(batch.column(1), model.width)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n)), pa.array([d for d in model.deviations(x) for _ in range(k)], pa.int64()),
                    pa.array(model.project(x).ravel()), pa.array(np.tile(model.explained, rows)), pa.array(np.full(rows * k, model.identity_error)),
                ], names)

    return rows.where(F.size("x") == model.width).mapInArrow(task, schema)
