"""Similarity of embeddings.

Scoring goes through Arrow in whole batches: the list column is seen as one NumPy matrix, which is
several times faster than array higher-order functions, as those are not compiled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def matrix(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that hold a vector of `dims` numbers, their values as a matrix in double precision)."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    usable = lengths == dims
    kept = vectors if usable.all() else vectors.filter(pa.array(usable))
    values = kept.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return usable, values.reshape(-1, dims)


def cosine(vector: Column, query: list[float]) -> Column:
    """Cosine similarity to a fixed query; null where the vector is null, zero or of another length."""
    q = np.asarray(query, dtype=np.float64)
    q = q / np.linalg.norm(q)

    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        usable, m = matrix(vectors, len(q))
        norms = np.sqrt(np.einsum("ij,ij->i", m, m))
        dots = m @ q
        out = np.full(len(usable), np.nan)
        out[usable] = np.divide(dots, norms, out=np.full(len(dots), np.nan), where=norms > 0)
        return pa.array(out, from_pandas=True)

    return score(vector)


def cosine_pair(left: Column, right: Column) -> Column:
    """Cosine similarity of two vectors of each row; null where one is null or zero, or their lengths differ."""

    @F.arrow_udf("double")
    def score(a: pa.Array, b: pa.Array) -> pa.Array:
        size = a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        same = (size == b.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) & (size > 0)
        out = np.full(len(size), np.nan)
        for dims in np.unique(size[same]):
            rows = same & (size == dims)
            (_, x), (_, y) = (matrix(v.filter(pa.array(rows)), dims) for v in (a, b))
            norms = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
            dots = np.einsum("ij,ij->i", x, y)
            out[rows] = np.divide(dots, norms, out=np.full(len(dots), np.nan), where=norms > 0)
        return pa.array(out, from_pandas=True)

    return score(left, right)


def sign_planes(dims: int, tables: int, bits: int) -> np.ndarray:
    """Random +1/-1 hyperplanes, shape (tables, bits, dims), from the parity of MD5 sums.

    Entry (t, b, d) is +1 if the first hex digit of md5("t:b:d") is below 8. Being a plain rule, an index
    can be extended or rebuilt anywhere with the same planes.
    """
    from hashlib import md5

    return np.array([
        [[1.0 if md5(f"{t}:{b}:{d}".encode()).hexdigest()[0] < "8" else -1.0 for d in range(dims)] for b in range(bits)]
        for t in range(tables)
    ])


def buckets_of(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Bucket number per vector and table: bit b is set where the vector is on plane b's positive side."""
    tables, bits, _ = planes.shape
    side = (vectors @ planes.reshape(tables * bits, -1).T > 0).reshape(-1, tables, bits)
    return (side * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def sign_buckets(vector: Column, planes: np.ndarray) -> Column:
    """array<int> with the vector's bucket in each table; null where it has no usable vector."""
    tables, _, dims = planes.shape

    @F.arrow_udf("array<int>")
    def assign(vectors: pa.Array) -> pa.Array:
        usable, m = matrix(vectors, dims)
        found = iter(buckets_of(m, planes).tolist())
        return pa.array([next(found) if ok else None for ok in usable], pa.list_(pa.int32()))

    return assign(vector)
