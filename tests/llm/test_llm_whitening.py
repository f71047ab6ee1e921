"""Embedding whitening against NumPy's own eigenvectors."""

import math

import numpy as np
import pytest

from tidelog.llm import queries
from tidelog.llm.whitening import divide, leading, polar, whiten


def spread(d, seed, values=None):
    draw = np.random.default_rng(seed)
    q, _ = np.linalg.qr(draw.normal(size=(d, d)))
    values = np.exp(draw.normal(size=d)) if values is None else np.array(values)
    return q @ np.diag(values) @ q.T


def test_polar_factor():
    a = spread(40, 1, np.concatenate([np.linspace(-2, -1e-9, 15), np.linspace(1e-6, 3, 25)]))
    u = polar(a)
    values, vectors = np.linalg.eigh(a)
    assert np.abs(u - vectors @ np.diag(np.sign(values)) @ vectors.T).max() < 1e-6
    assert np.abs(u @ u - np.eye(40)).max() < 1e-13


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64, 150])
def test_leading_vectors(d):
    v = spread(d, d)
    values, vectors = leading(v, 4)
    want, known = np.linalg.eigh(v)
    k = min(4, d)
    assert vectors.shape == (d, k) and np.allclose(values, want[::-1][:k], rtol=1e-13)
    assert np.abs(np.abs(np.einsum("ij,ij->j", vectors, known[:, ::-1][:, :k])) - 1).max() < 1e-12


def test_equal_and_zero_values():
    v = spread(12, 2, [3.0] * 5 + [1.0] * 4 + [0.0] * 3)
    values, vectors = leading(v, 12)
    assert np.allclose(values, [3.0] * 5 + [1.0] * 4, rtol=1e-13) and np.abs(vectors.T @ vectors - np.eye(9)).max() < 1e-13
    assert np.abs(v @ vectors - vectors * values).max() < 1e-13
    assert divide(np.eye(4) * 2, 4.0) is None and leading(np.zeros((3, 3)), 4)[1].shape == (3, 0)
    near = spread(30, 3, 1 + np.arange(30) * 1e-9)
    values, vectors = leading(near, 4)
    assert np.abs(near @ vectors - vectors * values).max() < 1e-13 and np.allclose(values, 1 + np.arange(29, 25, -1) * 1e-9, rtol=1e-13)


def brute(rows, components=4):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {tuple(math.floor(256 * float(c)) for c in v) for _, v in kept}
    n = len(x)
    a = np.array(sorted(x), float)
    sums = [sum(col) for col in zip(*x)]
    mean = np.array(sums) / n
    v = (a - mean).T @ (a - mean) / n
    values, vectors = np.linalg.eigh(v)
    out = {}
    for i, vec in kept:
        own = [math.floor(256 * float(c)) for c in vec]
        deviation = sum((n * c - s) ** 2 for c, s in zip(own, sums))
        for k in range(min(components, len(sums))):
            e = values[-1 - k]
            out.setdefault((i, k + 1), []).append((n, deviation, abs((np.array(own) - mean) @ vectors[:, -1 - k]) / math.sqrt(e), e / np.trace(v)))
    return out


def agree(found, want):
    assert len(found) == sum(map(len, want.values()))
    for r in found:
        n, deviation, white, explained = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, deviation) and abs(abs(r.whitened) - white) < 1e-9 and abs(r.explained / explained - 1) < 1e-10
        assert r.identity_error < 1e-10


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = queries.QUERIES["op13_embedding_whitening"](spark, sf_dir)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    agree(found.collect(), brute(rows))


def test_faulty_and_repeated_rows(spark):
    draw = np.random.default_rng(4)
    good = [(i, [float(c) for c in draw.normal(size=3) * [3, 2, 1]]) for i in range(40)]
    rows = good + [(100, good[0][1]), (101, good[0][1])] + [(None, good[1][1])]
    bad = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [1.0, float("nan"), 2.0]), (5, [1.0, float("inf"), 2.0]), (6, [1.0, 2.0])]
    data = [(i, v, 1, "c") for i, v in rows + bad]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>, n int, x string").repartition(4)
    agree(whiten(vectors).collect(), brute(rows))


def test_signs_and_sums_over_all_rows(spark):
    draw = np.random.default_rng(5)
    vectors = spark.createDataFrame([(i, [float(c) for c in draw.normal(size=6)]) for i in range(200)], "vec_id long, embedding array<float>").repartition(7)
    found = whiten(vectors, components=2).collect()
    first = np.array([r.whitened for r in found if r.component == 1])
    second = np.array([r.whitened for r in found if r.component == 2])
    assert abs(first.mean()) < 1e-9 and abs(first.var() - 1) < 1e-9 and abs((first * second).mean()) < 1e-9


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], schema)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    one = whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0])], schema)).collect()
    assert [r.component for r in one] == [1, 1] and sorted(r.whitened for r in one) == [-1.0, 1.0]


def test_values_beyond_a_long(spark):
    rows = [(1, [3e30, 1.0]), (2, [-3e30, 2.0]), (3, [0.0, 5.0])]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    told = {(r.vec_id, r.component): r.deviation for r in found}
    assert told == {(1, 1): None, (2, 1): None, (3, 1): (3 * 0 - -1) ** 2 + (3 * 1280 - 8 * 256) ** 2}
