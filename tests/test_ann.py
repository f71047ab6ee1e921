"""The inverted file with product-quantized residuals against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.operators import ann
from tidelog.operators.ann import CodeIndex, Codec, few_read, unit

SCHEMA = "partition int, offset bigint, embedding array<float>"


def clustered(n, dims, seed=1, centres=12):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, dims)) * 3
    return (middle[draw.integers(0, centres, n)] + draw.normal(size=(n, dims))).astype(np.float32)


def stored(spark, vectors):
    return spark.createDataFrame([(i % 3, i, None if v is None else [float(c) for c in v]) for i, v in enumerate(vectors)], SCHEMA).repartition(5)


def asked(spark, vectors, places):
    return spark.createDataFrame([(int(i), [float(c) for c in vectors[i]]) for i in places], "query_id long, q array<double>")


def truth(vectors, i, k):
    x = unit(np.asarray(vectors, float))
    return sorted(range(len(x)), key=lambda j: (-round(float(x[j] @ x[i]), 9), j % 3, j))[:k]


def test_hits_scores_and_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 100)  # many blocks
    monkeypatch.setattr(ann, "QUERIES", 7)
    vectors = clustered(1500, 16)
    index = CodeIndex(spark, stored(spark, vectors), 16, lists=24)
    queries = asked(spark, vectors, range(0, 1500, 30))
    found = index.search(queries, 10, vector_col="q").collect()
    x = unit(vectors.astype(float))
    share = 0
    for i in range(0, 1500, 30):
        mine = sorted((r for r in found if r.query_id == i), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(1, 11)) and mine[0].offset == i
        assert all(abs(r.score - x[i] @ x[r.offset]) < 1e-9 and r.partition == r.offset % 3 for r in mine)
        assert sorted((-r.score for r in mine)) == [-r.score for r in mine]
        share += len({r.offset for r in mine} & set(truth(vectors, i, 10))) / 10
    hits = spark.createDataFrame(found)
    assert share / 50 >= 0.95 and abs(index.recall(hits, queries) - share / 50) < 1e-9
    assert index.recall(hits.where("place <= 5"), queries) <= 0.5 and few_read(index.scored, 50, 1500) is not None
    routed = index._routed(queries, 10).groupBy("query_id").count().agg(F.avg("count")).first()[0]
    assert routed < 12  # lists of far clusters are left out


def test_every_row_is_filed(spark):
    vectors = [*clustered(300, 8), np.zeros(8), None, np.ones(3), np.full(8, np.nan)]
    index = CodeIndex(spark, stored(spark, vectors), 8)
    assert sorted(r.offset for r in index.codes.collect()) == list(range(300)) and index.rows == 300
    assert {len(r.code) for r in index.codes.collect()} == {2}


def test_equal_vectors_fill_a_list(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 50)
    vectors = clustered(600, 8, seed=3)
    vectors[100:400] = vectors[0]
    index = CodeIndex(spark, stored(spark, vectors), 8, lists=8)
    found = index.search(asked(spark, vectors, [0, 500]), 5, vector_col="q").collect()
    assert all(abs(r.score - 1) < 1e-6 for r in found if r.query_id == 0) and sum(r.query_id == 0 for r in found) == 5
    assert [r.offset for r in sorted(found, key=lambda r: r.place) if r.query_id == 500][0] == 500
    blocks = index._blocks(index.sizes, ann.ROWS, "chunks").collect()
    assert max(b.chunks for b in blocks) >= 6  # the full list is dealt to several tasks


def test_queries_and_indexes_without_vectors(spark):
    vectors = clustered(50, 8)
    index = CodeIndex(spark, stored(spark, vectors), 8)
    odd = spark.createDataFrame([("a", None), ("b", [0.0] * 8), ("c", [1.0]), ("d", [float(c) for c in vectors[7]])], "who string, v array<double>")
    found = index.search(odd, 3, "who", "v")
    assert found.columns == ["who", "place", "partition", "offset", "score"] and {r.who for r in found.collect()} == {"d"}
    empty = CodeIndex(spark, stored(spark, [None]), 8)
    assert empty.search(odd, 3, "who", "v").collect() == []
    with pytest.raises(ValueError):
        index.search(odd, 0, "who", "v")


def test_codes_stand_near_their_vectors():
    x = unit(clustered(4000, 32, seed=5).astype(float))
    codec = Codec(x, 30)
    near = ann.nearest(x, codec.centres)
    told = codec.decode(near, codec.encode(x, near))
    assert np.linalg.norm(x - told, axis=1).mean() < 0.5 * np.linalg.norm(x - codec.centres[near], axis=1).mean()
    again = Codec(x, 30)
    assert (again.centres == codec.centres).all() and all((a == b).all() for a, b in zip(again.books, codec.books))


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_embeddings(spark, scale):
    rows = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet").select(F.lit(0).alias("partition"), F.col("vec_id").alias("offset"), "embedding")
    index = CodeIndex(spark, rows, 64)
    queries = rows.where("offset % 100 = 0").select(F.col("offset").alias("query_id"), F.col("embedding").cast("array<double>").alias("q"))
    hits = index.search(queries, 10, vector_col="q")
    assert index.recall(hits, queries) >= 0.9
    assert 3 * index.scored.count() < queries.count() * index.rows
