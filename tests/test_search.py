import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.functions.text import word_cosine, words
from tidelog.operators import memory
from tidelog.operators import search as s
from tidelog.session import new_path

SCHEMA = "topic string, partition int, offset bigint, label int, embedding array<float>"


def corpus(spark, n=400, dims=16, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(8, dims))
    vectors = (centres[rnd.integers(0, 8, n)] + 0.3 * rnd.normal(size=(n, dims))).astype(np.float32)
    rows = [("t", i % 3, i, i % 4, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4), vectors.astype(float)


def best(vectors, q, k, keep=lambda i: True):
    score = vectors @ q / np.linalg.norm(vectors, axis=1) / np.linalg.norm(q)
    return sorted((i for i in range(len(vectors)) if keep(i)), key=lambda i: -score[i])[:k]


def test_exact_and_filtered(spark):
    df, vectors = corpus(spark)
    q = vectors[5] * 3
    hits = s.semantic_search(df, "t", list(q), 7)
    assert [r.offset for r in hits.collect()] == best(vectors, q, 7) and "embedding" not in hits.columns
    hits = s.semantic_search(df, "t", list(q), 7, {"label": 2})
    assert [r.offset for r in hits.collect()] == best(vectors, q, 7, lambda i: i % 4 == 2)
    assert s.search_total(df, "t", {"label": 2}) == 100
    assert s.semantic_search(df, "other", list(q), 7).isEmpty()


def test_unusable_embeddings_are_no_candidates(spark):
    rows = [("t", 0, 0, 0, [1.0, 0.0]), ("t", 0, 1, 0, None), ("t", 0, 2, 0, [0.0, 0.0]), ("t", 0, 3, 0, [1.0]), ("t", 0, 4, 0, [-1.0, 0.0])]
    got = s.semantic_search(spark.createDataFrame(rows, SCHEMA), "t", [2.0, 0.0]).collect()
    assert [(r.offset, r.score) for r in got] == [(0, 1.0), (4, -1.0)]


def test_arguments(spark):
    df, vectors = corpus(spark, 10)
    for topic, q, k in [("", [1.0], 5), (" ", [1.0], 5), ("t", [], 5), ("t", [1.0], 0), ("t", [1.0], 1001)]:
        with pytest.raises(ValueError):
            s.semantic_search(df, topic, q, k)


def test_bucket_index_recall(spark):
    df, vectors = corpus(spark, 600)
    index = s.BucketIndex(spark, new_path(spark, "index"), 16, tables=8, bits=5).build(df)
    found = wanted = read = 0
    for i in range(0, 600, 60):
        hits = index.search(list(vectors[i]), 10).collect()
        assert len({r.offset for r in hits}) == len(hits) and hits[0].offset == i
        truth = best(vectors, vectors[i], 10)
        found += len({r.offset for r in hits} & set(truth))
        wanted += len(truth)
        read += index.candidates(list(vectors[i])).select("offset").distinct().count()
    assert found / wanted > 0.9
    assert read / 10 < 500
    plan = index.candidates(list(vectors[0]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "tbl" in plan


def test_neighbouring_buckets_of_the_given_embeddings(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    vectors = np.array([r.embedding for r in given], float)
    records = spark.createDataFrame([("vectors", 0, r.vec_id, r.embedding) for r in given], "topic string, partition int, offset bigint, embedding array<float>")
    index = s.BucketIndex(spark, new_path(spark, "index"), 64, 8, 6).build(records)
    found = wanted = 0
    for i in (at for at, r in enumerate(given) if r.vec_id % 100 == 0):
        truth = {given[j].vec_id for j in best(vectors, vectors[i], 10)}
        found += len({r.offset for r in index.search(list(vectors[i]), 10, flips=1).collect()} & truth)
        wanted += len(truth)
    assert found / wanted >= 0.9


def test_words(spark):
    df = spark.createDataFrame([("The cat, the HAT!", "a cat"), ("", "x"), (None, "x")], "a string, b string")
    got = df.select(words(F.col("a")).alias("w"), word_cosine(words(F.col("a")), words(F.col("b"))).alias("c")).collect()
    assert got[0].w == ["the", "cat", "hat"] and abs(got[0].c - 1 / 6**0.5) < 1e-12 and got[1].c == 0.0


def remembered(spark):
    rows = [("a", "ns", "fact", f"cats like fish number {i}", 0.8, None, i) for i in range(8)]
    rows += [("a", "ns", "observation", "dogs", None, None, 8), ("a", "ns", "procedure", "feed cats", None, "feeding", 9), ("a", "ns", "procedure", "x", None, None, 10)]
    rows += [("b", "ns", "fact", "fish", None, None, 11), ("", "ns", "fact", "lost", None, None, 12)]
    df = spark.createDataFrame(rows, "agent_id string, namespace string, kind string, content string, salience double, skill string, seq int")
    return memory.memory_remember(df, ["seq"])


def test_remember(spark):
    got = remembered(spark)
    topics = {(r.topic, r.tier): r.n for r in got.groupBy("topic", "tier").agg(F.count("*").alias("n")).collect()}
    assert topics == {("a-ep", "episodic"): 9, ("a-sem", "semantic"): 8, ("a-proc", "procedural"): 1, ("b-ep", "episodic"): 1, ("b-sem", "semantic"): 1}
    assert [r.offset for r in got.where("topic = 'a-sem'").orderBy("seq").collect()] == list(range(8))


def test_offsets_go_on(spark):
    first = remembered(spark)
    more = spark.createDataFrame([("a", "ns", "fact", "later", None, None, 20), ("c", "ns", "fact", "new", None, None, 21)], "agent_id string, namespace string, kind string, content string, salience double, skill string, seq int")
    got = {(r.topic, r.offset) for r in memory.memory_remember(more, ["seq"], first).collect()}
    assert got == {("a-ep", 9), ("a-sem", 8), ("c-ep", 0), ("c-sem", 0)}


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_recall(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        recall(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def recall(spark):
    stored = remembered(spark)
    asked = spark.createDataFrame([("a", "fish number 3"), ("b", " ")], "agent_id string, query string")
    got = memory.memory_recall(stored, asked, k_semantic=2).collect()
    semantic = sorted((r for r in got if r.tier == "semantic"), key=lambda r: r.place)
    assert [r.offset for r in semantic] == [3, 0] and {r.agent_id for r in got} == {"a"}
    assert sum(r.tier == "episodic" for r in got) == memory.DEFAULT_K
    shared = memory.memory_recall(stored, spark.createDataFrame([("ns", "fish")], "namespace string, query string"), 1, 1, "namespace").collect()
    assert {(r.topic, r.place) for r in shared} == {("b-ep", 1), ("b-sem", 1)}
