"""Sliced scans against plain Python, with hot groups cut into several slices."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidelog.operators.ordered import SLICE, asof_join, ordered_scan, sliced
from tidelog.session import RELEASE, releasing, store


def rows(n, seed, hot=0.5):
    rnd = random.Random(seed)
    times = rnd.sample(range(10 * n), n)
    return [
        ("hot" if rnd.random() < hot else rnd.choice(["a", "b", None, ""]), t, rnd.choice([None, rnd.randint(-5, 5)]))
        for t in times
    ]


@pytest.mark.parametrize("seed,slices", [(1, 1), (2, 7), (3, 13)])
def test_scan_equals_python(spark, seed, slices):
    data = rows(400, seed)
    df = spark.createDataFrame(data, "k string, t bigint, v int").repartition(5)
    out = ordered_scan(
        df, ["k"], ["t"], number="n", sums={"total": F.col("v").cast("bigint")}, last={"known": F.col("v")}, slices=slices
    )
    got = {(r.k, r.t): (r.n, r.total, r.known) for r in out.collect()}
    state, wanted = {}, {}
    for k, t, v in sorted(data, key=lambda r: r[1]):
        n, total, known = state.get(k, (0, 0, None))
        total, known = total + (v or 0), v if v is not None else known
        wanted[(k, t)] = (n, total, known)
        state[k] = (n + 1, total, known)
    assert got == wanted


def test_a_hot_group_is_cut(spark):
    df = spark.createDataFrame(rows(2000, 4, hot=0.9), "k string, t bigint, v int").repartition(4)
    sizes = sliced(df, ["k"], ["t"], 10).groupBy(SLICE).count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 700


def test_rows_of_one_time_are_cut_too(spark):
    df = spark.range(2000).select(F.lit("k").alias("k"), F.lit(1).alias("t"), "id").repartition(4)
    sizes = [r["count"] for r in sliced(df, ["k"], ["t"], 8).groupBy(SLICE).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 800
    out = ordered_scan(df, ["k"], ["t"], number="n", slices=8)
    assert sorted(r.n for r in out.collect()) == list(range(2000))


def test_numbering_without_keys(spark):
    out = ordered_scan(spark.range(100).repartition(4), [], ["id"], number="n", slices=5)
    assert all(r.id == r.n for r in out.collect())


@pytest.mark.parametrize("seed", [5, 6])
def test_asof_equals_python(spark, seed):
    rnd = random.Random(seed)
    left = [(rnd.choice("hhhab"), t) for t in rnd.sample(range(500), 150)]
    right = [(k, t, t * 10) for k in "hab" for t in rnd.sample(range(500), 20)]
    joined = asof_join(
        spark.createDataFrame(left, "k string, t bigint"), spark.createDataFrame(right, "k string, at bigint, v bigint"),
        ["k"], "t", "at", ["v"],
    )
    wanted = sorted((k, t, max((a for j, a, _ in right if j == k and a <= t), default=None)) for k, t in left)
    assert sorted((r.k, r.t, None if r.v is None else r.v // 10) for r in joined.collect()) == wanted


def test_slices_and_logs_are_stored_small(spark, sf_dir):
    """Hexadecimal digits, as ids of traces are, take no more than their half in what an append stores and writes."""
    from tidelog.operators.ordered import sliced
    from tidelog.plans.inputs import full_log
    from tidelog.session import hadoop_path

    def size(paths):
        return sum(hadoop_path(spark, p)[0].getFileStatus(hadoop_path(spark, p)[1]).getLen() for p in paths)

    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    assert size(sliced(rows, [], ["id"]).inputFiles()) < 0.75 * 20_000 * 64
    assert all(".zstd." in name for name in full_log(spark, sf_dir).scan().inputFiles())


def shuffled(spark):
    """MB of each shuffle file on this machine's disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() / 1e6 for f in found if f.getName().startswith("shuffle_")}


def left_over(spark, before, most):
    """MB of shuffles that were not there before, when they are down to `most` or will not go."""
    for _ in range(50):
        mb = sum(size for name, size in shuffled(spark).items() if name not in before)
        if mb <= most:
            break
        time.sleep(0.1)
    return mb


def test_shuffles_go_when_a_table_is_written(spark, log):
    before = shuffled(spark)
    df = spark.range(100_000).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.md5(F.col("id").cast("string")).alias("value"), "id")
    stored = store(df.repartition(5, "value"), "table")
    assert left_over(spark, before, 0) == 0 and stored.count() == 100_000
    log.append(df, 3, ["id"])
    assert left_over(spark, before, 0.5) < 0.5 and log.scan("t").agg(F.sum("offset")).first()[0] > 0
    assert spark.conf.get(RELEASE, None) is None
    spark.conf.set(RELEASE, "false")  # the session's own setting stands
    with releasing(spark):
        assert spark.conf.get(RELEASE) == "false"
    assert spark.conf.get(RELEASE) == "false"
    spark.conf.unset(RELEASE)
