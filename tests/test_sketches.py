from pyspark.sql import functions as F

from tidelog.operators import sketches as sk
from tidelog.session import new_path

FRACTIONS = {"p50": 0.5, "p99": 0.99}


def points(spark, n):
    value = (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1000.0).alias("value")
    return spark.range(n).select(F.when(F.col("id") % 10 < 9, "busy").otherwise("quiet").alias("name"), value, (F.col("id") * 1000).alias("timestamp"))


def test_days_from_stored_hours(spark):
    read = points(spark, 200_000)
    path = new_path(spark, "hours")
    for part in (F.col("timestamp") % 2000 == 0, F.col("timestamp") % 2000 != 0):  # a window's points come in two appends
        sk.window_sketches(read.where(part), 3_600_000).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    days = sk.coarser(stored, 86_400_000)
    totals = {r.name: r.n for r in days.groupBy("name").agg(F.sum("points").alias("n")).collect()}
    assert totals == {"busy": 180_000, "quiet": 20_000}
    assert days.count() == 6
    whole = sk.quantiles(sk.coarser(stored, None), FRACTIONS)
    for row in sk.rank_errors(read, whole, FRACTIONS).collect():
        assert row.p50_error < 0.01 and row.p99_error < 0.01


def test_ties_nulls_and_nothing(spark):
    rows = [("a", 1.0, 5), ("a", 1.0, 6), ("a", None, 7), ("a", float("nan"), 8), ("b", None, 1)]
    read = spark.createDataFrame(rows, "name string, value double, timestamp bigint")
    told = sk.quantiles(sk.window_sketches(read, 100), FRACTIONS).collect()
    assert [(r.window_start, r.name, r.points, r.low, r.p50, r.p99) for r in told] == [(0, "a", 2, 1.0, 1.0, 1.0)]
    assert sk.quantiles(sk.coarser(sk.window_sketches(read.limit(0), 100), None), FRACTIONS).collect() == []


def sent(spark, start, n, topic="t"):
    return spark.range(start, start + n).select(
        F.lit(topic).alias("topic"), F.col("id").cast("string").alias("key"), F.lit("v").alias("value"), F.col("id").alias("timestamp")
    )


def test_keys_are_counted_without_a_scan(spark, log):
    keys = sk.KeySketches(log)
    assert keys.catch_up() == 0 and keys.distinct_keys().collect() == []
    log.append(sent(spark, 0, 20_000).unionByName(sent(spark, 0, 500, "u")), partitions=2)
    assert keys.catch_up() == 1
    log.append(sent(spark, 10_000, 20_000), partitions=2)
    log.append(sent(spark, 0, 10).withColumn("key", F.lit(None).cast("string")).withColumn("topic", F.lit("none")))
    assert keys.catch_up() == 2 and keys.catch_up() == 0
    told = {r.topic: r.distinct_keys for r in keys.distinct_keys().collect()}
    assert abs(told["t"] - 30_000) < 30_000 * 0.065 and abs(told["u"] - 500) < 500 * 0.065 and told["none"] == 0
    assert abs(keys.distinct_keys(by_topic=False).first().distinct_keys - 30_000) < 30_000 * 0.065
    assert {r.topic for r in keys.distinct_keys("u").collect()} == {"u"}
    assert not any("/data/" in f for f in keys.distinct_keys().inputFiles())


def test_states_survive_compaction_and_repeats(spark, log):
    keys = sk.KeySketches(log)
    for start in (0, 100):
        log.append(sent(spark, start, 150))
    keys.catch_up()
    before = keys.distinct_keys().collect()
    log.compact()
    assert keys.catch_up() == 0 and keys.distinct_keys().collect() == before
    keys.states().write.mode("append").parquet(keys.path + "-again")  # what a second one who catches up would have added
    spark.read.parquet(keys.path + "-again").write.mode("append").parquet(keys.path)
    assert keys.distinct_keys().collect() == before
