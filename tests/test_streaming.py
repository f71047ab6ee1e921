import pytest
from pyspark.sql import functions as F

from tidelog.operators import catalog, reads
from tidelog.session import new_path
from tidelog.streaming import follow
from tidelog.streaming.source import open_stream
from tidelog.operators.metrics import failure_states
from tidelog.streaming.windows import dedup_stream, failure_windows, metric_windows


def rows(spark, start, n):
    return spark.range(start, start + n).select(
        F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("timestamp")
    )


def test_resume_after_a_failure(spark, log):
    sink, commits, checkpoint = (new_path(spark, n) for n in ("sink", "commits", "checkpoint"))
    start = lambda f: follow.resume(open_stream(spark, log, "t").select("topic", "partition", "offset", "value"), "g", f, sink, commits, checkpoint)
    log.append(rows(spark, 0, 30), partitions=2)
    start(lambda df: df).awaitTermination()
    log.append(rows(spark, 30, 20), partitions=2)

    def breaks(df):
        raise RuntimeError("lost")

    with pytest.raises(Exception):
        start(breaks).awaitTermination()
    start(lambda df: df).awaitTermination()
    got = [r.value for r in spark.read.parquet(sink).collect()]
    assert sorted(map(int, got)) == list(range(50))
    ends = {r.partition: r.end_offset for r in log.end_offsets().collect()}
    current = catalog.current_commits(spark.read.parquet(commits)).collect()
    assert {r.partition: r.offset for r in current} == ends
    from_there = spark.createDataFrame([(p, o) for p, o in ends.items()], "partition int, start_offset bigint")
    assert reads.read_from_offsets(log.scan("t"), from_there).isEmpty()


def test_stream_equals_batch(spark, log):
    log.append(rows(spark, 0, 40), partitions=3)
    path = new_path(spark, "landed")
    stream = log.stream("t", maxFilesPerTrigger="1")
    follow.land(stream, path, new_path(spark, "cp")).awaitTermination()
    landed = spark.read.schema(stream.schema).parquet(path)
    assert landed.drop("headers").exceptAll(log.scan("t").drop("headers")).isEmpty()
    assert landed.count() == 40


def test_tail_counts_over_batches(spark, log):
    path, checkpoint = new_path(spark, "counts"), new_path(spark, "cp")
    for start, n in ((0, 10), (10, 25)):
        log.append(rows(spark, start, n))
        follow.upsert_batches(follow.tail_counts(log.stream("t")), path, checkpoint).awaitTermination()
    row = follow.latest_rows(spark.read.parquet(path), ["topic", "partition"], ["records", "position"]).collect()
    assert [(r.records, r.position) for r in row] == [(35, 35)]


def test_only_whole_appends_are_followed(spark, log):
    seen, checkpoint = [], new_path(spark, "cp")
    handle = lambda df, number: seen.append((number, df.count()))
    log.append(rows(spark, 0, 5))
    rows(spark, 0, 9).select("timestamp").write.parquet(f"{log.root}/pending/txn=crashed/topic=t/partition=0")
    log.transaction().send(rows(spark, 5, 7)).commit()
    follow.follow_committed(log, "t", handle, checkpoint).awaitTermination()
    log.append(rows(spark, 12, 2).withColumn("topic", F.lit("other")))
    log.compact()
    log.append(rows(spark, 14, 3))
    follow.follow_committed(log, "t", handle, checkpoint).awaitTermination()
    assert [n for _, n in seen] == [12, 3]


def test_windows_and_late_points(spark, log):
    hour = 3_600_000

    def points(*times):
        return spark.createDataFrame([("t", "m", str(t), t) for t in times], "topic string, key string, value string, timestamp bigint")

    path, checkpoint = new_path(spark, "windows"), new_path(spark, "cp")

    def go():
        stream = log.stream("t").select(F.col("key").alias("name"), F.lit(1.0).alias("value"), "timestamp")
        out = metric_windows(stream, "1 hour", "10 minutes")
        follow.land(out, path, checkpoint).awaitTermination()
        return {r.window_start: r.points for r in spark.read.schema(out.schema).parquet(path).collect()}

    log.append(points(1, 2, hour + 1, 3 * hour))
    assert go() == {0: 2, hour: 1}
    log.append(points(5, 3 * hour + 7, 5 * hour))  # the first is too late for its window
    assert go() == {0: 2, hour: 1, 3 * hour: 2}


def test_dedup_stream_over_batches(spark, log):
    path, checkpoint = new_path(spark, "dedup"), new_path(spark, "cp")
    for start in (1, 4):
        log.append(rows(spark, start, 6))
        once = dedup_stream(log.stream("t"), ["key"], "1 hour").select("key")
        follow.land(once, path, checkpoint).awaitTermination()
    assert sorted(int(r.key) for r in spark.read.parquet(path).collect()) == list(range(1, 10))


def test_failure_windows(spark, log):
    hour = 3_600_000
    rows_ = [("t", k, v, at) for k, v, at in (("s", "e", 1), ("s", "e", 2), ("s", "ok", 3), ("r", "e", 4), ("s", "e", 9 * hour))]
    log.append(spark.createDataFrame(rows_, "topic string, key string, value string, timestamp bigint"))
    stream = log.stream("t").select(F.col("key").alias("service"), (F.col("value") == "e").alias("failed"), "timestamp")
    out = failure_windows(stream, "1 hour", "1 hour", 2)
    path = new_path(spark, "failures")
    follow.land(out, path, new_path(spark, "cp")).awaitTermination()
    got = {r.service: (r.attempts, r.failures, r.state) for r in spark.read.schema(out.schema).parquet(path).collect()}
    assert got == {"s": (3, 2, "OPEN"), "r": (1, 1, "CLOSED")}


def test_failure_states(spark):
    fails = [1, 1, 0, 1, 1, 1, 0]
    df = spark.createDataFrame([("s", i, bool(f)) for i, f in enumerate(fails)] + [("r", 0, True)], "service string, at bigint, failed boolean")
    got = sorted((r.service, r.at, r.streak, r.state) for r in failure_states(df, "service", ["at"], F.col("failed"), 2).collect())
    streaks = [1, 2, 0, 1, 2, 3, 0]
    assert got == [("r", 0, 1, "CLOSED")] + [("s", i, n, "OPEN" if n >= 2 else "CLOSED") for i, n in enumerate(streaks)]
