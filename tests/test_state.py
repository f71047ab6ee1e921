from pyspark.sql import functions as F

from tidelog.session import new_path
from tidelog.streaming import follow
from tidelog.streaming.positions import positions
from tidelog.streaming.spans import match_spans

SPAN = "trace_id string, topic string, partition int, offset bigint, name string, at_ms bigint"
HOUR = 3_600_000
BEGIN = 400_000 * HOUR


def spans_at(spark, path):
    return spark.readStream.schema(SPAN).parquet(path)


def put(spark, path, *rows):
    spark.createDataFrame([(t, "t", 0, o, "s", BEGIN + at) for t, o, at in rows], SPAN).coalesce(1).write.mode("append").parquet(path)


def test_spans_are_matched_or_told_as_unmatched(spark):
    made, done, out, checkpoint = (new_path(spark, n) for n in ("made", "done", "out", "checkpoint"))
    start = lambda: follow.land(
        match_spans(spans_at(spark, made), spans_at(spark, done), "1 HOUR", "10 minutes"), out, checkpoint).awaitTermination()
    put(spark, made, ("a", 0, 0), ("b", 1, 0), ("c", 2, 1000), (None, 3, 0))
    put(spark, done, ("a", 0, 5000), ("a", 0, 6000), ("x", 9, 0))
    start()
    read = lambda: sorted((r.trace_id or "", r.offset, r.state, r.latency_ms) for r in spark.read.parquet(out).collect())
    assert read() == [("a", 0, "matched", 5000), ("a", 0, "matched", 6000)]  # nothing else is certain yet
    put(spark, made, ("z", 50, 9 * HOUR))
    put(spark, done, ("c", 2, 1000 + HOUR), ("z", 50, 9 * HOUR + 7))  # at the bound, with the state still there
    start()
    assert read() == [("", 3, "lost", None), ("a", 0, "matched", 5000), ("a", 0, "matched", 6000), ("b", 1, "lost", None),
                      ("c", 2, "matched", HOUR), ("x", 9, "orphan", None), ("z", 50, "matched", 7)]


RECORD = "topic string, partition int, offset bigint, timestamp bigint"


def test_positions_stay_and_silence_is_told(spark):
    path, out, checkpoint = (new_path(spark, n) for n in ("records", "told", "checkpoint"))

    def step(*rows):
        spark.createDataFrame([("t", p, o, BEGIN + at) for p, o, at in rows], RECORD).coalesce(1).write.mode("append").parquet(path)
        stream = positions(spark.readStream.schema(RECORD).parquet(path), "1 minute", HOUR)
        follow.upsert_batches(stream, out, checkpoint).awaitTermination()
        told = spark.read.parquet(out)
        idle = sorted((r.partition, r.position) for r in told.where("event = 'idle'").collect())
        now = follow.latest_rows(told, ["partition"], ["position", "records"]).orderBy("partition")
        return [tuple(r) for r in now.collect()], idle

    assert step((0, 1, 20), (0, 0, 10), (1, 0, 10)) == ([(0, 2, 2), (1, 1, 1)], [])
    assert step((0, 0, 10), (0, 1, 20), (0, 1, 20)) == ([(0, 2, 2), (1, 1, 1)], [])  # sent again
    assert step((0, 1, 20), (0, 2, 3 * HOUR)) == ([(0, 3, 3), (1, 1, 1)], [(1, 1)])
    assert step((1, 1, 3 * HOUR), (0, 3, 9 * HOUR))[1] == [(1, 1), (1, 2)]
