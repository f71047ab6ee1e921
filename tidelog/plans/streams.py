"""Streaming queries, run until they have read what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.headers import header_get_str
from tidelog.operators import catalog, tracing
from tidelog.operators.metrics import failure_states
from tidelog.plans.inputs import PARTITIONS, event_log, event_records, millis, table
from tidelog.plans.reads import MID_JANUARY, PLAIN
from tidelog.plans.registry import ELOG, RECORD, query
from tidelog.session import new_path, store
from tidelog.sources.topic_log import TopicLog
from tidelog.streaming import follow
from tidelog.streaming.positions import positions
from tidelog.streaming.source import END, drain, open_stream
from tidelog.streaming.spans import match_spans
from tidelog.streaming.windows import dedup_stream, failure_windows, metric_windows

DAY_MS, HOUR_MS = 86_400_000, 3_600_000


@query("topic_stream", f"WITH {ELOG} SELECT {RECORD} FROM elog")
def topic_stream(spark, sf_dir):
    """The events topic, followed into a table."""
    stream = event_log(spark, sf_dir).stream("events").select(*PLAIN)
    path = new_path(spark, "landed")
    follow.land(stream, path, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_from_offsets", f"""
WITH {ELOG} SELECT {RECORD} FROM elog
WHERE ("partition" = 0 AND "offset" >= 100) OR "partition" = 1 OR ("partition" = 2 AND "offset" >= 5) OR ("partition" = 3 AND "timestamp" >= {MID_JANUARY})
""")
def stream_from_offsets(spark, sf_dir):
    """Partition 0 from 100, 1 from its beginning, 2 from 5, 3 from its end, which is the middle of the month; the rest is
    appended when the stream has stopped, and read when it goes on."""
    log = TopicLog(spark, new_path(spark, "positions"))
    path, checkpoint = new_path(spark, "landed"), new_path(spark, "checkpoint")
    for half in (F.col("timestamp") < MID_JANUARY, F.col("timestamp") >= MID_JANUARY):
        log.append(event_records(spark, sf_dir).where(half), PARTITIONS, ["ts", "event_id"])
        drain(open_stream(spark, log, "events", {0: 100, 2: 5, 3: END}), path, checkpoint)
    return spark.read.parquet(path).select(*PLAIN)


@query("stream_from_timestamp", f'WITH {ELOG} SELECT {RECORD} FROM elog WHERE "timestamp" >= {MID_JANUARY}')
def stream_from_timestamp(spark, sf_dir):
    path = new_path(spark, "landed")
    drain(open_stream(spark, event_log(spark, sf_dir), "events", since=MID_JANUARY), path, new_path(spark, "checkpoint"))
    return spark.read.parquet(path).select(*PLAIN)


@query("stream_bounded", f"""
WITH {ELOG} SELECT "partition", "offset", "key", CAST("offset" // (SELECT count(*) // 5 // {PARTITIONS} FROM events) AS INTEGER) AS batch FROM elog
""")
def stream_bounded(spark, sf_dir):
    """A fifth of the events to a batch; the stream is stopped after two batches, in the middle of its partitions."""
    log = event_log(spark, sf_dir)
    most = log.describe().agg(F.sum("records")).first()[0] // 5
    path, checkpoint = new_path(spark, "landed"), new_path(spark, "checkpoint")
    for batches in (2, None):
        drain(open_stream(spark, log, "events", most=most), path, checkpoint, batches)
    return spark.read.parquet(path).select("partition", "offset", "key", "batch")


@query("stream_tail_count", f"""
WITH {ELOG} SELECT topic, "partition", count(*) AS records, max("offset") + 1 AS position FROM elog GROUP BY topic, "partition"
""")
def stream_tail_count(spark, sf_dir):
    counts = follow.tail_counts(event_log(spark, sf_dir).stream("events"))
    path = new_path(spark, "counts")
    follow.upsert_batches(counts, path, new_path(spark, "checkpoint")).awaitTermination()
    return follow.latest_rows(spark.read.parquet(path), ["topic", "partition"], ["records", "position"])


@query("stream_resume", f"""
WITH {ELOG} SELECT 'readers' AS group_id, topic, "partition", max("offset") + 1 AS "offset", count(*) AS processed,
                   count(DISTINCT "offset") AS distinct_offsets FROM elog GROUP BY topic, "partition"
""")
def stream_resume(spark, sf_dir):
    """A group reads the first half of the month, stops, and goes on when the rest has been appended."""
    log = TopicLog(spark, new_path(spark, "resumed"))
    sink, commits, checkpoint = (new_path(spark, n) for n in ("sink", "commits", "checkpoint"))
    records, arrival = event_records(spark, sf_dir), ["ts", "event_id"]
    for half in (F.col("timestamp") < MID_JANUARY, F.col("timestamp") >= MID_JANUARY):
        log.append(records.where(half), PARTITIONS, arrival)
        stream = open_stream(spark, log, "events", columns=["topic", "partition", "offset"])
        follow.resume(stream, "readers", lambda batch: batch, sink, commits, checkpoint).awaitTermination()
    current = catalog.current_commits(spark.read.parquet(commits))
    done = spark.read.parquet(sink).groupBy("topic", "partition").agg(
        F.count("*").alias("processed"), F.countDistinct("offset").alias("distinct_offsets")
    )
    return current.join(done, ["topic", "partition"]).select("group_id", "topic", "partition", "offset", "processed", "distinct_offsets")


@query("stream_positions", f"""
WITH {ELOG}, seen AS (SELECT * FROM elog WHERE "partition" <> 3 OR "timestamp" < {MID_JANUARY})
SELECT topic, "partition", max("offset") + 1 AS position, count(*) AS records, max("timestamp") AS last_ms,
       CASE WHEN max("timestamp") + {2 * DAY_MS} <= (SELECT max("timestamp") FROM seen) - {HOUR_MS} THEN 'idle' ELSE 'moved' END AS event
FROM seen GROUP BY topic, "partition"
""")
def stream_positions(spark, sf_dir):
    """Positions as state over two runs; partition 3 falls silent in the middle of the month, and is told as idle."""
    log = TopicLog(spark, new_path(spark, "silent"))
    path, checkpoint = new_path(spark, "told"), new_path(spark, "checkpoint")
    for half in (F.col("timestamp") < MID_JANUARY, F.col("timestamp") >= MID_JANUARY):
        log.append(event_records(spark, sf_dir).where(half), PARTITIONS, ["ts", "event_id"])
        heard = open_stream(spark, log, "events").where((F.col("partition") != 3) | (F.col("timestamp") < MID_JANUARY))
        drain(positions(heard, "1 hour", 2 * DAY_MS), path, checkpoint, mode="update")
    return follow.latest_rows(spark.read.parquet(path), ["topic", "partition"], ["position", "records", "last_ms", "event"])


@query("trace_join_stream", f"""
WITH {ELOG},
made AS (SELECT topic, "partition", "offset", event_id, "timestamp" AS produced_at FROM elog WHERE event_type <> 'signup'),
done AS (SELECT topic, "partition", "offset", event_id, "timestamp" + CAST(floor(amount * 60000) AS BIGINT) AS processed_at FROM elog WHERE event_type <> 'error'),
mark AS (SELECT least((SELECT max(produced_at) FROM made), (SELECT max(processed_at) FROM done)) - {6 * HOUR_MS} AS wm),
hits AS (SELECT topic, "partition", "offset", event_id, produced_at, processed_at FROM made JOIN done USING (topic, "partition", "offset", event_id)
         WHERE processed_at - produced_at BETWEEN 0 AND {HOUR_MS}),
found AS (
  SELECT *, 'matched' AS state FROM hits
  UNION ALL SELECT topic, "partition", "offset", event_id, produced_at, NULL, 'lost' FROM made ANTI JOIN hits USING ("partition", "offset"), mark WHERE produced_at <= wm - {HOUR_MS}
  UNION ALL SELECT topic, "partition", "offset", event_id, NULL, processed_at, 'orphan' FROM done ANTI JOIN hits USING ("partition", "offset"), mark WHERE processed_at <= wm)
SELECT md5('trace-' || event_id) AS trace_id, topic, "partition", "offset", CASE WHEN produced_at IS NOT NULL THEN 'events produce' END AS produce_span,
       CASE WHEN processed_at IS NOT NULL THEN 'events process' END AS process_span, produced_at, processed_at,
       processed_at - produced_at AS latency_ms, state FROM found
""")
def trace_join_stream(spark, sf_dir):
    """Spans of two streams: signups are produced without a trace, errors are never processed, and the rest within as many
    minutes as their value tells. What has no match within an hour is told when no more can come."""
    log = event_log(spark, sf_dir)
    kind = header_get_str(F.col("headers"), "event_type")
    delay = F.floor(F.get_json_object("value", "$.value").cast("double") * 60000)
    made = tracing.spans(log.stream("events").where(kind != "signup"), "produce")
    done = tracing.spans(log.stream("events").where(kind != "error").withColumn("done", F.col("timestamp") + delay), "process", "done")
    matches, path = match_spans(made, done, "1 HOUR", "6 hours"), new_path(spark, "matches")
    follow.land(matches, path, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(matches.schema).parquet(path)


@query("stream_metric_windows", f"""
SELECT * FROM (
  SELECT epoch_us(ts) // 1000 // {DAY_MS} * {DAY_MS} AS window_start, event_type AS name, count(*) AS points,
         round(sum(value), 4) AS total, max(value) AS high
  FROM events GROUP BY 1, 2)
WHERE window_start + {DAY_MS} <= (SELECT max(epoch_us(ts) // 1000) - {6 * HOUR_MS} FROM events)
""")
def stream_metric_windows(spark, sf_dir):
    """Daily windows that are closed, six hours being allowed for late points."""
    parsed = F.from_json("value", "event_id bigint, event_type string, value double")
    points = event_log(spark, sf_dir).stream("events").withColumn("v", parsed).select(
        F.col("v.event_type").alias("name"), F.col("v.value").alias("value"), "timestamp"
    )
    closed = metric_windows(points, "1 day", "6 hours").withColumn("total", F.round("total", 4))
    path = new_path(spark, "windows")
    follow.land(closed, path, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(closed.schema).parquet(path)


@query("dedup_stream", f"""
WITH {ELOG}, sent AS (
  SELECT *, 0 AS half FROM elog UNION ALL SELECT *, 1 FROM elog)
SELECT "partition", row_number() OVER (PARTITION BY "partition" ORDER BY half, ts, event_id) - 1 AS "offset", "timestamp", "key"
FROM sent QUALIFY half = 0
""")
def dedup_stream_query(spark, sf_dir):
    """Every event is appended twice, one append after the other; the stream takes them in turn and keeps the first of
    each by user and event id, with the offset it had."""
    log = TopicLog(spark, new_path(spark, "twice"))
    sent, path, checkpoint = event_records(spark, sf_dir), new_path(spark, "deduped"), new_path(spark, "checkpoint")
    schema = None
    for _ in range(2):
        log.append(sent, PARTITIONS, ["ts", "event_id"])
        ids = log.stream("events", maxFilesPerTrigger="100000").withColumn("seq", F.get_json_object("value", "$.event_id"))
        once = dedup_stream(ids, ["key", "seq"], "31 days").select("partition", "offset", "timestamp", "key")
        follow.land(once, path, checkpoint).awaitTermination()
        schema = once.schema
    return spark.read.schema(schema).parquet(path)


FAILURES = 3


@query("breaker_states", f"""
SELECT user_id, event_id, streak, CASE WHEN streak >= {FAILURES} THEN 'OPEN' ELSE 'CLOSED' END AS state
FROM (SELECT user_id, event_id, n - coalesce(max(CASE WHEN event_type <> 'error' THEN n END)
               OVER (PARTITION BY user_id ORDER BY n ROWS UNBOUNDED PRECEDING), 0) AS streak
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events))
""")
def breaker_states_query(spark, sf_dir):
    """How many errors in a row each user has had after each event, and whether a breaker would be open."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", millis("ts").alias("at_ms"), (F.col("event_type") == "error").alias("failed"))
    return failure_states(rows, "user_id", ["at_ms", "event_id"], F.col("failed"), FAILURES).drop("at_ms")


@query("breaker_stream", f"""
SELECT *, CASE WHEN failures >= {FAILURES} THEN 'OPEN' ELSE 'CLOSED' END AS state FROM (
  SELECT epoch_us(ts) // 1000 // {DAY_MS} * {DAY_MS} AS window_start, CAST(user_id AS VARCHAR) AS service, count(*) AS attempts,
         count(*) FILTER (event_type = 'error') AS failures
  FROM events GROUP BY 1, 2)
WHERE window_start + {DAY_MS} <= (SELECT max(epoch_us(ts) // 1000) - {6 * HOUR_MS} FROM events)
""")
def breaker_stream_query(spark, sf_dir):
    """Errors per user and closed day, as a stream over the events topic."""
    parsed = F.from_json("value", "event_type string")
    outcomes = event_log(spark, sf_dir).stream("events").select(
        F.col("key").alias("service"), (parsed["event_type"] == "error").alias("failed"), "timestamp"
    )
    closed = failure_windows(outcomes, "1 day", "6 hours", FAILURES)
    path = new_path(spark, "breaker")
    follow.land(closed, path, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(closed.schema).parquet(path)
