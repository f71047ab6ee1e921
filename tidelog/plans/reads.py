"""Reads, writes, catalog and lag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.routing import route
from tidelog.operators import catalog, reads, writes
from tidelog.operators.sketches import KeySketches, bounded_error
from tidelog.plans.inputs import PARTITIONS, event_log, event_records, full_log, millis, once, order_records, table
from tidelog.plans.registry import ELOG, OLOG, RECORD, hashed, query
from tidelog.session import new_path, store
from tidelog.sources.topic_log import TopicLog

MID_JANUARY = 1705276800000  # 2024-01-15T00:00:00Z

PLAIN = ["topic", "partition", "offset", "timestamp", "key", "value"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).scan("events")


@query("topic_scan", f"WITH {ELOG} SELECT {RECORD} FROM elog")
def topic_scan(spark, sf_dir):
    return events(spark, sf_dir).select(*PLAIN)


@query("start_position", f"""
WITH {ELOG}, {OLOG},
ends AS (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM (
           SELECT topic, "partition", "offset" FROM elog UNION ALL SELECT topic, "partition", "offset" FROM olog) GROUP BY ALL)
SELECT 'earliest' AS reset, topic, "partition", CAST(0 AS BIGINT) AS start_offset, end_offset AS to_read FROM ends
UNION ALL
SELECT 'latest', topic, "partition", end_offset, CAST(0 AS BIGINT) FROM ends
""")
def start_position(spark, sf_dir):
    """Where a reader begins under each reset policy, and how many records it then finds."""
    log = full_log(spark, sf_dir)
    described = store(log.describe(), "described")
    out = None
    for reset in (reads.EARLIEST, reads.LATEST):
        starts = reads.start_positions(described, reset).join(described.select("topic", "partition", "begin_offset", "end_offset"), ["topic", "partition"])
        to_read = F.col("end_offset") - F.greatest("start_offset", "begin_offset")
        told = starts.select(F.lit(reset).alias("reset"), "topic", "partition", "start_offset", to_read.alias("to_read"))
        out = told if out is None else out.unionByName(told)
    return out


@query("read_from_offsets", f"""
WITH {ELOG} SELECT {RECORD} FROM elog
WHERE ("partition" = 0 AND "offset" >= 100) OR "partition" = 1 OR ("partition" = 2 AND "offset" >= 5)
""")
def read_from_offsets(spark, sf_dir):
    """Partition 0 from 100, 1 from the beginning, 2 from 5, 3 from its end."""
    starts = {0: 100, 1: reads.BEGINNING, 2: 5, 3: reads.END}
    return reads.read_from_offsets(events(spark, sf_dir), starts).select(*PLAIN)


@query("read_from_timestamp", f'WITH {ELOG} SELECT {RECORD} FROM elog WHERE "timestamp" >= {MID_JANUARY}')
def read_from_timestamp(spark, sf_dir):
    return reads.read_from_timestamp(events(spark, sf_dir), MID_JANUARY).select(*PLAIN)


@query("partition_select", f'WITH {ELOG} SELECT {RECORD} FROM elog WHERE "partition" IN (0, 2)')
def partition_select(spark, sf_dir):
    """Assigned 0, 1 and 2, with 1 paused."""
    return reads.partition_select(events(spark, sf_dir), [0, 1, 2], [1]).select(*PLAIN)


@query("poll_limit", f'WITH {ELOG} SELECT {RECORD} FROM elog ORDER BY "partition", "offset" LIMIT 500')
def poll_limit(spark, sf_dir):
    return reads.poll(event_log(spark, sf_dir), "events").select(*PLAIN)


@query("inspect_messages", f"""
WITH {ELOG} SELECT "partition", "offset", "timestamp", "key", payload AS "value", event_type, props FROM elog
WHERE "partition" = 1 AND "offset" >= 10 ORDER BY "offset" LIMIT 20
""")
def inspect_messages(spark, sf_dir):
    return with_headers(reads.inspect(event_log(spark, sf_dir), "events", 1, 20, offset=10))


@query("latest_messages", f"""
WITH {ELOG} SELECT "partition", "offset", "timestamp", "key", payload AS "value", event_type, props FROM elog
ORDER BY "timestamp" DESC, "partition", "offset" DESC LIMIT 25
""")
def latest_messages(spark, sf_dir):
    return with_headers(reads.latest(event_log(spark, sf_dir), "events", 25))


def with_headers(messages: DataFrame) -> DataFrame:
    shown = [F.try_element_at("headers", F.lit(h)).alias(h) for h in ("event_type", "props")]
    return messages.select("partition", "offset", "timestamp", "key", "value", *shown)


@query("key_filter", f"""WITH {ELOG} SELECT {RECORD} FROM elog WHERE "key" = '8'""")
def key_filter(spark, sf_dir):
    return event_log(spark, sf_dir).key_scan("events", "8").select(*PLAIN)


# -- writes -----------------------------------------------------------------------------------------


@query("append_records", f'WITH {ELOG} SELECT topic, "partition", "offset", "timestamp" FROM elog')
def append_records(spark, sf_dir):
    """The receipts of appending all events."""
    log = TopicLog(spark, new_path(spark, "append"))
    return log.append(event_records(spark, sf_dir), PARTITIONS, ["ts", "event_id"])


@query("partition_route", f"""
SELECT event_id, CASE WHEN event_type = 'error' THEN 3
                      WHEN event_type = 'view' THEN {hashed("'e' || event_id")}
                      ELSE {hashed('CAST(user_id AS VARCHAR)')} END AS "partition"
FROM events
""")
def partition_route(spark, sf_dir):
    """Errors name partition 3, views have no key and are spread, the rest goes by user."""
    kind = F.col("event_type")
    explicit = F.when(kind == "error", F.lit(3))
    key = F.when(kind != "view", F.col("user_id").cast("string"))
    spread = F.concat(F.lit("e"), F.col("event_id"))
    return table(spark, sf_dir, "events").select("event_id", route(key, PARTITIONS, explicit, spread).alias("partition"))


@query("transactional_append", f"""
WITH kept AS (
  SELECT event_type || 's' AS topic,
         {hashed('CAST(user_id AS VARCHAR)', 2)} AS "partition", epoch_us(ts) // 1000 AS "timestamp",
         CAST(user_id AS VARCHAR) AS "key", ts, event_id
  FROM events)
SELECT topic, "partition", row_number() OVER (PARTITION BY topic, "partition" ORDER BY ts, event_id) - 1 AS "offset",
       "timestamp", "key" FROM kept
""")
def transactional_append(spark, sf_dir):
    """One transaction over a topic for every kind of event is committed, one is aborted, one is empty: what readers then see."""
    log = TopicLog(spark, new_path(spark, "txn"))
    kind = F.col("headers")["event_type"].cast("string")
    records = event_records(spark, sf_dir).withColumn("topic", F.concat(kind, F.lit("s")))
    settings = {"partitions": 2, "arrival": ["ts", "event_id"]}
    paid = F.col("topic") == "purchases"
    log.transaction(**settings).send(records.where(paid)).send(records.where(~paid)).commit()
    log.transaction(**settings).send(records).abort()
    log.transaction(**settings).commit()
    return log.scan().select("topic", "partition", "offset", "timestamp", "key")


@query("reject_oversize", """
SELECT doc_id, CAST(strlen(CAST(doc_id AS VARCHAR)) + strlen(text) AS INTEGER) AS size,
       strlen(CAST(doc_id AS VARCHAR)) + strlen(text) <= 4096 AS accepted FROM documents
""")
def reject_oversize(spark, sf_dir):
    """Documents as records, at most 4 KiB each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("key"), F.col("text").alias("value"))
    return writes.reject_oversize(docs, 4096).select("doc_id", "size", "accepted")


@query("dedup_append", f"""
WITH {ELOG} SELECT "partition", "offset", "timestamp", user_id AS producer_id, event_id AS seq FROM elog
""")
def dedup_append(spark, sf_dir):
    """Every event is sent, errors and clicks twice; then everything is sent once more."""
    log = TopicLog(spark, new_path(spark, "dedup"))
    sent = event_records(spark, sf_dir).withColumns(
        {"producer_id": F.col("key").cast("bigint"), "seq": F.col("event_id"), "attempt": F.lit(0)}
    )
    repeated = sent.where(F.col("headers")["event_type"].cast("string").isin("error", "click")).withColumn("attempt", F.lit(1))
    ids, arrival = ["producer_id", "seq"], ["ts", "event_id", "attempt"]

    def stored() -> DataFrame:
        value = F.col("value")
        return log.scan("events").select(
            F.col("key").cast("bigint").alias("producer_id"),
            F.get_json_object(value, "$.event_id").cast("bigint").alias("seq"), "partition", "offset", "timestamp",
        )

    nothing = stored().select(*ids)
    writes.dedup_append(log, sent.unionByName(repeated), ids, nothing, arrival, partitions=PARTITIONS)
    writes.dedup_append(log, sent, ids, stored().select(*ids), arrival, partitions=PARTITIONS)
    return stored()


@query("dedup_append_indexed", f"""
WITH {ELOG} SELECT "partition", "offset", "timestamp", user_id AS producer_id, event_id AS seq FROM elog
""")
def dedup_append_indexed(spark, sf_dir):
    """The same against a bucketed table of the ids, which is brought up to date from the appends it does not have."""
    log = TopicLog(spark, new_path(spark, "dedup"))
    sent = event_records(spark, sf_dir).withColumns({"producer_id": F.col("key").cast("bigint"), "seq": F.col("event_id"), "attempt": F.lit(0)})
    repeated = sent.where(F.col("headers")["event_type"].cast("string").isin("error", "click")).withColumn("attempt", F.lit(1))

    def ids(records: DataFrame) -> DataFrame:
        seq = F.get_json_object("value", "$.event_id").cast("bigint").alias("seq")
        return records.select("txn", F.col("key").cast("bigint").alias("producer_id"), seq)

    index = writes.IdIndex(log, ["producer_id", "seq"], ids, PARTITIONS * 2)
    for batch in (sent.where(F.col("timestamp") < MID_JANUARY), sent.unionByName(repeated), sent):
        index.append(batch, ["ts", "event_id", "attempt"], partitions=PARTITIONS)
    value = F.get_json_object("value", "$.event_id").cast("bigint").alias("seq")
    return log.scan("events").select("partition", "offset", "timestamp", F.col("key").cast("bigint").alias("producer_id"), value)


# -- catalog ----------------------------------------------------------------------------------------

BOTH = f"""
WITH {ELOG}, {OLOG},
both_topics AS (SELECT topic, "partition", "offset", "timestamp" FROM elog
                UNION ALL SELECT topic, "partition", "offset", "timestamp" FROM olog)"""


@query("list_topics", f"""
{BOTH} SELECT topic, count(DISTINCT "partition") AS partitions, count(*) AS records FROM both_topics GROUP BY topic
""")
def list_topics(spark, sf_dir):
    return catalog.list_topics(full_log(spark, sf_dir).describe())


@query("topic_distinct_keys", f"""
WITH {ELOG}, {OLOG}, keyed AS (SELECT topic, "key" FROM elog UNION ALL SELECT topic, "key" FROM olog)
SELECT topic, count(DISTINCT "key") AS exact_keys, TRUE AS holds FROM keyed GROUP BY topic
UNION ALL SELECT '*', count(DISTINCT "key"), TRUE FROM keyed
""")
def topic_distinct_keys(spark, sf_dir):
    """Distinct keys per topic and of all topics, from states kept per append; whether they are within their error."""
    log = TopicLog(spark, new_path(spark, "keyed"))
    keys = KeySketches(log)
    early = F.col("timestamp") < MID_JANUARY
    log.append(event_records(spark, sf_dir).where(early), PARTITIONS, ["ts", "event_id"])
    keys.catch_up()
    log.append(event_records(spark, sf_dir).where(~early), PARTITIONS, ["ts", "event_id"])
    log.append(order_records(spark, sf_dir), PARTITIONS, ["o_orderdate", "o_orderkey"])
    keys.catch_up()
    told = keys.distinct_keys().unionByName(keys.distinct_keys(by_topic=False).withColumn("topic", F.lit("*")))
    pairs = log.scan().select("topic", "key").distinct()
    exact = pairs.groupBy("topic").agg(F.count("key").alias("exact_keys")).unionByName(
        pairs.select(F.lit("*").alias("topic"), "key").distinct().groupBy("topic").agg(F.count("key").alias("exact_keys")))
    return told.join(exact, "topic").select("topic", "exact_keys", bounded_error(F.col("distinct_keys"), F.col("exact_keys")).alias("holds"))


@query("describe_topic", f"""
WITH {ELOG} SELECT topic, "partition", min("offset") AS begin_offset, max("offset") + 1 AS end_offset, count(*) AS records,
       min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp FROM elog GROUP BY ALL
""")
def describe_topic(spark, sf_dir):
    return event_log(spark, sf_dir).describe()


@query("partition_positions", f"""
WITH {ELOG}
SELECT topic, "partition", coalesce(max("offset") FILTER ("timestamp" < {MID_JANUARY} AND "partition" <> 3) + 1, 0) AS position
FROM elog GROUP BY topic, "partition"
""")
def partition_positions(spark, sf_dir):
    """After reading what came before mid-January, from all partitions but 3."""
    records = events(spark, sf_dir)
    consumed = records.where((F.col("timestamp") < MID_JANUARY) & (F.col("partition") != 3))
    partitions = event_log(spark, sf_dir).end_offsets().where("topic = 'events'").select("topic", "partition")
    return catalog.partition_positions(consumed, partitions)


@once
def commit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group per event type: it commits the offset after each event of its type, when that happens."""
    commits = events(spark, sf_dir).select(
        F.concat(F.lit("group-"), F.col("headers")["event_type"].cast("string")).alias("group_id"),
        "topic", "partition", (F.col("offset") + 1).alias("offset"), F.col("timestamp").alias("committed_at"),
    )
    return store(commits, "commits")


LAGS = f"""
WITH {ELOG},
ends AS (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM elog GROUP BY ALL),
current AS (SELECT 'group-' || event_type AS group_id, topic, "partition", max("offset") + 1 AS current_offset,
                   max("timestamp") AS committed_at FROM elog GROUP BY ALL),
lags AS (SELECT group_id, topic, "partition", current_offset, end_offset, end_offset - current_offset AS lag
         FROM current JOIN ends USING (topic, "partition"))"""
FLAT = """SELECT group_id, topic, "partition", current_offset, end_offset, lag,
                 CAST(sum(lag) OVER (PARTITION BY group_id) AS BIGINT) AS total_lag FROM lags"""


def flat(lags: DataFrame) -> DataFrame:
    return lags.select("group_id", "total_lag", F.inline("partitions"))


@query("commit_offsets", f"""
WITH {ELOG},
read AS (SELECT 'readers' AS group_id, topic, "partition", max("offset") FILTER ("timestamp" < until) + 1 AS "offset", until AS committed_at
         FROM elog, (VALUES ({MID_JANUARY}::BIGINT), ({MID_JANUARY}::BIGINT * 2)) halves(until) GROUP BY ALL)
SELECT group_id, topic, "partition", "offset", committed_at FROM read WHERE committed_at > {MID_JANUARY}
""")
def commit_offsets(spark, sf_dir):
    """A group commits its positions after half of the month and after all of it; one reader without a group does so too."""
    records, path = events(spark, sf_dir), new_path(spark, "committed")
    partitions = event_log(spark, sf_dir).end_offsets().select("topic", "partition")
    for until in (MID_JANUARY, 2 * MID_JANUARY):
        positions = catalog.partition_positions(records.where(F.col("timestamp") < until), partitions)
        catalog.commit_offsets(path, "readers", positions, F.lit(until))
        catalog.commit_offsets(path, None, positions, F.lit(until))
    return catalog.current_commits(spark.read.parquet(path))


@query("list_consumer_groups", "SELECT DISTINCT 'group-' || event_type AS group_id FROM events")
def list_consumer_groups(spark, sf_dir):
    return catalog.list_consumer_groups(commit_history(spark, sf_dir))


@query("consumer_group_lag", f"{LAGS} {FLAT}")
def consumer_group_lag(spark, sf_dir):
    return flat(catalog.consumer_group_lag(commit_history(spark, sf_dir), event_log(spark, sf_dir).end_offsets()))


@query("consumer_group_topic_lag", f"{LAGS} {FLAT} WHERE group_id = 'group-purchase' AND topic = 'events'")
def consumer_group_topic_lag(spark, sf_dir):
    ends = event_log(spark, sf_dir).end_offsets()
    return flat(catalog.consumer_group_topic_lag(commit_history(spark, sf_dir), ends, "group-purchase", "events"))
