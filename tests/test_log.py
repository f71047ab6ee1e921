import pytest
from pyspark.sql import functions as F

from tidelog.operators import reads, writes
from tidelog.sources import topic_log
from tidelog.sources.topic_log import ConcurrentAppend, TopicLog, escape


def keyed(spark, n, topic="t"):
    return spark.createDataFrame([(topic, f"user-{i % 7}", f"val-{i}", i) for i in range(n)], "topic string, key string, value string, timestamp bigint")


def test_dense_offsets_over_two_appends(spark, log):
    for _ in range(2):
        log.append(keyed(spark, 50), partitions=3, arrival=["timestamp", "value"])
    got = log.scan("t").groupBy("partition").agg(F.sort_array(F.collect_list("offset")).alias("o")).collect()
    assert sum(len(r.o) for r in got) == 100
    assert all(r.o == list(range(len(r.o))) for r in got)
    ends = {r.partition: r.end_offset for r in log.end_offsets().collect()}
    assert ends == {r.partition: len(r.o) for r in got}


def test_manifest_knows_what_a_scan_finds(spark, log):
    from tidelog.operators.catalog import describe_topic

    for n in (30, 20):
        log.append(keyed(spark, n), partitions=3, arrival=["timestamp"])
    log.append(keyed(spark, 5, "other"))
    assert sorted(log.describe().collect()) == sorted(describe_topic(log.scan()).collect())


def test_same_key_same_partition_and_explicit_wins(spark, log):
    records = keyed(spark, 40).withColumn("partition", F.when(F.col("timestamp") >= 35, F.lit(5)))
    log.append(records, partitions=3, arrival=["timestamp"])
    rows = log.scan("t").collect()
    assert {r.partition for r in rows if r.timestamp >= 35} == {5}
    by_key = {}
    for r in rows:
        if r.timestamp < 35:
            by_key.setdefault(r.key, set()).add(r.partition)
    assert all(len(p) == 1 for p in by_key.values()) and max(max(p) for p in by_key.values()) < 3


def test_keyless_records_spread(spark, log):
    records = spark.range(300).select(F.lit("t").alias("topic"), F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("timestamp"))
    log.append(records, partitions=4)
    rows = log.scan("t").groupBy("partition").count().collect()
    assert len(rows) == 4 and min(r["count"] for r in rows) > 30
    assert log.scan("t").where("key IS NOT NULL").isEmpty()


def test_input_order_is_arrival_order(spark, log):
    log.append(keyed(spark, 20).coalesce(1).withColumn("partition", F.lit(0)))
    assert [r.value for r in log.scan("t").orderBy("offset").collect()] == [f"val-{i}" for i in range(20)]


def test_receipts_headers_and_bytes(spark):
    from pyspark.sql import types as T
    from tidelog.session import new_path

    log = TopicLog(spark, new_path(spark, "bytes"), T.BinaryType())
    rows = [("t", None, bytearray(b"\x00\xff\xab"), {"h": bytearray(b"\x01")}, 7)]
    records = spark.createDataFrame(rows, "topic string, key string, value binary, headers map<string,binary>, timestamp bigint")
    receipt = log.append(records).first()
    assert (receipt.topic, receipt.partition, receipt.offset, receipt.timestamp) == ("t", 0, 0, 7)
    row = log.scan("t").first()
    assert row.key is None and row.value == b"\x00\xff\xab" and row.headers == {"h": b"\x01"}


def test_empty_batch(spark, log):
    assert log.append(keyed(spark, 0)).count() == 0
    assert log.scan().count() == 0 and log.scan("t").columns == TopicLog.COLUMNS


@pytest.mark.parametrize("codec", sorted(topic_log.CODECS))
def test_codecs(spark, log, codec):
    log.append(keyed(spark, 5), compression=codec)
    assert log.scan("t").count() == 5


def test_unknown_codec(spark, log):
    with pytest.raises(KeyError):
        log.append(keyed(spark, 5), compression="rot13")


@pytest.mark.parametrize("topic", ["my.topic", "events/exp-a", "a=b", "x%y", "sp ace"])
def test_topic_folders(spark, log, topic):
    log.append(keyed(spark, 4, topic), check_names=False)
    assert [r.topic for r in log.scan(topic).select("topic").distinct().collect()] == [topic]
    assert log.stream(topic).isStreaming


def test_transaction(spark, log):
    with_two = log.transaction(arrival=["timestamp"]).send(keyed(spark, 3, "a")).send(keyed(spark, 4, "b"))
    assert log.scan().isEmpty()
    with_two.commit()
    assert {r.topic: r["count"] for r in log.scan().groupBy("topic").count().collect()} == {"a": 3, "b": 4}
    assert log.manifest().select("txn").distinct().count() == 1
    dropped = log.transaction().send(keyed(spark, 9, "a"))
    dropped.abort()
    with pytest.raises(RuntimeError):
        dropped.commit()
    assert log.transaction().commit() is None
    assert log.transaction().send(keyed(spark, 1, "a")).flush().count() == 1
    assert log.scan("a").count() == 4


def test_failed_append_is_not_seen(spark, log, monkeypatch):
    """A writer that dies before its commit: neither scans nor streams see its records."""
    log.append(keyed(spark, 3))
    other = TopicLog(spark, log.root)
    monkeypatch.setattr(other, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        other.append(keyed(spark, 5))
    assert log.scan("t").count() == 3 and streamed(spark, log) == 3
    log.append(keyed(spark, 2))
    assert log.scan("t").agg(F.max("offset")).first()[0] == 4 and streamed(spark, log) == 5


def test_committed_append_is_finished_by_others(spark, log, monkeypatch):
    """A writer that dies between its commit and the move: the records are there for whoever comes next."""
    log.append(keyed(spark, 3))
    other = TopicLog(spark, log.root)
    monkeypatch.setattr(other, "_move", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        other.append(keyed(spark, 5))
    assert streamed(spark, log) == 8 and log.scan("t").count() == 8


def streamed(spark, log):
    from tidelog.session import new_path
    from tidelog.streaming import follow

    path = new_path(spark, "streamed")
    stream = log.stream("t")
    follow.land(stream, path, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).count()


def test_second_writer_is_told(spark, log, monkeypatch):
    """Another append falls between a writer's look at the log and its commit, at the last moment."""
    other = TopicLog(spark, log.root)
    log.append(keyed(spark, 4))
    publish = log._publish

    def late(*args):
        other.append(keyed(spark, 1))
        publish(*args)

    monkeypatch.setattr(log, "_publish", late)
    with pytest.raises(ConcurrentAppend):
        log.append(keyed(spark, 2))
    offsets = [r.offset for r in log.scan("t").collect()]
    assert sorted(offsets) == list(range(5))


def test_partition_count_is_the_topics(spark, log):
    log.append(keyed(spark, 50), partitions=4, arrival=["timestamp"])
    log.append(keyed(spark, 50), arrival=["timestamp"])
    with pytest.raises(Exception, match="another number of partitions"):
        log.append(keyed(spark, 5), partitions=6)
    by_key = log.scan("t").groupBy("key").agg(F.countDistinct("partition").alias("n")).collect()
    assert all(r.n == 1 for r in by_key)
    assert {r.topic: r.partitions for r in log.topics().collect()} == {"t": 4}
    found = log.key_scan("t", "user-3")
    assert found.count() == reads.key_filter(log.scan("t"), "user-3").count() == 14
    assert "PartitionFilters: [isnotnull(partition" in found._jdf.queryExecution().executedPlan().toString()
    log.append(keyed(spark, 10).withColumn("partition", F.lit(9)))
    assert log.key_scan("t", "user-3").count() == reads.key_filter(log.scan("t"), "user-3").count() == 15


@pytest.mark.parametrize("topic", ["my topic@!", "", ".."])
def test_names_are_checked(spark, log, topic):
    with pytest.raises(Exception, match="topic name is"):
        log.append(keyed(spark, 2, topic))
    assert log.scan().isEmpty()


def test_compaction(spark, log):
    for topic, n in (("a", 3), ("b", 4), ("a", 5)):
        log.append(keyed(spark, n, topic), partitions=2, arrival=["timestamp"])
    before = sorted(log.scan().drop("headers").collect())
    log.compact()
    assert sorted(log.scan().drop("headers").collect()) == before and log.manifest().select("txn").distinct().count() == 1
    log.append(keyed(spark, 2, "a"), arrival=["timestamp"])
    log.compact()
    assert log.scan("a").count() == 10 and log.scan("b").count() == 4
    assert log.end_offsets().agg(F.sum("end_offset")).first()[0] == 14


def test_staged_tables_are_dropped(spark, log):
    import os

    from tidelog.session import shared_dir

    folder = f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}"
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    log.append(keyed(spark, 30), partitions=3)
    log.compact()
    new = set(os.listdir(folder)) - before
    assert not [n for n in new if n.startswith(("sliced-", "slices-", "arrived-", "ends-", "topics-"))]


def test_reads_reach_the_scan(spark, log):
    log.append(keyed(spark, 60), partitions=3, arrival=["timestamp"])
    df = reads.key_filter(reads.read_from_offsets(log.scan("t"), {0: 5, 1: reads.END, 2: 0}), "user-1")
    plan = df.select("offset")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(key,user-1)" in plan and "Exchange" not in plan
    chosen = reads.partition_select(log.scan("t"), [0, 1], [1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [partition" in chosen or "PartitionFilters: [isnotnull(partition" in chosen


def test_seek(spark, log):
    log.append(keyed(spark, 10).withColumn("partition", F.lit(0)), arrival=["timestamp"])
    records = log.scan("t")
    assert sorted(r.offset for r in reads.read_from_offsets(records, {0: 5}).collect()) == [5, 6, 7, 8, 9]
    assert reads.read_from_offsets(records, {0: reads.END}).isEmpty()
    assert reads.read_from_offsets(records, {}).count() == 10
    table = spark.createDataFrame([(0, 8), (1, 0)], "partition int, start_offset bigint")
    assert reads.read_from_offsets(records, table).count() == 2
    with pytest.raises(ValueError):
        reads.start_positions(log.end_offsets(), "middle")
    assert reads.latest_messages(records, 3).count() == 3
    assert [r.offset for r in reads.inspect_messages(records, 0, 2, 4).collect()] == [4, 5]
    assert reads.inspect_messages(records, 9, 5).isEmpty()


def test_polls_read_in_part(spark, log):
    log.append(keyed(spark, 900), partitions=3, arrival=["timestamp"])
    records = log.scan("t")
    part = records.first().partition
    for n in (35, 500, 2000):
        assert reads.poll(log, "t", n).drop("headers").collect() == reads.poll_limit(records, n).drop("headers").collect()
    starts = {part: 100, (part + 1) % 3: reads.END}
    seek = reads.poll_limit(reads.read_from_offsets(records, starts), 50)
    assert reads.poll(log, "t", 50, starts).drop("headers").collect() == seek.drop("headers").collect() and seek.count() == 50
    assert reads.inspect(log, "t", part, 4, 3).collect() == reads.inspect_messages(records, part, 4, 3).collect()
    assert reads.inspect(log, "t", part, 4).count() == 4 and reads.poll(log, "none", 5).isEmpty() and reads.inspect(log, "t", 99, 5).isEmpty()


def test_logs_that_begin_above_zero(spark, log):
    first = spark.createDataFrame([("t", 0, 5000)], "topic string, partition int, first_offset bigint")
    log.append(keyed(spark, 20), first_offsets=first, arrival=["timestamp"])
    assert [r.offset for r in reads.inspect(log, "t", 0, 5).collect()] == list(range(5000, 5005))
    assert [r.offset for r in reads.poll(log, "t", 3).collect()] == [5000, 5001, 5002]
    assert [r.offset for r in reads.poll(log, "t", 3, {0: 5018}).collect()] == [5018, 5019]


def test_oversize_counts_bytes_and_nulls(spark):
    df = spark.createDataFrame([("k", "é" * 4), (None, None), ("", "x" * 9)], "key string, value string")
    got = [(r.size, r.accepted) for r in writes.reject_oversize(df, 9).collect()]
    assert got == [(9, True), (0, True), (9, True)]
    assert not writes.reject_oversize(df, 8).first().accepted


def test_escape_is_how_the_writer_spells_it():
    assert escape("events/exp-a") == "events%2Fexp-a" and escape("plain.name_1") == "plain.name_1"


def test_latest_reads_the_last_appends(spark, log):
    for start in range(0, 100, 10):
        log.append(spark.range(start, start + 10).select(
            F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.col("id").cast("string").alias("value"), (F.col("id") - F.col("id") % 3).alias("timestamp"),
        ), partitions=2, arrival=["timestamp", "key"])
    want = [tuple(r)[:5] for r in reads.latest_messages(log.scan("t"), 7).collect()]
    found = reads.latest(log, "t", 7)
    assert [tuple(r)[:5] for r in found.collect()] == want and len(want) == 7
    assert len({f.split("txn=")[1].split("/")[0] for f in found.inputFiles()}) <= 2
    assert reads.latest(log, "t", 1000).count() == 100 and reads.latest(log, "none", 3).collect() == []


def test_starts_in_a_table_bound_the_scan(spark, log):
    log.append(spark.range(40).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.lit("v").alias("value")), partitions=2)
    starts = spark.createDataFrame([(0, 5), (1, 7)], "partition int, start_offset bigint")
    found = reads.read_from_offsets(log.scan("t"), starts)
    assert "GreaterThanOrEqual(offset,5)" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.partition, r.offset) for r in found.collect()) == sorted((r.partition, r.offset) for r in log.scan("t").collect() if r.offset >= (5, 7)[r.partition])


def numbered(spark, ids, sent=0):
    rows = [(None if i is None else str(i), i, sent, n) for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, "value string, id bigint, attempt int, n int").withColumns(
        {"topic": F.lit("t"), "key": F.col("value"), "timestamp": F.col("n").cast("bigint")})


def index_of(log):
    return writes.IdIndex(log, ["id"], lambda r: r.select("txn", F.col("value").cast("bigint").alias("id")), 4)


def test_ids_are_kept_in_buckets(spark, log):
    values = lambda: sorted((r.value or "") for r in log.scan("t").collect())
    index = index_of(log)
    index.append(numbered(spark, [1, 2, 2, 3]), ["n"])
    index.append(numbered(spark, [3, 4, 1]), ["n"])
    assert values() == ["1", "2", "3", "4"]
    log.append(numbered(spark, [9]).select("topic", "key", "value", "timestamp"))  # by a writer that knows of no table
    index_of(log).append(numbered(spark, [9, 10]), ["n"])
    assert values() == ["1", "10", "2", "3", "4", "9"]
    assert index.catch_up() == log.version() and index.catch_up() == 4
    index_of(log).append(numbered(spark, [10, 1]), ["n"])  # nothing is new: no append
    assert log.version() == 4


def test_stored_ids_are_not_shuffled(spark, log):
    index = index_of(log)
    index.append(numbered(spark, range(50)), ["n"])
    index.catch_up()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.fresh(numbered(spark, [1, 99]), ["n"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    stored = plan[plan.index("SortMergeJoin"):].split("\n")
    at = next(i for i, line in enumerate(stored) if "tidelog_ids" in line)
    above = [line for line in stored[:at] if "Exchange" in line]
    assert "Bucketed: true" in stored[at] or "SelectedBucketsCount: 4 out of 4" in stored[at]
    assert not any("Exchange" in line for line in stored[at - 3:at]), above


def test_a_writer_in_between_fails_the_append(spark, log):
    index = index_of(log)
    version = index.catch_up()
    log.append(numbered(spark, [5]).select("topic", "key", "value", "timestamp"))
    with pytest.raises(ConcurrentAppend):
        log.append(index.fresh(numbered(spark, [5]), ["n"]), arrival=["n"], at_version=version)


def test_ids_after_a_table_without_its_note(spark, log):
    index = index_of(log)
    index.append(numbered(spark, [1, 2]), ["n"])
    index.catch_up()
    spark.sql(f"DROP TABLE {index.name}")  # another session's catalog; the files stay
    again = index_of(log)
    again.append(numbered(spark, [2, 3, None]), ["n"])
    assert sorted((r.value or "") for r in log.scan("t").collect()) == ["", "1", "2", "3"]
