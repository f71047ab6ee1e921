"""Streams with offsets per partition: starts, bounds, restarts."""

import pytest
from pyspark.sql import functions as F

from tidelog.session import new_path
from tidelog.streaming import source
from tidelog.streaming.source import Entries, Folder, Range, TopicReader, drain, open_stream

SCHEMA = "topic string, partition int, offset long, timestamp long, value string, batch int"


def rows(spark, start, n, topic="t"):
    return spark.range(start, start + n).select(
        F.lit(topic).alias("topic"), F.col("id").cast("string").alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("timestamp"),
        F.create_map(F.lit("h"), F.encode(F.col("id").cast("string"), "utf-8")).alias("headers"),
    )


def landed(spark, path):
    return spark.read.parquet(path)


def offsets(df):
    return sorted((r.partition, r.offset) for r in df.select("partition", "offset").collect())


def test_records_equal_the_scan(spark, log):
    log.append(rows(spark, 0, 40), partitions=3, arrival=["timestamp"])
    log.append(rows(spark, 40, 25), arrival=["timestamp"])
    log.append(rows(spark, 0, 5, "other"), partitions=2)
    path = new_path(spark, "landed")
    drain(open_stream(spark, log, "t"), path, new_path(spark, "cp"))
    got, want = landed(spark, path), log.scan("t")
    shown = [*want.columns[:-1], F.map_entries("headers").alias("headers")]
    assert got.select(*shown).exceptAll(want.select(*shown)).isEmpty() and got.count() == want.count() == 65


def test_starts(spark, log):
    log.append(rows(spark, 0, 40), partitions=3, arrival=["timestamp"])
    ends = {r.partition: r.end_offset for r in log.end_offsets().collect()}
    path, checkpoint = new_path(spark, "landed"), new_path(spark, "cp")
    stream = lambda: open_stream(spark, log, "t", {0: 4, 2: -1})
    drain(stream(), path, checkpoint)
    assert offsets(landed(spark, path)) == [(0, o) for o in range(4, ends[0])] + [(1, o) for o in range(ends[1])]
    log.append(rows(spark, 40, 30), arrival=["timestamp"])
    later = {r.partition: r.end_offset for r in log.end_offsets().collect()}
    drain(stream(), path, checkpoint)
    want = [(0, o) for o in range(4, later[0])] + [(1, o) for o in range(later[1])] + [(2, o) for o in range(ends[2], later[2])]
    assert offsets(landed(spark, path)) == want

    path, checkpoint = new_path(spark, "landed"), new_path(spark, "cp")
    drain(open_stream(spark, log, "t", "latest"), path, checkpoint)
    log.append(rows(spark, 70, 10), arrival=["timestamp"])
    drain(open_stream(spark, log, "t", "latest"), path, checkpoint)
    assert offsets(landed(spark, path)) == [(p, o) for p, o in offsets(log.scan("t")) if o >= later[p]]


def test_start_at_a_time_whatever_the_order(spark, log):
    log.append(rows(spark, 0, 30), partitions=2, arrival=["timestamp"])
    log.append(rows(spark, 10, 5), arrival=["timestamp"])  # late ones
    log.append(rows(spark, 30, 20), arrival=["timestamp"])
    path = new_path(spark, "landed")
    drain(open_stream(spark, log, "t", since=28), path, new_path(spark, "cp"))
    all_rows = log.scan("t").select("partition", "offset", "timestamp").collect()
    first = {p: min((r.offset for r in all_rows if r.partition == p and r.timestamp >= 28)) for p in (0, 1)}
    assert offsets(landed(spark, path)) == sorted((r.partition, r.offset) for r in all_rows if r.offset >= first[r.partition])
    path = new_path(spark, "landed")
    drain(open_stream(spark, log, "t", since=10**6), path, new_path(spark, "cp"))
    assert landed(spark, path).isEmpty()


def test_bounded_batches_and_restarts(spark, log, monkeypatch):
    monkeypatch.setattr(source, "RECORDS", 3)
    log.append(rows(spark, 0, 50), partitions=2, arrival=["timestamp"])
    path, checkpoint = new_path(spark, "landed"), new_path(spark, "cp")
    stream = lambda: open_stream(spark, log, "t", most=10)
    drain(stream(), path, checkpoint, batches=2)  # stops in the middle of both partitions
    assert sorted({o for _, o in offsets(landed(spark, path))}) == list(range(10))
    drain(stream(), path, checkpoint)
    got = landed(spark, path).collect()
    assert sorted((r.partition, r.offset) for r in got) == offsets(log.scan("t"))
    assert all(r.batch == r.offset // 5 for r in got)


def test_failed_batch_is_read_again(spark, log):
    log.append(rows(spark, 0, 30), partitions=2, arrival=["timestamp"])
    path, checkpoint = new_path(spark, "landed"), new_path(spark, "cp")
    drain(open_stream(spark, log, "t", most=10), path, checkpoint, batches=1)

    def breaks(batch, number):
        raise RuntimeError("lost")

    with pytest.raises(Exception):
        open_stream(spark, log, "t", most=10).writeStream.foreachBatch(breaks).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    log.append(rows(spark, 30, 10), arrival=["timestamp"])
    drain(open_stream(spark, log, "t", most=10), path, checkpoint)
    got = landed(spark, path)
    assert offsets(got) == offsets(log.scan("t"))


def test_only_committed_and_moved_or_not(spark, log, tmp_path):
    log.append(rows(spark, 0, 10), partitions=1, arrival=["timestamp"])
    reader = TopicReader({"root": log.root, "topic": "t"})
    assert reader.initialOffset() == {"0": 0} and reader.latestOffset() == {"0": 10}
    plan = reader.partitions({"0": 3}, {"0": 10})
    assert [(r.partition, r.first, r.end) for r in plan] == [(0, 3, 10)]
    assert [o for batch in reader.read(plan[0]) for o in batch.column("offset").to_pylist()] == list(range(3, 10))
    txn = plan[0].txn
    fs = Folder(log.root).fs
    fs.create_dir(f"{log.root}/pending")
    fs.move(f"{log.root}/data/txn={txn}", f"{log.root}/pending/txn={txn}")
    assert sum(b.num_rows for b in reader.read(Range(txn, 0, 0, 10))) == 10
    assert Entries(Folder(log.root), "unknown").refresh().ends() == {}


def test_bound_below_the_partitions(spark, log):
    log.append(rows(spark, 0, 30), partitions=3, arrival=["timestamp"])
    reader = TopicReader({"root": log.root, "topic": "t", "maxrecordsperbatch": "2"})
    at = reader.initialOffset()
    for _ in range(30):
        end = reader.latestOffset()
        assert 0 <= sum(end.values()) - sum(at.values()) <= 2
        reader.partitions(at, end)
        at = end
    assert sum(at.values()) == 30
    for bad in ({"maxrecordsperbatch": "0"}, {"startingoffsets": "earliest", "startingtimestamp": "5"}):
        with pytest.raises(ValueError):
            TopicReader({"root": log.root, "topic": "t", **bad})


def test_only_what_is_asked_for_is_read_and_little_at_once(spark, log):
    log.append(rows(spark, 0, 30_000), partitions=1, arrival=["timestamp"])
    path = new_path(spark, "landed")
    drain(open_stream(spark, log, "t", columns=["offset", "topic"]), path, new_path(spark, "cp"))
    got = landed(spark, path)
    assert got.columns[:2] == ["offset", "topic"] and "value" not in got.columns
    assert (got.count(), got.agg(F.sum("offset")).first()[0], got.where("topic = 't'").count()) == (30_000, sum(range(30_000)), 30_000)
    reader = TopicReader({"root": log.root, "topic": "t"})
    sizes = [b.num_rows for r in reader.partitions({"0": 0}, {"0": 30_000}) for b in reader.read(r)]
    assert sum(sizes) == 30_000 and max(sizes) <= 8_192
