"""Positioned and bounded reads of topic records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.headers import header_count
from tidelog.session import store
from tidelog.sources.topic_log import TopicLog

EARLIEST, LATEST = "earliest", "latest"
BEGINNING, END = 0, -1
DEFAULT_MAX_POLL_RECORDS = 500


def start_positions(ends: DataFrame, reset: str = EARLIEST) -> DataFrame:
    """(topic, partition, start_offset) of a reader without a position: 0 or the end offset.

    ends: (topic, partition, end_offset), as TopicLog.end_offsets() gives it.
    """
    if reset not in (EARLIEST, LATEST):
        raise ValueError("reset must be 'earliest' or 'latest'")
    start = F.lit(BEGINNING).cast("bigint") if reset == EARLIEST else F.col("end_offset")
    return ends.select("topic", "partition", start.alias("start_offset"))


def read_from_offsets(records: DataFrame, starts: dict[int, int] | DataFrame) -> DataFrame:
    """Records from each partition's start on; partitions without a start are read from the beginning.

    A start of -1 means the end: nothing of what is there. A dict becomes a plain filter that reaches
    the scan (folders and row groups). A table of (partition, start_offset) is stored, so that the planner knows its size;
    its partitions and their lowest start reach the scan as a filter.
    """
    if isinstance(starts, dict):
        if not starts:
            return records
        partition, offset = F.col("partition"), F.col("offset")
        given = [(partition == p) & (offset >= o) for p, o in starts.items() if o != END]
        return records.where(reduce(lambda a, b: a | b, given, ~partition.isin(*starts)))
    keys = ["topic", "partition"] if "topic" in starts.columns else ["partition"]
    known = store(starts.select(*keys, "start_offset"), "starts")
    start = F.coalesce("start_offset", F.lit(BEGINNING))
    bounds = known.agg(F.min(F.when(F.col("start_offset") != END, F.col("start_offset"))).alias("low"), F.min("partition").alias("first"), F.max("partition").alias("last")).first()
    if bounds.low is not None and "topic" not in keys:
        # Partitions beyond the named ones have no start; those between them may have none either.
        named = F.col("partition").between(bounds.first, bounds.last)
        whole = known.select("partition").distinct().count() == bounds.last - bounds.first + 1
        if whole:
            # Two scans of different folders: one filter over both could not be pushed down.
            records = records.where(named & (F.col("offset") >= bounds.low)).unionByName(records.where(~named))
    joined = records.join(known, keys, "left")
    return joined.where((start != END) & (F.col("offset") >= start)).select(*records.columns)


def read_from_timestamp(records: DataFrame, epoch_ms: int) -> DataFrame:
    return records.where(F.col("timestamp") >= epoch_ms)


def partition_select(
    records: DataFrame, assigned: list[int] | None = None, paused: list[int] | None = None
) -> DataFrame:
    """Records of the assigned partitions (all, if none are named) that are not paused."""
    if assigned is not None:
        records = records.where(F.col("partition").isin(*assigned))
    if paused:
        records = records.where(~F.col("partition").isin(*paused))
    return records


def poll_limit(records: DataFrame, max_records: int = DEFAULT_MAX_POLL_RECORDS) -> DataFrame:
    """The first max_records by partition and offset."""
    return records.orderBy("partition", "offset").limit(max_records)


def poll(log: TopicLog, topic: str, max_records: int = DEFAULT_MAX_POLL_RECORDS, starts: dict[int, int] | None = None) -> DataFrame:
    """The first max_records of a topic by partition and offset, from each partition's start (or beginning) on.

    Offsets are dense, so the manifest tells which ranges hold them; the scan reads these alone.
    """
    left, ranges = max_records, []
    for row in log.describe().where(F.col("topic") == topic).orderBy("partition").collect():
        start = (starts or {}).get(row.partition, BEGINNING)
        begin = row.end_offset if start == END else max(row.begin_offset, start)
        take = max(0, min(left, row.end_offset - begin))
        if take:
            ranges.append((F.col("partition") == row.partition) & (F.col("offset") >= begin) & (F.col("offset") < begin + take))
            left -= take
    return poll_limit(log.scan(topic).where(reduce(lambda a, b: a | b, ranges, F.lit(False))), max_records)


def inspect_messages(records: DataFrame, partition: int, limit: int, offset: int | None = None) -> DataFrame:
    """Up to `limit` messages of one partition, from an offset on, with headers as text."""
    chosen = records.where(F.col("partition") == partition)
    if offset is not None:
        chosen = chosen.where(F.col("offset") >= offset)
    return _shown(chosen.orderBy("offset").limit(limit))


def inspect(log: TopicLog, topic: str, partition: int, limit: int, offset: int | None = None) -> DataFrame:
    """inspect_messages of a topic, reading only the offsets that the manifest says are asked for."""
    first = log.describe().where((F.col("topic") == topic) & (F.col("partition") == partition)).first()
    begin = max(offset or BEGINNING, first.begin_offset if first else BEGINNING)
    return inspect_messages(log.scan(topic).where(F.col("offset") < begin + limit), partition, limit, begin)


def latest_messages(records: DataFrame, count: int) -> DataFrame:
    """The most recent `count` messages."""
    newest = records.orderBy(F.desc("timestamp"), "partition", F.desc("offset")).limit(count)
    return _shown(newest)


def latest(log: TopicLog, topic: str, count: int) -> DataFrame:
    """latest_messages of a topic, reading only appends that can hold some of them.

    Entries of the manifest with `count` records between them, those of the latest first times, set a bar: the records
    asked for are not older than the oldest first time among these. What ends before the bar is not read. An entry has a
    record at least, so no more than `count` entries come to the driver.
    """
    newest = log.manifest().where((F.col("topic") == topic) & (F.col("records") > 0)).orderBy(F.desc("first_timestamp")).limit(count)
    bar, held = None, 0
    for entry in newest.select("first_timestamp", "records").collect():
        if held >= count:
            break
        bar, held = entry.first_timestamp, held + entry.records
    return latest_messages(log.scan(topic, since=bar), count)


def _shown(messages: DataFrame) -> DataFrame:
    """The first messages of an order, with headers as text.

    The filter holds nothing back. It keeps projections from being moved below the limit, where they
    could part it from the sort and have everything sorted instead of the first few kept.
    """
    headers = F.transform_values("headers", lambda _, v: F.try_validate_utf8(v.cast("string")))
    return messages.where(header_count(F.col("headers")) >= 0).select(
        "partition", "offset", "timestamp", "key", "value", headers.alias("headers")
    )


def key_filter(records: DataFrame, key: str) -> DataFrame:
    """Records with the key; TopicLog.key_scan also leaves out the partitions it cannot be in."""
    return records.where(F.col("key") == key)
