"""What topics, partitions and groups there are, and how far each group has read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import store


def list_topics(described: DataFrame) -> DataFrame:
    """Topics with the number of partitions that hold records, and of records.

    described: as describe_topic or, from the manifest alone, TopicLog.describe() gives it.
    """
    return described.groupBy("topic").agg(F.count("*").alias("partitions"), F.sum("records").alias("records"))


def describe_topic(records: DataFrame) -> DataFrame:
    """Per partition: offset range, record count and time range."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("begin_offset"),
        (F.max("offset") + 1).alias("end_offset"),
        F.count("*").alias("records"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )


def partition_positions(consumed: DataFrame, partitions: DataFrame) -> DataFrame:
    """Next offset to read per partition: the highest consumed plus one, 0 where nothing was."""
    reached = consumed.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("reached"))
    return partitions.join(reached, ["topic", "partition"], "left").select(
        "topic", "partition", F.coalesce("reached", F.lit(0)).alias("position")
    )


def commit_offsets(path: str, group_id: str | None, positions: DataFrame, committed_at=None) -> None:
    """Store a group's positions (topic, partition, position). Without a group nothing is stored."""
    if group_id is None:
        return
    when = F.unix_millis(F.current_timestamp()) if committed_at is None else committed_at
    positions.select(
        F.lit(group_id).alias("group_id"), "topic", "partition",
        F.col("position").alias("offset"), when.alias("committed_at"),
    ).coalesce(1).write.mode("append").parquet(path)


def current_commits(commits: DataFrame) -> DataFrame:
    """The latest commit per group, topic and partition; of commits at one time, the highest offset.

    Two hash aggregates and a join with the small table between them: the highest (time, offset) pair
    in one aggregate would have every task sort its rows first.
    """
    keys = ["group_id", "topic", "partition"]
    newest = store(commits.groupBy(*keys).agg(F.max("committed_at").alias("committed_at")), "newest")
    return commits.join(newest, [*keys, "committed_at"]).groupBy(*keys, "committed_at").agg(
        F.max("offset").alias("offset")
    ).select(*keys, "offset", "committed_at")


def list_consumer_groups(commits: DataFrame) -> DataFrame:
    return commits.select("group_id").distinct()


def partition_lag(commits: DataFrame, ends: DataFrame) -> DataFrame:
    """group_id, topic, partition, current_offset, end_offset and lag, never below 0.

    Partitions a group has no commit for are not listed; ends: (topic, partition, end_offset).
    """
    current = current_commits(commits).withColumnRenamed("offset", "current_offset")
    end = F.coalesce("end_offset", F.lit(0))
    return current.join(ends, ["topic", "partition"], "left").select(
        "group_id", "topic", "partition", "current_offset", end.alias("end_offset"),
        F.greatest(end - F.col("current_offset"), F.lit(0)).alias("lag"),
    )


def consumer_group_lag(commits: DataFrame, ends: DataFrame, group_id: str | None = None) -> DataFrame:
    """Per group its total lag and an array with the lag of each partition."""
    if group_id is not None:
        commits = commits.where(F.col("group_id") == group_id)
    lag = F.struct("topic", "partition", "current_offset", "end_offset", "lag")
    return partition_lag(commits, ends).groupBy("group_id").agg(
        F.sum("lag").alias("total_lag"), F.array_sort(F.collect_list(lag)).alias("partitions")
    )


def consumer_group_topic_lag(commits: DataFrame, ends: DataFrame, group_id: str, topic: str) -> DataFrame:
    """The same for one group and topic; both filters come before the join."""
    return consumer_group_lag(
        commits.where(F.col("topic") == topic), ends.where(F.col("topic") == topic), group_id
    )
