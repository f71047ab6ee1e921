"""Following a topic: counting, landing, and resuming where a group left off."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.sources.topic_log import COMMIT, TopicLog


def kafka_topic(spark, servers: str, topic: str, reset: str = "earliest", max_per_poll: int | None = None) -> DataFrame:
    """The same record columns from a Kafka topic, where the connector is installed."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", reset).option("includeHeaders", "true")
    )
    if max_per_poll:
        reader = reader.option("maxOffsetsPerTrigger", max_per_poll)
    headers = F.map_from_entries(F.transform("headers", lambda h: F.struct(h["key"], h["value"])))
    return reader.load().select(
        "topic", "partition", "offset", F.unix_millis("timestamp").alias("timestamp"),
        F.col("key").cast("string").alias("key"), "value", headers.alias("headers"),
    )


def land(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write a stream's records to a table, each once, until all that is there has been read."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def tail_counts(stream: DataFrame) -> DataFrame:
    """Running number of records and the position per topic and partition."""
    return stream.groupBy("topic", "partition").agg(
        F.count("*").alias("records"), (F.max("offset") + 1).alias("position")
    )


def upsert_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what changed in each micro-batch under its number; a batch run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_rows(batches: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The current value per key from what upsert_batches wrote."""
    newest = F.max(F.struct("batch", *values)).alias("_row")
    return batches.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{v}").alias(v) for v in values])


def resume(
    stream: DataFrame,
    group_id: str,
    process: Callable[[DataFrame], DataFrame],
    sink: str,
    commits: str,
    checkpoint: str,
) -> StreamingQuery:
    """Poll, process, commit: the sink is written first, then the group's positions.

    Both go to a folder named by the micro-batch, so a batch that is run again after a failure
    replaces what it had written, and a restart goes on from the checkpoint. The position is the end
    of a batch, so the stream must be source.open_stream's, whose batches have no gaps: files of
    one append may come in any order, and a position would pass over records still to be read.
    """

    def step(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")
        positions = batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))
        positions.select(
            F.lit(group_id).alias("group_id"), "topic", "partition", "offset",
            F.unix_millis(F.current_timestamp()).alias("committed_at"),
        ).coalesce(1).write.mode("overwrite").parquet(f"{commits}/batch={number}")

    return (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def follow_committed(
    log: TopicLog, topic: str, handle: Callable[[DataFrame, int], None], checkpoint: str, appends_per_batch: int = 100
) -> StreamingQuery:
    """Follow whole appends, in the order of their commits: a batch holds all records of at most appends_per_batch appends."""

    def step(batch: DataFrame, number: int) -> None:
        appends = [r.txn for r in batch.where(F.col("folder") == "data").collect()]  # appends_per_batch at most
        held = [r.txn for r in log.entries().where(F.col("txn").isin(*appends) & (F.col("topic") == topic)).select("txn").distinct().collect()]
        if held:
            handle(log.read_appends(held, topic).drop("txn"), number)

    commits = log.spark.readStream.schema(COMMIT).option("maxFilesPerTrigger", str(appends_per_batch)).json(f"{log.root}/commits")
    return commits.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
