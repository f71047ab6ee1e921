"""Positions of topic-partitions as state: they never move back, and a partition that falls silent is told."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

STATE = StructType([StructField("position", LongType()), StructField("records", LongType()), StructField("last_ms", LongType())])
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOLD = "topic string, partition int, position bigint, records bigint, last_ms bigint, event string"


class Positions(StatefulProcessor):
    """Per topic and partition: the end of what was seen, how many records were new, and the latest time among them.

    Only three numbers are kept, so a re-sent record is one below the position. Records must come in order of their offsets
    from batch to batch, as open_stream gives them. A timer of event time is set idle_ms after the latest record; when the
    watermark passes it without a further one, the partition is told as idle, once until it goes on.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("position", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        position, records, last = self.state.get() if self.state.exists() else (0, 0, None)
        before = position
        for batch in rows:  # in no order of offsets: what is new is what was at or beyond the position before
            new = batch[batch["offset"] >= before]
            if len(new):
                position = max(position, int(new["offset"].max()) + 1)
                records += int(new["offset"].nunique())
                seen = int(new["timestamp"].max())
                last = seen if last is None else max(last, seen)
        if position == before:
            return
        self.state.update((position, records, last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last + self.idle_ms)
        yield self.row(key, position, records, last, "moved")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self.row(key, *self.state.get(), "idle")

    @staticmethod
    def row(key, position: int, records: int, last: int, event: str) -> pd.DataFrame:
        return pd.DataFrame({"topic": [key[0]], "partition": [key[1]], "position": [position], "records": [records], "last_ms": [last], "event": [event]})

    def close(self) -> None:
        pass


def positions(records: DataFrame, lateness: str, idle_ms: int) -> DataFrame:
    """A stream of (topic, partition, offset, timestamp in ms) as one of moved and idle positions (see Positions), to be run
    in update mode. Records that come later than `lateness` are left out; a later one of the partition moves past them."""
    records.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)  # the only store that has timers
    timed = records.select("topic", "partition", "offset", "timestamp", F.timestamp_millis("timestamp").alias("_at")).withWatermark("_at", lateness)
    return timed.groupBy("topic", "partition").transformWithStateInPandas(
        statefulProcessor=Positions(idle_ms), outputStructType=TOLD, outputMode="Update", timeMode="EventTime"
    )
