"""Event-time windows over a stream of metric points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metric_windows(points: DataFrame, width: str, lateness: str) -> DataFrame:
    """Metric points (name, value, timestamp in ms) in tumbling windows; each is told once, when closed."""
    timed = points.withColumn("_at", F.timestamp_millis("timestamp")).withWatermark("_at", lateness)
    return (
        timed.groupBy(F.window("_at", width).alias("w"), "name")
        .agg(F.count("*").alias("points"), F.sum("value").alias("total"), F.max("value").alias("high"))
        .select(F.unix_millis("w.start").alias("window_start"), "name", "points", "total", "high")
    )


def dedup_stream(records: DataFrame, ids: list[str], lateness: str) -> DataFrame:
    """A stream in which records sent again within `lateness` are dropped."""
    timed = records.withColumn("_at", F.timestamp_millis("timestamp")).withWatermark("_at", lateness)
    return timed.dropDuplicatesWithinWatermark(ids).drop("_at")


def failure_windows(outcomes: DataFrame, width: str, lateness: str, threshold: int) -> DataFrame:
    """Outcomes (service, failed, timestamp in ms) per service and tumbling window, OPEN where `threshold` have failed."""
    timed = outcomes.withColumn("_at", F.timestamp_millis("timestamp")).withWatermark("_at", lateness)
    failures = F.sum(F.col("failed").cast("bigint"))
    return (
        timed.groupBy(F.window("_at", width).alias("w"), "service")
        .agg(F.count("*").alias("attempts"), failures.alias("failures"))
        .select(
            F.unix_millis("w.start").alias("window_start"), "service", "attempts", "failures",
            F.when(F.col("failures") >= threshold, "OPEN").otherwise("CLOSED").alias("state"),
        )
    )
