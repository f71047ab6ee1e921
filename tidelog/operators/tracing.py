"""Spans of produced and processed records, joined by their trace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.traces import trace_extract

KINDS = {"produce": "PRODUCER", "process": "CONSUMER", "consume": "CONSUMER"}


def spans(records: DataFrame, operation: str, at: str = "timestamp") -> DataFrame:
    """One span per record with a trace context: "{topic} {operation}" with partition and offset."""
    found = records.withColumns(trace_extract(F.col("headers"))).where(F.col("trace_id").isNotNull())
    return found.select(
        "trace_id", "span_id",
        F.concat_ws(" ", "topic", F.lit(operation)).alias("name"), F.lit(KINDS[operation]).alias("kind"),
        "topic", "partition", "offset", F.col(at).alias("at_ms"),
    )


def trace_join(produced: DataFrame, processed: DataFrame) -> DataFrame:
    """Each processing span with the span that produced its record, and the time between the two.

    Both sides are equal in trace id and record, so a busy trace does not pair every span with every other.
    """
    left = produced.select("trace_id", "topic", "partition", "offset", F.col("name").alias("produce_span"), F.col("at_ms").alias("produced_at"))
    right = processed.select("trace_id", "topic", "partition", "offset", F.col("name").alias("process_span"), F.col("at_ms").alias("processed_at"))
    return left.join(right, ["trace_id", "topic", "partition", "offset"]).withColumn(
        "latency_ms", F.col("processed_at") - F.col("produced_at")
    )
