"""Spans of produced and processed records, matched as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["trace_id", "topic", "partition", "offset"]


def match_spans(produced: DataFrame, processed: DataFrame, within: str, lateness: str) -> DataFrame:
    """Two streams of spans (operators.tracing.spans) as one of matches: a processing span with the span that produced its
    record, `within` that time before it; `matched`, or `lost` (produced only) or `orphan` (processed only).

    A match is told at once. What has none is told when the watermark, the latest time of the stream that is further
    behind less `lateness`, says that none can come, and only then, so state holds no more than about `within` and
    `lateness` of both streams. Spans that come later than `lateness` are left out. A span without a time or a key matches
    nothing, and is told like the others if it has a time.
    """

    def side(spans: DataFrame, name: str, at: str) -> DataFrame:
        named = [F.col(c).alias(f"_{at}_{c}") for c in KEYS]
        timed = spans.select(*named, F.col("name").alias(name), F.col("at_ms").alias(at), F.timestamp_millis("at_ms").alias(f"_{at}"))
        return timed.withWatermark(f"_{at}", lateness)

    left, right = side(produced, "produce_span", "produced_at"), side(processed, "process_span", "processed_at")
    equal = [F.col(f"_produced_at_{c}") == F.col(f"_processed_at_{c}") for c in KEYS]
    inside = (F.col("_processed_at") >= F.col("_produced_at")) & (F.col("_processed_at") <= F.col("_produced_at") + F.expr(f"INTERVAL {within}"))
    both = left.join(right, [*equal, inside], "full_outer")
    state = F.when(F.col("processed_at").isNull(), "lost").when(F.col("produced_at").isNull(), "orphan").otherwise("matched")
    return both.select(
        *[F.coalesce(f"_produced_at_{c}", f"_processed_at_{c}").alias(c) for c in KEYS], "produce_span", "process_span",
        "produced_at", "processed_at", (F.col("processed_at") - F.col("produced_at")).alias("latency_ms"), state.alias("state"),
    )
