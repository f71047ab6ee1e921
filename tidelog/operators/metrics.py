"""Client metrics, latencies, throughput and metric history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.ordered import ordered_scan, same
from tidelog.session import store

PRODUCE, CONSUME, ERROR = "produce", "consume", "error"

# The error kinds a client reports, and those worth another try (fixed values).
ERROR_KINDS = [
    "TopicNotFound", "PartitionNotFound", "ConnectionFailed", "Connection", "Timeout",
    "AuthenticationFailed", "AuthorizationFailed", "InvalidConfiguration", "Protocol", "Serialization",
    "Schema", "Server", "Internal", "Transaction", "Unsupported", "ContractViolation",
    "AttestationFailed", "MemoryAccessDenied", "BranchQuotaExceeded", "SemanticSearchUnavailable",
]
RETRYABLE = ["Connection", "ConnectionFailed", "Timeout", "Server", "SemanticSearchUnavailable"]


def client_metrics(ops: DataFrame, by: list[str]) -> DataFrame:
    """Snapshot per client. ops: op, messages, bytes, latency_ms; latencies are averaged per operation."""
    return op_counters(ops, by, F.col("messages"), latencies=True)


def op_counters(
    ops: DataFrame, by: list[str], messages: Column | None = None, latencies: bool = False
) -> DataFrame:
    """Counters per client; without a messages column each operation counts as one message."""
    op = F.col("op")
    messages = F.lit(1).cast("bigint") if messages is None else messages

    def total(kind: str, what: Column) -> Column:
        return F.coalesce(F.sum(F.when(op == kind, what)), F.lit(0))

    def average(kind: str) -> Column:
        return F.coalesce(F.avg(F.when(op == kind, F.col("latency_ms"))), F.lit(0.0))

    columns = [
        total(PRODUCE, messages).alias("messages_produced"),
        total(CONSUME, messages).alias("messages_consumed"),
        total(PRODUCE, F.col("bytes")).alias("bytes_sent"),
        total(CONSUME, F.col("bytes")).alias("bytes_received"),
        F.count_if(op == ERROR).alias("errors_total"),
    ]
    if latencies:
        columns += [
            average(PRODUCE).alias("produce_latency_avg_ms"),
            average(CONSUME).alias("consume_latency_avg_ms"),
        ]
    return ops.groupBy(*by).agg(*columns)


def classify_errors(errors: DataFrame, kind: str = "kind") -> DataFrame:
    """Errors per kind, and whether a retry may help."""
    return errors.groupBy(F.col(kind).alias("kind"), F.col(kind).isin(*RETRYABLE).alias("retryable")).agg(
        F.count("*").alias("errors")
    )


def latency_quantile(
    latencies: DataFrame, by: list[str], value: str, fraction: float = 0.99, exact: bool = True
) -> DataFrame:
    """Per group, the value at index min(floor(fraction * n), n - 1) of the sorted values.

    Equal values are counted together before anything is moved; running counts over slices of the
    sorted values then find the rank, so a group of any size is spread over the cluster. exact=False gives an estimate from one map-side aggregate instead.
    """
    latencies = latencies.where(F.col(value).isNotNull())
    if not exact:
        return latencies.groupBy(*by).agg(
            F.percentile_approx(value, fraction, 10_000).alias("latency"), F.count("*").alias("n")
        )
    counts = store(latencies.groupBy(*by, value).agg(F.count("*").alias("_n")), "counts")
    ranked = ordered_scan(counts, by, [value], sums={"_through": F.col("_n")})
    sizes = store(counts.groupBy(*by).agg(F.sum("_n").alias("n")).withColumn(
        "_at", F.least(F.floor(F.col("n") * F.lit(fraction)), F.col("n") - 1)
    ), "sizes")  # one row per group
    hit = same(ranked, sizes, by) & (ranked["_through"] > sizes["_at"]) & (ranked["_through"] - ranked["_n"] <= sizes["_at"])
    return ranked.join(sizes, hit, "inner").select(*[ranked[c] for c in by], ranked[value].alias("latency"), sizes["n"])


def throughput(described: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Messages per second between the first and the last record; null if no time has passed.

    described: records, first_timestamp and last_timestamp per topic and partition, as the manifest has them.
    """
    by = by or ["topic"]
    seconds = (F.max("last_timestamp") - F.min("first_timestamp")) / F.lit(1000.0)
    return described.groupBy(*by).agg(
        F.sum("records").alias("messages"),
        seconds.alias("seconds"),
        F.try_divide(F.sum("records").cast("double"), seconds).alias("messages_per_second"),
    )


def label_key(labels: Column) -> Column:
    """Labels in an order of their own, so that equal sets of labels are equal (maps cannot be grouped by)."""
    return F.array_sort(F.map_entries(labels))


def metrics_history(points: DataFrame, window_ms: int | None = None) -> DataFrame:
    """Metric points (name, value, labels, timestamp), summed up in windows of window_ms if it is given."""
    if window_ms is None:
        return points.select("name", "value", "labels", "timestamp")
    start = F.col("timestamp") - F.pmod("timestamp", F.lit(window_ms))
    return (
        points.groupBy(start.alias("window_start"), "name", label_key(F.col("labels")).alias("_labels"))
        .agg(
            F.count("*").alias("points"), F.sum("value").alias("total"),
            F.min("value").alias("low"), F.max("value").alias("high"),
        )
        .withColumn("labels", F.map_from_entries("_labels"))
        .drop("_labels")
    )


def failure_streaks(
    outcomes: DataFrame, service: str, order: list[str], failed: Column, threshold: int
) -> DataFrame:
    """Runs of at least `threshold` failures in a row, per service.

    Within a run, the number of earlier successes does not change, so it names the run. It comes from
    sliced running sums and the runs are aggregated map-side: no service has to fit into one task.
    """
    narrow = outcomes.select(service, *order, failed.alias("_failed"))
    success = F.when(F.col("_failed"), 0).otherwise(1).cast("bigint")
    marked = ordered_scan(narrow, [service], order, number="_place", sums={"_run": success})
    return (
        marked.where("_failed")
        .groupBy(service, "_run")
        .agg(
            F.count("*").alias("failures"), F.min("_place").alias("first_place"),
            F.min(order[0]).alias("started"), F.max(order[0]).alias("ended"),
        )
        .where(F.col("failures") >= threshold)
        .drop("_run")
    )


def failure_states(outcomes: DataFrame, service: str, order: list[str], failed: Column, threshold: int) -> DataFrame:
    """For every outcome how many failures in a row have led up to it, and OPEN from `threshold` on, else CLOSED.

    The place of the last success is carried forward by a sliced scan, so no service has to fit into one task.
    """
    numbered = ordered_scan(outcomes.select(service, *order, failed.alias("_failed")), [service], order, number="_place")
    marked = ordered_scan(numbered, [service], ["_place"], last={"_success": F.when(~F.col("_failed"), F.col("_place"))})
    streak = F.col("_place") - F.coalesce("_success", F.lit(-1))
    return marked.select(service, *order, streak.alias("streak"), F.when(streak >= threshold, "OPEN").otherwise("CLOSED").alias("state"))
