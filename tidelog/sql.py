"""SQL over topics: SELECT ... FROM topic('events')."""

from __future__ import annotations

import threading
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidelog.session import configure
from tidelog.sources.topic_log import TopicLog

DEFAULT_TIMEOUT_MS = 30_000
DEFAULT_MAX_ROWS = 10_000

_registered: dict[str, tuple[TopicLog, int]] = {}


class QueryTimeout(RuntimeError):
    pass


@dataclass
class QueryResult:
    columns: list[tuple[str, str]]
    rows: list[list]
    execution_time_ms: int
    rows_scanned: int | None
    rows_returned: int
    truncated: bool


@dataclass
class QueryRequest:
    sql: str
    timeout_ms: int = DEFAULT_TIMEOUT_MS
    max_rows: int = DEFAULT_MAX_ROWS
    parameters: dict = field(default_factory=dict)


def register_topics(log: TopicLog, function: str = "topic") -> SparkSession:
    """Make topic('name') a table of the topic's records.

    The function is inlined by the optimizer: conditions on topic, partition and offset reach the scan.
    It sees what had been appended when it was registered; run() registers it again if more has been appended since.
    """
    spark = configure(log.spark)
    _registered[function] = (log, log.version())
    log.scan().createOrReplaceTempView(f"{function}_records")
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {function}(topic_name STRING)
        RETURNS TABLE(topic STRING, `partition` INT, `offset` BIGINT, `timestamp` BIGINT, `key` STRING,
                      value {log.schema['value'].dataType.simpleString()}, headers MAP<STRING, BINARY>)
        RETURN SELECT topic, `partition`, `offset`, `timestamp`, `key`, value, headers
               FROM {function}_records WHERE topic = topic_name
        """
    )
    return spark


def refresh_topics(spark: SparkSession) -> None:
    """Let the registered functions see what has been appended since."""
    for function, (log, version) in list(_registered.items()):
        if log.spark is spark and log.version() != version:
            register_topics(log, function)


def limited(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """One row more than max_rows, to tell whether there are more."""
    return df.limit(max_rows + 1)


def run(spark: SparkSession, request: QueryRequest) -> QueryResult:
    """Run SQL text; at most max_rows rows come to the driver, and no later than timeout_ms."""
    refresh_topics(spark)
    tag = f"query-{uuid.uuid4().hex}"
    late = threading.Event()
    sc = spark.sparkContext

    def stop() -> None:
        late.set()
        sc.cancelJobsWithTag(tag)

    begun = time.monotonic()
    timer = threading.Timer(request.timeout_ms / 1000, stop)
    timer.daemon = True
    sc.addJobTag(tag)
    timer.start()
    try:
        df = spark.sql(request.sql, args=request.parameters or None)
        asked = limited(df, request.max_rows)
        rows = asked.collect()
    except Exception as error:
        if late.is_set():
            raise QueryTimeout(f"not done after {request.timeout_ms} ms") from error
        raise
    finally:
        timer.cancel()
        sc.removeJobTag(tag)
    kept = [list(row) for row in rows[: request.max_rows]]
    return QueryResult(
        columns=[(f.name, f.dataType.simpleString().upper()) for f in df.schema],
        rows=kept,
        execution_time_ms=int((time.monotonic() - begun) * 1000),
        rows_scanned=rows_scanned(asked),
        rows_returned=len(kept),
        truncated=len(rows) > request.max_rows,
    )


def rows_scanned(df: DataFrame) -> int:
    """Rows the file scans of an executed DataFrame gave out, by the metrics of its plan."""

    def total(node) -> int:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return total(node.executedPlan())
        if name.endswith("QueryStage"):
            return total(node.plan())
        children = node.children()
        if name.startswith("Scan") and children.isEmpty():
            metric = node.metrics().get("numOutputRows")
            return metric.get().value() if metric.isDefined() else 0
        return sum(total(children.apply(i)) for i in range(children.size()))

    return total(df._jdf.queryExecution().executedPlan())


def explain(spark: SparkSession, sql: str) -> str:
    return spark.sql(f"EXPLAIN FORMATTED {sql}").first()[0]
