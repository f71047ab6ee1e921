"""Logs and tables that the registered queries read, derived by Spark from the given tables.

Each is built once per application and data folder, over the whole tables, and kept in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import configure, new_path
from tidelog.sources.topic_log import TopicLog

PARTITIONS = 4
CODEC = "zstd"  # of the logs, which many queries write before they read

_built: dict[tuple[str, str, str], object] = {}


def once(build: Callable) -> Callable:
    """Keep what build(spark, sf_dir) returns for the life of the application."""

    @wraps(build)
    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir, build.__qualname__)
        if key not in _built:
            _built[key] = build(spark, sf_dir)
        return _built[key]

    return get


def forget(keep: tuple[str, ...] = ()) -> None:
    """Have all but the named inputs built anew when they are next asked for."""
    for key in [k for k in _built if k[2] not in keep]:
        del _built[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(column: str) -> F.Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic `events`: key is the user, value the event as JSON, headers its type and a trace parent."""
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct("event_id", "event_type", "value")).alias("value"),
        millis("ts").alias("timestamp"),
        F.create_map(
            F.lit("event_type"), F.col("event_type").cast("binary"),
            F.lit("props"), F.col("props").cast("binary"),
            F.lit("traceparent"),
            F.concat(
                F.lit("00-"), F.md5(F.concat(F.lit("trace-"), F.col("event_id"))), F.lit("-"),
                F.substring(F.md5(F.concat(F.lit("span-"), F.col("event_id"))), 1, 16), F.lit("-01"),
            ).cast("binary"),
        ).alias("headers"),
        "ts",
        "event_id",
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic `orders`: key is the customer, value the order as JSON."""
    return table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("topic"),
        F.col("o_custkey").cast("string").alias("key"),
        F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_totalprice")).alias("value"),
        millis("o_orderdate").alias("timestamp"),
        "o_orderdate",
        "o_orderkey",
    )


@once
def event_log(spark: SparkSession, sf_dir: str) -> TopicLog:
    configure(spark)
    log = TopicLog(spark, new_path(spark, "events"))
    log.append(event_records(spark, sf_dir), PARTITIONS, ["ts", "event_id"], compression=CODEC)
    return log


@once
def full_log(spark: SparkSession, sf_dir: str) -> TopicLog:
    """Topics `events` and `orders` in one log."""
    configure(spark)
    log = TopicLog(spark, new_path(spark, "topics"))
    log.append(event_records(spark, sf_dir), PARTITIONS, ["ts", "event_id"], compression=CODEC)
    log.append(order_records(spark, sf_dir), PARTITIONS, ["o_orderdate", "o_orderkey"], compression=CODEC)
    return log
