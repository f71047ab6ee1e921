"""The list of registered queries and the SQL their results are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register fn(spark, sf_dir) under a name, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir.rstrip("/"))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def hashed(text: str, partitions: int = 4) -> str:
    """SQL for the partition a text is routed to."""
    return f"CAST(('0x' || substr(md5({text}), 1, 8))::BIGINT % {partitions} AS INTEGER)"


# The topics `events` and `orders` as common table expressions over the given tables.
ELOG = f"""
elog AS (
  SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY ts, event_id) - 1 AS "offset"
  FROM (SELECT 'events' AS topic, {hashed('CAST(user_id AS VARCHAR)')} AS "partition",
               epoch_us(ts) // 1000 AS "timestamp", CAST(user_id AS VARCHAR) AS "key",
               CAST(to_json({{'event_id': event_id, 'event_type': event_type, 'value': value}}) AS VARCHAR) AS payload,
               ts, event_id, user_id, event_type, value AS amount, props
        FROM events))"""

OLOG = f"""
olog AS (
  SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY o_orderdate, o_orderkey) - 1 AS "offset"
  FROM (SELECT 'orders' AS topic, {hashed('CAST(o_custkey AS VARCHAR)')} AS "partition",
               epoch_us(o_orderdate) // 1000 AS "timestamp", CAST(o_custkey AS VARCHAR) AS "key",
               CAST(to_json({{'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus, 'o_totalprice': o_totalprice}}) AS VARCHAR) AS payload,
               o_orderdate, o_orderkey
        FROM orders))"""

RECORD = 'topic, "partition", "offset", "timestamp", "key", payload AS "value"'
