"""SQL over topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import sql as tsql
from tidelog.operators.halo import NUMBER, lag, lead, numbered, over_range, over_rows, with_rank
from tidelog.operators.intervals import range_join
from tidelog.operators.ordered import asof_join
from tidelog.plans.inputs import full_log
from tidelog.plans.reads import MID_JANUARY, events
from tidelog.plans.registry import ELOG, OLOG, query
from tidelog.session import store

MONTH_BEGIN, HOUR_MS = 1704067200000, 3_600_000  # 2024-01-01T00:00:00Z


def topics(spark: SparkSession, sf_dir: str) -> SparkSession:
    return tsql.register_topics(full_log(spark, sf_dir))


def over_topics(sql: str) -> str:
    """The same text for DuckDB: topic('x') and its JSON values become the tables they are derived from."""
    return f"WITH {ELOG}, {OLOG} {sql}"


@query("topic_tvf", over_topics("""
SELECT topic, "partition", "offset", "timestamp", "key", payload AS "value" FROM elog WHERE "partition" = 1 AND "offset" > 10
"""))
def topic_tvf(spark, sf_dir):
    return topics(spark, sf_dir).sql(
        "SELECT topic, `partition`, `offset`, `timestamp`, `key`, value FROM topic('events') WHERE `partition` = 1 AND `offset` > 10"
    )


def as_table(spark: SparkSession, result: tsql.QueryResult) -> DataFrame:
    schema = ", ".join(f"`{name}` {kind}" for name, kind in result.columns)
    return spark.createDataFrame(result.rows, schema).withColumn("truncated", F.lit(result.truncated))


@query("sql_query", over_topics("""
SELECT "partition", "offset", "key", payload AS "value", TRUE AS truncated FROM elog ORDER BY "offset" DESC, "partition" LIMIT 3
"""))
def sql_query(spark, sf_dir):
    """A request with its own time limit and number of rows."""
    request = tsql.QueryRequest(
        "SELECT `partition`, `offset`, `key`, value FROM topic('events') ORDER BY `offset` DESC, `partition`",
        timeout_ms=600_000, max_rows=3,
    )
    return as_table(spark, tsql.run(topics(spark, sf_dir), request))


@query("query_max_rows", over_topics("""
SELECT "key", n, (SELECT count(DISTINCT "key") FROM elog) > 50 AS truncated
FROM (SELECT "key", count(*) AS n FROM elog GROUP BY "key" ORDER BY n DESC, "key" LIMIT 50)
"""))
def query_max_rows(spark, sf_dir):
    request = tsql.QueryRequest(
        "SELECT `key`, count(*) AS n FROM topic('events') GROUP BY `key` ORDER BY n DESC, `key`", timeout_ms=600_000, max_rows=50
    )
    return as_table(spark, tsql.run(topics(spark, sf_dir), request))


@query("sql_project_filter", over_topics("""
SELECT "key" || '@' || "partition" AS place, "offset" * 2 AS twice, event_id, round(amount * 1.1, 4) AS gross
FROM elog WHERE event_type IN ('purchase', 'signup') AND amount > 20 AND "offset" BETWEEN 5 AND 1000000
"""))
def sql_project_filter(spark, sf_dir):
    return topics(spark, sf_dir).sql("""
        SELECT `key` || '@' || `partition` AS place, `offset` * 2 AS twice, v.event_id, round(v.value * 1.1, 4) AS gross
        FROM (SELECT *, from_json(value, 'event_id BIGINT, event_type STRING, value DOUBLE') AS v FROM topic('events'))
        WHERE v.event_type IN ('purchase', 'signup') AND v.value > 20 AND `offset` BETWEEN 5 AND 1000000
    """)


# Both sides are summed up by key before they are joined: a busy key gives one row, not pairs.
JOINS = """
{e}, {o},
inner_j AS (SELECT 'inner' AS kind, e.k, e.n, o.m FROM e JOIN o ON e.k = o.k),
left_j AS (SELECT 'left' AS kind, e.k, e.n, o.m FROM e LEFT JOIN o ON e.k = o.k),
full_j AS (SELECT 'full' AS kind, coalesce(e.k, o.k) AS k, e.n, o.m FROM e FULL JOIN o ON e.k = o.k),
theta_j AS (SELECT 'theta' AS kind, e.k, e.n, o.m FROM e JOIN o ON e.k = o.k AND e.n > 5 * o.m)
SELECT * FROM inner_j UNION ALL SELECT * FROM left_j UNION ALL SELECT * FROM full_j UNION ALL SELECT * FROM theta_j
UNION ALL SELECT 'semi', k, n, NULL FROM e {semi}
UNION ALL SELECT 'anti', k, n, NULL FROM e {anti}
"""


@query("sql_joins", over_topics("," + JOINS.format(
    e='e AS (SELECT "key" AS k, count(*) AS n FROM elog GROUP BY "key")',
    o='o AS (SELECT "key" AS k, count(*) AS m FROM olog GROUP BY "key")',
    semi="WHERE k IN (SELECT k FROM o)", anti="WHERE k NOT IN (SELECT k FROM o)",
)))
def sql_joins(spark, sf_dir):
    return topics(spark, sf_dir).sql("WITH " + JOINS.format(
        e="e AS (SELECT `key` AS k, count(*) AS n FROM topic('events') GROUP BY `key`)",
        o="o AS (SELECT `key` AS k, count(*) AS m FROM topic('orders') GROUP BY `key`)",
        semi="LEFT SEMI JOIN o USING (k)", anti="LEFT ANTI JOIN o USING (k)",
    ))


@query("sql_joins_asof", over_topics("""
SELECT e."partition", e."offset", e.event_id, p.event_id AS purchase_id, p."timestamp" AS purchased_at
FROM elog e ASOF LEFT JOIN (SELECT "key", "timestamp", max(event_id) AS event_id FROM elog WHERE event_type = 'purchase' GROUP BY ALL) p
  ON e."key" = p."key" AND e."timestamp" >= p."timestamp"
"""))
def sql_joins_asof(spark, sf_dir):
    """Each event with its user's latest purchase up to then; SQL has no such join, so it is an operator."""
    parsed = F.from_json("value", "event_id bigint, event_type string")
    rows = events(spark, sf_dir).withColumn("v", parsed).select("key", "partition", "offset", "timestamp", "v.event_id", "v.event_type")
    bought = rows.where("event_type = 'purchase'").groupBy("key", "timestamp").agg(F.max("event_id").alias("purchase_id"))
    bought = bought.withColumn("purchased_at", F.col("timestamp"))
    joined = asof_join(rows, bought, ["key"], "timestamp", "timestamp", ["purchase_id", "purchased_at"], tie=["offset"])
    return joined.select("partition", "offset", "event_id", "purchase_id", "purchased_at")


# Every other event is moved to one moment; the windows of orders lie in the month of the events and overlap.
MOVED = f"CASE WHEN event_id % 2 = 0 THEN {MID_JANUARY} ELSE {{t}} END"
OPENS = f"{MONTH_BEGIN} + o_orderkey * 7 % 43200 * 60000"
CLOSES = f"{OPENS} + CAST({{k}} AS BIGINT) % 7 * 60000"


@query("sql_joins_range", over_topics(f"""
SELECT event_id, moment, o_orderkey, opens, closes
FROM (SELECT event_id, {MOVED.format(t='"timestamp"')} AS moment FROM elog) e
JOIN (SELECT o_orderkey, {OPENS} AS opens, {CLOSES.format(k='"key"')} AS closes FROM olog) o ON e.moment BETWEEN o.opens AND o.closes
"""))
def sql_joins_range(spark, sf_dir):
    """Events that fall into windows of orders, without an equal key; one moment has half the events."""
    log = full_log(spark, sf_dir)
    told = log.scan("events").select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), "timestamp")
    points = told.select("event_id", F.expr(MOVED.format(t="`timestamp`")).alias("moment"))
    bought = log.scan("orders").select("key", F.get_json_object("value", "$.o_orderkey").cast("long").alias("o_orderkey"))
    windows = bought.select("o_orderkey", F.expr(OPENS).alias("opens"), F.expr(CLOSES.format(k="`key`")).alias("closes"))
    return range_join(points, windows, "moment", "opens", "closes")


AGGREGATES = """
SELECT {part} AS part, {kind} AS kind, grouping({part}) + 2 * grouping({kind}) AS level, count(*) AS n, count(DISTINCT {k}) AS users,
       {close} AS approx_close, min({at}) AS first_at, max({at}) AS last_at
FROM {source} GROUP BY CUBE ({part}, {kind})
"""


# The same for Spark, a user at a time: each cell of the cube has a user once, so counting them is exact, and a sketch is kept
# for each cell. Beside count(DISTINCT) Spark would keep one for each cell and user.
AGGREGATES_BY_USER = """
WITH seen AS (SELECT {part} AS part, {kind} AS kind, {k} AS k, count(*) AS n, min({at}) AS first_at, max({at}) AS last_at
              FROM {source} GROUP BY {part}, {kind}, {k}),
cells AS (SELECT part, kind, grouping(part) + 2 * grouping(kind) AS level, k, sum(n) AS n, min(first_at) AS first_at, max(last_at) AS last_at
          FROM seen GROUP BY k, CUBE (part, kind))
SELECT part, kind, level, sum(n) AS n, count(k) AS users, abs(approx_count_distinct(k, 0.01) - count(k)) <= 0.1 * count(k) AS approx_close,
       min(first_at) AS first_at, max(last_at) AS last_at
FROM cells GROUP BY part, kind, level
"""


@query("sql_aggregates", over_topics(
    "SELECT part, kind, CAST(level AS BIGINT) AS level, n, users, approx_close, first_at, last_at FROM (" + AGGREGATES.format(
        part='"partition"', kind="event_type", k='"key"', at='"timestamp"', close="TRUE", source="elog") + ")"))
def sql_aggregates(spark, sf_dir):
    text = AGGREGATES_BY_USER.format(
        part="`partition`", kind="event_type", k="`key`", at="`timestamp`",
        source="(SELECT *, get_json_object(value, '$.event_type') AS event_type FROM topic('events'))",
    )
    return topics(spark, sf_dir).sql(f"SELECT part, kind, CAST(level AS BIGINT) AS level, n, users, approx_close, first_at, last_at FROM ({text})")


# Frames over the records of a user, as SQL takes them; operators.ordered has the forms that split a user.
WINDOWS = """
SELECT {p} AS part, {o} AS off, row_number() OVER (PARTITION BY {b} ORDER BY {o}) AS place,
       rank() OVER (PARTITION BY {b} ORDER BY {v}) AS value_rank,
       lag({t}) OVER (PARTITION BY {b} ORDER BY {o}) AS earlier, lead({t}) OVER (PARTITION BY {b} ORDER BY {o}) AS later,
       count(*) OVER (PARTITION BY {b} ORDER BY {o} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS frame_rows,
       max({v}) OVER (PARTITION BY {b} ORDER BY {o} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS recent_high,
       count(*) OVER (PARTITION BY {b} ORDER BY {t} RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW) AS last_hour
FROM {source}
"""


@query("sql_windows", over_topics(
    "SELECT part, off, CAST(place AS INTEGER) AS place, CAST(value_rank AS INTEGER) AS value_rank, earlier, later, frame_rows, recent_high, last_hour FROM ("
    + WINDOWS.format(b='"key"', p='"partition"', o='"offset"', t='"timestamp"', v="amount", source="elog") + ")"))
def sql_windows(spark, sf_dir):
    return topics(spark, sf_dir).sql(WINDOWS.format(
        b="`key`", p="`partition`", o="`offset`", t="`timestamp`", v="amount",
        source="(SELECT *, CAST(get_json_object(value, '$.value') AS DOUBLE) AS amount FROM topic('events'))",
    ))


BUSY = "CASE WHEN CAST({id} AS BIGINT) % 2 = 0 THEN 'busy' ELSE {k} END"


@query("sql_windows_busy", over_topics(
    "SELECT part, off, who, CAST(place AS BIGINT) AS place, CAST(value_rank AS BIGINT) AS value_rank, earlier, later, frame_rows, recent_high, last_hour FROM ("
    + WINDOWS.format(b="who", p='"partition"', o="event_id", t='"timestamp"', v="amount", source=f"""(SELECT *, {BUSY.format(id="event_id", k='"key"')} AS who FROM elog)""")
    .replace("event_id AS off", '"offset" AS off, who') + ")"))
def sql_windows_busy(spark, sf_dir):
    """The windows of sql_windows, where one user has half the events: no task takes all events of a user."""
    parsed = F.from_json("value", "event_id bigint, value double")
    rows = events(spark, sf_dir).withColumn("v", parsed).select(
        F.col("partition").alias("part"), F.col("offset").alias("off"), "timestamp", F.col("v.event_id").alias("event_id"), F.col("v.value").alias("amount"),
        F.expr(BUSY.format(id="get_json_object(value, '$.event_id')", k="`key`")).alias("who"),
    )
    keys = ["who"]
    told = over_rows(numbered(rows, keys, ["event_id"]), keys, {
        "earlier": lag(F.col("timestamp")), "later": lead(F.col("timestamp")), "frame_rows": (F.count("*"), -2, 0), "recent_high": (F.max("amount"), -4, -1),
    })
    told = with_rank(over_range(store(told, "framed"), keys, "timestamp", {"last_hour": (F.lit(1), -HOUR_MS, 0)}), keys, "amount", "value_rank")
    return told.select("part", "off", "who", (F.col(NUMBER) + 1).alias("place"), "value_rank", "earlier", "later", "frame_rows", "recent_high", "last_hour")


@query("sql_sort_limit", over_topics("""
SELECT "partition", "offset", "key" FROM elog ORDER BY "offset" DESC, "partition" LIMIT 5 OFFSET 2
"""))
def sql_sort_limit(spark, sf_dir):
    return topics(spark, sf_dir).sql(
        "SELECT `partition`, `offset`, `key` FROM topic('events') ORDER BY `offset` DESC, `partition` LIMIT 5 OFFSET 2"
    )


SET_OPS = """
SELECT 'union' AS op, k FROM (SELECT {k} AS k FROM {e} UNION SELECT {k} FROM {o})
UNION ALL SELECT 'intersect', k FROM (SELECT {k} AS k FROM {e} INTERSECT SELECT {k} FROM {o})
UNION ALL SELECT 'except', k FROM (SELECT {k} AS k FROM {o} EXCEPT SELECT {k} FROM {e})
UNION ALL SELECT 'union all', k FROM (SELECT {k} AS k FROM {e} UNION ALL SELECT {k} FROM {o})
"""


@query("sql_set_ops", over_topics(SET_OPS.format(k='"key"', e="elog", o="olog")))
def sql_set_ops(spark, sf_dir):
    return topics(spark, sf_dir).sql(SET_OPS.format(k="`key`", e="topic('events')", o="topic('orders')"))


@query("sql_scalar_functions", over_topics("""
SELECT "partition", "offset", upper(event_type) AS loud, substr(event_type, 2, 3) AS middle, length(payload) AS chars,
       strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d %H') AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
       CAST(floor(sqrt(amount)) AS BIGINT) AS root, abs("offset" - 100) AS distance, len(string_split(props, '"')) AS pieces,
       json_extract_string(props, '$.k') AS k, CASE WHEN amount > 50 THEN 'high' ELSE 'low' END AS band
FROM elog
"""))
def sql_scalar_functions(spark, sf_dir):
    return topics(spark, sf_dir).sql("""
        SELECT `partition`, `offset`, upper(v.event_type) AS loud, substr(v.event_type, 2, 3) AS middle, CAST(length(value) AS BIGINT) AS chars,
               date_format(timestamp_millis(`timestamp`), 'yyyy-MM-dd HH') AS hour, dayofweek(timestamp_millis(`timestamp`)) AS weekday,
               CAST(floor(sqrt(v.value)) AS BIGINT) AS root, abs(`offset` - 100) AS distance,
               CAST(size(split(CAST(headers['props'] AS STRING), '"')) AS BIGINT) AS pieces,
               get_json_object(CAST(headers['props'] AS STRING), '$.k') AS k, if(v.value > 50, 'high', 'low') AS band
        FROM (SELECT *, from_json(value, 'event_id BIGINT, event_type STRING, value DOUBLE') AS v FROM topic('events'))
    """)


SUBQUERIES = """
SELECT r.part, r.off, r.k, (SELECT count(*) FROM {o} x WHERE x.{k} = r.k) AS orders, t.n AS spread
FROM (SELECT {p} AS part, {f} AS off, {k} AS k FROM {e}) r
JOIN steps t ON t.n = r.part
WHERE r.off >= (SELECT avg({f}) FROM {e}) AND EXISTS (SELECT 1 FROM {o} y WHERE y.{k} = r.k)
"""


@query("sql_subqueries", "WITH RECURSIVE steps(n) AS (SELECT 0 UNION ALL SELECT n + 1 FROM steps WHERE n < 3), "
       + f"{ELOG}, {OLOG} " + SUBQUERIES.format(e="elog", o="olog", k='"key"', p='"partition"', f='"offset"'))
def sql_subqueries(spark, sf_dir):
    return topics(spark, sf_dir).sql(
        "WITH RECURSIVE steps(n) AS (SELECT 0 UNION ALL SELECT n + 1 FROM steps WHERE n < 3) "
        + SUBQUERIES.format(e="topic('events')", o="topic('orders')", k="`key`", p="`partition`", f="`offset`")
    )
