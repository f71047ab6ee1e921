"""Branches of the events topic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import branches as b
from tidelog.plans.inputs import PARTITIONS, event_log, event_records, once
from tidelog.plans.reads import events
from tidelog.plans.registry import ELOG, query
from tidelog.session import new_path, store
from tidelog.sources.topic_log import TopicLog

CREATED = 1706745600000  # 2024-02-01T00:00:00Z

REQUEST = "topic string, name string, parent_id string, fork_offset bigint, base_offsets map<int,bigint>, metadata map<string,string>"


@dataclass
class Forks:
    branches: DataFrame
    log: TopicLog
    receipts: DataFrame

    def own(self) -> DataFrame:
        return self.log.scan()


@once
def forks(spark: SparkSession, sf_dir: str) -> Forks:
    """exp-a forks early and gets the purchases; exp-b forks at the end and gets the errors; child forks
    from exp-a's end and gets the signups; deep forks from child at offset 150 and has nothing of its own."""
    topic, log = event_log(spark, sf_dir), TopicLog(spark, new_path(spark, "branches"))

    def ends() -> DataFrame:
        return topic.end_offsets().unionByName(log.end_offsets())

    def ask(*rows) -> DataFrame:
        return spark.createDataFrame(list(rows), REQUEST)

    def add(known: DataFrame | None, *rows) -> DataFrame:
        new = b.branch_create(ask(*rows), ends(), CREATED, known)
        return store(new if known is None else known.unionByName(new), "branches")

    def append(known: DataFrame, branch_id: str, kind: str) -> DataFrame:
        rows = event_records(spark, sf_dir).where(F.col("headers")["event_type"].cast("string") == kind)
        return b.branch_append(log, known, branch_id, rows, partitions=PARTITIONS, arrival=["ts", "event_id"])

    known = add(
        None,
        ("events", "exp-a", None, None, {0: 100, 1: 200, 2: 50, 3: 10}, {"why": "replay"}),
        ("events", "exp-b", None, None, None, None),
    )
    receipts = append(known, "events/exp-a", "purchase").unionByName(append(known, "events/exp-b", "error"))
    known = add(known, ("events", "child", "events/exp-a", None, None, None))
    receipts = receipts.unionByName(append(known, "events/child", "signup"))
    known = add(known, ("events", "deep", "events/child", 150, None, None))
    return Forks(known, log, receipts)


BRANCHED = f"""
WITH {ELOG},
ends AS (SELECT "partition", max("offset") + 1 AS e FROM elog GROUP BY "partition"),
kinds AS (SELECT "partition", count(*) FILTER (event_type = 'purchase') AS purchases, count(*) FILTER (event_type = 'error') AS errors,
                 count(*) FILTER (event_type = 'signup') AS signups FROM elog GROUP BY "partition"),
f AS (SELECT "partition", least(e, CASE "partition" WHEN 0 THEN 100 WHEN 1 THEN 200 WHEN 2 THEN 50 ELSE 10 END) AS fa, e AS fb,
             least(e, CASE "partition" WHEN 0 THEN 100 WHEN 1 THEN 200 WHEN 2 THEN 50 ELSE 10 END) + purchases AS fc,
             least(150, least(e, CASE "partition" WHEN 0 THEN 100 WHEN 1 THEN 200 WHEN 2 THEN 50 ELSE 10 END) + purchases + signups) AS fd
      FROM ends JOIN kinds USING ("partition")),
own AS (
  SELECT 'events/exp-a' AS branch_id, "partition", fa + n AS "offset", "timestamp", "key" FROM f JOIN (
    SELECT "partition", row_number() OVER (PARTITION BY "partition" ORDER BY ts, event_id) - 1 AS n, "timestamp", "key" FROM elog WHERE event_type = 'purchase') USING ("partition")
  UNION ALL SELECT 'events/exp-b', "partition", fb + n, "timestamp", "key" FROM f JOIN (
    SELECT "partition", row_number() OVER (PARTITION BY "partition" ORDER BY ts, event_id) - 1 AS n, "timestamp", "key" FROM elog WHERE event_type = 'error') USING ("partition")
  UNION ALL SELECT 'events/child', "partition", fc + n, "timestamp", "key" FROM f JOIN (
    SELECT "partition", row_number() OVER (PARTITION BY "partition" ORDER BY ts, event_id) - 1 AS n, "timestamp", "key" FROM elog WHERE event_type = 'signup') USING ("partition")),
br AS (
  SELECT 'events/exp-a' AS branch_id, 'exp-a' AS name, NULL AS parent_id, "partition", fa AS fork_offset FROM f
  UNION ALL SELECT 'events/exp-b', 'exp-b', NULL, "partition", fb FROM f
  UNION ALL SELECT 'events/child', 'child', 'events/exp-a', "partition", fc FROM f
  UNION ALL SELECT 'events/deep', 'deep', 'events/child', "partition", fd FROM f),
line AS (
  SELECT branch_id, branch_id AS source, 0 AS depth, "partition", NULL AS upto FROM br
  UNION ALL SELECT 'events/exp-a', 'events', 1, "partition", fa FROM f
  UNION ALL SELECT 'events/exp-b', 'events', 1, "partition", fb FROM f
  UNION ALL SELECT 'events/child', 'events/exp-a', 1, "partition", fc FROM f
  UNION ALL SELECT 'events/child', 'events', 2, "partition", least(fa, fc) FROM f
  UNION ALL SELECT 'events/deep', 'events/child', 1, "partition", fd FROM f
  UNION ALL SELECT 'events/deep', 'events/exp-a', 2, "partition", least(fd, fc) FROM f
  UNION ALL SELECT 'events/deep', 'events', 3, "partition", least(fd, fc, fa) FROM f),
everything AS (SELECT topic AS source, "partition", "offset", "timestamp", "key" FROM elog UNION ALL SELECT * FROM own),
seen AS (
  SELECT line.branch_id, r."partition", r."offset", r."timestamp", r."key"
  FROM everything r JOIN line ON r.source = line.source AND r."partition" = line."partition"
  WHERE line.upto IS NULL OR r."offset" < line.upto)"""


@query("branch_create", f"""{BRANCHED}
SELECT branch_id, name, parent_id, "partition", fork_offset, 'active' AS state, CAST({CREATED} AS BIGINT) AS created_at_ms FROM br
""")
def branch_create(spark, sf_dir):
    return forks(spark, sf_dir).branches.select("branch_id", "name", "parent_id", "partition", "fork_offset", "state", "created_at_ms")


LISTED = f"""{BRANCHED}
SELECT branch_id, name, parent_id, coalesce(n, 0) AS message_count
FROM (SELECT DISTINCT branch_id, name, parent_id FROM br) LEFT JOIN (SELECT branch_id, count(*) AS n FROM own GROUP BY branch_id) USING (branch_id)"""


@query("branch_list", LISTED)
def branch_list(spark, sf_dir):
    made = forks(spark, sf_dir)
    return b.branch_list(made.branches, made.own(), "events").select("branch_id", "name", "parent_id", "message_count")


@query("branch_get", f"{LISTED} WHERE branch_id = 'events/exp-a'")
def branch_get(spark, sf_dir):
    made = forks(spark, sf_dir)
    return b.branch_get(made.branches, made.own(), "events/exp-a").select("branch_id", "name", "parent_id", "message_count")


@query("branch_append", f"""{BRANCHED} SELECT branch_id, "partition", "offset", "timestamp" FROM own""")
def branch_append(spark, sf_dir):
    return forks(spark, sf_dir).receipts.withColumnRenamed("topic", "branch_id")


@query("branch_lineage", f"""{BRANCHED} SELECT branch_id, source, CAST(depth AS INTEGER) AS depth, "partition", CAST(upto AS BIGINT) AS upto FROM line""")
def branch_lineage(spark, sf_dir):
    return b.branch_lineage(forks(spark, sf_dir).branches)


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = forks(spark, sf_dir)
    return b.branch_read(made.branches, events(spark, sf_dir), made.own())


@query("branch_read", f"""{BRANCHED} SELECT * FROM seen""")
def branch_read(spark, sf_dir):
    return view(spark, sf_dir).select("branch_id", "partition", "offset", "timestamp", "key")


@query("branch_messages", f"""{BRANCHED} SELECT * FROM seen WHERE branch_id = 'events/exp-a' ORDER BY "partition", "offset" LIMIT 200""")
def branch_messages(spark, sf_dir):
    made = forks(spark, sf_dir)
    one = b.branch_scan(event_log(spark, sf_dir), made.log, made.branches, "events/exp-a")
    rows = b.branch_messages(one, "events/exp-a", 200)
    return rows.select("branch_id", "partition", "offset", "timestamp", "key")


@query("branch_discard", f"""{BRANCHED}
SELECT DISTINCT branch_id, CASE WHEN branch_id = 'events/exp-b' THEN 'discarded' ELSE 'active' END AS state,
       CASE WHEN branch_id = 'events/exp-b' THEN 0 ELSE n END AS visible
FROM br JOIN (SELECT branch_id, count(*) AS n FROM seen GROUP BY branch_id) USING (branch_id)
""")
def branch_discard(spark, sf_dir):
    """exp-b is discarded; exp-a is too, but made active again."""
    made = forks(spark, sf_dir)
    changes = spark.createDataFrame(
        [("events/exp-b", b.DISCARDED, 1), ("events/exp-a", b.DISCARDED, 1), ("events/exp-a", b.ACTIVE, 2)],
        "branch_id string, state string, changed_at bigint",
    )
    now = b.branch_discard(made.branches, changes)
    visible = b.branch_read(now, events(spark, sf_dir), made.own()).groupBy("branch_id").agg(F.count("*").alias("n"))
    states = now.select("branch_id", "state").distinct()
    return states.join(visible, "branch_id", "left").select("branch_id", "state", F.coalesce("n", F.lit(0)).alias("visible"))
