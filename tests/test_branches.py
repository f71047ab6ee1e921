import pytest
from pyspark.sql import functions as F

from tidelog.operators import branches as b
from tidelog.session import new_path
from tidelog.sources.topic_log import TopicLog


def rows(spark, topic, values):
    return spark.createDataFrame([(topic, "k", v, i, 0) for i, v in enumerate(values)], "topic string, key string, value string, timestamp bigint, partition int")


def request(spark, **kw):
    schema = "topic string, name string, parent_id string, fork_offset bigint"
    return spark.createDataFrame([(kw.get("topic", "t"), kw["name"], kw.get("parent_id"), kw.get("fork_offset"))], schema)


def values(view, branch_id):
    return [r.value for r in b.branch_messages(view, branch_id).collect()]


def test_branches(spark, log):
    own = TopicLog(spark, new_path(spark, "own"))
    log.append(rows(spark, "t", list("abcde")), arrival=["timestamp"])
    ends = lambda: log.end_offsets().unionByName(own.end_offsets())
    known = b.branch_create(request(spark, name="x", fork_offset=2), ends(), 1000)
    b.branch_append(own, known, "t/x", rows(spark, "t", ["X1", "X2"]), arrival=["timestamp"])
    b.branch_append(own, known, "t/x", rows(spark, "t", ["X3"]), arrival=["timestamp"])
    known = known.unionByName(b.branch_create(request(spark, name="y", parent_id="t/x"), ends(), 1000, known))
    known = known.unionByName(b.branch_create(request(spark, name="z", parent_id="t/y", fork_offset=1), ends(), 1000, known))
    known = known.unionByName(b.branch_create(request(spark, name="far", fork_offset=99), ends(), 1000, known))
    known = known.unionByName(b.branch_create(request(spark, name=" "), ends(), 1000, known))
    b.branch_append(own, known, "t/z", rows(spark, "t", ["Z1"]), arrival=["timestamp"])
    b.branch_append(own, known, "t/x", rows(spark, "t", ["X4"]), arrival=["timestamp"])
    log.append(rows(spark, "t", ["f"]), arrival=["timestamp"])

    view = b.branch_read(known, log.scan("t"), own.scan())
    assert values(view, "t/x") == ["a", "b", "X1", "X2", "X3", "X4"]
    assert values(view, "t/y") == ["a", "b", "X1", "X2", "X3"]
    assert values(view, "t/z") == ["a", "Z1"]
    assert values(view, "t/far") == list("abcde")
    assert [r.value for r in b.branch_messages(view, "t/x", 3).collect()] == ["a", "b", "X1"]
    assert [r.offset for r in b.branch_messages(view, "t/x").collect()] == list(range(6))

    listed = {r.branch_id: r for r in b.branch_list(known, own.scan(), "t").collect()}
    assert {k: v.message_count for k, v in listed.items()} == {"t/x": 4, "t/y": 0, "t/z": 1, "t/far": 0}
    assert listed["t/y"].base_offsets == {0: 5} and listed["t/far"].base_offsets == {0: 5} and listed["t/z"].parent_id == "t/y"
    assert b.branch_get(known, own.scan(), "t/none").isEmpty()

    gone = spark.createDataFrame([("t/x", "discarded", 1), ("t/y", "discarded", 1), ("t/y", "active", 2)], "branch_id string, state string, changed_at int")
    now = b.branch_discard(known, gone)
    view = b.branch_read(now, log.scan("t"), own.scan())
    assert values(view, "t/x") == [] and values(view, "t/y") == ["a", "b", "X1", "X2", "X3"]


def test_per_partition_forks(spark):
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 4)], "topic string, partition int, end_offset bigint")
    asked = spark.createDataFrame([("t", "m", {0: 3})], "topic string, name string, base_offsets map<int,bigint>")
    got = {r.partition: (r.fork_offset, r.state, r.branch_id) for r in b.branch_create(asked, ends, 1).collect()}
    assert got == {0: (3, "active", "t/m"), 1: (4, "active", "t/m")}


def test_rejected_requests(spark):
    ends = spark.createDataFrame([("t", 0, 10)], "topic string, partition int, end_offset bigint")
    known = b.branch_create(request(spark, name="old"), ends, 1)
    asked = spark.createDataFrame([("t", "old"), ("t", "new"), ("nope", "x"), ("t", "two"), ("t", "two"), ("t", " ")], "topic string, name string")
    reasons = sorted((r.topic, r.name, r.reason) for r in b.branch_check(asked, ends, known).where("reason IS NOT NULL").collect())
    assert reasons == [("nope", "x", "unknown source"), ("t", " ", "blank"), ("t", "old", "exists"), ("t", "two", "asked twice"), ("t", "two", "asked twice")]
    assert [r.branch_id for r in b.branch_create(asked, ends, 1, known).collect()] == ["t/new"]


def test_long_chains(spark):
    rows_ = [("t/0", "t", None, 0, 500)] + [(f"t/{i}", "t", f"t/{i - 1}", 0, 500 - i) for i in range(1, 150)]
    chain = spark.createDataFrame(rows_, "branch_id string, topic string, parent_id string, partition int, fork_offset bigint")
    lines = [r for r in b.branch_lineage(chain).collect() if r.branch_id == "t/149"]
    assert sorted(r.depth for r in lines) == list(range(151))
    assert {r.depth: r.upto for r in lines}[150] == 351 and next(r.source for r in lines if r.depth == 150) == "t"
    ring = spark.createDataFrame([("t/a", "t", "t/b", 0, 5), ("t/b", "t", "t/a", 0, 5)], chain.schema)
    with pytest.raises(ValueError):
        b.branch_lineage(ring)


def test_one_branch_reads_its_bounds(spark, log):
    own = TopicLog(spark, new_path(spark, "own"))
    log.append(rows(spark, "t", list("abcde")), arrival=["timestamp"])
    known = b.branch_create(request(spark, name="x", fork_offset=2), log.end_offsets(), 1000)
    b.branch_append(own, known, "t/x", rows(spark, "t", ["X1", "X2"]), arrival=["timestamp"])
    one = b.branch_scan(log, own, known, "t/x")
    assert [r.value for r in b.branch_messages(one, "t/x").collect()] == ["a", "b", "X1", "X2"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(offset,2)" in plan and "PartitionFilters: [" in plan
    assert b.branch_scan(log, own, known.withColumn("state", F.lit("discarded")), "t/x").isEmpty()
