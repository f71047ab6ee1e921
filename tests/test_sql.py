import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelog import plans
from tidelog import sql as tsql


@pytest.fixture
def topics(spark, log):
    rows = spark.createDataFrame(
        [("events", f"user-{i}", f'{{"user":"user-{i}","action":"click","value":{i * 10}}}', i, i % 2) for i in range(10)],
        "topic string, key string, value string, timestamp bigint, partition int",
    )
    log.append(rows, arrival=["timestamp"])
    return tsql.register_topics(log)


def test_request_defaults():
    request = tsql.QueryRequest("SELECT * FROM topic('events')")
    assert (request.timeout_ms, request.max_rows) == (30_000, 10_000)


def test_result(topics):
    result = tsql.run(topics, tsql.QueryRequest("SELECT `key`, `offset` FROM topic('events') ORDER BY `offset` DESC, `key`", max_rows=3))
    assert result.columns == [("key", "STRING"), ("offset", "BIGINT")]
    assert result.rows == [["user-8", 4], ["user-9", 4], ["user-6", 3]]
    assert result.truncated and result.rows_returned == 3 and result.rows_scanned == 10 and result.execution_time_ms >= 0


def test_not_truncated(topics):
    for text, rows in (("SELECT 1 AS one", [[1]]), ("SELECT count(*) FROM topic('events')", [[10]]), ("SELECT * FROM topic('none')", [])):
        result = tsql.run(topics, tsql.QueryRequest(text, max_rows=1))
        assert result.rows == rows and not result.truncated


def test_later_appends_are_seen(spark, topics, log):
    count = tsql.QueryRequest("SELECT count(*) FROM topic('events')")
    more = spark.createDataFrame([("events", "k", "{}", 99, 0)], "topic string, key string, value string, timestamp bigint, partition int")
    assert tsql.run(topics, count).rows == [[10]]
    log.append(more)
    assert tsql.run(topics, count).rows == [[11]]


def test_parameters(topics):
    request = tsql.QueryRequest("SELECT `key` FROM topic('events') WHERE `offset` = :o AND `partition` = 0", parameters={"o": 2})
    assert tsql.run(topics, request).rows == [["user-4"]]


def test_bad_sql_is_not_a_timeout(topics):
    with pytest.raises(Exception) as error:
        tsql.run(topics, tsql.QueryRequest("SELEC 1"))
    assert not isinstance(error.value, tsql.QueryTimeout)


def test_timeout(topics):
    slow = "SELECT count(*) FROM range(60000000) WHERE sha2(CAST(id AS STRING), 512) LIKE 'zz%'"
    with pytest.raises(tsql.QueryTimeout):
        tsql.run(topics, tsql.QueryRequest(slow, timeout_ms=1500))


def test_explain_shows_pruning(topics):
    plan = tsql.explain(topics, "SELECT `key` FROM topic('events') WHERE `partition` = 1 AND `offset` > 2")
    assert "PartitionFilters" in plan and "GreaterThan(offset,2)" in plan


def test_aggregates_keep_one_sketch_a_cell(spark, tmp_path):
    """Users without an id, events without a type, repeated rows; no sketch beside a user's key."""
    begin = datetime(2024, 1, 1)
    draws = [(i, begin + timedelta(minutes=i), None if i % 7 == 0 else i % 11, None if i % 5 == 0 else "view" if i % 3 else "click", 1.5, "{}") for i in range(120)]
    draws += draws[:10]
    spark.createDataFrame(draws, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    orders = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
    spark.createDataFrame([(1, 1, "O", 1.0, begin)], orders).write.parquet(f"{tmp_path}/orders.parquet")
    found = plans.QUERIES["sql_aggregates"](spark, str(tmp_path))
    lines = re.findall(r"Aggregate\(keys=\[([^\]]*)\][^\n]*approx_count_distinct", found._jdf.queryExecution().executedPlan().toString())
    assert lines and not any(re.search(r"\b(k|key)#", keys) for keys in lines)
    told = tsql.register_topics(plans.inputs.full_log(spark, str(tmp_path))).sql(
        "SELECT `partition` AS part, get_json_object(value, '$.event_type') AS kind, `key` AS k, `timestamp` AS t FROM topic('events')").collect()
    cells = {}
    for r in told:
        for part, kind, level in ((r.part, r.kind, 0), (None, r.kind, 1), (r.part, None, 2), (None, None, 3)):
            cells.setdefault((part, kind, level), []).append(r)
    want = {c: (len(held), len({r.k for r in held} - {None}), True, min(r.t for r in held), max(r.t for r in held)) for c, held in cells.items()}
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found.collect()} == want and found.count() == len(want)
