"""Names, headers, traces, contracts, metrics, lag."""

import json

import pytest
from pyspark.sql import functions as F

from tidelog.functions import headers as h
from tidelog.functions.names import topic_name_check
from tidelog.functions.traces import trace_extract, trace_inject
from tidelog.operators import catalog, contracts, metrics
from tidelog.operators.memory import validate_memories


def test_topic_names(spark):
    cases = {
        "my-topic": None, "my.topic": None, "my_topic": None, "MyTopic123": None, "a": None, ".hidden-topic": None, "..prefix": None,
        "x" * 249: None, "": "empty", "x" * 250: "too long", "é" * 125: "too long", ".": "reserved", "..": "reserved",
        "my topic": "invalid character", "my/topic": "invalid character", "topic@name": "invalid character", "naïve": "invalid character",
    }
    df = spark.createDataFrame([(n,) for n in cases], "name string")
    got = {r.name: (r.reason, r.valid) for r in df.withColumns(topic_name_check(F.col("name"))).collect()}
    assert got == {n: (why, why is None) for n, why in cases.items()}
    bad = spark.createDataFrame([("naïve @",)], "name string").withColumns(topic_name_check(F.col("name"))).first()
    assert bad.bad_char == "ï"


def test_headers(spark):
    df = spark.createDataFrame([({"a": bytearray(b"1"), "b": bytearray(b"\x00\xff\xab\xcd"), "": bytearray(b"")},), ({},), (None,)], "headers map<string,binary>")
    head = F.col("headers")
    got = df.select(
        h.header_get_str(head, "a").alias("a"), h.header_get(head, "b").alias("b"), h.header_get_str(head, "b").alias("b_text"),
        h.header_get_str(head, "").alias("blank"), h.header_count(head).alias("n"), h.headers_empty(head).alias("empty"),
        h.header_get_str(h.header_add(head, "a", F.lit("2")), "a").alias("over"),
    ).collect()
    assert got[0].a == "1" and got[0].b == b"\x00\xff\xab\xcd" and got[0].b_text is None and got[0].blank == ""
    assert [r.n for r in got] == [3, 0, 0] and [r.empty for r in got] == [False, True, True]
    assert [r.over for r in got] == ["2", "2", "2"]
    assert h.header_explode(df).count() == 3


def test_traces(spark):
    good = "00-" + "a" * 32 + "-" + "b" * 16 + "-01"
    values = [good, "00-" + "0" * 32 + "-" + "b" * 16 + "-01", "nonsense", None]
    df = spark.createDataFrame([({"traceparent": bytearray(v.encode())} if v else {},) for v in values], "headers map<string,binary>")
    got = df.withColumns(trace_extract(F.col("headers"))).collect()
    assert [r.trace_id for r in got] == ["a" * 32, None, None, None] and got[0].trace_flags == "01"
    again = trace_extract(trace_inject(F.col("headers"), F.lit("c" * 32), F.lit("d" * 16)))
    assert {r.trace_id for r in df.withColumns(again).collect()} == {"c" * 32}


CONTRACT = {
    "type": "object", "required": ["id", "who"],
    "properties": {
        "id": {"type": "integer"}, "tags": {"type": "array"}, "on": {"type": "boolean"},
        "who": {"type": "object", "required": ["name"], "properties": {"name": {"type": "string"}, "age": {"type": "number"}}},
    },
}


def check(spark, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, value {kind}")
    rows = contracts.contract_validate(df, json.dumps(CONTRACT)).orderBy("i").collect()
    return [[(e.field_path, e.expected, e.actual) for e in r.errors] for r in rows]


def test_contract(spark):
    got = check(spark, [
        '{"id":1,"who":{"name":"x","age":2.5},"tags":[],"on":true}', '{"id":"1","who":{"name":"x","age":3}}',
        '{"id":1.5,"who":{}}', '{"id":null,"tags":{},"who":{"name":"x"}}', "[1]", "not json", None, "",
    ])
    assert got[0] == []
    assert got[1] == [("id", "integer", "string")]
    assert got[2] == [("id", "integer", "number"), ("who.name", "string", "missing")]
    assert got[3] == [("id", "integer", "null"), ("tags", "array", "object")]
    assert got[4] == [("$", "object", "array")]
    assert got[5] == [("$", "object", "invalid")] and got[6] == [("$", "object", "missing")] and got[7] == [("$", "object", "invalid")]


def test_contract_bytes(spark):
    assert check(spark, [bytearray(b'{"id":1,"who":{"name":"x"}}'), bytearray(b"\xff\xfe")], "binary") == [[], [("$", "utf-8", "bytes")]]


def test_contract_types_are_known():
    with pytest.raises(ValueError):
        contracts.contract_fields({"properties": {"a": {"type": "money"}}})


RULES = {
    "type": "object", "additionalProperties": False, "required": ["n"],
    "properties": {
        "n": {"type": "integer", "minimum": 1, "exclusiveMaximum": 18446744073709551617}, "a.b": {"type": "string", "maxLength": 3, "pattern": "^x"},
        "c": {"enum": ["red", 5, None]}, "it's": {"type": "object", "properties": {"k": {"type": "number", "maximum": 2.5}}},
    },
}


@pytest.mark.parametrize("value,paths", [
    ('{"n":18446744073709551615,"a.b":"xy","c":5,"it\'s":{"k":2.5}}', []), ('{"n":0}', ["n"]), ('{"n":1.5}', ["n"]),
    ('{"n":1,"a.b":"xyzz"}', ["a.b"]), ('{"n":1,"a.b":"y"}', ["a.b"]), ('{"n":1,"a":{"b":1}}', ["a"]), ('{"n":1,"c":"blue"}', ["c"]),
    ('{"n":1,"c":null}', []), ('{"n":1,"it\'s":{"k":3}}', ["it's.k"]), ('{"more":1}', ["more", "n"]),
])
def test_contract_keywords(spark, value, paths):
    row = contracts.contract_validate(spark.createDataFrame([(value,)], "value string"), RULES).first()
    assert sorted(e.field_path for e in row.errors) == paths and row.valid == (not paths)


def test_keywords_that_are_not_covered_are_told():
    for rule in ({"anyOf": []}, {"properties": {"a": {"format": "date"}}}, {"additionalProperties": {"type": "string"}}):
        with pytest.raises(ValueError):
            contracts.contract_fields(rule)


def test_client_metrics(spark):
    ops = [("c", "produce", 1, 64, ms) for ms in (10.0, 20.0, 30.0)] + [("c", "consume", 2, 128, 5.0), ("c", "error", 0, 0, None), ("idle", "error", 0, 0, None)]
    df = spark.createDataFrame(ops, "client string, op string, messages bigint, bytes bigint, latency_ms double")
    got = {r.client: r for r in metrics.client_metrics(df, ["client"]).collect()}
    assert (got["c"].messages_produced, got["c"].messages_consumed, got["c"].bytes_sent, got["c"].bytes_received, got["c"].errors_total) == (3, 2, 192, 128, 1)
    assert (got["c"].produce_latency_avg_ms, got["idle"].produce_latency_avg_ms, got["idle"].messages_produced) == (20.0, 0.0, 0)


@pytest.mark.parametrize("n,index", [(1, 0), (50, 49), (100, 99), (101, 99), (1000, 990)])
def test_p99_index(spark, n, index):
    df = spark.createDataFrame([("op", float(v)) for v in range(n)], "op string, ms double").repartition(3)
    row = metrics.latency_quantile(df, ["op"], "ms").first()
    assert (row.latency, row.n) == (float(index), n)


def test_quantile_of_repeated_values(spark):
    data = [("a", 5.0)] * 60 + [("a", float(i)) for i in range(40)] + [("b", 1.0)] * 7 + [("a", None)]
    df = spark.createDataFrame(data, "op string, ms double").repartition(4)
    for fraction in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {r.op: (r.latency, r.n) for r in metrics.latency_quantile(df, ["op"], "ms", fraction).collect()}
        mine = sorted(v for k, v in data if k == "a" and v is not None)
        assert got == {"a": (mine[min(int(fraction * 100), 99)], 100), "b": (1.0, 7)}


def test_throughput(spark):
    df = spark.createDataFrame([("a", 1, 0, 0), ("a", 1, 2000, 2000), ("b", 1, 5, 5)], "topic string, records bigint, first_timestamp bigint, last_timestamp bigint")
    got = {r.topic: r.messages_per_second for r in metrics.throughput(df).collect()}
    assert got == {"a": 1.0, "b": None}


def test_lag_edges(spark):
    commits = spark.createDataFrame(
        [("g", "t", 0, 3, 1), ("g", "t", 0, 5, 2), ("g", "t", 0, 4, 2), ("g", "t", 1, 99, 1), ("g", "gone", 0, 2, 1), ("h", "t", 0, 10, 1)],
        "group_id string, topic string, partition int, offset bigint, committed_at bigint",
    )
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 20), ("t", 2, 7)], "topic string, partition int, end_offset bigint")
    got = {r.group_id: r for r in catalog.consumer_group_lag(commits, ends).collect()}
    assert [(p.topic, p.partition, p.current_offset, p.end_offset, p.lag) for p in got["g"].partitions] == [
        ("gone", 0, 2, 0, 0), ("t", 0, 5, 10, 5), ("t", 1, 99, 20, 0)]
    assert got["g"].total_lag == 5 and got["h"].total_lag == 0
    assert catalog.consumer_group_lag(commits, ends, "nobody").isEmpty()
    assert catalog.consumer_group_topic_lag(commits, ends, "g", "gone").first().total_lag == 0


def test_commit_without_group_stores_nothing(spark):
    from tidelog.session import new_path

    path = new_path(spark, "commits")
    positions = spark.createDataFrame([("t", 0, 4)], "topic string, partition int, position bigint")
    catalog.commit_offsets(path, None, positions)
    catalog.commit_offsets(path, "g", positions)
    row = catalog.current_commits(spark.read.parquet(path)).collect()
    assert [(r.group_id, r.offset) for r in row] == [("g", 4)]


def test_memory_checks(spark):
    rows = [
        ("a", "fact", "x", 0.8, None), ("", "fact", "x", None, None), ("a", "fact", " \t", None, None), ("a", "procedure", "x", None, " "),
        ("a", "procedure", "x", 0.0, "s"), ("a", "observation", "x", 1.01, None), ("a", "fact", "x", float("nan"), None), (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "agent_id string, kind string, content string, salience double, skill string")
    got = [len(r.errors) for r in validate_memories(df).collect()]
    assert got == [0, 1, 1, 1, 0, 1, 1, 3]


def test_type_lists_and_items(spark):
    rule = {"type": "object", "properties": {"n": {"type": ["integer", "null"]}, "l": {"type": ["array", "null"], "items": {"type": ["number", "null"], "minimum": 2}}}}
    values = ['{"n":null,"l":null}', '{"n":"x","l":[2,null,"y",1,2.5]}', '{"l":[]}', '{"n":1,"l":3}']
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    got = {r.i: [(e.field_path, e.expected, e.actual) for e in r.errors] for r in contracts.contract_validate(rows, rule).collect()}
    assert got[0] == got[2] == []
    assert got[1] == [("n", "integer|null", "string"), ("l[2]", "number|null", "string"), ("l[3]", ">= 2", "1")]
    assert got[3] == [("l", "array|null", "integer")]
    for bad in ({"items": {"items": {}}}, {"type": ["text"]}, {"items": []}):
        with pytest.raises(ValueError):
            contracts.contract_fields({"properties": {"a": bad}})
