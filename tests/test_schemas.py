import json

import pytest
from pyspark.sql import types as T

from tidelog.operators import schemas as sc

CATALOG = "id int, subject string, version int, schema_type string, schema string"
USER = '{"type":"record","name":"User","fields":[{"name":"id","type":"int"},{"name":"name","type":"string"}]}'


def avro(*fields):
    return json.dumps({"type": "record", "name": "R", "fields": [dict(zip(("name", "type", "default"), f)) for f in fields]})


def test_types():
    text = avro(("a", "int"), ("b", ["null", "double"]), ("c", {"type": "array", "items": "long"}), ("d", {"type": "map", "values": "string"}),
                ("e", {"type": "record", "name": "X", "fields": [{"name": "f", "type": "boolean"}]}), ("g", {"type": "enum", "symbols": ["q"]}))
    assert sc.struct_of(text).simpleString() == "struct<a:int,b:double,c:array<bigint>,d:map<string,string>,e:struct<f:boolean>,g:string>"
    js = '{"type":"object","properties":{"id":{"type":"integer"},"xs":{"type":"array","items":{"type":"number"}}},"required":["id"]}'
    assert sc.struct_of(js, sc.JSON) == T.StructType([T.StructField("id", T.LongType()), T.StructField("xs", T.ArrayType(T.DoubleType()))])
    assert sc.required_fields(js, sc.JSON) == ["id"] and sc.required_fields(text) == ["a", "c", "d", "e", "g"]
    with pytest.raises(ValueError):
        sc.struct_of("message M {}", "PROTOBUF")


def test_decode(spark):
    values = ['{"id":1,"name":"x"}', '{"id":"1","name":"x"}', '{"id":1}', "{", None, '{"id":3,"name":"y","more":1}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    got = sc.decode_topic(df, USER).orderBy("i").collect()
    assert [r.decoded is not None for r in got] == [True, False, False, False, False, True]
    assert got[0].decoded.asDict() == {"id": 1, "name": "x"} and got[1].corrupt == values[1] and got[3].corrupt == "{"


def test_register(spark):
    nothing = spark.createDataFrame([], CATALOG)
    ask = lambda *rows: spark.createDataFrame(list(rows), "subject string, schema_type string, schema string, at int")
    first = sc.schema_register(ask(("s", "AVRO", "A", 1), ("s", "AVRO", "B", 2), ("s", "AVRO", "A", 3), ("t", "AVRO", "B", 4)), nothing, ["at"])
    assert sorted(first.collect()) == [(1, "s", 1, "AVRO", "A"), (2, "s", 2, "AVRO", "B"), (2, "t", 1, "AVRO", "B")]
    more = sc.schema_register(ask(("s", "AVRO", "A", 1), ("t", "AVRO", "C", 2), ("t", "AVRO", "A", 3)), first, ["at"])
    assert sorted(more.collect()) == [(1, "t", 3, "AVRO", "A"), (3, "t", 2, "AVRO", "C")]
    known = first.unionByName(more)
    assert sc.versions(known, "unknown").isEmpty()
    assert sc.versions(known, "t").first().versions == [1, 2, 3]
    assert sc.schema_by_id(known, 2).collect() == [(2, "AVRO", "B")]
    left, removed = sc.schema_delete(known, spark.createDataFrame([("t",)], "subject string"))
    assert {r.subject for r in sc.subjects(left).collect()} == {"s"} and removed.first().versions == [1, 2, 3]


@pytest.mark.parametrize("new,compatible,change", [
    (avro(("id", "int")), True, None), (avro(("id", "long")), True, "widened"), (avro(("id", "string")), False, "retyped"),
    (avro(("id", "int"), ("x", "int")), False, "added without default"), (avro(("id", "int"), ("x", "int", 0)), True, "added"),
    (avro(), True, "removed"),
])
def test_compatibility(spark, new, compatible, change):
    known = spark.createDataFrame([(1, "s", 1, "AVRO", avro(("id", "string"))), (2, "s", 2, "AVRO", avro(("id", "int")))], CATALOG)
    candidates = spark.createDataFrame([("s", new), ("unknown", new)], "subject string, schema string")
    got = {r.subject: r.is_compatible for r in sc.schema_compat_report(candidates, known).collect()}
    assert got == {"s": compatible, "unknown": True}
    assert [r.change for r in sc.schema_changes(candidates, known).collect()] == ([change] if change else [])


def report(spark, schema_type, old, new):
    known = spark.createDataFrame([(1, "s", 1, schema_type, json.dumps(old))], CATALOG)
    asked = spark.createDataFrame([("s", schema_type, json.dumps(new))], "subject string, schema_type string, schema string")
    changes = {(r.name, r.change) for r in sc.schema_changes(asked, known).collect()}
    return changes, sc.schema_compat_report(asked, known).first().is_compatible


def record(*fields):
    return {"type": "record", "name": "R", "fields": list(fields)}


def field(name, kind, **more):
    return {"name": name, "type": kind, **more}


@pytest.mark.parametrize("old,new,changes,compatible", [
    (record(), record(field("x", ["null", "int"], default=None)), {("x", "added")}, True),
    (record(field("x", "int")), record(field("x", ["null", "long"])), {("x", "widened")}, True),
    (record(field("x", ["null", "int"])), record(field("x", "int")), {("x", "retyped")}, False),
    (record(field("r", record(field("a", "int")))), record(field("r", record(field("a", "int"), field("b", "int")))), {("r.b", "added without default")}, False),
    (record(field("r", {"type": "array", "items": record(field("a", "int"))})), record(field("r", {"type": "array", "items": record(field("a", "long"))})), {("r.a", "widened")}, True),
])
def test_unions_defaults_and_nested_records(spark, old, new, changes, compatible):
    got, fits = report(spark, "AVRO", old, new)
    assert {c for c in got if c[0] != "r"} == changes and fits == compatible


def test_json_schemas(spark):
    old = {"type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "string"}, "c": {"type": "object", "properties": {"d": {"type": "integer"}}}}, "required": ["a"]}
    new = json.loads(json.dumps(old))
    assert report(spark, "JSON", old, new) == (set(), True)
    new["properties"]["a"]["type"] = "number"
    assert report(spark, "JSON", old, new) == ({("a", "widened")}, True)
    new["properties"]["c"]["properties"]["d"]["type"] = "string"
    new["required"] = ["a", "b", "e"]
    new["properties"]["e"] = {"type": "integer"}
    got, fits = report(spark, "JSON", old, new)
    assert got == {("a", "widened"), ("c.d", "retyped"), ("b", "now required"), ("e", "added without default")} and not fits
    with pytest.raises(Exception, match="not covered"):
        report(spark, "PROTOBUF", {}, {})


def test_ids_of_deleted_subjects_stay(spark):
    ask = lambda *rows: spark.createDataFrame(list(rows), "subject string, schema_type string, schema string, at int")
    known = sc.schema_register(ask(("s", "AVRO", "A", 1), ("t", "AVRO", "B", 2)), spark.createDataFrame([], CATALOG), ["at"])
    left, _ = sc.schema_delete(known, spark.createDataFrame([("t",)], "subject string"))
    more = sc.schema_register(ask(("u", "AVRO", "C", 1), ("t", "AVRO", "B", 2)), left, ["at"])
    assert sorted(more.collect()) == [(2, "t", 2, "AVRO", "B"), (3, "u", 1, "AVRO", "C")]
    assert sc.schema_by_id(left, 2).collect() == [(2, "AVRO", "B")] and sc.versions(left, "t").isEmpty()


POINT = '{"type":"record","name":"Line","namespace":"geo","fields":[{"name":"a","type":{"type":"record","name":"P","fields":[{"name":"x","type":"int"}]}},{"name":"b","type":"P"},{"name":"c","type":["null","geo.P"],"default":null}]}'


def test_named_types_are_found():
    p = "struct<x:int>"
    assert sc.struct_of(POINT).simpleString() == f"struct<a:{p},b:{p},c:{p}>"
    names = {f[0] for f in sc.avro_fields(json.loads(POINT))}
    assert names == {"a", "a.x", "b", "b.x", "c", "c.x"}
    tree = '{"type":"record","name":"T","fields":[{"name":"v","type":"int"},{"name":"next","type":["null","T"],"default":null}]}'
    with pytest.raises(ValueError, match="holds itself"):
        sc.struct_of(tree)
    assert [f[:2] for f in sc.avro_fields(json.loads(tree))] == [("v", ["int"]), ("next", ["null", "record"])]
    with pytest.raises(ValueError, match="not known"):
        sc.struct_of('{"type":"record","name":"T","fields":[{"name":"v","type":"Nothing"}]}')


def test_type_lists_of_json_schemas(spark):
    text = '{"type":"object","required":["a","b"],"properties":{"a":{"type":["string","null"]},"b":{"type":["integer","number"]},"c":{"type":["string","integer"]}}}'
    assert sc.struct_of(text, sc.JSON).simpleString() == "struct<a:string,b:double,c:string>"
    rows = spark.createDataFrame([('{"a":null,"b":1.5}',), ('{"a":"x"}',)], "value string")
    assert [r.decoded is not None for r in sc.decode_topic(rows, text, sc.JSON).collect()] == [True, False]


def test_aliases_are_no_removal(spark):
    old = '{"type":"record","name":"R","fields":[{"name":"size","type":"int"},{"name":"p","type":{"type":"record","name":"P","fields":[{"name":"x","type":"int"}]}}]}'
    new = '{"type":"record","name":"R","fields":[{"name":"length","aliases":["size"],"type":"long"},{"name":"q","aliases":["p"],"type":{"type":"record","name":"P","fields":[{"name":"x","type":"int"}]}}]}'
    known = spark.createDataFrame([(1, "s", 1, sc.AVRO, old)], "id int, subject string, version int, schema_type string, schema string")
    asked = spark.createDataFrame([("s", new)], "subject string, schema string")
    assert [(r.name, r.change, r.breaks) for r in sc.schema_changes(asked, known).collect()] == [("size", "widened", False)]
