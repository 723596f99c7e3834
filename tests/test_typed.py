import pytest
from pyspark.sql import functions as F, types as T

from tidegate.operators.catalog import latest_schemas, register_schemas, schema_by_id, subject_name
from tidegate.operators.typed import (
    conform, infer_schema, schema_drift, schema_name, validation_report,
)
from tests.helpers import bodies, in_order

INFER = [
    ('{"name":"John","age":30,"active":true}', "avro", "name string, age int, active boolean"),
    ('{"user":{"id":1,"email":"test@test.com"},"status":"active"}', "avro", "user struct<id:int,email:string>, status string"),
    ('{"items":["apple","banana","orange"],"count":3}', "avro", "items array<string>, count int"),
    ('{"name":"John","nickname":null,"age":25}', "avro", "name string, nickname string, age int"),
    ('{"intValue":42,"longValue":9999999999,"doubleValue":3.14159}', "avro", "intValue int, longValue bigint, doubleValue double"),
    ('{"a":[],"b":[[1]],"c":[{"x":1}],"d":99999999999999999999}', "avro", "a array<string>, b array<string>, c array<struct<x:int>>, d string"),
    ('{"integer":100,"decimal":3.14159,"negative":-42}', "json", "integer bigint, decimal double, negative bigint"),
    ('{"firstName":"Bob","middleName":null,"lastName":"Smith"}', "json", "firstName string, middleName string, lastName string"),
    ('{"user":{"profile":{"name":"Test","n":1}},"m":[[1]],"big":99999999999999999999}', "json",
     "user struct<profile:struct<name:string,n:bigint>>, m array<array<bigint>>, big double"),
    ('{"intField":42,"longField":9999999999,"doubleField":3.14}', "protobuf", "intField int, longField bigint, doubleField double"),
    ('{"tags":["tag1","tag2","tag3"],"count":3}', "protobuf", "tags array<string>, count int"),
    ('{"user":{"id":1},"none":[],"rows":[{"a":1}]}', "protobuf", "user string, none array<string>, rows array<string>"),
]


@pytest.mark.parametrize("body,profile,expected", INFER)
def test_infer(spark, body, profile, expected):
    found = infer_schema(bodies(spark, body, "no json", "[1]", None), profile)
    assert found.simpleString() == T.StructType.fromDDL(expected).simpleString()


def test_infer_limits(spark):
    assert infer_schema(bodies(spark, '{"a":[[1]]}'), "protobuf") is None
    with pytest.raises(ValueError):
        infer_schema(bodies(spark, "{}"), "thrift")
    df = bodies(spark, '{"a":1}', '{"a":9999999999,"b":1.5}', '{"a":null,"b":2}')
    assert infer_schema(df, "avro").simpleString() == "struct<a:bigint,b:double>"
    assert infer_schema(df, "avro", first_only=True).simpleString() == "struct<a:int>"
    assert schema_name("my-topic.v1") == "my_topic_v1_value"


SCHEMA = ("name string, age int, ok boolean, pay double, user struct<id:bigint,`detail-type`:string>, tags array<string>")


def test_conform(spark):
    schema = T.StructType.fromDDL(SCHEMA)
    df = bodies(
        spark, '{"name":"J","age":"30","ok":"true","pay":1,"user":{"id":5,"detail-type":"x"},"tags":["a",1],"more":1}',
        '{"name":5,"age":"abc","user":7,"tags":"t"}', '["element1"]', "text", "5", None)
    rows = in_order(conform(df, schema, "avro"), "typed", "raw")
    first, raw = rows[0]
    assert raw is None and first.asDict(True) == {
        "name": "J", "age": 30, "ok": True, "pay": 1.0, "user": {"id": 5, "detail-type": "x"}, "tags": ["a", "1"]}
    assert rows[1][0].asDict(True) == {"name": "5", "age": None, "ok": None, "pay": None, "user": None, "tags": None}
    assert rows[2:] == [(None, '["element1"]'), (None, "text"), (None, "5"), (None, None)]


def test_conform_protobuf(spark):
    schema = T.StructType.fromDDL("s string, i int, l bigint, d double, b boolean, r array<string>")
    df = bodies(spark, "{}", '{"s":"x","i":"7","l":2,"d":"1.5","b":true,"r":["a"]}', '{"s":null,"r":null}',
                '{"i":1.5}', '{"i":99999999999}', '{"s":{"a":1}}', '{"b":1}', '{"r":[null]}', '{"r":"x"}', '{"i":2.0}')
    rows = in_order(conform(df, schema, "protobuf"), "typed", "raw")
    defaults = ("", 0, 0, 0.0, False, [])
    assert tuple(rows[0][0]) == defaults == tuple(rows[2][0])
    assert tuple(rows[1][0]) == ("x", 7, 2, 1.5, True, ["a"])
    assert [r[1] for r in rows[3:9]] == ['{"i":1.5}', '{"i":99999999999}', '{"s":{"a":1}}', '{"b":1}', '{"r":[null]}', '{"r":"x"}']
    assert tuple(rows[9][0]) == ("", 2, 0, 0.0, False, [])
    assert in_order(conform(df, None, "protobuf"), "raw")[0] == "{}"


def test_drift_and_report(spark):
    schema = T.StructType.fromDDL("a bigint, b string")
    df = bodies(spark, '{"a":1,"b":"x"}', '{"a":1,"c":2}', '{"a":"1","b":"x","c":1}', "text")
    rows = in_order(schema_drift(df, schema), "missing", "extra", "reusable")
    assert rows == [([], [], True), (["b"], ["c"], False), ([], ["c"], True)]
    report = sorted(tuple(r) for r in validation_report(df, schema).collect())
    assert report == [("msg-1", "b", "missing_required"), ("msg-1", "c", "extra"), ("msg-2", "a", "wrong_type"), ("msg-2", "c", "extra")]


def test_report_looks_inside(spark):
    schema = T.StructType.fromDDL("u struct<id:bigint,v:struct<w:string>>, t array<string>, n array<struct<k:bigint>>")
    df = bodies(
        spark, '{"u":{"id":"x","v":{"w":1},"free":2},"t":["a",1],"n":[{"k":1}]}',
        '{"u":{"id":1,"v":null},"t":["a",null],"n":[]}', '{"u":[],"t":{},"n":[1]}')
    report = sorted(tuple(r) for r in validation_report(df, schema).collect())
    assert report == [("msg-0", "t", "wrong_type"), ("msg-0", "u.id", "wrong_type"), ("msg-0", "u.v.w", "wrong_type"),
                      ("msg-2", "n", "wrong_type"), ("msg-2", "t", "wrong_type"), ("msg-2", "u", "wrong_type")]


def test_catalog(spark):
    layout = "subject string, version bigint, schema_id bigint, profile string, schema_json string, fingerprint string"
    empty = spark.createDataFrame([], layout)
    wanted = spark.createDataFrame([("t-value", "avro", "A"), ("t-value", "avro", "A"), ("u-value", "avro", "A")], "subject string, profile string, schema_json string")
    first = register_schemas(empty, wanted)
    rows = {r.subject: r for r in first.collect()}
    assert {s: r.version for s, r in rows.items()} == {"t-value": 1, "u-value": 1}
    assert rows["t-value"].schema_id == rows["u-value"].schema_id
    more = spark.createDataFrame([("t-value", "avro", "A"), ("t-value", "avro", "B"), ("t-value", "avro", "C")], wanted.schema)
    second = register_schemas(first, more)
    assert sorted(r.version for r in second.collect()) == [2, 3]
    both = first.unionByName(second)
    assert {r.subject: r.version for r in latest_schemas(both).collect()} == {"t-value": 3, "u-value": 1}
    assert schema_by_id(both, rows["t-value"].schema_id).count() == 2
    names = spark.range(1).select(subject_name(F.lit("t")), subject_name(F.lit("t"), True)).first()
    assert tuple(names) == ("t-value", "t-key")
