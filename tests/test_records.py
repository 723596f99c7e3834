import pytest
from pyspark.sql import functions as F

from tidegate.operators.deadletter import to_dlq
from tidegate.operators.extract import extract_field
from tidegate.operators.records import to_records
from tidegate.schemas import RECORD_SCHEMA
from tidegate.sources.messages import attribute_names, project_attributes, queue_list, union_queues
from tidegate.sources.queues import check_receive_options, receive_messages
from tests.helpers import QUEUE, bodies, frame, in_order, message, text

SYSTEM = {"SentTimestamp": "1234567890", "ApproximateReceiveCount": "1", "ApproximateFirstReceiveTimestamp": "1234567890"}
FIFO = {"MessageGroupId": "order-123", "MessageDeduplicationId": "dedup-abc", "SequenceNumber": "100"}


def headers(row):
    return [(h.key, bytes(h.value).decode()) for h in row.headers]


def test_default_record(spark):
    df = frame(spark, [message(attributes=SYSTEM, user={"customAttribute": "custom-value"})])
    row = to_records(df, "topic").first()
    assert [f.dataType for f in to_records(df, "t").schema] == [f.dataType for f in RECORD_SCHEMA]
    assert (row.topic, row.key, row.value, row.partition) == ("topic", "msg-1", "test body", None)
    assert row.source_partition == {"queue_url": QUEUE} and row.source_offset == {"message_id": "msg-1"}
    assert headers(row) == [
        ("sqs.message.id", "msg-1"), ("sqs.receipt.handle", "receipt-msg-1"), ("sqs.md5.of.body", "md5"),
        ("sqs.sent.timestamp", "1234567890"), ("sqs.approximate.receive.count", "1"),
        ("sqs.approximate.first.receive.timestamp", "1234567890"),
        ("sqs.message.attribute.customAttribute", "custom-value"),
        ("sqs.message.attribute.customAttribute.type", "String")]


def test_fifo_record(spark):
    df = frame(spark, [message("msg-0", attributes=FIFO, queue="q.fifo"), message("msg-1", queue="q.fifo"),
                       message("msg-2", attributes=FIFO)])
    assert in_order(to_records(df, "t"), "key") == ["order-123", "msg-1", "msg-2"]
    assert in_order(to_records(df, "t", fifo=True), "key") == ["order-123", "msg-1", "order-123"]
    assert in_order(to_records(df, "t", fifo_auto_detect=False), "key") == ["msg-0", "msg-1", "msg-2"]
    names = [h[0] for h in headers(to_records(df, "t").where("message_id = 'msg-2'").first())]
    assert names[-3:] == ["sqs.message.group.id", "sqs.message.deduplication.id", "sqs.sequence.number"]


def test_binary_and_absent_attributes(spark):
    binary = {"data_type": "Binary", "string_value": None, "binary_value": b"\x01\x02"}
    df = frame(spark, [message(md5=None, user={"b": binary, "a": text("1", "Number")})])
    row = to_records(df, "t", partition=5).first()
    assert row.partition == 5
    assert [(h.key, bytes(h.value)) for h in row.headers][2:] == [
        ("sqs.message.attribute.a", b"1"), ("sqs.message.attribute.a.type", b"Number"),
        ("sqs.message.attribute.b", b"\x01\x02"), ("sqs.message.attribute.b.type", b"Binary")]
    assert len(to_records(df, "t", with_attributes=False).first().headers) == 2
    assert headers(to_records(df.drop("x"), "t", with_attributes=False, schema_type="protobuf").first())[0] == ("sqs.schema.type", "Protobuf")


def test_dead_letter(spark):
    df = frame(spark, [message(body="body")]).withColumns(
        {"error_class": F.lit("E"), "error_message": F.lit("x" * 9000), "attempt": F.lit(2)})
    row = to_dlq(df, "dlq-topic", 3).first()
    h = dict(headers(row))
    assert (row.topic, row.key, row.value) == ("dlq-topic", "msg-1", "body")
    assert row.source_offset == {"message_id": "msg-1", "dlq": "true"}
    assert [k for k, _ in headers(row)] == [
        "sqs.message.id", "sqs.queue.url", "error.class", "error.message", "error.stacktrace", "error.timestamp",
        "retry.count", "retry.max", "retry.exhausted", "sqs.md5.of.body"]
    assert (h["retry.count"], h["retry.max"], h["retry.exhausted"]) == ("2", "3", "false")
    assert len(h["error.stacktrace"]) == 8000 + len("... (truncated)")
    assert to_dlq(df, " ").count() == 0 == to_dlq(df, None).count()


EXTRACT = [
    ('{"version":"0","detail":{"data":{"offers":[{"id":"123"}]}}}', "detail.data", '{"offers":[{"id":"123"}]}', None),
    ('{"data":{"key":"value"},"metadata":"extra"}', "data", '{"key":"value"}', None),
    ('{"a":{"b":{"c":{"d":"final-value"}}}}', "a.b.c.d", "final-value", None),
    ('{"version":"0","detail":{"other":"data"}}', "detail.data", '{"version":"0","detail":{"other":"data"}}', "FieldMissing"),
    ('{"a":1}', None, '{"a":1}', None),
    ('{"a":1}', " ", '{"a":1}', None),
    ("not json", "a", "not json", "JsonError"),
    ('{"a":1,}', "a", '{"a":1,}', "JsonError"),
    ('{"a":null}', "a", "null", None),
    ('{"a":{"b":null}}', "a.b", "null", None),
    ('{"a":[{"b":1}]}', "a.b", '{"a":[{"b":1}]}', "FieldMissing"),
    ('{"a":100.50}', "a", "100.5", None),
    ('{"z":1,"a":{"y":true,"b":2}}', "a", '{"y":true,"b":2}', None),
    ("", "a", "", None),
    (None, "a", None, None),
    ('{"it\'s":"x"}', "it's", "x", None),
]


@pytest.mark.parametrize("value,path,expected,error", EXTRACT)
def test_extract(spark, value, path, expected, error):
    df = bodies(spark, value).select("message_id", F.col("body").alias("value"))
    assert in_order(extract_field(df, path), "value") == [expected]
    strict = extract_field(df, path, True)
    if path and path.strip():
        assert in_order(strict, "value", "error_class") == [(expected if not error else value, error)]


def test_extract_from_typed_value(spark):
    df = bodies(spark, "x").select("message_id", F.struct(
        F.struct(F.lit("t").alias("name"), F.array(F.lit(1)).alias("list")).alias("a")).alias("value"))
    assert in_order(extract_field(df, "a.name"), "value") == ["t"]
    assert in_order(extract_field(df, "a.list"), "value") == ["[1]"]
    assert in_order(extract_field(df, "a.none", True), "error_class") == ["FieldMissing"]


QUEUES = [("q1,q1,q2", "q1|q2"), ("q1,q2,q1,q3", "q1|q2|q3"), ("q1,q1,q1,q1,q1", "q1"), ("q1, , q1,  ,q2", "q1|q2"),
          ("  ", "single"), (None, "single"), ("q1,q2,", "q1|q2"), ("q1,,q2", "q1|q2")]


@pytest.mark.parametrize("urls,expected", QUEUES)
def test_queue_list(spark, urls, expected):
    df = spark.createDataFrame([(urls, "single")], "u string, s string")
    assert "|".join(df.select(queue_list(F.col("u"), F.col("s"))).first()[0]) == expected
    assert df.select(queue_list(F.lit(" "), F.lit(None).cast("string"))).first()[0] == []


def test_attribute_projection(spark):
    assert attribute_names(" a, ,b ,") == ["a", "b"] and attribute_names(None) == []
    df = frame(spark, [message(attributes={**SYSTEM, **FIFO, "Other": "x"}, user={"a": "1", "b": "2"})])
    assert set(project_attributes(df).first().attributes) == set(SYSTEM)
    assert set(project_attributes(df, fifo=True).first().attributes) == {**SYSTEM, **FIFO}.keys()
    assert set(project_attributes(df, True, "b, c").first().message_attributes) == {"b"}
    assert project_attributes(df, False, "b").first().message_attributes == {}


def test_union(spark):
    df = bodies(spark, "x")
    got = union_queues([("q1", df), ("q2.fifo", df)]).select("queue_url").collect()
    assert sorted(r[0] for r in got) == ["q1", "q2.fifo"]


def receive_two(queue, batch, wait):
    """Gives two batches per process, then nothing."""
    seen = receive_two.__dict__.setdefault("seen", {})
    n = seen[queue] = seen.get(queue, 0) + 1
    return [] if n > 2 else [{"message_id": f"{queue}-{n}-{i}", "body": "b", "receipt_handle": "r"} for i in range(batch)]


def test_receive(spark):
    got = receive_messages(spark, ["q1", "q2"], receive_two, batch=3, wait_seconds=0, max_polls=2).collect()
    assert len({(r.queue_url, r.message_id) for r in got}) == len(got) > 0
    assert {r.queue_url for r in got} == {"q1", "q2"} and got[0].body == "b"
    for bad in ((0, 0), (11, 0), (1, 21), (1, -1)):
        with pytest.raises(ValueError):
            check_receive_options(*bad)
