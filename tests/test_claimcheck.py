import gzip
import os
import tempfile

from pyspark.sql import functions as F

from tidegate.operators.claimcheck import claim_check, decode_and_fetch
from tidegate.sources.objects import parse_object_uri, read_objects
from tests.helpers import bodies, gz64, in_order

EVENT = '{"version":"0","detail":{"s3Key":%s}}'


def store(spark, **objects):
    """A folder of objects read through the binary file source."""
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, data in objects.items():
        path = os.path.join(root, name.replace("__", "/"))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data if isinstance(data, bytes) else data.encode())
    return read_objects(spark, root, "my-bucket")


def test_body(spark):
    objects = store(spark, **{"large.json": '{"message":"large"}', "a b__x%1.json": "nested", "raw.gz": gzip.compress(b"raw gzip"),
                              "text.b64": gz64("packed"), "bad": b"\xff\xfe"})
    df = bodies(spark, "s3://my-bucket/large.json", " s3://my-bucket/a b/x%1.json ", '{"plain":1}', None, "",
                "s3://my-bucket/none", "s3://my-bucket", "s3:///k", "s3://my-bucket/raw.gz", "s3://my-bucket/text.b64", "s3://my-bucket/bad")
    done = claim_check(df, objects)
    got = in_order(done, "body", "error_class")
    assert got[:5] == [('{"message":"large"}', None), ("nested", None), ('{"plain":1}', None), (None, None), ("", None)]
    assert [e for _, e in got[5:8]] == ["ObjectNotFound", "InvalidUri", "InvalidUri"]
    assert got[9] == (gz64("packed"), None) and got[10][0].count("�") == 2
    unpacked = in_order(claim_check(df, objects, fmt="AUTO"), "body")
    assert unpacked[8:10] == ["raw gzip", "packed"] and unpacked[0] == '{"message":"large"}'


def test_field(spark):
    objects = store(spark, **{"large.json": '{"price":100,"currency":"USD"}'})
    df = bodies(spark, EVENT % '"s3://my-bucket/large.json"', '{"version": "0"}', EVENT % "123", EVENT % '"other  text"',
                "no json", EVENT % '"s3://my-bucket/none"', "", EVENT % "null")
    got = in_order(claim_check(df, objects, "detail.s3Key"), "body", "error_class")
    assert got[0] == (EVENT % '"{\\"price\\":100,\\"currency\\":\\"USD\\"}"', None)
    assert got[1] == ('{"version": "0"}', None) and got[2] == (EVENT % "123", None)
    assert got[3] == (EVENT % '"other  text"', None)
    assert [e for _, e in got[4:]] == ["JsonError", "ObjectNotFound", None, None]


def test_decode_and_fetch(spark):
    body = '{"detail":{"data":%s}}'
    objects = store(spark, **{"json": '{"price":200,"currency":"EUR"}', "packed": gz64('{"a":[1,2]}'), "uri": gz64("s3://my-bucket/json")})
    df = bodies(
        spark,
        body % f'"{gz64("s3://my-bucket/json")}"',      # packed address
        body % '"s3://my-bucket/packed"',                # direct address, unpacked after
        body % f'"{gz64("plain words")}"',               # packed text
        body % '"s3://my-bucket/uri"',                   # at most one fetch
        body % f'"{gz64("s3://my-bucket/packed")}"',    # an inner object is not unpacked
        body % "12345678901234567890", body % '"{\\"k\\":1}"', '{"x":1}', "no json", body % '"s3://my-bucket/none"', body % '"s3://"',
    )
    got = in_order(decode_and_fetch(df, objects, "detail.data"), "body", "error_class")
    assert got[:8] == [
        (body % '{"price":200,"currency":"EUR"}', None), (body % '{"a":[1,2]}', None), (body % '"plain words"', None),
        (body % '"s3://my-bucket/json"', None), (body % f'"{gz64(chr(123) + chr(34) + "a" + chr(34) + ":[1,2]}")}"', None),
        (body % "12345678901234567890", None), (body % '{"k":1}', None), ('{"x":1}', None)]
    assert [e for _, e in got[8:]] == ["JsonError", "ObjectNotFound", None]
    untouched = decode_and_fetch(bodies(spark, "any"), objects, " ")
    assert in_order(untouched, "body") == ["any"]


def test_fixed_format_fails_only_text_leaves(spark):
    df = bodies(spark, '{"d":123}', '{"d":"text"}')
    got = in_order(decode_and_fetch(df, store(spark, x="y"), "d", "GZIP"), "error_class")
    assert got == [None, "DecompressionError"]


def test_uri(spark):
    df = bodies(spark, "s3://b/k/x y", "s3://b", "s3:///k", "s3://b/", "http://b/k", None)
    got = in_order(df.withColumn("u", parse_object_uri(F.col("body"))), "u")
    assert tuple(got[0]) == ("b", "k/x y") and got[1:] == [None] * 5
