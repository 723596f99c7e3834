import base64
import gzip
import json
import zlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidegate.functions.payload import (
    check_format, detect_compression, inflate, inflate_text, is_likely_base64, read_json, strict_base64, write_json,
)
from tidegate.operators.decompress import decompress_body, decompress_safe
from tests.helpers import bodies, gz64, in_order, zl64

EVENT = '{"version":"0","id":"test-123","detail-type":"PriceCache.Updated","detail":{"data":%s}}'


def test_whole_body(spark):
    plain = '{"message":"Hello, World!"}'
    df = bodies(spark, gz64(plain), zl64(plain), '{"test":"data"}', None, "", "x^2 is no zlib")
    done = decompress_body(df)
    assert in_order(done, "body")[:5] == [plain, plain, '{"test":"data"}', None, ""]
    assert in_order(done, "error_class") == [None] * 5 + ["DecompressionError"]
    assert in_order(done, "md5_of_body") == ["md5"] * 6
    assert in_order(done, "original_body")[0] == gz64(plain)


def test_field(spark):
    inner = '{"price":100,"currency":"USD"}'
    nested = '{"level1":{"level2":{"level3":{"data":"%s"}}}}' % gz64("nested-value")
    df = bodies(
        spark, EVENT % f'"{gz64(inner)}"', '{"version":"0","id":"test-123"}',
        '{"version":"0","id":"test-123","detail":{"data":123}}', "no json", "", None,
    )
    done = decompress_body(df, path="detail.data")
    got = in_order(done, "body", "error_class")
    assert got[0] == (EVENT % inner, None)
    assert got[1] == ('{"version":"0","id":"test-123"}', None)
    assert got[2] == ('{"version":"0","id":"test-123","detail":{"data":123}}', None)
    assert got[3] == ("no json", "JsonError")
    assert got[4:] == [("", None), (None, None)]
    deep = decompress_body(bodies(spark, nested), path="level1.level2.level3.data")
    assert in_order(deep, "body") == ['{"level1":{"level2":{"level3":{"data":"nested-value"}}}}']


def test_malformed_field_fails_its_row_only(spark):
    df = bodies(spark, EVENT % '"not-base64-data!"', EVENT % f'"{base64.b64encode(b"not gzip data at all").decode()}"',
                EVENT % f'"{gz64("fine")}"')
    done = decompress_body(df, "GZIP", True, "detail.data")
    assert in_order(done, "error_class") == ["DecompressionError", "DecompressionError", None]
    assert in_order(done, "body")[2] == EVENT % '"fine"'


def test_likely_base64(spark):
    df = bodies(spark, "SGVsbG8gV29ybGQh", "Hello World!", "abc", None, "", " SGVsbG8gV29ybGQh\n", "a" * 15, "a-b_" * 4, "====" * 5)
    assert in_order(df.withColumn("f", is_likely_base64(F.col("body"))), "f") == [
        True, False, False, False, False, True, False, True, False]


def test_detect(spark):
    data = [b"\x1f\x8bxx", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"\x78\x02", b"\x1f", b""]
    df = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(data)], "i int, d binary")
    got = [r.f for r in df.withColumn("f", detect_compression(F.col("d"))).orderBy("i").collect()]
    assert got == ["GZIP"] + ["ZLIB"] * 4 + ["NONE"] * 3


def test_safe(spark):
    cut = gz64("some longer plain text")[:-8]
    df = bodies(spark, gz64("plain"), cut, "plain")
    assert in_order(df.withColumn("s", decompress_safe(F.col("body"))), "s") == ["plain", cut, "plain"]


def test_base64_rules():
    assert strict_base64("AAA") == b"\0\0" and strict_base64("AAA=") == b"\0\0"
    for text in ("AA=", "A", "AAAAA", "AA-_", "AA AA", "AAAA\n", "=AAA"):
        assert strict_base64(text) is None
    # URL-safe letters look like base64 but are not decoded: the text stays.
    assert inflate_text("a-b_" * 8, "AUTO", True) == "a-b_" * 8


def test_inflate_members_and_rest():
    two = gzip.compress(b"a") + gzip.compress(b"b")
    assert inflate(two + b"rest", "GZIP") == b"ab"
    assert inflate(zlib.compress(b"x"), "DEFLATE") == b"x" == inflate(zlib.compress(b"x") + b"rest", "ZLIB")
    assert inflate(b"abc", "NONE") == b"abc"
    with pytest.raises(zlib.error):
        inflate(gzip.compress(b"abc")[:-3], "GZIP")
    with pytest.raises(ValueError):
        check_format("LZ4")


def test_json_text_form():
    text = '{"b":1.50,"a":[1e20,12345678.0,0.00012,-0.0],"u":"\\u00e9\\ud800","n":null}'
    assert write_json(read_json(text)) == '{"b":1.5,"a":[1.0E20,1.2345678E7,1.2E-4,-0.0],"u":"é?","n":null}'
    for bad in ("", "{", "[NaN]", "1 foo", "1e999"):
        with pytest.raises(ValueError):
            read_json(bad)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=300), st.sampled_from(["gzip", "zlib"]))
def test_round_trip(plain, kind):
    data = gzip.compress(plain.encode()) if kind == "gzip" else zlib.compress(plain.encode())
    packed = base64.b64encode(data).decode()
    # Texts below the length that marks base64 stay as they are.
    assert inflate_text(packed, "AUTO", True) == (plain if len(packed) >= 16 else packed)


@settings(max_examples=100, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(st.characters(exclude_categories=["Cs"])),
                    lambda c: st.lists(c, max_size=4) | st.dictionaries(st.text(st.characters(exclude_categories=["Cs"])), c, max_size=4), max_leaves=12))
def test_json_rewrite_keeps_values(value):
    assert json.loads(write_json(read_json(json.dumps(value)))) == value


def test_base64_column_equals_the_strict_decoder(spark):
    from tidegate.functions.payload import base64_bytes, strict_base64

    texts = ["", "QQ==", "QQ", "QQ=", "QUI=", "QUI", "QUJD", "QUJDR", "QU-D", "QU_D", " QQ==", "QQ==\n", "Q Q=", "====", "=", "QUJD====",
             "QU=D", "é", "QUJDRA==", "A", "QUJDRA=", "+/+/"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").union(
        spark.createDataFrame([(99, None)], "i int, t string"))
    got = {r.i: r.b for r in df.select("i", base64_bytes(F.col("t")).alias("b")).collect()}
    assert got.pop(99) is None
    assert {i: None if b is None else bytes(b) for i, b in got.items()} == {i: strict_base64(t) for i, t in enumerate(texts)}


def test_batches_of_long_bodies_are_cut_by_bytes(spark):
    import pandas as pd
    import pyarrow as pa
    from pyspark.sql import functions as F

    long_bodies = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("body"))

    @F.pandas_udf("bigint")
    def held(bodies: pd.Series) -> pd.Series:
        return pd.Series([int(bodies.str.len().sum())] * len(bodies))

    def arrow(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    limit = 4 << 20
    assert long_bodies.select(held("body").alias("n")).agg(F.max("n")).first()[0] < limit
    assert long_bodies.mapInArrow(arrow, "n bigint").agg(F.max("n")).first()[0] < limit
