"""Objects fetched by address: any bucket, one request per address, errors per address."""

from __future__ import annotations

import gzip
import os
import threading
import time
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from tidegate.operators.claimcheck import claim_check, decode_and_fetch
from tidegate.sources.object_store import FolderGet, ObjectStore, in_order as in_flight_order, write_objects
from tests.helpers import bodies, gz64, in_order

EVENT = '{"detail":{"ref":%s}}'


@pytest.fixture
def store(spark, tmp_path):
    roots = {"a": str(tmp_path / "a"), "b": f"file://{tmp_path}/b"}
    objects = [("s3://a/x/one.txt", b"one"), ("s3://b/two two.gz", gzip.compress(b"two")), ("s3://b/empty", b"")]
    assert write_objects(spark.createDataFrame(objects, "uri string, content binary"), roots) == 3
    return ObjectStore(FolderGet(roots, log=str(tmp_path / "log")))


def requests(store):
    log = store.get.log
    return len(os.listdir(log)) if os.path.isdir(log) else 0


def test_two_buckets_and_one_request_per_address(spark, store):
    df = bodies(spark, "s3://a/x/one.txt", " s3://b/two two.gz ", "s3://b/none", "s3://c/k", "plain", None, "s3://a",
                "s3://b/empty", *["s3://a/x/one.txt"] * 40)
    done = claim_check(df, store, fmt="AUTO")
    got = in_order(done, "body", "error_class")
    assert got[:2] == [("one", None), ("two", None)] and got[4:6] == [("plain", None), (None, None)]
    assert [e for _, e in got[2:4]] == ["ObjectNotFound"] * 2 and got[6][1] == "InvalidUri"
    assert got[7] == ("", None) and set(got[8:]) == {("one", None)}
    # Five full addresses; evaluated once more, nothing is asked for again.
    assert requests(store) == 5
    done.count()
    assert requests(store) == 5


def test_leaf_and_inner_address(spark, store):
    df = bodies(spark, EVENT % '"s3://a/x/one.txt"', EVENT % f'"{gz64("s3://b/two two.gz")}"', EVENT % "1")
    got = in_order(decode_and_fetch(df, store, "detail.ref"), "body", "error_class")
    assert got[0] == (EVENT % '"one"', None) and got[2] == (EVENT % "1", None)
    assert "two" not in (got[1][0] or "") and got[1][1] is None  # an inner one is not unpacked
    field = in_order(claim_check(df, store, path="detail.ref"), "body")
    assert field[0] == EVENT % '"one"'


def broken(bucket, key):
    if key == "bad":
        raise ConnectionError("no route")
    return f"{bucket}/{key}".encode()


def test_a_failed_request_fails_its_own_message(spark):
    df = bodies(spark, "s3://x/bad", "s3://x/good")
    done = claim_check(df, ObjectStore(broken))
    assert in_order(done, "body", "error_class", "error_message") == [
        ("s3://x/bad", "ObjectStoreError", "ConnectionError: no route"), ("x/good", None, None)]


def test_streams_look_up_row_by_row(spark, store, tmp_path):
    from tidegate.sources.messages import read_messages

    bodies(spark, "s3://a/x/one.txt", "s3://b/none", "plain", "s3://a/x/one.txt").coalesce(1).write.parquet(str(tmp_path / "in"))
    done = claim_check(read_messages(spark, str(tmp_path / "in"), streaming=True), store, fmt="AUTO")
    query = (
        done.select("message_id", "body", "error_class").writeStream.format("parquet").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "progress")).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = in_order(spark.read.parquet(str(tmp_path / "out")), "body", "error_class")
    assert got == [("one", None), ("s3://b/none", "ObjectNotFound"), ("plain", None), ("one", None)]
    assert requests(store) == 2


@dataclass
class Counting:
    now: int = 0
    most: int = 0

    def __post_init__(self):
        self.lock = threading.Lock()

    def __call__(self, bucket, key):
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)
        time.sleep(0.002)
        with self.lock:
            self.now -= 1
        return key.encode()


def test_requests_in_flight_are_bounded_and_in_order():
    get = Counting()
    wanted = [(f"s3://b/{i}", "b", str(i)) for i in range(200)]
    got = list(in_flight_order(get, iter(wanted), 7))
    assert [u for u, *_ in got] == [u for u, *_ in wanted] and 1 < get.most <= 7


def test_only_whole_addresses_are_fetched(spark):
    table = ObjectStore(broken).fetched(spark, spark.createDataFrame([("s3://b",), ("x",), (None,), ("s3://b/k",)], "uri string"))
    assert [(r.uri, bytes(r.content), r.failure) for r in table.collect()] == [("s3://b/k", b"b/k", None)]
    assert ObjectStore(broken).fetched(spark, table.where(F.lit(False))).count() == 0
