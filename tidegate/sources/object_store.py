"""Objects fetched by address on the executors: any bucket, each address once.

Nothing is listed and nothing else is read. A task keeps a bounded number of requests in
flight and hands on what came in bounded batches.
"""

from __future__ import annotations

import json
import os
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.session import materialize
from tidegate.sources.objects import parse_object_uri

Get = Callable[[str, str], bytes | None]
"""``get(bucket, key)`` -> content, None where there is no such object; raises otherwise."""

#: Requests of a task in flight, and bytes of content handed on together.
IN_FLIGHT = 16
BATCH_BYTES = 8 << 20

FOUND = "uri string, content binary, failure string"


def one_get(get: Get, uri: str | None, bucket: str | None, key: str | None) -> tuple[str | None, bytes | None, str | None]:
    """(uri, content, failure); a failed request fails its own address only."""
    if bucket is None:
        return uri, None, None
    try:
        return uri, get(bucket, key), None
    except Exception as error:  # noqa: BLE001 - whatever a store raises belongs to the row
        return uri, None, f"{type(error).__name__}: {error}"


def in_order(get: Get, wanted: Iterator[tuple], in_flight: int) -> Iterator[tuple]:
    """Results in the order of the addresses, with at most so many requests under way."""
    with ThreadPoolExecutor(in_flight) as pool:
        under_way: deque = deque()
        for one in wanted:
            if len(under_way) >= in_flight:
                yield under_way.popleft().result()
            under_way.append(pool.submit(one_get, get, *one))
        while under_way:
            yield under_way.popleft().result()


@dataclass(frozen=True)
class ObjectStore:
    """Where claim checks are looked up: a ``get`` function that executors can run."""

    get: Get
    in_flight: int = IN_FLIGHT

    def fetched(self, spark: SparkSession, addresses: DataFrame) -> DataFrame:
        """(uri, content, failure) of the different full addresses in column ``uri``, stored,
        so that later reads do not ask the store again."""
        get, in_flight = self.get, self.in_flight
        place = parse_object_uri(F.col("uri"))
        distinct = addresses.select("uri").distinct().withColumn("place", place).where("place is not null")
        layout = pa.schema([("uri", pa.string()), ("content", pa.binary()), ("failure", pa.string())])

        def run(batches):
            def wanted():
                for batch in batches:
                    yield from zip(*(batch.column(c).to_pylist() for c in ("uri", "bucket", "key")))

            held, size = [], 0
            for row in in_order(get, wanted(), in_flight):
                held.append(row)
                size += len(row[1] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), layout)], schema=layout)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), layout)], schema=layout)

        return materialize(spark, distinct.select("uri", "place.*").mapInArrow(run, FOUND), "fetched")

    def column(self, uri: Column) -> Column:
        """Struct (content, failure) per row, for streams; each different address of an Arrow
        batch is asked for once."""
        get, in_flight = self.get, self.in_flight

        @F.pandas_udf("content binary, failure string")
        def looked_up(uris: pd.Series, buckets: pd.Series, keys: pd.Series) -> pd.DataFrame:
            wanted = {u: (u, b, k) for u, b, k in zip(uris, buckets, keys) if b is not None}
            found = {u: (content, failure) for u, content, failure in in_order(get, iter(wanted.values()), in_flight)}
            return pd.DataFrame([found.get(u, (None, None)) for u in uris], columns=["content", "failure"])

        place = parse_object_uri(uri)
        return looked_up(uri, place["bucket"], place["key"])


@dataclass(frozen=True)
class FolderGet:
    """Buckets that are folders of any file system Arrow knows. With ``log`` every request
    leaves a file there, for tests."""

    roots: dict[str, str]
    log: str | None = None

    def __call__(self, bucket: str, key: str) -> bytes | None:
        if self.log:
            os.makedirs(self.log, exist_ok=True)
            with open(os.path.join(self.log, uuid.uuid4().hex), "w") as out:
                json.dump({"bucket": bucket, "key": key}, out)
        if bucket not in self.roots:
            return None
        root = self.roots[bucket]
        files, path = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        try:
            with files.open_input_stream(f"{path}/{key}") as source:
                return source.read()
        except FileNotFoundError:
            return None


def write_objects(objects: DataFrame, roots: dict[str, str]) -> int:
    """Put (uri, content) rows into such buckets; returns how many there were."""

    def run(batches):
        for batch in batches:
            for uri, content in zip(batch.column("uri").to_pylist(), batch.column("content").to_pylist()):
                bucket, _, key = uri.removeprefix("s3://").partition("/")
                root = roots[bucket]
                files, path = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
                files.create_dir(f"{path}/{key}".rpartition("/")[0], recursive=True)
                with files.open_output_stream(f"{path}/{key}") as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return objects.select("uri", "content").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0
