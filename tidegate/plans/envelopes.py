"""Queue messages derived from the given tables (events, documents, orders, ...)."""

from __future__ import annotations

import gzip
import zlib
from base64 import b64encode

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidegate.functions.payload import give_back
from tidegate.sources.messages import spread

# The three queues the events are spread over.
QUEUES = [
    "https://queue.example.com/100/orders",
    "https://queue.example.com/100/alerts",
    "https://queue.example.com/100/audit.fifo",
]
BUCKET = "ingest-bucket"


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A given table, narrowed to the columns in use before it is spread."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df.select(*columns) if columns else df)


def text_attribute(data_type: str, value: Column) -> Column:
    return F.struct(
        F.lit(data_type).alias("data_type"),
        value.cast("string").alias("string_value"),
        F.lit(None).cast("binary").alias("binary_value"),
    )


def price_text(value: Column) -> Column:
    """Two-digit decimal text, the same in every SQL dialect."""
    return value.cast("decimal(18,2)").cast("string")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant whose UTC clock reads as stored, whatever
    the session's time zone."""
    e = table(spark, sf_dir, "events")
    local = F.col("ts").cast("timestamp")
    return e.withColumn("ts", F.from_utc_timestamp(local, F.current_timezone()))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event, over three queues, the last one ordered."""
    e = events(spark, sf_dir)
    user = F.col("user_id").cast("string")
    queue = F.element_at(
        F.array(*[F.lit(q) for q in QUEUES]), (F.col("user_id") % 3 + 1).cast("int")
    )
    millis = F.unix_millis("ts").cast("string")
    base = F.create_map(
        F.lit("SentTimestamp"), millis,
        F.lit("ApproximateReceiveCount"), F.lit("1"),
        F.lit("ApproximateFirstReceiveTimestamp"), millis,
    )
    fifo = F.create_map(
        F.lit("MessageGroupId"), user,
        F.lit("MessageDeduplicationId"), F.concat_ws(":", user, "event_type"),
        F.lit("SequenceNumber"), F.col("event_id").cast("string"),
    )
    shared = F.create_map(
        F.lit("Type"), text_attribute("String", F.col("event_type")),
        F.lit("price"), text_attribute("Number", price_text(F.col("value"))),
    )
    vip = F.create_map(F.lit("vip"), text_attribute("String", F.lit("gold")))
    body = F.concat(
        F.lit('{"version":"0","detail-type":"'), F.col("event_type"),
        F.lit('","detail":{"data":'), F.col("props"), F.lit("}}"),
    )
    return e.select(
        F.col("event_id").cast("string").alias("message_id"),
        F.concat(F.lit("receipt-"), F.col("event_id").cast("string")).alias("receipt_handle"),
        body.alias("body"),
        F.md5(body).alias("md5_of_body"),
        F.when(queue.endswith(".fifo"), F.map_concat(base, fifo)).otherwise(base).alias("attributes"),
        F.when(F.col("user_id") % 5 == 0, F.map_concat(shared, vip))
        .otherwise(shared).alias("message_attributes"),
        queue.alias("queue_url"),
        F.col("ts").alias("received_at"),
    )


def plain_message(message_id: Column, body: Column) -> list[Column]:
    return [
        message_id.cast("string").alias("message_id"),
        F.concat(F.lit("receipt-"), message_id.cast("string")).alias("receipt_handle"),
        body.alias("body"),
        F.md5(body).alias("md5_of_body"),
        F.create_map(F.lit("SentTimestamp"), F.lit("0")).alias("attributes"),
        F.lit(None).cast(
            "map<string,struct<data_type:string,string_value:string,binary_value:binary>>"
        ).alias("message_attributes"),
        F.lit(QUEUES[0]).alias("queue_url"),
        F.timestamp_seconds(F.lit(0)).alias("received_at"),
    ]


def pack_bytes(kind: str, text: str) -> bytes:
    data = text.encode("utf-8")
    if kind == "gzip":
        return gzip.compress(data, mtime=0)
    return zlib.compress(data) if kind == "zlib" else data


@F.pandas_udf(T.BinaryType())
def packed(kinds: pd.Series, texts: pd.Series) -> pd.Series:
    give_back()
    return pd.Series([pack_bytes(k, t) for k, t in zip(kinds, texts)], dtype=object)


@F.pandas_udf(T.StringType())
def packed_base64(kinds: pd.Series, texts: pd.Series) -> pd.Series:
    give_back()
    return pd.Series(
        [t if k == "none" else b64encode(pack_bytes(k, t)).decode() for k, t in zip(kinds, texts)],
        dtype=object,
    )


def kind_of(number: Column) -> Column:
    return F.element_at(
        F.array(F.lit("none"), F.lit("gzip"), F.lit("zlib")), (number % 3 + 1).cast("int")
    )


def json_string(col: Column) -> Column:
    """A text as a JSON string literal."""
    listed = F.to_json(F.array(col))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as bodies: plain, gzip + base64 or zlib + base64 by id."""
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    body = packed_base64(kind_of(F.col("doc_id")), F.col("text"))
    packs = d.select("doc_id", body.alias("packed"))
    return packs.select(*plain_message(F.col("doc_id"), F.col("packed")))


def page_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event envelopes whose ``detail.data`` holds a whole page, packed by id."""
    p = table(spark, sf_dir, "pages", ["page_id", "html"])
    leaf = packed_base64(kind_of(F.col("page_id")), F.col("html"))
    body = F.concat(
        F.lit('{"version":"0","id":"'), F.col("page_id").cast("string"),
        F.lit('","detail":{"data":'), json_string(F.col("leaf")), F.lit("}}"),
    )
    return p.select("page_id", leaf.alias("leaf")).select(*plain_message(F.col("page_id"), body))


def document_uri(number: Column) -> Column:
    """Address of a document; every tenth one is a stale address with no object."""
    folder = F.when(number % 10 == 0, "gone").otherwise("docs")
    return F.concat(F.lit(f"s3://{BUCKET}/"), folder, F.lit("/"), number.cast("string"), F.lit(".bin"))


def document_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object store content: every document, packed by id."""
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select(
        F.concat(
            F.lit(f"s3://{BUCKET}/docs/"), F.col("doc_id").cast("string"), F.lit(".bin")
        ).alias("uri"),
        packed(kind_of(F.col("doc_id")), F.col("text")).alias("content"),
    )


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON bodies; some lack a field, some carry an extra one, some
    are arrays, some are no JSON."""
    o = table(
        spark, sf_dir, "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
    )
    key = F.col("o_orderkey")
    status = F.when(key % 7 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"status":"'), F.col("o_orderstatus"), F.lit('"'))
    )
    extra = F.when(key % 11 == 0, F.lit(',"note":"rush"')).otherwise(F.lit(""))
    quantity = F.when(key % 13 == 0, F.lit('"many"')).otherwise((key % 50).cast("string"))
    record = F.concat(
        F.lit('{"orderId":"'), key.cast("string"),
        F.lit('","customer":{"id":'), F.col("o_custkey").cast("string"),
        F.lit(',"priority":'), json_string(F.col("o_orderpriority")),
        F.lit('},"quantity":'), quantity,
        F.lit(',"bigId":'), (key + F.lit(9000000000)).cast("string"),
        F.lit(',"amount":'), price_text(F.col("o_totalprice")),
        F.lit(',"open":'), F.when(F.col("o_orderstatus") == "O", "true").otherwise("false"),
        F.lit(',"tags":["'), F.col("o_orderstatus"), F.lit('","t'), (key % 3).cast("string"),
        F.lit('"],"memo":null'), status, extra, F.lit("}"),
    )
    body = (
        F.when(key % 17 == 0, F.concat(F.lit('["'), key.cast("string"), F.lit('"]')))
        .when(key % 19 == 0, F.concat(F.lit("plain text "), key.cast("string")))
        .otherwise(record)
    )
    return o.select(*plain_message(key, body))
