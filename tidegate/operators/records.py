"""Messages to topic records: key, headers, partition, source position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Header names, in output order, and where each value comes from.
MESSAGE_HEADERS = [
    ("sqs.message.id", "message_id"),
    ("sqs.receipt.handle", "receipt_handle"),
    ("sqs.md5.of.body", "md5_of_body"),
]
ATTRIBUTE_HEADERS = [
    ("sqs.sent.timestamp", "SentTimestamp"),
    ("sqs.approximate.receive.count", "ApproximateReceiveCount"),
    ("sqs.approximate.first.receive.timestamp", "ApproximateFirstReceiveTimestamp"),
    ("sqs.message.group.id", "MessageGroupId"),
    ("sqs.message.deduplication.id", "MessageDeduplicationId"),
    ("sqs.sequence.number", "SequenceNumber"),
]
USER_ATTRIBUTE_PREFIX = "sqs.message.attribute."
SCHEMA_TYPE_HEADER = "sqs.schema.type"
SCHEMA_TYPES = {"avro": "Avro", "json": "JSON Schema", "protobuf": "Protobuf"}


def system_attribute(name: str) -> Column:
    return F.try_element_at(F.col("attributes"), F.lit(name))


def is_fifo(flag: bool = False, auto_detect: bool = True) -> Column:
    """Ordered queue: by flag, else by the suffix of the row's own queue."""
    suffix = F.coalesce(F.col("queue_url").endswith(".fifo"), F.lit(False))
    return F.lit(flag) | (F.lit(auto_detect) & suffix)


def record_key(fifo: Column) -> Column:
    group = system_attribute("MessageGroupId")
    return F.when(fifo & group.isNotNull(), group).otherwise(F.col("message_id"))


def header(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))


def system_headers() -> list[Column]:
    return [header(n, F.col(c)) for n, c in MESSAGE_HEADERS] + [
        header(n, system_attribute(a)) for n, a in ATTRIBUTE_HEADERS
    ]


def user_headers() -> Column:
    """A value header and a type header per user attribute, by attribute name."""

    def pair(entry):
        name = F.concat(F.lit(USER_ATTRIBUTE_PREFIX), entry["key"])
        value = F.coalesce(
            entry["value"]["string_value"].cast("binary"), entry["value"]["binary_value"]
        )
        kind = entry["value"]["data_type"].cast("binary")
        return F.array(
            F.struct(name.alias("key"), value.alias("value")),
            F.struct(F.concat(name, F.lit(".type")).alias("key"), kind.alias("value")),
        )

    attributes = F.col("message_attributes")
    names = F.array_sort(F.map_keys(attributes))
    entries = F.transform(
        names, lambda n: F.struct(n.alias("key"), F.element_at(attributes, n).alias("value"))
    )
    return F.coalesce(
        F.flatten(F.transform(entries, pair)),
        F.array().cast("array<struct<key:string,value:binary>>"),
    )


def record_headers(with_attributes: bool = True, schema_type: str | None = None) -> Column:
    fixed = system_headers()
    if schema_type is not None:
        fixed = [header(SCHEMA_TYPE_HEADER, F.lit(SCHEMA_TYPES[schema_type]))] + fixed
    headers = F.array(*fixed)
    if with_attributes:
        headers = F.concat(headers, user_headers())
    return F.filter(headers, lambda h: h["value"].isNotNull())


def record_columns(
    topic: str,
    partition: int | None = None,
    with_attributes: bool = True,
    fifo: bool = False,
    fifo_auto_detect: bool = True,
    schema_type: str | None = None,
    value: Column | None = None,
) -> list[Column]:
    """The columns of a topic record, computed from a message row."""
    return [
        F.create_map(F.lit("queue_url"), F.col("queue_url")).alias("source_partition"),
        F.create_map(F.lit("message_id"), F.col("message_id")).alias("source_offset"),
        F.lit(topic).alias("topic"),
        F.lit(partition).cast("int").alias("partition"),
        record_key(is_fifo(fifo, fifo_auto_detect)).alias("key"),
        (F.col("body") if value is None else value).alias("value"),
        F.col("received_at").alias("timestamp"),
        record_headers(with_attributes, schema_type).alias("headers"),
        F.col("message_id"),
    ]


def to_records(df: DataFrame, topic: str, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """One topic record per message. ``value`` defaults to the body; ``keep``
    names further columns to carry along; other options as in ``record_columns``."""
    return df.select(*record_columns(topic, **options), *keep)
