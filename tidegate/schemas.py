"""Row layouts shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

ATTRIBUTE_VALUE = T.StructType(
    [
        T.StructField("data_type", T.StringType()),
        T.StructField("string_value", T.StringType()),
        T.StructField("binary_value", T.BinaryType()),
    ]
)

HEADER = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]
)

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("receipt_handle", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("md5_of_body", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("message_attributes", T.MapType(T.StringType(), ATTRIBUTE_VALUE)),
        T.StructField("queue_url", T.StringType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("source_partition", T.MapType(T.StringType(), T.StringType())),
        T.StructField("source_offset", T.MapType(T.StringType(), T.StringType())),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("headers", T.ArrayType(HEADER)),
        T.StructField("message_id", T.StringType()),
    ]
)

# Names of the system attributes a queue attaches to a message.
BASE_SYSTEM_ATTRIBUTES = [
    "SentTimestamp",
    "ApproximateReceiveCount",
    "ApproximateFirstReceiveTimestamp",
]
FIFO_SYSTEM_ATTRIBUTES = [
    "MessageGroupId",
    "MessageDeduplicationId",
    "SequenceNumber",
]

# Defaults of the options.
DEFAULT_MAX_RETRIES = 3
DEFAULT_BACKOFF_MS = 1000
DEFAULT_DEDUP_WINDOW_MS = 300000
DEFAULT_RECEIVE_BATCH = 10
DEFAULT_WAIT_SECONDS = 10
