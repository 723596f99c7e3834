"""Queries over record building and field extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators.extract import extract_field
from tidegate.operators.records import to_records
from tidegate.plans.envelopes import event_messages, order_messages
from tidegate.plans.registry import EVENTS_SQL, query


@query(
    "records_default",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, 'events' AS topic, body AS value, queue_url AS source_queue,
           message_id AS source_message, t_ms AS timestamp_ms,
           CASE WHEN fifo THEN CAST(user_id AS VARCHAR) ELSE message_id END AS record_key,
           CAST(CASE WHEN fifo THEN 9 ELSE 6 END + CASE WHEN vip THEN 6 ELSE 4 END AS BIGINT) AS n_headers,
           TRUE AS partition_unset
    FROM ev""",
)
def records_default(spark, sf_dir):
    return to_records(event_messages(spark, sf_dir), "events").select(
        "message_id", "topic", "value",
        F.col("source_partition")["queue_url"].alias("source_queue"),
        F.col("source_offset")["message_id"].alias("source_message"),
        F.unix_millis("timestamp").alias("timestamp_ms"),
        F.col("key").alias("record_key"),
        F.size("headers").cast("bigint").alias("n_headers"),
        F.col("partition").isNull().alias("partition_unset"),
    )


def exploded_headers(records):
    # The outer form: headers are never empty, and the inner one would compute them
    # a second time in a filter of its own.
    return records.select("message_id", F.posexplode_outer("headers").alias("position", "h")).select(
        "message_id", F.col("position").cast("bigint").alias("position"),
        F.col("h.key").alias("header"), F.col("h.value").cast("string").alias("text"),
    )


BASE_HEADERS_SQL = """
   [{'k': 'sqs.message.id', 'v': message_id},
    {'k': 'sqs.receipt.handle', 'v': receipt_handle},
    {'k': 'sqs.md5.of.body', 'v': md5(body)},
    {'k': 'sqs.sent.timestamp', 'v': CAST(t_ms AS VARCHAR)},
    {'k': 'sqs.approximate.receive.count', 'v': '1'},
    {'k': 'sqs.approximate.first.receive.timestamp', 'v': CAST(t_ms AS VARCHAR)}]
   || CASE WHEN fifo THEN
     [{'k': 'sqs.message.group.id', 'v': CAST(user_id AS VARCHAR)},
      {'k': 'sqs.message.deduplication.id', 'v': CAST(user_id AS VARCHAR) || ':' || event_type},
      {'k': 'sqs.sequence.number', 'v': CAST(event_id AS VARCHAR)}]
     ELSE [] END"""
USER_HEADERS_SQL = """
   || [{'k': 'sqs.message.attribute.Type', 'v': event_type},
       {'k': 'sqs.message.attribute.Type.type', 'v': 'String'},
       {'k': 'sqs.message.attribute.price', 'v': price},
       {'k': 'sqs.message.attribute.price.type', 'v': 'Number'}]
   || CASE WHEN vip THEN
     [{'k': 'sqs.message.attribute.vip', 'v': 'gold'},
      {'k': 'sqs.message.attribute.vip.type', 'v': 'String'}]
     ELSE [] END"""


def headers_sql(listed: str) -> str:
    return f"""WITH {EVENTS_SQL}, h AS (SELECT message_id, {listed} AS l FROM ev),
    s AS (SELECT message_id, unnest(l) AS e, unnest(range(len(l))) AS position FROM h)
    SELECT message_id, CAST(position AS BIGINT) AS position, e.k AS header, e.v AS text FROM s"""


@query("record_headers", headers_sql(BASE_HEADERS_SQL))
def record_headers(spark, sf_dir):
    return exploded_headers(to_records(event_messages(spark, sf_dir), "events", with_attributes=False))


@query("record_attr_headers", headers_sql(BASE_HEADERS_SQL + USER_HEADERS_SQL))
def record_attr_headers(spark, sf_dir):
    return exploded_headers(to_records(event_messages(spark, sf_dir), "events"))


@query(
    "schema_type_header",
    headers_sql("[{'k': 'sqs.schema.type', 'v': 'JSON Schema'}] || " + BASE_HEADERS_SQL),
)
def schema_type_header(spark, sf_dir):
    return exploded_headers(
        to_records(event_messages(spark, sf_dir), "events", with_attributes=False, schema_type="json")
    )


@query(
    "fifo_key",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, message_id AS key_plain,
           CASE WHEN fifo THEN CAST(user_id AS VARCHAR) ELSE message_id END AS key_flagged
    FROM ev""",
)
def fifo_key(spark, sf_dir):
    """Keys with detection switched off, and with the ordered flag set for all."""
    m = event_messages(spark, sf_dir)
    plain = to_records(m, "t", fifo=False, fifo_auto_detect=False, keep=("attributes",))
    flagged = to_records(m, "t", fifo=True, keep=("attributes", "queue_url"))
    from_plain = plain.select("message_id", F.col("key").alias("key_plain"))
    from_flag = flagged.select("message_id", F.col("key").alias("key_flagged"))
    return from_plain.join(from_flag, "message_id")


@query(
    "pinned_partition",
    f"""WITH {EVENTS_SQL}
    SELECT 'pinned' AS topic, CAST(3 AS BIGINT) AS partition_number, COUNT(*) AS records FROM ev""",
)
def pinned_partition(spark, sf_dir):
    records = to_records(event_messages(spark, sf_dir), "pinned", partition=3)
    return records.groupBy("topic", F.col("partition").cast("bigint").alias("partition_number")).agg(
        F.count("*").alias("records")
    )


def extracted(spark, sf_dir, path, fail=False):
    records = to_records(event_messages(spark, sf_dir), "events")
    return extract_field(records, path, fail).select(
        "message_id", "value", F.coalesce("error_class", F.lit("")).alias("error_class")
    )


@query(
    "extract_field",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, replace(props, ' ', '') AS value, '' AS error_class FROM ev""",
)
def extract_object(spark, sf_dir):
    return extracted(spark, sf_dir, "detail.data")


@query(
    "extract_field_text",
    f"""WITH {EVENTS_SQL} SELECT message_id, event_type AS value, '' AS error_class FROM ev""",
)
def extract_text(spark, sf_dir):
    return extracted(spark, sf_dir, "detail-type")


@query(
    "extract_field_number",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, json_extract_string(props, '$.k') AS value, '' AS error_class FROM ev""",
)
def extract_number(spark, sf_dir):
    return extracted(spark, sf_dir, "detail.data.k")


@query(
    "extract_field_missing",
    f"""WITH {EVENTS_SQL} SELECT message_id, body AS value, '' AS error_class FROM ev""",
)
def extract_missing(spark, sf_dir):
    return extracted(spark, sf_dir, "detail.other")


@query(
    "extract_field_missing_fails",
    f"""WITH {EVENTS_SQL} SELECT message_id, body AS value, 'FieldMissing' AS error_class FROM ev""",
)
def extract_missing_fails(spark, sf_dir):
    return extracted(spark, sf_dir, "detail.other", True)


@query(
    "extract_json_null",
    """SELECT CAST(o_orderkey AS VARCHAR) AS message_id,
      CASE WHEN o_orderkey % 17 = 0 THEN '["' || CAST(o_orderkey AS VARCHAR) || '"]'
           WHEN o_orderkey % 19 = 0 THEN 'plain text ' || CAST(o_orderkey AS VARCHAR)
           ELSE 'null' END AS value,
      CASE WHEN o_orderkey % 17 = 0 THEN 'FieldMissing'
           WHEN o_orderkey % 19 = 0 THEN 'JsonError' ELSE '' END AS error_class
    FROM orders""",
)
def extract_json_null(spark, sf_dir):
    """A JSON null reads as the text ``null``; arrays and plain text have no field."""
    records = to_records(order_messages(spark, sf_dir), "orders")
    return extract_field(records, "memo", True).select(
        "message_id", "value", F.coalesce("error_class", F.lit("")).alias("error_class")
    )
