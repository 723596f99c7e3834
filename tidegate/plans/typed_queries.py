"""Queries over schema inference, typed conversion and the schema catalog."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F, types as T

from tidegate.operators.catalog import (
    fingerprint, latest_schemas, register_schemas, schema_by_id, schema_id_of, subject_name,
)
from tidegate.operators.records import to_records
from tidegate.operators.typed import (
    conform, infer_schema, inferred_fields, schema_drift, validation_report,
)
from tidegate.plans.envelopes import events, order_messages
from tidegate.plans.registry import query
from tidegate.session import run_dir
from tidegate.sinks.schema_log import SchemaLog

OBJECTS_SQL = """
objects AS (
  SELECT *, CAST(o_orderkey AS VARCHAR) AS message_id,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 50 END AS quantity
  FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0
)"""


def fields_sql(kinds: dict[str, str]) -> str:
    """Expected kind per path; how often a path occurs comes from the table."""
    where = {"status": "o_orderkey % 7 <> 0", "note": "o_orderkey % 11 = 0"}
    parts = [
        f"SELECT '{path}' AS path, '{kind}' AS kind, COUNT(*) AS n_messages FROM objects"
        f" WHERE {where.get(path, 'TRUE')}"
        for path, kind in kinds.items()
    ]
    return f"WITH {OBJECTS_SQL} " + " UNION ALL ".join(parts)


AVRO_KINDS = {
    "orderId": "string", "customer": "object", "customer.id": "int", "customer.priority": "string",
    "quantity": "string", "bigId": "long", "amount": "double", "open": "boolean",
    "tags": "array", "tags.[]": "string", "memo": "string", "status": "string", "note": "string",
}
JSON_KINDS = {**AVRO_KINDS, "customer.id": "long"}
PROTOBUF_KINDS = {**AVRO_KINDS, "customer": "string"}


def fields(spark, sf_dir, profile):
    found = inferred_fields(order_messages(spark, sf_dir), profile)
    return found.select(F.concat_ws(".", "path").alias("path"), "kind", "n_messages")


@query("infer_avro", fields_sql(AVRO_KINDS))
def infer_avro(spark, sf_dir):
    return fields(spark, sf_dir, "avro")


@query("infer_json", fields_sql(JSON_KINDS))
def infer_json(spark, sf_dir):
    return fields(spark, sf_dir, "json")


@query("infer_protobuf", fields_sql(PROTOBUF_KINDS))
def infer_protobuf(spark, sf_dir):
    return fields(spark, sf_dir, "protobuf")


NESTED_KINDS = {
    "lines": ("array", "TRUE"), "lines.[]": ("object", "n > 0"), "lines.[].sku": ("string", "n > 0"),
    "lines.[].sizes": ("array", "n > 0"), "lines.[].sizes.[]": ("array", "n > 0"),
    "lines.[].sizes.[].[]": ("long", "n > 0"), "none": ("array", "TRUE"), "deep": ("object", "TRUE"),
    "deep.er": ("object", "TRUE"), "deep.er.big": ("string", "TRUE"), "deep.er.half": ("double", "TRUE"),
}
NESTED_SQL = "WITH o AS (SELECT *, o_orderkey % 4 AS n FROM orders) " + " UNION ALL ".join(
    f"SELECT '{path}' AS path, '{kind}' AS kind, COUNT(*) AS n_messages FROM o WHERE {where}"
    for path, (kind, where) in NESTED_KINDS.items()
)


@query("infer_nested_arrays", NESTED_SQL)
def infer_nested_arrays(spark, sf_dir):
    """Arrays speak through their first element, at any depth; the second line of an order is
    of another shape and does not count."""
    key = F.col("o_orderkey")
    line = F.concat(F.lit('{"sku":"'), key.cast("string"), F.lit('","sizes":[['), (key * 3_000_000_000).cast("string"), F.lit("],7]}"))
    lines = F.when(key % 4 > 0, F.concat(line, F.lit(',{"other":true}'))).otherwise("")
    big = F.when(key % 2 == 0, "12345678901234567890").otherwise('"text"')
    body = F.concat(
        F.lit('{"lines":['), lines, F.lit('],"none":[],"deep":{"er":{"big":'), big, F.lit(',"half":'),
        F.when(key % 3 == 0, "1.5").otherwise("2"), F.lit("}}}"),
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(body.alias("body"))
    return inferred_fields(orders, "avro").select(F.concat_ws(".", "path").alias("path"), "kind", "n_messages")


@query(
    "infer_first_only",
    """SELECT 'orderId' AS field, 'string' AS type UNION ALL SELECT 'first', 'int' UNION ALL SELECT 'second', 'boolean'""",
)
def infer_first_only(spark, sf_dir):
    """The schema of the earliest body alone: later ones have other types."""
    messages = order_messages(spark, sf_dir)
    least = messages.agg(F.min(F.col("message_id").cast("bigint"))).first()[0]
    earliest = F.col("message_id").cast("bigint") == least
    body = F.when(earliest, '{"orderId":"x","first":1,"second":true}').otherwise('{"orderId":5,"first":"y","third":[1]}')
    aged = messages.withColumns({
        "body": body, "received_at": F.timestamp_seconds(F.col("message_id").cast("bigint")),
    })
    schema = infer_schema(aged, "avro", first_only=True)
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "field string, type string")


ORDER_SCHEMA = T.StructType(
    [
        T.StructField("orderId", T.LongType()),
        T.StructField(
            "customer",
            T.StructType([T.StructField("id", T.LongType()), T.StructField("priority", T.StringType())]),
        ),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("bigId", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("open", T.BooleanType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("memo", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("absent", T.StringType()),
    ]
)

CONFORM_SQL = f"""WITH {OBJECTS_SQL}
SELECT message_id, o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS priority,
       coalesce(CAST(quantity AS VARCHAR), 'null') AS quantity, o_orderkey + 9000000000 AS big_id,
       CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus = 'O' AS is_open,
       o_orderstatus || '|t' || CAST(o_orderkey % 3 AS VARCHAR) AS tags,
       CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE o_orderstatus END AS status,
       TRUE AS memo_null, TRUE AS absent_null
FROM objects"""


@query("conform_typed", CONFORM_SQL)
def conform_typed(spark, sf_dir):
    rows = conform(order_messages(spark, sf_dir), ORDER_SCHEMA, "avro").where("typed IS NOT NULL")
    return rows.select(
        "message_id", F.col("typed.orderId").alias("order_id"),
        F.col("typed.customer.id").alias("customer_id"), F.col("typed.customer.priority").alias("priority"),
        F.coalesce(F.col("typed.quantity").cast("string"), F.lit("null")).alias("quantity"),
        F.col("typed.bigId").alias("big_id"),
        F.round(F.col("typed.amount") * 100).cast("bigint").alias("cents"),
        F.col("typed.open").alias("is_open"), F.concat_ws("|", "typed.tags").alias("tags"),
        F.coalesce("typed.status", F.lit("null")).alias("status"),
        F.col("typed.memo").isNull().alias("memo_null"), F.col("typed.absent").isNull().alias("absent_null"),
    )


FLAT_SCHEMA = T.StructType(
    [
        T.StructField("orderId", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("open", T.BooleanType()),
        T.StructField("memo", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("absentNumber", T.LongType()),
        T.StructField("absentList", T.ArrayType(T.StringType())),
        T.StructField("absentFlag", T.BooleanType()),
    ]
)


@query(
    "conform_proto_defaults",
    """SELECT CAST(o_orderkey AS VARCHAR) AS message_id,
         CASE WHEN text_value THEN 'text' ELSE 'typed' END AS form,
         CASE WHEN text_value THEN -1 ELSE o_orderkey % 50 END AS quantity,
         CASE WHEN text_value THEN '-' ELSE '' END AS memo,
         CASE WHEN text_value THEN '-' WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderstatus END AS status,
         CAST(CASE WHEN text_value THEN -1 ELSE 0 END AS BIGINT) AS absent_number,
         CAST(CASE WHEN text_value THEN -1 ELSE 0 END AS BIGINT) AS absent_items,
         CASE WHEN text_value THEN '-' ELSE 'false' END AS absent_flag
    FROM (SELECT *, o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 13 = 0 AS text_value FROM orders)""",
)
def conform_proto_defaults(spark, sf_dir):
    """Absent fields read as their defaults; a body that does not fit stays text."""
    rows = conform(order_messages(spark, sf_dir), FLAT_SCHEMA, "protobuf")
    typed = F.col("typed").isNotNull()
    return rows.select(
        "message_id", F.when(typed, "typed").otherwise("text").alias("form"),
        F.coalesce(F.col("typed.quantity").cast("bigint"), F.lit(-1)).alias("quantity"),
        F.coalesce("typed.memo", F.lit("-")).alias("memo"),
        F.coalesce("typed.status", F.lit("-")).alias("status"),
        F.coalesce("typed.absentNumber", F.lit(-1)).alias("absent_number"),
        F.when(typed, F.size("typed.absentList")).otherwise(-1).cast("bigint").alias("absent_items"),
        F.coalesce(F.col("typed.absentFlag").cast("string"), F.lit("-")).alias("absent_flag"),
    )


@query(
    "non_object_passthrough",
    """SELECT CAST(o_orderkey AS VARCHAR) AS message_id,
         CASE WHEN o_orderkey % 17 = 0 THEN '["' || CAST(o_orderkey AS VARCHAR) || '"]'
              ELSE 'plain text ' || CAST(o_orderkey AS VARCHAR) END AS value
    FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 19 = 0""",
)
def non_object_passthrough(spark, sf_dir):
    rows = conform(order_messages(spark, sf_dir), ORDER_SCHEMA, "json").where("typed IS NULL")
    return to_records(rows, "orders", value=F.col("raw")).select("message_id", "value")


@query(
    "typed_records",
    f"""WITH {OBJECTS_SQL}
    SELECT message_id, 'Avro' AS schema_type, o_custkey AS customer_id FROM objects""",
)
def typed_records(spark, sf_dir):
    rows = conform(order_messages(spark, sf_dir), ORDER_SCHEMA, "avro").where("typed IS NOT NULL")
    records = to_records(rows, "orders", schema_type="avro", value=F.col("typed"))
    return records.select(
        "message_id", F.col("headers")[0]["value"].cast("string").alias("schema_type"),
        F.col("value.customer.id").alias("customer_id"),
    )


@query(
    "schema_drift",
    f"""WITH {OBJECTS_SQL}
    SELECT message_id,
           CASE WHEN o_orderkey % 7 = 0 THEN 'absent,status' ELSE 'absent' END AS missing,
           CASE WHEN o_orderkey % 11 = 0 THEN 'note' ELSE '' END AS extra, FALSE AS reusable
    FROM objects""",
)
def drift(spark, sf_dir):
    return schema_drift(order_messages(spark, sf_dir), ORDER_SCHEMA).select(
        "message_id", F.concat_ws(",", "missing").alias("missing"),
        F.concat_ws(",", "extra").alias("extra"), "reusable",
    )


@query(
    "schema_reuse",
    f"""WITH {OBJECTS_SQL}
    SELECT o_orderkey % 7 <> 0 AS reusable, COUNT(*) AS messages FROM objects GROUP BY ALL""",
)
def reuse(spark, sf_dir):
    """Extra fields do not hinder reuse of a cached schema; a missing one does."""
    known = T.StructType([f for f in ORDER_SCHEMA.fields if f.name != "absent"])
    rows = schema_drift(order_messages(spark, sf_dir), known)
    return rows.groupBy("reusable").agg(F.count("*").alias("messages"))


@query(
    "validation_report",
    f"""WITH {OBJECTS_SQL}
    SELECT message_id, 'absent' AS field, 'missing_required' AS violation FROM objects
    UNION ALL SELECT message_id, 'status', 'missing_required' FROM objects WHERE o_orderkey % 7 = 0
    UNION ALL SELECT message_id, 'note', 'extra' FROM objects WHERE o_orderkey % 11 = 0
    UNION ALL SELECT message_id, 'orderId', 'wrong_type' FROM objects
    UNION ALL SELECT message_id, 'quantity', 'wrong_type' FROM objects WHERE o_orderkey % 13 = 0""",
)
def validation(spark, sf_dir):
    return validation_report(order_messages(spark, sf_dir), ORDER_SCHEMA)


# --- catalog ----------------------------------------------------------------------

CATALOG_SQL = """
catalog AS (
  SELECT event_type || '-value' AS subject, event_id + 1 AS version, 'json' AS profile,
         props AS schema_json, md5('json' || chr(10) || props) AS fingerprint,
         CAST('0x' || substr(md5('json' || chr(10) || props), 1, 12) AS BIGINT) AS schema_id
  FROM events
)"""


def catalog(spark, sf_dir):
    """Schema versions per topic, one per event."""
    e = events(spark, sf_dir)
    mark = fingerprint(F.lit("json"), F.col("props"))
    return e.select(
        subject_name(F.col("event_type")).alias("subject"), (F.col("event_id") + 1).alias("version"),
        F.lit("json").alias("profile"), F.col("props").alias("schema_json"),
        mark.alias("fingerprint"), schema_id_of(mark).alias("schema_id"),
    )


@query(
    "schema_latest",
    f"""WITH {CATALOG_SQL}
    SELECT subject, MAX(version) AS version, arg_max(schema_id, version) AS schema_id,
           arg_max(schema_json, version) AS schema_json FROM catalog GROUP BY subject""",
)
def schema_latest(spark, sf_dir):
    return latest_schemas(catalog(spark, sf_dir))


@query(
    "schema_by_id",
    f"""WITH {CATALOG_SQL}
    SELECT subject, version, schema_json FROM catalog
    WHERE fingerprint = md5('json' || chr(10) || '{{"k": 9}}')""",
)
def by_id(spark, sf_dir):
    import hashlib

    mark = hashlib.md5(b'json\n{"k": 9}').hexdigest()
    found = schema_by_id(catalog(spark, sf_dir), int(mark[:12], 16))
    return found.select("subject", "version", "schema_json")


@query(
    "schema_register",
    f"""WITH {CATALOG_SQL}, candidates AS (
      SELECT DISTINCT subject, schema_json, md5('json' || chr(10) || schema_json) AS fingerprint FROM (
        SELECT event_type || '-value' AS subject,
               CASE WHEN user_id % 2 = 0 THEN props ELSE '{{"u": ' || CAST(user_id AS VARCHAR) || '}}' END AS schema_json
        FROM events)
    ), fresh AS (
      SELECT * FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM catalog k WHERE k.subject = c.subject AND k.fingerprint = c.fingerprint)
    )
    SELECT f.subject, f.schema_json,
           (SELECT MAX(version) FROM catalog k WHERE k.subject = f.subject)
             + row_number() OVER (PARTITION BY f.subject ORDER BY f.fingerprint) AS version,
           CAST('0x' || substr(f.fingerprint, 1, 12) AS BIGINT) AS schema_id
    FROM fresh f""",
)
def register(spark, sf_dir):
    """Half of the candidates are known already, the others get the next versions."""
    e = events(spark, sf_dir)
    candidates = e.select(
        subject_name(F.col("event_type")).alias("subject"), F.lit("json").alias("profile"),
        F.when(F.col("user_id") % 2 == 0, F.col("props")).otherwise(
            F.concat(F.lit('{"u": '), F.col("user_id").cast("string"), F.lit("}"))
        ).alias("schema_json"),
    )
    added = register_schemas(catalog(spark, sf_dir), candidates)
    return added.select("subject", "schema_json", "version", "schema_id")


@query(
    "subject_names",
    """SELECT DISTINCT event_type AS topic, event_type || '-value' AS value_subject,
              event_type || '-key' AS key_subject FROM events""",
)
def subjects(spark, sf_dir):
    topic = F.col("event_type")
    return events(spark, sf_dir).select(
        topic.alias("topic"), subject_name(topic).alias("value_subject"),
        subject_name(topic, True).alias("key_subject"),
    ).distinct()


@query(
    "schema_register_writers",
    """SELECT event_type || '-value' AS subject, COUNT(DISTINCT props) AS schemas,
              CAST(1 AS BIGINT) AS first_version, COUNT(DISTINCT props) AS last_version,
              COUNT(DISTINCT props) AS different_versions, COUNT(DISTINCT props) AS different_ids
       FROM events GROUP BY event_type""",
)
def schema_register_writers(spark, sf_dir):
    """Three writers register overlapping thirds at once; versions come out dense."""
    e = events(spark, sf_dir)
    rows = e.select(
        subject_name(F.col("event_type")).alias("subject"), F.lit("json").alias("profile"),
        F.col("props").alias("schema_json"), (F.col("event_id") % 3).alias("third"),
    )
    root = run_dir(spark, "schema-log")

    def write(third):
        SchemaLog(spark, root).register(rows.where((F.col("third") == third) | (F.col("third") == (third + 1) % 3)))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    return SchemaLog(spark, root).read().groupBy("subject").agg(
        F.count("*").alias("schemas"), F.min("version").alias("first_version"), F.max("version").alias("last_version"),
        F.countDistinct("version").alias("different_versions"), F.countDistinct("schema_id").alias("different_ids"),
    )
