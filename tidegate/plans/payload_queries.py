"""Queries over body decoding and object lookup."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F, types as T

from tidegate.functions.payload import base64_bytes, detect_compression, is_likely_base64
from tidegate.operators.claimcheck import claim_check, decode_and_fetch
from tidegate.operators.decompress import decompress_body, decompress_safe
from tidegate.plans.envelopes import (
    BUCKET, document_messages, document_objects, document_uri, event_messages, json_string,
    kind_of, packed_base64, page_event_messages, plain_message, table,
)
from tidegate.plans.registry import EVENTS_SQL, query
from tidegate.sources.objects import parse_object_uri


def text_check(df, value=None):
    value = F.col("body") if value is None else value
    return df.select(
        "message_id", F.md5(value).alias("text_md5"),
        F.length(value).cast("bigint").alias("text_length"),
        F.coalesce("error_class", F.lit("")).alias("error_class"),
    )


@query(
    "base64_detect",
    r"""SELECT doc_id, doc_id % 3 <> 0
             OR (length(text) >= 16 AND regexp_full_match(text, '[A-Za-z0-9+/\-_]+={0,2}')) AS likely
    FROM documents""",
)
def base64_detect(spark, sf_dir):
    return document_messages(spark, sf_dir).select(
        F.col("message_id").cast("bigint").alias("doc_id"), is_likely_base64(F.col("body")).alias("likely")
    )


@query(
    "compression_detect",
    """SELECT CASE doc_id % 3 WHEN 1 THEN 'GZIP' WHEN 2 THEN 'ZLIB' ELSE 'NONE' END AS format,
              COUNT(*) AS objects
    FROM documents GROUP BY ALL""",
)
def compression_detect(spark, sf_dir):
    objects = document_objects(spark, sf_dir)
    return objects.groupBy(detect_compression(F.col("content")).alias("format")).agg(
        F.count("*").alias("objects")
    )


@query(
    "decompress_body",
    """SELECT CAST(doc_id AS VARCHAR) AS message_id, md5(text) AS text_md5,
              CAST(length(text) AS BIGINT) AS text_length, '' AS error_class FROM documents""",
)
def decompress_whole(spark, sf_dir):
    return text_check(decompress_body(document_messages(spark, sf_dir)))


@query(
    "decompress_body_gzip",
    """SELECT CAST(doc_id AS VARCHAR) AS message_id,
              CASE WHEN doc_id % 3 = 1 THEN md5(text) END AS text_md5,
              CASE doc_id % 3 WHEN 1 THEN '' ELSE 'DecompressionError' END AS error_class
    FROM documents""",
)
def decompress_fixed_format(spark, sf_dir):
    """A fixed format fails on bodies that are packed otherwise; they stay marked."""
    done = decompress_body(document_messages(spark, sf_dir), "GZIP")
    return done.select(
        "message_id",
        F.when(F.col("error_class").isNull(), F.md5("body")).alias("text_md5"),
        F.coalesce("error_class", F.lit("")).alias("error_class"),
    )


@query(
    "decompress_field",
    """SELECT CAST(page_id AS VARCHAR) AS message_id, md5(html) AS text_md5,
              CAST(length(html) AS BIGINT) AS text_length, '' AS error_class FROM pages""",
)
def decompress_leaf(spark, sf_dir):
    done = decompress_body(page_event_messages(spark, sf_dir), path="detail.data")
    return text_check(done, F.get_json_object("body", "$.detail.data"))


@query(
    "decompress_field_json",
    """SELECT CAST(o_orderkey AS VARCHAR) AS message_id,
              CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS status
    FROM orders""",
)
def decompress_leaf_json(spark, sf_dir):
    """A packed JSON leaf comes back as an object."""
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    inner = F.concat(
        F.lit('{"customer":'), F.col("o_custkey").cast("string"),
        F.lit(',"status":"'), F.col("o_orderstatus"), F.lit('"}'),
    )
    leaf = o.select("o_orderkey", packed_base64(kind_of(F.col("o_orderkey")), inner).alias("leaf"))
    body = F.concat(F.lit('{"detail":{"data":'), json_string(F.col("leaf")), F.lit("}}"))
    done = decompress_body(leaf.select(*plain_message(F.col("o_orderkey"), body)), path="detail.data")
    return done.select(
        "message_id",
        F.get_json_object("body", "$.detail.data.customer").alias("customer"),
        F.get_json_object("body", "$.detail.data.status").alias("status"),
    )


@query(
    "decompress_field_untouched",
    f"""WITH {EVENTS_SQL} SELECT message_id, body, '' AS error_class FROM ev""",
)
def decompress_leaf_untouched(spark, sf_dir):
    """A leaf that is an object, not text, leaves the body as it came."""
    done = decompress_body(event_messages(spark, sf_dir), path="detail.data")
    return done.select("message_id", "body", F.coalesce("error_class", F.lit("")).alias("error_class"))


@F.pandas_udf(T.StringType())
def cut_short(texts: pd.Series) -> pd.Series:
    return texts.str[:-8]


@query(
    "decompress_safe",
    """SELECT CAST(doc_id AS VARCHAR) AS message_id, doc_id % 3 = 2 AS kept,
              CASE WHEN doc_id % 3 = 2 THEN '' ELSE md5(text) END AS text_md5 FROM documents""",
)
def decompress_or_keep(spark, sf_dir):
    """Streams cut short stay as they are."""
    m = document_messages(spark, sf_dir)
    damaged = (F.col("message_id").cast("bigint") % 3) == 2
    m = m.withColumn("body", F.when(damaged, cut_short("body")).otherwise(F.col("body")))
    m = m.withColumn("safe", decompress_safe(F.col("body")))
    kept = damaged & (F.col("safe") == F.col("body"))
    return m.select(
        "message_id", kept.alias("kept"),
        F.when(kept, "").otherwise(F.md5("safe")).alias("text_md5"),
    )


@query(
    "base64_strict",
    """WITH packed AS (
      SELECT doc_id, text, rtrim(to_base64(encode(text)), '=') AS bare FROM documents WHERE length(text) > 3
    ), spoilt AS (
      SELECT *, CASE doc_id % 5
        WHEN 1 THEN TRUE
        WHEN 2 THEN NOT regexp_matches(bare, '[+/]') AND len(bare) % 4 <> 1
        WHEN 3 THEN FALSE WHEN 4 THEN FALSE ELSE TRUE END AS good FROM packed)
    SELECT doc_id, CASE WHEN good THEN md5(text) END AS decoded_md5 FROM spoilt""",
)
def base64_strict(spark, sf_dir):
    """Whole texts in base64: as it is, without padding, in the url alphabet, with a line
    feed, one character too long."""
    d = table(spark, sf_dir, "documents", ["doc_id", "text"]).where("length(text) > 3")
    packed = F.base64(F.col("text").cast("binary"))
    # Spark's writer may break lines; the standard form has none.
    packed = F.regexp_replace(packed, "[\\r\\n]", "")
    bare = F.rtrim(packed, F.lit("="))
    spoilt = (
        F.when(F.col("doc_id") % 5 == 1, bare).when(F.col("doc_id") % 5 == 2, F.translate(bare, "+/", "-_"))
        .when(F.col("doc_id") % 5 == 3, F.concat(F.substring(bare, 1, 4), F.lit("\n"), F.substring(bare, 5, 1 << 30)))
        .when(F.col("doc_id") % 5 == 4, F.concat(F.left(bare, (F.length(bare) - F.length(bare) % 4).cast("int")), F.lit("A")))
        .otherwise(packed)
    )
    return d.select("doc_id", F.md5(base64_bytes(spoilt)).alias("decoded_md5"))


@query(
    "object_uri_parse",
    """SELECT CAST(doc_id AS VARCHAR) AS message_id,
         CASE WHEN doc_id % 5 IN (0, 1, 2) THEN '' ELSE 'ingest-bucket' END AS bucket,
         CASE WHEN doc_id % 5 IN (0, 1, 2) THEN ''
              ELSE CASE WHEN doc_id % 10 = 0 THEN 'gone/' ELSE 'docs/' END || CAST(doc_id AS VARCHAR) || '.bin' END AS object_key
    FROM documents""",
)
def object_uri_parse(spark, sf_dir):
    d = table(spark, sf_dir, "documents", ["doc_id"])
    n = F.col("doc_id") % 5
    uri = (
        F.when(n == 0, F.lit("http://x/y")).when(n == 1, F.lit("s3://only-bucket"))
        .when(n == 2, F.lit("s3:///key")).otherwise(document_uri(F.col("doc_id")))
    )
    parsed = parse_object_uri(uri)
    return d.select(
        F.col("doc_id").cast("string").alias("message_id"),
        F.coalesce(parsed["bucket"], F.lit("")).alias("bucket"),
        F.coalesce(parsed["key"], F.lit("")).alias("object_key"),
    )


CLAIM_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS message_id,
       CASE WHEN doc_id % 4 <> 3 AND doc_id % 10 = 0 THEN '' ELSE md5(text) END AS text_md5,
       CASE WHEN doc_id % 4 <> 3 AND doc_id % 10 = 0 THEN 'ObjectNotFound' ELSE '' END AS error_class
FROM documents"""


def claim_messages(spark, sf_dir, wrap=None):
    """Three of four documents by reference, the fourth in full (mixed mode)."""
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    leaf = F.when(
        F.col("doc_id") % 4 != 3, F.concat(F.lit(" "), document_uri(F.col("doc_id")))
    ).otherwise(F.col("text"))
    return d.select(*plain_message(F.col("doc_id"), wrap(leaf) if wrap else leaf))


def claim_result(df, value):
    good = F.col("error_class").isNull()
    return df.select(
        "message_id", F.when(good, F.md5(value)).otherwise("").alias("text_md5"),
        F.coalesce("error_class", F.lit("")).alias("error_class"),
    )


@query("claim_check_body", CLAIM_SQL)
def claim_check_body(spark, sf_dir):
    done = claim_check(claim_messages(spark, sf_dir), document_objects(spark, sf_dir), fmt="AUTO")
    return claim_result(done, F.col("body"))


@query("claim_check_duplicate_objects", CLAIM_SQL)
def claim_check_duplicate_objects(spark, sf_dir):
    """A listing that names objects twice does not multiply messages."""
    objects = document_objects(spark, sf_dir)
    done = claim_check(claim_messages(spark, sf_dir), objects.unionByName(objects), fmt="AUTO")
    return claim_result(done, F.col("body"))


@query("claim_check_field", CLAIM_SQL)
def claim_check_field(spark, sf_dir):
    wrap = lambda leaf: F.concat(
        F.lit('{"version":"0","detail":{"s3Key":'), json_string(leaf), F.lit("}}")
    )
    done = claim_check(
        claim_messages(spark, sf_dir, wrap), document_objects(spark, sf_dir), "detail.s3Key", "AUTO"
    )
    return claim_result(done, F.get_json_object("body", "$.detail.s3Key"))


@query(
    "claim_check_missing",
    """SELECT CASE doc_id % 10 WHEN 0 THEN 'ObjectNotFound' WHEN 5 THEN 'InvalidUri' ELSE '' END AS error_class,
              COUNT(*) AS messages
    FROM documents GROUP BY ALL""",
)
def claim_check_missing(spark, sf_dir):
    d = table(spark, sf_dir, "documents", ["doc_id"])
    uri = F.when(F.col("doc_id") % 10 == 5, F.lit("s3://bucket-alone")).otherwise(
        document_uri(F.col("doc_id"))
    )
    done = claim_check(
        d.select(*plain_message(F.col("doc_id"), uri)), document_objects(spark, sf_dir)
    )
    return done.groupBy(F.coalesce("error_class", F.lit("")).alias("error_class")).agg(
        F.count("*").alias("messages")
    )


@query(
    "claim_check_hot_object",
    f"""WITH {EVENTS_SQL}, refs AS (
      SELECT message_id, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE user_id % 100 + 1 END AS doc_id FROM ev)
    SELECT message_id,
           CASE WHEN d.doc_id % 10 = 0 THEN '' ELSE md5(d.text) END AS text_md5,
           CASE WHEN d.doc_id % 10 = 0 THEN 'ObjectNotFound' ELSE '' END AS error_class
    FROM refs JOIN documents d USING (doc_id)""",
)
def claim_check_hot_object(spark, sf_dir):
    """Two of five messages point at one object."""
    e = table(spark, sf_dir, "events", ["event_id", "user_id", "event_type"])
    target = F.when(F.col("event_type").isin("click", "view"), F.lit(1)).otherwise(
        F.col("user_id") % 100 + 1
    )
    refs = e.select(*plain_message(F.col("event_id"), document_uri(target)))
    return claim_result(claim_check(refs, document_objects(spark, sf_dir), fmt="AUTO"), F.col("body"))


@query(
    "decode_and_fetch",
    """SELECT CAST(doc_id AS VARCHAR) AS message_id,
       CASE WHEN doc_id % 4 = 0 AND doc_id % 10 = 0 THEN '' ELSE md5(text) END AS text_md5,
       CASE WHEN doc_id % 4 = 0 AND doc_id % 10 = 0 THEN 'ObjectNotFound' ELSE '' END AS error_class
    FROM documents""",
)
def decode_then_fetch(spark, sf_dir):
    """By id: an address, packed text, a packed address, plain text."""
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    n = F.col("doc_id") % 4
    plain_uri = F.concat(F.lit(f"s3://{BUCKET}/plain/"), F.col("doc_id").cast("string"))
    leaf = (
        F.when(n == 0, document_uri(F.col("doc_id")))
        .when(n == 2, plain_uri).otherwise(F.col("text"))
    )
    kind = F.when(n.isin(1, 2), F.lit("gzip")).otherwise(F.lit("none"))
    rows = d.select("doc_id", packed_base64(kind, leaf).alias("leaf"))
    body = F.concat(F.lit('{"detail":{"data":'), json_string(F.col("leaf")), F.lit("}}"))
    objects = document_objects(spark, sf_dir).unionByName(
        d.select(plain_uri.alias("uri"), F.col("text").cast("binary").alias("content"))
    )
    done = decode_and_fetch(rows.select(*plain_message(F.col("doc_id"), body)), objects, "detail.data")
    return claim_result(done, F.get_json_object("body", "$.detail.data"))
