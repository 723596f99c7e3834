"""Literal messages for the tests."""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import zlib

from tidegate.schemas import MESSAGE_SCHEMA

QUEUE = "https://queue.example.com/123456789012/test-queue"
EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def text(value, kind="String"):
    return {"data_type": kind, "string_value": value, "binary_value": None}


def message(message_id="msg-1", body="test body", attributes=None, user=None, queue=QUEUE,
            at_ms=0, md5="md5", receipt=None):
    return {
        "message_id": message_id,
        "receipt_handle": receipt or f"receipt-{message_id}",
        "body": body,
        "md5_of_body": md5,
        "attributes": attributes or {},
        "message_attributes": {
            k: v if isinstance(v, dict) else text(v) for k, v in (user or {}).items()
        },
        "queue_url": queue,
        "received_at": EPOCH + dt.timedelta(milliseconds=at_ms),
    }


def frame(spark, messages):
    return spark.createDataFrame(messages, MESSAGE_SCHEMA)


def bodies(spark, *texts):
    return frame(spark, [message(f"msg-{i}", b) for i, b in enumerate(texts)])


def in_order(df, *columns):
    rows = df.select("message_id", *columns).collect()
    rows.sort(key=lambda r: int(r.message_id.split("-")[-1]))
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]


def gz64(plain: str) -> str:
    return base64.b64encode(gzip.compress(plain.encode(), mtime=0)).decode()


def zl64(plain: str) -> str:
    return base64.b64encode(zlib.compress(plain.encode())).decode()
