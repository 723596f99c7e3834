"""Named queries over the given tables, each with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


# The event envelopes in SQL.
EVENTS_SQL = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id,
         event_id, user_id, event_type, value, props,
         'receipt-' || CAST(event_id AS VARCHAR) AS receipt_handle,
         CASE user_id % 3
           WHEN 0 THEN 'https://queue.example.com/100/orders'
           WHEN 1 THEN 'https://queue.example.com/100/alerts'
           ELSE 'https://queue.example.com/100/audit.fifo' END AS queue_url,
         user_id % 3 = 2 AS fifo,
         user_id % 5 = 0 AS vip,
         '{"version":"0","detail-type":"' || event_type || '","detail":{"data":' || props || '}}' AS body,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS price,
         CAST(value AS DECIMAL(18,2)) AS price_number,
         epoch_us(ts) // 1000 AS t_ms
  FROM events
)"""
