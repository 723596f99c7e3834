"""Queries over de-duplication, order, retry, dead letters and acknowledgement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions.backoff import backoff_ms
from tidegate.operators.ack import ack_ledger, pending
from tidegate.operators.deadletter import to_dlq
from tidegate.operators.dedup import flag_duplicates, tracked_ids
from tidegate.operators.filtering import filter_messages
from tidegate.operators.ordering import fifo_order, group_positions
from tidegate.operators.retry import (
    RetryPolicy, remaining_backoff_ms, retry_decisions, retry_status,
)
from tidegate.plans.envelopes import QUEUES, event_messages, events
from tidegate.plans.registry import EVENTS_SQL, query

DAY_MS = 86_400_000


def dedup_sql(window_ms: int, select: str, id_sql: str = "user_id || ':' || event_type") -> str:
    """Rows of an id in time order; each carries the expiry the row before left."""
    return f"""WITH RECURSIVE {EVENTS_SQL}, ids AS (
      SELECT message_id, queue_url, t_ms, {id_sql} AS id,
             row_number() OVER (PARTITION BY {id_sql} ORDER BY t_ms, message_id) AS rn
      FROM ev WHERE fifo
    ), fold AS (
      SELECT id, rn, message_id, t_ms, FALSE AS duplicate, t_ms + {window_ms} AS expiry
      FROM ids WHERE rn = 1
      UNION ALL
      SELECT i.id, i.rn, i.message_id, i.t_ms, i.t_ms < f.expiry,
             CASE WHEN i.t_ms < f.expiry THEN f.expiry ELSE i.t_ms + {window_ms} END
      FROM fold f JOIN ids i ON i.id = f.id AND i.rn = f.rn + 1
    ) {select}"""


ALL_FLAGS = """
    SELECT message_id, duplicate FROM fold
    UNION ALL SELECT message_id, FALSE FROM ev WHERE NOT fifo"""


@query("fifo_dedup", dedup_sql(300_000, ALL_FLAGS))
def fifo_dedup(spark, sf_dir):
    return flag_duplicates(event_messages(spark, sf_dir)).select("message_id", "duplicate")


@query("fifo_dedup_days", dedup_sql(4 * DAY_MS, ALL_FLAGS))
def fifo_dedup_days(spark, sf_dir):
    """A window so wide that most ids repeat within it."""
    return flag_duplicates(event_messages(spark, sf_dir), 4 * DAY_MS).select("message_id", "duplicate")


HOT_ID_SQL = "CASE WHEN event_type IN ('click', 'view') THEN 'hot' ELSE user_id || ':' || event_type END"


@query("fifo_dedup_hot_id", dedup_sql(3_600_000, ALL_FLAGS, HOT_ID_SQL))
def fifo_dedup_hot_id(spark, sf_dir):
    """One id holds two fifths of an ordered queue."""
    m = event_messages(spark, sf_dir)
    kind = F.get_json_object("body", "$['detail-type']")
    hot = F.transform_values(
        "attributes",
        lambda k, v: F.when((k == "MessageDeduplicationId") & kind.isin("click", "view"), "hot").otherwise(v),
    )
    return flag_duplicates(m.withColumn("attributes", hot), 3_600_000).select("message_id", "duplicate")


DENSE_SQL = dedup_sql(7, """
    SELECT message_id, duplicate FROM fold""", "'all'").replace(
    "SELECT message_id, queue_url, t_ms,", "SELECT message_id, queue_url, event_id % 500 AS t_ms,"
).replace("ORDER BY t_ms, message_id", "ORDER BY event_id % 500, message_id")


@query("fifo_dedup_dense_hot", DENSE_SQL)
def fifo_dedup_dense_hot(spark, sf_dir):
    """One id holds a whole ordered queue, within half a second: its rows are dealt to many
    segments, single milliseconds too."""
    m = event_messages(spark, sf_dir).where(F.col("queue_url").endswith(".fifo"))
    hot = F.transform_values(
        "attributes", lambda k, v: F.when(k == "MessageDeduplicationId", "hot").otherwise(v)
    )
    dense = m.withColumns({
        "attributes": hot, "received_at": F.timestamp_millis(F.col("message_id").cast("bigint") % 500),
    })
    return flag_duplicates(dense, 7, dense_rows=5).select("message_id", "duplicate")


@query(
    "dedup_emitted",
    dedup_sql(4 * DAY_MS, """
    SELECT queue_url, COUNT(*) AS emitted, MIN(t_ms) AS first_ms FROM (
      SELECT message_id FROM fold WHERE NOT duplicate
      UNION ALL SELECT message_id FROM ev WHERE NOT fifo) JOIN ev USING (message_id)
    GROUP BY queue_url"""),
)
def dedup_emitted(spark, sf_dir):
    kept = flag_duplicates(event_messages(spark, sf_dir), 4 * DAY_MS).where(~F.col("duplicate"))
    return kept.groupBy("queue_url").agg(
        F.count("*").alias("emitted"), F.min(F.unix_millis("received_at")).alias("first_ms")
    )


@query(
    "dedup_tracked_count",
    dedup_sql(4 * DAY_MS, f"""
    SELECT '{QUEUES[2]}' AS queue_url,
           CAST(COUNT(*) FILTER (expiry > 1706000000000) AS BIGINT) AS tracked_count
    FROM (SELECT id, MAX(expiry) AS expiry FROM fold GROUP BY id)"""),
)
def dedup_tracked_count(spark, sf_dir):
    flagged = flag_duplicates(event_messages(spark, sf_dir), 4 * DAY_MS)
    return tracked_ids(flagged, F.lit(1706000000000), 4 * DAY_MS)


@query(
    "fifo_order",
    f"""WITH {EVENTS_SQL}
    SELECT queue_url, CAST(user_id AS VARCHAR) AS group_id, message_id,
           row_number() OVER (PARTITION BY queue_url, user_id ORDER BY event_id) AS position
    FROM ev WHERE fifo""",
)
def fifo_positions(spark, sf_dir):
    ordered = group_positions(event_messages(spark, sf_dir), span=1000)
    return ordered.select("queue_url", "group_id", "message_id", "position")


@query(
    "fifo_ordered_rows",
    f"""WITH {EVENTS_SQL}
    SELECT queue_url, message_id, CAST(event_id AS VARCHAR) AS sequence_text FROM ev WHERE fifo""",
)
def fifo_ordered_rows(spark, sf_dir):
    fifo = event_messages(spark, sf_dir).where(F.col("queue_url").endswith(".fifo"))
    return fifo_order(fifo).select(
        "queue_url", "message_id", F.col("sequence").cast("string").alias("sequence_text")
    )


# --- retry ------------------------------------------------------------------------

DELIVERIES_SQL = f"""{EVENTS_SQL}, deliveries AS (
  SELECT event_id, queue_url, t_ms, event_type || '-' || CAST(user_id % 7 AS VARCHAR) AS mid,
         user_id % 3 <> 0 OR vip AS failed, receipt_handle,
         'failure of event ' || message_id AS error_message
  FROM ev
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY queue_url, mid ORDER BY t_ms, failed, receipt_handle) AS rn
  FROM deliveries
)"""


def retry_sql(max_retries: int, base_ms: int, select: str) -> str:
    wait = f"CAST(LEAST(600000, GREATEST(1, FLOOR({base_ms} * POW(2.0, n)))) AS BIGINT)"
    return f"""WITH RECURSIVE {DELIVERIES_SQL}, start_rows AS (
      SELECT DISTINCT queue_url, mid FROM ranked
    ), fold AS (
      SELECT queue_url, mid, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id,
             CAST('' AS VARCHAR) AS decision, CAST(0 AS BIGINT) AS attempt,
             CAST(0 AS BIGINT) AS wait_ms, CAST(0 AS BIGINT) AS n, CAST(-1 AS BIGINT) AS gate
      FROM start_rows
      UNION ALL
      SELECT queue_url, mid, rn, event_id, decision,
             CASE WHEN decision IN ('retry', 'dlq') THEN n + 1 ELSE 0 END,
             CASE WHEN decision = 'retry' THEN wait_ms ELSE 0 END,
             CASE decision WHEN 'backoff' THEN n WHEN 'retry' THEN n + 1 ELSE 0 END,
             CASE decision WHEN 'backoff' THEN gate WHEN 'retry' THEN t_ms + wait_ms ELSE -1 END
      FROM (
        SELECT f.queue_url, f.mid, r.rn, r.event_id, r.t_ms, f.n, f.gate, {wait} AS wait_ms,
               CASE WHEN r.t_ms < f.gate THEN 'backoff' WHEN NOT r.failed THEN 'emit'
                    WHEN f.n + 1 >= {max_retries} THEN 'dlq' ELSE 'retry' END AS decision
        FROM fold f JOIN ranked r ON r.queue_url = f.queue_url AND r.mid = f.mid AND r.rn = f.rn + 1
      )
    ) {select}"""


def deliveries(spark, sf_dir):
    """Redeliveries: events of one type and user class are deliveries of one message."""
    e = events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_key"), "user_id", "event_type"
    )
    m = event_messages(spark, sf_dir)
    user = F.col("user_id")
    failed = (user % 3 != 0) | (user % 5 == 0)
    return m.join(e, m.message_id == e.event_key).select(
        F.concat_ws("-", "event_type", (user % 7).cast("string")).alias("message_id"),
        "receipt_handle", "body", "md5_of_body", "queue_url", "received_at",
        F.when(failed, "ConversionError").alias("error_class"),
        F.when(failed, F.concat(F.lit("failure of event "), F.col("event_key"))).alias("error_message"),
        F.col("event_key").cast("bigint").alias("event_id"),
    )


@query(
    "retry_attempts",
    retry_sql(3, 1, "SELECT event_id, decision, attempt FROM fold WHERE rn > 0"),
)
def retry_attempts(spark, sf_dir):
    done = retry_decisions(deliveries(spark, sf_dir), RetryPolicy(3, 1, jitter=0.0))
    return done.select("event_id", "decision", F.col("attempt").cast("bigint").alias("attempt"))


@query(
    "retry_gate",
    retry_sql(
        5, 400_000,
        "SELECT event_id, decision, attempt, wait_ms AS backoff_ms FROM fold WHERE rn > 0",
    ),
)
def retry_gate(spark, sf_dir):
    """Waits near the cap, so that many redeliveries come too early."""
    done = retry_decisions(deliveries(spark, sf_dir), RetryPolicy(5, 400_000, jitter=0.0))
    return done.select(
        "event_id", "decision", F.col("attempt").cast("bigint").alias("attempt"), "backoff_ms"
    )


@query(
    "retry_hot_message",
    retry_sql(3, 5, "SELECT event_id, decision, attempt, wait_ms AS backoff_ms FROM fold WHERE rn > 0")
    .replace("SELECT event_id, queue_url, t_ms, event_type || '-' || CAST(user_id % 7 AS VARCHAR) AS mid,",
             "SELECT event_id, 'one' AS queue_url, event_id % 300 AS t_ms, 'hot' AS mid,"),
)
def retry_hot_message(spark, sf_dir):
    """All deliveries are of one message, within a third of a second."""
    d = deliveries(spark, sf_dir)
    hot = d.withColumns({
        "queue_url": F.lit("one"), "message_id": F.lit("hot"),
        "received_at": F.timestamp_millis(F.col("event_id") % 300),
    })
    done = retry_decisions(hot, RetryPolicy(3, 5, jitter=0.0, dense_rows=7))
    return done.select(
        "event_id", "decision", F.col("attempt").cast("bigint").alias("attempt"), "backoff_ms"
    )


@query(
    "retry_none_allowed",
    f"""WITH {DELIVERIES_SQL}
    SELECT event_id, CASE WHEN failed THEN 'dlq' ELSE 'emit' END AS decision,
           CAST(CASE WHEN failed THEN 1 ELSE 0 END AS BIGINT) AS attempt FROM deliveries""",
)
def retry_none_allowed(spark, sf_dir):
    done = retry_decisions(deliveries(spark, sf_dir), RetryPolicy(0, 1000))
    return done.select("event_id", "decision", F.col("attempt").cast("bigint").alias("attempt"))


@query(
    "retry_backoff",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, CAST(user_id % 15 + 1 AS BIGINT) AS attempt,
           CAST(LEAST(600000, GREATEST(1, FLOOR(1000 * POW(2.0, user_id % 15)))) AS BIGINT) AS wait_ms
    FROM ev""",
)
def retry_backoff(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", (F.col("user_id") % 15 + 1).alias("attempt"))
    return e.select(
        F.col("event_id").cast("string").alias("message_id"), "attempt",
        backoff_ms(F.col("attempt"), 1000, 2.0, 0.0).alias("wait_ms"),
    )


@query(
    "retry_backoff_jitter",
    f"""WITH {EVENTS_SQL}
    SELECT user_id % 8 + 1 AS attempt, COUNT(*) AS waits, TRUE AS in_range, TRUE AS spread FROM ev GROUP BY ALL""",
)
def retry_backoff_jitter(spark, sf_dir):
    """Jittered waits stay within their range and differ between messages."""
    from tidegate.functions.backoff import unit_draw

    e = events(spark, sf_dir).select("event_id", (F.col("user_id") % 8 + 1).alias("attempt"))
    base = backoff_ms(F.col("attempt"), 1000, 2.0, 0.0)
    wait = backoff_ms(F.col("attempt"), 1000, 2.0, 0.5, unit_draw(F.col("event_id"), F.col("attempt")))
    rows = e.select("attempt", base.alias("base"), wait.alias("wait"))
    fits = (F.col("wait") >= F.col("base") * 0.5) & (F.col("wait") <= F.col("base") * 1.5)
    return rows.groupBy("attempt").agg(
        F.count("*").alias("waits"), F.every(fits).alias("in_range"),
        (F.max("wait") > F.min("wait")).alias("spread"),
    )


@query(
    "retry_status",
    retry_sql(3, 1000, """, latest AS (
      SELECT queue_url, mid, max(rn) AS rn FROM fold WHERE rn > 0 AND decision <> 'backoff' GROUP BY ALL)
    SELECT f.queue_url, f.mid AS message_id, f.attempt AS retry_count, d.error_message AS last_error,
           f.gate AS next_retry_ms,
           GREATEST(f.gate - 1706658000000, 0) AS remaining_ms
    FROM fold f JOIN latest l USING (queue_url, mid, rn) JOIN deliveries d ON d.event_id = f.event_id
    WHERE f.decision = 'retry'"""),
)
def retry_status_report(spark, sf_dir):
    done = retry_decisions(deliveries(spark, sf_dir), RetryPolicy(3, 1000, jitter=0.0))
    status = retry_status(done)
    return status.withColumn(
        "remaining_ms", remaining_backoff_ms(F.col("next_retry_ms"), F.lit(1706658000000))
    )


@query(
    "dlq_records",
    retry_sql(3, 1000, """
    SELECT f.event_id, 'dead-letters' AS topic, f.mid AS record_key, e.body AS value, 'true' AS dlq_mark,
           f.queue_url AS h_queue, 'ConversionError' AS h_class, d.error_message AS h_message,
           CAST(f.attempt AS VARCHAR) AS h_count, '3' AS h_max, 'true' AS h_exhausted,
           CAST(d.t_ms AS VARCHAR) AS h_time, md5(e.body) AS h_md5
    FROM fold f JOIN deliveries d ON d.event_id = f.event_id JOIN ev e ON e.event_id = f.event_id
    WHERE f.decision = 'dlq'"""),
)
def dlq_records(spark, sf_dir):
    done = retry_decisions(deliveries(spark, sf_dir), RetryPolicy(3, 1000, jitter=0.0))
    dead = to_dlq(done.where(F.col("decision") == "dlq"), "dead-letters", 3, keep=("event_id",))
    named = F.map_from_entries(
        F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string")))
    )
    h = dead.withColumn("h", named)
    return h.select(
        "event_id", "topic", F.col("key").alias("record_key"), "value",
        F.col("source_offset")["dlq"].alias("dlq_mark"),
        F.col("h")["sqs.queue.url"].alias("h_queue"), F.col("h")["error.class"].alias("h_class"),
        F.col("h")["error.message"].alias("h_message"), F.col("h")["retry.count"].alias("h_count"),
        F.col("h")["retry.max"].alias("h_max"), F.col("h")["retry.exhausted"].alias("h_exhausted"),
        F.col("h")["error.timestamp"].alias("h_time"), F.col("h")["sqs.md5.of.body"].alias("h_md5"),
    )


@query(
    "retry_drop_without_dlq",
    retry_sql(2, 1000, """
    SELECT queue_url, COUNT(*) FILTER (decision = 'dlq') AS dropped, CAST(0 AS BIGINT) AS dead_letters
    FROM fold WHERE rn > 0 GROUP BY queue_url"""),
)
def retry_drop_without_dlq(spark, sf_dir):
    done = retry_decisions(deliveries(spark, sf_dir), RetryPolicy(2, 1000, jitter=0.0, dead_letter=False))
    return done.groupBy("queue_url").agg(
        F.count_if(F.col("decision") == "drop").alias("dropped"),
        F.count_if(F.col("decision") == "dlq").alias("dead_letters"),
    )


# --- acknowledgement --------------------------------------------------------------

@query(
    "ack_batches",
    f"""WITH {EVENTS_SQL}, laned AS (
      SELECT queue_url, message_id, receipt_handle,
             CAST('0x' || substr(md5(message_id), 1, 8) AS BIGINT) % 1024 AS lane FROM ev)
    SELECT *, (row_number() OVER (PARTITION BY queue_url, lane ORDER BY message_id, receipt_handle) - 1) // 10 AS ack_batch
    FROM laned""",
)
def ack_batches(spark, sf_dir):
    return ack_ledger(event_messages(spark, sf_dir))


@query(
    "ack_disabled",
    f"""WITH {EVENTS_SQL}
    SELECT queue_url, CAST(0 AS BIGINT) AS acked, COUNT(*) AS still_pending FROM ev GROUP BY queue_url""",
)
def ack_disabled(spark, sf_dir):
    m = event_messages(spark, sf_dir)
    ledger = ack_ledger(m, delete_enabled=False)
    acked = ledger.select("queue_url", "message_id", F.lit(1).alias("n"))
    left = pending(m, ledger).select("queue_url", "message_id", F.lit(0).alias("n"))
    return acked.unionByName(left).groupBy("queue_url").agg(
        F.count_if(F.col("n") == 1).alias("acked"), F.count_if(F.col("n") == 0).alias("still_pending")
    )


@query(
    "pending_after_ack",
    f"""WITH {EVENTS_SQL}
    SELECT queue_url, message_id FROM ev
    WHERE NOT EXISTS (SELECT 1 FROM ev a WHERE a.queue_url = ev.queue_url AND a.message_id = ev.message_id
                      AND a.event_type IN ('click', 'view') AND a.price_number < 30)""",
)
def pending_after_ack(spark, sf_dir):
    m = event_messages(spark, sf_dir)
    handled = filter_messages(m, '{"Type":["click","view"],"price":[{"numeric":["<",30]}]}')
    return pending(m, ack_ledger(handled)).select("queue_url", "message_id")
