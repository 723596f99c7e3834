"""Queries over the whole message path, as a table and as a stream."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from tidegate.operators.decompress import decompress_body
from tidegate.operators.retry import RetryPolicy
from tidegate.plans import stand_in
from tidegate.plans.envelopes import event_messages, events, kind_of, packed_base64
from tidegate.plans.pipeline import Pipeline
from tidegate.plans.registry import EVENTS_SQL, query
from tidegate.plans.state_queries import ALL_FLAGS, dedup_sql
from tidegate.session import run_dir
from tidegate.sinks.topics import batch_path, write_topic
from tidegate.sources.messages import read_messages
from tidegate.sources.queue_stream import stream_queues
from tidegate.streaming.pipeline import read_batches, run_available, start_stream
from tidegate.streaming.stateful import dedup_stream

WINDOW_MS = 4 * 86_400_000
#: Rows of a written file that are checked for order together.
ROWS_PER_SLICE = 100_000
#: Receives of a worker in one round; more where a queue would take over ROUNDS rounds.
RECEIVES_PER_ROUND, ROUNDS = 2_000, 4

# Clicks and views pass the filter; a price of 40 or more cannot be converted;
# retries are off, so a failure goes to the dead letters at once.
FLOW_SQL = f"""WITH RECURSIVE {EVENTS_SQL}, passed AS (
  SELECT * FROM ev WHERE event_type IN ('click', 'view')
), good AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t_ms, message_id) AS rn
  FROM passed WHERE price_number < 40
), fold AS (
  SELECT message_id, user_id, event_type, rn, FALSE AS duplicate, t_ms + {WINDOW_MS} AS expiry
  FROM good WHERE fifo AND rn = 1
  UNION ALL
  SELECT g.message_id, g.user_id, g.event_type, g.rn, g.t_ms < f.expiry,
         CASE WHEN g.t_ms < f.expiry THEN f.expiry ELSE g.t_ms + {WINDOW_MS} END
  FROM fold f JOIN good g ON g.user_id = f.user_id AND g.event_type = f.event_type AND g.rn = f.rn + 1
), flags AS (
  SELECT p.*, p.price_number >= 40 AS failed, coalesce(f.duplicate, FALSE) AS duplicate
  FROM passed p LEFT JOIN fold f USING (message_id)
)"""

RECORDS_SQL = f"""{FLOW_SQL}
SELECT message_id, CASE WHEN failed THEN 'dead' ELSE 'events' END AS topic,
       CASE WHEN fifo AND NOT failed THEN CAST(user_id AS VARCHAR) ELSE message_id END AS record_key,
       CASE WHEN failed THEN 'raw' ELSE replace(props, ' ', '') END AS value
FROM flags WHERE NOT duplicate"""

METRICS_SQL = f"""{FLOW_SQL}, counted AS (
  SELECT ev.queue_url, ev.event_type IN ('click', 'view') AS passed,
         coalesce(f.failed, FALSE) AS failed, coalesce(f.duplicate, FALSE) AS duplicate
  FROM ev LEFT JOIN flags f USING (message_id)
)
SELECT queue_url, COUNT(*) AS messages_received,
       COUNT(*) FILTER (passed AND NOT duplicate) AS messages_sent,
       COUNT(*) AS messages_deleted,
       COUNT(*) FILTER (failed) AS messages_failed,
       CAST(0 AS BIGINT) AS messages_retried,
       COUNT(*) FILTER (duplicate) AS messages_deduplicated,
       CAST(0 AS BIGINT) AS messages_in_backoff
FROM counted GROUP BY queue_url"""


def packed_events(spark, sf_dir) -> DataFrame:
    """Event messages whose bodies are packed by id."""
    m = event_messages(spark, sf_dir)
    return m.withColumn("body", packed_base64(kind_of(F.col("message_id").cast("bigint")), F.col("body")))


def refuse_expensive(df: DataFrame) -> DataFrame:
    """A user-made step: marks messages it cannot convert."""
    price = F.col("message_attributes")["price"]["string_value"].cast("double")
    bad = (price >= 40) & F.col("error_class").isNull()
    return df.withColumns(
        {
            "error_class": F.when(bad, "ConversionError").otherwise(F.col("error_class")),
            "error_message": F.when(bad, "too expensive").otherwise(F.col("error_message")),
        }
    )


def flow() -> Pipeline:
    return Pipeline(
        topic="events",
        policy='{"Type":["click","view"]}',
        extract_path="detail.data",
        retry=RetryPolicy(max_retries=1),
        dedup_window_ms=WINDOW_MS,
        dlq_topic="dead",
    ).decompress().then(refuse_expensive)


def record_summary(records: DataFrame) -> DataFrame:
    dead = F.col("topic") == "dead"
    return records.select(
        "message_id", "topic", F.col("key").alias("record_key"),
        F.when(dead, "raw").otherwise(F.col("value")).alias("value"),
    )


@query("flow_records", RECORDS_SQL)
def flow_records(spark, sf_dir):
    return record_summary(flow().run(spark, packed_events(spark, sf_dir)).output())


@query(
    "flow_group_order",
    f"""{FLOW_SQL}
    SELECT CAST(user_id AS VARCHAR) AS group_id, COUNT(*) AS records, TRUE AS in_order
    FROM flags WHERE fifo AND NOT duplicate AND NOT failed GROUP BY user_id""",
)
def flow_group_order(spark, sf_dir):
    """Records of the ordered queue as they stand in the written files, file by file."""
    root = run_dir(spark, "group-order")
    write_topic(flow().run(spark, packed_events(spark, sf_dir)).output(), root, 0)
    records = spark.read.parquet(batch_path(root, 0)).where("topic = 'events'")
    queue = F.element_at("source_partition", "queue_url")
    placed = records.where(queue.endswith(".fifo")).select(
        F.col("key").alias("group_id"), F.col("message_id").cast("bigint").alias("sequence"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"),
        F.floor(F.col("_metadata.row_index") / ROWS_PER_SLICE).alias("slice"),
    )
    return order_by_slices(placed)


def order_by_slices(placed: DataFrame) -> DataFrame:
    """Per group its records and whether sequences rise, row by row within a slice of a file,
    then from slice to slice: no task sorts a whole group."""
    rises = lambda before, after: F.coalesce(before < after, F.lit(True))
    inside = Window.partitionBy("group_id", "file", "slice").orderBy("row")
    slices = (
        placed.withColumn("follows", rises(F.lag("sequence").over(inside), F.col("sequence")))
        .groupBy("group_id", "file", "slice").agg(
            F.count("*").alias("records"), F.bool_and("follows").alias("follows"),
            F.min_by("sequence", "row").alias("first"), F.max_by("sequence", "row").alias("last"),
        )
    )
    between = Window.partitionBy("group_id").orderBy("file", "slice")
    steps = slices.withColumn("follows", F.col("follows") & rises(F.lag("last").over(between), F.col("first")))
    return steps.groupBy("group_id").agg(
        F.sum("records").alias("records"), F.bool_and("follows").alias("in_order")
    )


@query("flow_flagged_fifo", f"{RECORDS_SQL} AND fifo")
def flow_flagged_fifo(spark, sf_dir):
    """An ordered queue whose name does not say so, told by the pipeline's flag."""
    messages = packed_events(spark, sf_dir).where(F.col("queue_url").endswith(".fifo"))
    unnamed = messages.withColumn("queue_url", F.regexp_replace("queue_url", r"\.fifo$", ""))
    return record_summary(replace(flow(), fifo=True).run(spark, unnamed).output())


@query(
    "body_rewrite_keeps_rest",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, receipt_handle, queue_url, t_ms, md5(body) AS md5_of_body, md5(body) AS body_md5,
           CAST(CASE WHEN fifo THEN 6 ELSE 3 END AS INT) AS system_attributes,
           CAST(CASE WHEN vip THEN 3 ELSE 2 END AS INT) AS user_attributes
    FROM ev""",
)
def body_rewrite_keeps_rest(spark, sf_dir):
    """Unpacking changes the body; what came with it stays."""
    done = decompress_body(packed_events(spark, sf_dir))
    return done.select(
        "message_id", "receipt_handle", "queue_url", F.unix_millis("received_at").alias("t_ms"),
        "md5_of_body", F.md5("body").alias("body_md5"), F.size("attributes").alias("system_attributes"),
        F.size("message_attributes").alias("user_attributes"),
    )


@query(
    "null_time_dead_letter",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, CASE WHEN user_id % 7 = 0 THEN 'dead' ELSE 'events' END AS topic FROM ev""",
)
def null_time_dead_letter(spark, sf_dir):
    """Messages without a receive time are given up, the others are not disturbed."""
    messages = event_messages(spark, sf_dir).join(
        events(spark, sf_dir).select(F.col("event_id").cast("string").alias("message_id"), "user_id"), "message_id"
    )
    untimed = messages.withColumn(
        "received_at", F.when(F.col("user_id") % 7 != 0, F.col("received_at"))
    ).drop("user_id")
    pipe = Pipeline(
        topic="events", retry=RetryPolicy(max_retries=3), dedup_window_ms=1, dlq_topic="dead"
    )
    return pipe.run(spark, untimed).output().select("message_id", "topic")


@query("queue_metrics", METRICS_SQL)
def flow_metrics(spark, sf_dir):
    return flow().run(spark, packed_events(spark, sf_dir)).metrics()


@query(
    "flow_acknowledged",
    f"""{FLOW_SQL}
    SELECT queue_url, COUNT(*) AS acked FROM ev GROUP BY queue_url""",
)
def flow_acknowledged(spark, sf_dir):
    ledger = flow().run(spark, packed_events(spark, sf_dir)).ledger()
    return ledger.groupBy("queue_url").agg(F.countDistinct("message_id").alias("acked"))


def landed_stream(spark, messages: DataFrame, root: str) -> DataFrame:
    """Land messages ten days at a time, a file per task; the stream takes the folder in
    micro-batches of as many files, in the order they were written."""
    day = F.dayofmonth("received_at")
    files = max(2, messages.rdd.getNumPartitions())
    for part in (day <= 10, (day > 10) & (day <= 20), day > 20):
        messages.where(part).repartition(files).write.mode("append").parquet(f"{root}/landing")
    return read_messages(spark, f"{root}/landing", streaming=True, max_files_per_trigger=files)


def streamed(spark, sf_dir):
    root = run_dir(spark, "stream")
    source = landed_stream(spark, packed_events(spark, sf_dir), root)
    return run_available(source, flow(), root, lateness_ms=WINDOW_MS)


@query("stream_records", RECORDS_SQL)
def stream_records(spark, sf_dir):
    folders = streamed(spark, sf_dir)
    return record_summary(read_batches(spark, folders.records))


@query("receive_stream", RECORDS_SQL)
def receive_stream(spark, sf_dir):
    """Live queues, here made of files, received round by round and piped as a stream."""
    root = run_dir(spark, "receive")
    messages = packed_events(spark, sf_dir)
    stand_in.fill(messages, f"{root}/queues")
    waiting = {r.queue_url: r["count"] for r in messages.groupBy("queue_url").count().collect()}
    workers = max(1, spark.sparkContext.defaultParallelism // max(1, len(waiting)))
    share = -(-max(waiting.values(), default=0) // (stand_in.TAKEN_AT_ONCE * workers * ROUNDS))
    source = stream_queues(
        spark, list(waiting), "tidegate.plans.stand_in:FileQueues", f"{root}/rounds",
        receiver_options={"root": f"{root}/queues"}, workers_per_queue=workers,
        max_polls=max(RECEIVES_PER_ROUND, share),
    )
    query, folders = start_stream(
        source, flow(), root, lateness_ms=WINDOW_MS, available_now=False, interval="0 seconds"
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return record_summary(read_batches(spark, folders.records))


@query("stream_metrics", METRICS_SQL)
def stream_metrics(spark, sf_dir):
    folders = streamed(spark, sf_dir)
    counts = read_batches(spark, folders.metrics).drop("batch_id")
    names = [c for c in counts.columns if c != "queue_url"]
    return counts.groupBy("queue_url").agg(*[F.sum(n).alias(n) for n in names])


@query("stream_dedup", dedup_sql(WINDOW_MS, ALL_FLAGS))
def stream_dedup(spark, sf_dir):
    """De-duplication by the stateful operator, its output appended to a folder."""
    root = run_dir(spark, "dedup-stream")
    messages = landed_stream(spark, event_messages(spark, sf_dir), root)
    flagged = dedup_stream(messages, WINDOW_MS, forget_after_ms=None)
    (
        flagged.writeStream.format("parquet").trigger(availableNow=True)
        .option("checkpointLocation", f"{root}/progress").start(f"{root}/flags").awaitTermination()
    )
    return spark.read.parquet(f"{root}/flags").select("message_id", "duplicate")
