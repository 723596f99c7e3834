"""Queries over states kept in the state store, and over objects fetched by address."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.operators.claimcheck import claim_check
from tidegate.operators.retry import RetryPolicy
from tidegate.plans.envelopes import (
    BUCKET, document_objects, document_uri, event_messages, plain_message, table,
)
from tidegate.plans.flow_queries import RECORDS_SQL, flow, packed_events, record_summary
from tidegate.plans.pipeline import Pipeline
from tidegate.plans.registry import EVENTS_SQL, query
from tidegate.plans.state_queries import DAY_MS, deliveries, retry_sql
from tidegate.session import run_dir
from tidegate.sources.messages import read_messages
from tidegate.sources.object_store import FolderGet, ObjectStore, write_objects
from tidegate.streaming.state_store import StateFolders, run_stateful, states_per_queue

# --- states -----------------------------------------------------------------------


def run_in_parts(spark, messages: DataFrame, parts: list, pipe: Pipeline, root: str, lateness_ms: int) -> StateFolders:
    """Land the parts one after the other, a file per task, each worked off by a run of its own."""
    for part in parts:
        messages.where(part).write.mode("append").parquet(f"{root}/landing")
        stream = read_messages(spark, f"{root}/landing", streaming=True)
        folders = run_stateful(stream, pipe, f"{root}/out", lateness_ms=lateness_ms)
    return folders


def halves() -> list:
    day = F.dayofmonth("received_at")
    return [day <= 15, day > 15]


@query("state_store_records", RECORDS_SQL)
def state_store_records(spark, sf_dir):
    """The whole path as two streaming queries, two runs of them."""
    folders = run_in_parts(
        spark, packed_events(spark, sf_dir), halves(), flow(), run_dir(spark, "stateful"), 30 * DAY_MS
    )
    return record_summary(spark.read.parquet(folders.records))


def refuse_marked(df: DataFrame) -> DataFrame:
    """A user-made step: messages that say so cannot be converted."""
    bad = F.try_element_at("message_attributes", F.lit("fails")).isNotNull() & F.col("error_class").isNull()
    return df.withColumns({
        "error_class": F.when(bad, "ConversionError").otherwise(F.col("error_class")),
        "error_message": F.when(bad, "it says it fails").otherwise(F.col("error_message")),
    })


def marked_deliveries(spark, sf_dir) -> DataFrame:
    """The redeliveries of the retry queries as messages; an id of its own for each of the
    ordered queue."""
    fails = F.map_from_arrays(
        F.array(F.lit("fails")),
        F.array(F.struct(
            F.lit("String").alias("data_type"), F.lit("yes").alias("string_value"),
            F.lit(None).cast("binary").alias("binary_value"),
        )),
    )
    return deliveries(spark, sf_dir).select(
        "message_id", "receipt_handle", "body", "md5_of_body",
        F.create_map(F.lit("MessageDeduplicationId"), F.col("receipt_handle")).alias("attributes"),
        F.when(F.col("error_class").isNotNull(), fails).alias("message_attributes"), "queue_url", "received_at",
    )


def retried(spark, sf_dir) -> StateFolders:
    pipe = Pipeline(
        topic="events", dlq_topic="dead", dedup_window_ms=1000, retry=RetryPolicy(5, 400_000, jitter=0.0)
    ).then(refuse_marked)
    return run_in_parts(
        spark, marked_deliveries(spark, sf_dir), halves(), pipe, run_dir(spark, "retries"), 60 * DAY_MS
    )


@query(
    "stream_retry",
    retry_sql(5, 400_000, "SELECT event_id, decision, attempt, wait_ms AS backoff_ms FROM fold WHERE rn > 0"),
)
def stream_retry(spark, sf_dir):
    """Back-off and attempts go on from run to run, out of the state store."""
    decided = spark.read.parquet(retried(spark, sf_dir).decided)
    return decided.select(
        F.substring_index("receipt_handle", "-", -1).cast("bigint").alias("event_id"), "decision",
        F.col("attempt").cast("bigint").alias("attempt"), "backoff_ms",
    )


@query(
    "queue_metrics_retries",
    retry_sql(5, 400_000, """, last_rows AS (
      SELECT queue_url, mid, max(rn) AS rn FROM fold WHERE rn > 0 GROUP BY ALL
    ), waiting AS (
      SELECT f.queue_url, COUNT(*) AS messages_in_retry
      FROM fold f JOIN last_rows USING (queue_url, mid, rn) WHERE f.n > 0 GROUP BY f.queue_url)
    SELECT queue_url, COUNT(*) AS messages_received,
           COUNT(*) FILTER (decision IN ('emit', 'dlq')) AS messages_sent,
           COUNT(*) FILTER (decision IN ('retry', 'dlq')) AS messages_failed,
           COUNT(*) FILTER (decision = 'retry') AS messages_retried,
           COUNT(*) FILTER (decision = 'backoff') AS messages_in_backoff,
           COUNT(*) FILTER (decision IN ('retry', 'backoff')) AS deliveries_pending,
           coalesce(max(messages_in_retry), 0) AS messages_in_retry,
           COUNT(*) FILTER (decision = 'emit' AND queue_url LIKE '%.fifo') AS ids_tracked
    FROM fold LEFT JOIN waiting USING (queue_url) WHERE rn > 0 GROUP BY queue_url"""),
)
def queue_metrics_retries(spark, sf_dir):
    """Counters of all runs beside what the state store still holds."""
    folders = retried(spark, sf_dir)
    names = ["messages_received", "messages_sent", "messages_failed", "messages_retried", "messages_in_backoff"]
    counts = spark.read.parquet(folders.metrics).groupBy("queue_url").agg(*[F.sum(n).alias(n) for n in names])
    acknowledged = spark.read.parquet(folders.ledger).groupBy("queue_url").agg(F.count("*").alias("acknowledged"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return (
        counts.join(acknowledged, "queue_url", "left").join(states_per_queue(spark, folders), "queue_url", "left")
        .select(
            "queue_url", *names, (F.col("messages_received") - F.coalesce("acknowledged", F.lit(0))).alias("deliveries_pending"),
            zero("messages_in_retry"), zero("ids_tracked"),
        )
    )


LATE_MS = 2 * DAY_MS


@query(
    "stream_late_rows",
    f"""WITH {EVENTS_SQL}, parts AS (
      SELECT *, extract(day FROM epoch_ms(t_ms)) AS day FROM ev
    ), landed AS (
      SELECT *, day <= 20 AND NOT (user_id % 7 = 0 AND day >= 10) AS early FROM parts
    ), bound AS (SELECT max(t_ms) - {LATE_MS} AS bound_ms FROM landed WHERE early)
    SELECT message_id, CASE WHEN NOT early AND t_ms < bound_ms THEN 'late' ELSE 'acknowledged' END AS fate
    FROM landed, bound""",
)
def stream_late_rows(spark, sf_dir):
    """Some users' messages come with the second part only: within the bound they are taken,
    behind it they are left to their queue."""
    day = F.dayofmonth("received_at")
    messages = event_messages(spark, sf_dir)
    owners = table(spark, sf_dir, "events", ["event_id", "user_id"]).select(
        F.col("event_id").cast("string").alias("message_id"), "user_id"
    )
    held = owners.where("user_id % 7 = 0").select("message_id", F.lit(True).alias("held"))
    marked = messages.join(held, "message_id", "left").withColumn(
        "md5_of_body", F.when(F.col("held"), "held").otherwise(F.col("md5_of_body"))
    ).drop("held")
    early = (day <= 20) & ~((F.col("md5_of_body") == "held") & (day >= 10))
    pipe = Pipeline(topic="events", dedup_window_ms=0)
    folders = run_in_parts(spark, marked, [early, ~early], pipe, run_dir(spark, "late"), LATE_MS)
    late = spark.read.parquet(folders.late).select("message_id", F.lit("late").alias("fate"))
    done = spark.read.parquet(folders.ledger).select("message_id", F.lit("acknowledged").alias("fate"))
    return late.unionByName(done)


# --- objects by address -----------------------------------------------------------

OTHER_BUCKET = "second-bucket"


def two_buckets(spark, sf_dir) -> tuple[ObjectStore, str]:
    """Documents as objects: odd ids in the second bucket. Requests are logged."""
    root = run_dir(spark, "store").removeprefix("file://")
    roots = {BUCKET: f"{root}/a", OTHER_BUCKET: f"{root}/b"}
    odd = F.regexp_extract("uri", r"/(\d+)\.bin$", 1).cast("bigint") % 2 == 1
    objects = document_objects(spark, sf_dir).withColumn(
        "uri", F.when(odd, F.replace("uri", F.lit(f"/{BUCKET}/"), F.lit(f"/{OTHER_BUCKET}/"))).otherwise(F.col("uri"))
    )
    write_objects(objects, roots)
    return ObjectStore(FolderGet(roots, log=f"{root}/log")), f"{root}/log"


def address(number):
    in_first = document_uri(number)
    return F.when(number % 2 == 1, F.replace(in_first, F.lit(f"/{BUCKET}/"), F.lit(f"/{OTHER_BUCKET}/"))).otherwise(in_first)


@query(
    "claim_check_two_buckets",
    """SELECT CAST(doc_id AS VARCHAR) AS message_id,
              CASE WHEN doc_id % 10 = 0 THEN NULL ELSE md5(text) END AS value_md5,
              CASE WHEN doc_id % 10 = 0 THEN 'ObjectNotFound' END AS error_class FROM documents""",
)
def claim_check_two_buckets(spark, sf_dir):
    """Bodies are addresses in either bucket; each object is fetched by its address."""
    store, _ = two_buckets(spark, sf_dir)
    number = F.col("doc_id")
    messages = table(spark, sf_dir, "documents", ["doc_id"]).select(*plain_message(number, address(number)))
    done = claim_check(messages, store, fmt="AUTO")
    good = F.col("error_class").isNull()
    return done.select("message_id", F.when(good, F.md5("body")).alias("value_md5"), "error_class")


@query(
    "claim_check_few",
    """SELECT CASE WHEN doc_id % 2 = 1 THEN 'second-bucket' ELSE 'ingest-bucket' END AS bucket,
              CAST(COUNT(*) AS BIGINT) AS requests, CAST(COUNT(*) AS BIGINT) AS objects
       FROM documents WHERE doc_id % 50 IN (0, 1, 2) GROUP BY 1""",
)
def claim_check_few(spark, sf_dir):
    """Three messages point at each of a few objects: one request per address, none for the
    objects that nobody names."""
    store, log = two_buckets(spark, sf_dir)
    number = F.col("doc_id")
    few = table(spark, sf_dir, "documents", ["doc_id"]).where("doc_id % 50 in (0, 1, 2)")
    thrice = few.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    messages = thrice.select(*plain_message(number * 10 + F.col("copy"), address(number)))
    done = claim_check(messages, store, fmt="AUTO")
    done.write.format("noop").mode("overwrite").save()
    requests = spark.read.schema("bucket string, key string").json(log)
    return requests.groupBy("bucket").agg(
        F.count("*").alias("requests"), F.countDistinct("key").alias("objects")
    )
