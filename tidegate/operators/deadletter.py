"""Records for the dead-letter topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.operators.records import header
from tidegate.schemas import DEFAULT_MAX_RETRIES

# Stack text limit and its suffix.
STACK_LIMIT = 8000
STACK_SUFFIX = "... (truncated)"


def stack_text() -> Column:
    text = F.concat_ws(": ", "error_class", "error_message")
    return F.when(
        F.length(text) > STACK_LIMIT,
        F.concat(F.substring(text, 1, STACK_LIMIT), F.lit(STACK_SUFFIX)),
    ).otherwise(text)


def dead_letter_columns(topic: str | None, max_retries: int, body: str) -> list[Column]:
    attempt = F.col("attempt")
    headers = F.array(
        header("sqs.message.id", F.col("message_id")),
        header("sqs.queue.url", F.col("queue_url")),
        header("error.class", F.col("error_class")),
        header("error.message", F.coalesce("error_message", F.lit(""))),
        header("error.stacktrace", stack_text()),
        header("error.timestamp", F.unix_millis("received_at").cast("string")),
        header("retry.count", attempt.cast("string")),
        header("retry.max", F.lit(str(max_retries))),
        header("retry.exhausted", (attempt >= max_retries).cast("string")),
        header("sqs.md5.of.body", F.col("md5_of_body")),
    )
    return [
        F.create_map(F.lit("queue_url"), F.col("queue_url")).alias("source_partition"),
        F.create_map(
            F.lit("message_id"), F.col("message_id"), F.lit("dlq"), F.lit("true")
        ).alias("source_offset"),
        F.lit(topic).cast("string").alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.col("message_id").alias("key"),
        F.col(body).alias("value"),
        F.col("received_at").alias("timestamp"),
        F.filter(headers, lambda h: h["value"].isNotNull()).alias("headers"),
        F.col("message_id"),
    ]


def to_dlq(
    failed: DataFrame,
    topic: str | None,
    max_retries: int = DEFAULT_MAX_RETRIES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Dead-letter records of exhausted messages: the body as received, keyed by
    message id, with the error in the headers. No topic, no record."""
    body = "original_body" if "original_body" in failed.columns else "body"
    rows = failed if topic and topic.strip() else failed.where(F.lit(False))
    return rows.select(*dead_letter_columns(topic, max_retries, body), *keep)
