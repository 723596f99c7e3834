"""Per-queue counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def counters(delete_enabled: bool = True) -> list[Column]:
    """Counters over rows with ``passed``, ``decision`` and ``duplicate``. "Sent"
    includes dead-letter records; duplicates are acknowledged, not sent."""
    passed = F.col("passed")
    emitted = passed & (F.col("decision") == "emit")
    duplicate = emitted & F.col("duplicate")
    dead = passed & (F.col("decision") == "dlq")
    dropped = passed & (F.col("decision") == "drop")
    done = ~passed | emitted | dead | dropped
    return [
        F.count("*").alias("messages_received"),
        F.count_if((emitted & ~duplicate) | dead).alias("messages_sent"),
        F.count_if(done & F.lit(delete_enabled)).alias("messages_deleted"),
        F.count_if(passed & F.col("decision").isin("retry", "dlq", "drop")).alias("messages_failed"),
        F.count_if(passed & (F.col("decision") == "retry")).alias("messages_retried"),
        F.count_if(duplicate).alias("messages_deduplicated"),
        F.count_if(passed & (F.col("decision") == "backoff")).alias("messages_in_backoff"),
    ]


def pipeline_metrics(processed: DataFrame, delete_enabled: bool = True) -> DataFrame:
    return processed.groupBy("queue_url").agg(*counters(delete_enabled))
