"""Retry with back-off: what to do with each delivery of a message."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.backoff import MAX_BACKOFF_MS, backoff_schedule
from tidegate.operators.gated import (
    DENSE_ROWS, Machine, NEXT_ROW, SEGMENT_MS, apply_gates, column, cut_dense, entry_states,
)
from tidegate.schemas import DEFAULT_BACKOFF_MS, DEFAULT_MAX_RETRIES

KEYS = ["queue_url", "message_id"]
# Deliveries of the same millisecond: successes first, then by receipt.
ORDER = ["failed", "tie_order"]


def retry_machine(max_retries: int) -> Machine:
    """Layer = failures so far. Success clears it, so does the last failure; a
    failure before that closes the gate for its back-off."""
    layers = max(1, max_retries)

    def steps(batch):
        t, failed = column(batch, "t_ms"), column(batch, "failed").astype(bool)
        next_layer = np.zeros((layers, len(t)), dtype="int64")
        gate = np.full((layers, len(t)), NEXT_ROW, dtype="int64")
        waits = batch.column("waits").flatten().to_numpy(zero_copy_only=False)
        waits = waits.reshape(len(t), layers - 1)
        for layer in range(layers - 1):
            next_layer[layer] = np.where(failed, layer + 1, 0)
            gate[layer] = np.where(failed, t + waits[:, layer], NEXT_ROW)
        return next_layer, gate

    return Machine(layers, MAX_BACKOFF_MS, ("failed", "waits"), steps)


@dataclass(frozen=True)
class RetryPolicy:
    max_retries: int = DEFAULT_MAX_RETRIES
    base_ms: int = DEFAULT_BACKOFF_MS
    multiplier: float = 2.0
    jitter: float = 0.3
    seed: int = 0
    dead_letter: bool = True
    segment_ms: int = SEGMENT_MS
    dense_rows: int = DENSE_ROWS


def keyed_rows(df: DataFrame, policy: RetryPolicy) -> DataFrame:
    t = F.unix_millis("received_at")
    return df.withColumns(
        {
            "t_ms": t,
            "segment": F.floor(t / F.lit(policy.segment_ms)) * policy.segment_ms,
            "failed": F.col("error_class").isNotNull(),
            "waits": backoff_schedule(
                F.col("message_id"), policy.max_retries, policy.base_ms,
                policy.multiplier, policy.jitter, policy.seed,
            ),
            "tie_order": F.coalesce("receipt_handle", F.lit("")),
        }
    )


def cut_rows(df: DataFrame, policy: RetryPolicy) -> DataFrame:
    return cut_dense(keyed_rows(df, policy), KEYS, "tie_order", "failed", policy.dense_rows)


def retry_states(df: DataFrame, policy: RetryPolicy, **carry) -> DataFrame:
    """Entry states of the segments; ``carry`` passes states between micro-batches."""
    machine = retry_machine(policy.max_retries)
    df = df.where("received_at is not null")
    return entry_states(cut_rows(df, policy), machine, KEYS, ORDER, **carry)


def retry_decisions(
    df: DataFrame, policy: RetryPolicy = RetryPolicy(), states: DataFrame | None = None
) -> DataFrame:
    """Every delivery with ``decision`` (emit, retry, backoff, dlq or drop), the
    failure count ``attempt`` and ``backoff_ms``. A delivery failed when it has an
    ``error_class``; redeliveries share queue and message id. A delivery without a
    receive time is given up at once."""
    machine = retry_machine(policy.max_retries)
    timed = cut_rows(df.where("received_at is not null"), policy)
    if states is None:
        states = entry_states(timed, machine, KEYS, ORDER)
    marked = apply_gates(timed, machine, KEYS, ORDER, states)
    layer, failed = F.col("taken_layer"), F.col("failed")
    attempt = F.when((layer >= 0) & failed, layer + 1).otherwise(0).cast("int")
    decision = (
        F.when(layer < 0, "backoff")
        .when(~failed, "emit")
        .when(attempt >= policy.max_retries, "dlq" if policy.dead_letter else "drop")
        .otherwise("retry")
    )
    wait = F.when(decision == "retry", F.try_element_at("waits", attempt)).otherwise(0)
    decided = marked.withColumns(
        {"decision": decision, "attempt": attempt, "backoff_ms": wait.cast("bigint")}
    ).drop("t_ms", "segment", "failed", "waits", "tie_order", "taken_layer")
    # Without a receive time there is no next try: such a row is given up at once.
    untimed = df.where("received_at is null").withColumns(
        {
            "decision": F.lit("dlq" if policy.dead_letter else "drop"),
            "attempt": F.lit(policy.max_retries),
            "backoff_ms": F.lit(0).cast("bigint"),
        }
    )
    return decided.unionByName(untimed)


def retry_status(decisions: DataFrame) -> DataFrame:
    """Messages still in retry: failure count, last error, time of the next try.

    The latest delivery the gate let through decides: a success or the last
    failure ends tracking."""
    rank = F.struct("received_at", "attempt")
    return (
        decisions.where(F.col("decision") != "backoff")
        .groupBy(*KEYS)
        .agg(
            F.max_by(
                F.struct("decision", "attempt", "error_message", "received_at", "backoff_ms"), rank
            ).alias("last")
        )
        .where(F.col("last.decision") == "retry")
        .select(
            *KEYS,
            F.col("last.attempt").cast("bigint").alias("retry_count"),
            F.col("last.error_message").alias("last_error"),
            (F.unix_millis("last.received_at") + F.col("last.backoff_ms")).alias("next_retry_ms"),
        )
    )


def remaining_backoff_ms(next_retry_ms: Column, at_ms: Column) -> Column:
    return F.greatest(next_retry_ms - at_ms, F.lit(0).cast("bigint"))
