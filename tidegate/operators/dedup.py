"""De-duplication of ordered queues in a fixed time window."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.operators.gated import (
    DENSE_ROWS, Machine, SEGMENT_MS, apply_gates, column, cut_dense, entry_states,
)
from tidegate.operators.records import is_fifo, system_attribute
from tidegate.schemas import DEFAULT_DEDUP_WINDOW_MS

KEYS = ["queue_url", "dedup_key"]


def dedup_id(fifo: Column | None = None) -> Column:
    """The id to compare, null for rows that are never duplicates: those of queues
    that are not ordered, without an id, or without a receive time."""
    value = system_attribute("MessageDeduplicationId")
    ordered = is_fifo() if fifo is None else fifo
    return F.when(ordered & (value != "") & F.col("received_at").isNotNull(), value)


def dedup_machine(window_ms: int) -> Machine:
    """A taken row closes the gate for the window; a duplicate does not extend it."""

    def steps(batch):
        gate = column(batch, "t_ms")[None, :] + window_ms
        return np.zeros_like(gate), gate

    return Machine(1, window_ms, (), steps)


def keyed_rows(df: DataFrame, segment_ms: int, eligible: Column | None, fifo: Column | None) -> DataFrame:
    t = F.coalesce(F.unix_millis("received_at"), F.lit(0))
    compared = dedup_id(fifo) if eligible is None else F.when(eligible, dedup_id(fifo))
    # Exempt rows get a filler key that spreads them over tasks.
    return df.withColumns(
        {
            "dedup_key": F.coalesce(compared, F.concat(F.lit("\x00"), "message_id")),
            "exempt": compared.isNull(),
            "t_ms": t,
            "segment": F.floor(t / F.lit(segment_ms)) * segment_ms,
        }
    )


def cut_rows(keyed: DataFrame, dense_rows: int) -> DataFrame:
    return cut_dense(keyed, KEYS, "message_id", None, dense_rows)


def dedup_states(
    df: DataFrame,
    window_ms: int,
    segment_ms: int = SEGMENT_MS,
    eligible: Column | None = None,
    fifo: Column | None = None,
    dense_rows: int = DENSE_ROWS,
    **carry,
) -> DataFrame:
    """Entry states of the segments; ``carry`` passes states between micro-batches."""
    keyed = keyed_rows(df, segment_ms, eligible, fifo).where(~F.col("exempt"))
    return states_of(cut_rows(keyed, dense_rows), window_ms, **carry)


def states_of(cut: DataFrame, window_ms: int, **carry) -> DataFrame:
    # Within one millisecond only the first row can be taken: distinct instants
    # are enough here, and they shrink a hot id before its shuffle.
    instants = cut.select(*KEYS, "segment", "t_ms").distinct()
    return entry_states(instants, dedup_machine(window_ms), KEYS, [], **carry)


def flag_duplicates(
    df: DataFrame,
    window_ms: int = DEFAULT_DEDUP_WINDOW_MS,
    segment_ms: int = SEGMENT_MS,
    name: str = "duplicate",
    states: DataFrame | None = None,
    eligible: Column | None = None,
    fifo: Column | None = None,
    dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    """Every row with a flag. The state is per queue and id; the clock is
    ``received_at`` in milliseconds, ties in message id order. Rows that are not
    ``eligible`` are neither duplicates nor sightings."""
    if window_ms <= 0:
        return df.withColumn(name, F.lit(False))
    keyed = keyed_rows(df, segment_ms, eligible, fifo)
    # Rows that are never duplicates go around the exchange, the sort and the fold.
    cut = cut_rows(keyed.where(~F.col("exempt")), dense_rows)
    if states is None:
        states = states_of(cut, window_ms)
    marked = apply_gates(cut, dedup_machine(window_ms), KEYS, ["message_id"], states).withColumn(
        name, F.col("taken_layer") < 0
    )
    work = ["dedup_key", "exempt", "t_ms", "segment"]
    around = keyed.where("exempt").drop(*work).withColumn(name, F.lit(False))
    return marked.drop("taken_layer", *work).unionByName(around)


def drop_duplicates(df: DataFrame, window_ms: int = DEFAULT_DEDUP_WINDOW_MS) -> DataFrame:
    return flag_duplicates(df, window_ms).where(~F.col("duplicate")).drop("duplicate")


def tracked_ids(flagged: DataFrame, at: Column, window_ms: int) -> DataFrame:
    """Ids whose window is still open at a time, per queue."""
    expiry = F.max(F.unix_millis("received_at")) + window_ms
    return (
        flagged.where(~F.col("duplicate"))
        .withColumn("id", dedup_id())
        .where(F.col("id").isNotNull())
        .groupBy("queue_url", "id")
        .agg(expiry.alias("expiry"))
        .groupBy("queue_url")
        .agg(F.count_if(F.col("expiry") > at).alias("tracked_count"))
    )
