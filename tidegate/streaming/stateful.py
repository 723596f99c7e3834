"""De-duplication as one stateful operator of a running stream.

For streams that are composed further as streams. State is kept by Spark per
(queue, id) and checkpointed with the query. The pipeline's micro-batches
(``streaming.pipeline``) do the same with whole-batch plans, which costs less per
id and splits hot ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidegate.operators.dedup import dedup_id
from tidegate.schemas import DEFAULT_DEDUP_WINDOW_MS

#: A day of clock time: far longer than a redelivery waits.
DEFAULT_FORGET_AFTER_MS = 86_400_000

SIGHTING = "queue_url string, message_id string, receipt_handle string, t_ms bigint"
COLUMNS = [c.split()[0] for c in SIGHTING.split(", ")]


def first_per_instant(rows: pd.DataFrame):
    """Rows that may be taken, in time order, and rows that surely are duplicates.
    Only one row per millisecond stays, however many a hot id has. Most ids come with a few
    rows in order: those are handed on as they are."""
    times = rows["t_ms"].to_numpy()
    if (times[1:] > times[:-1]).all():
        return rows, rows[:0]
    rows = rows.sort_values(["t_ms", "message_id"], kind="stable")
    again = rows["t_ms"].duplicated()
    return rows[~again], rows[again]


def flagged_rows(rows: pd.DataFrame, duplicate: np.ndarray) -> pd.DataFrame:
    """The sightings with their flags, without the key; one frame made at once."""
    return pd.DataFrame({**{n: rows[n].array for n in COLUMNS}, "duplicate": duplicate}, copy=False)


def accepted(times: np.ndarray, expiry: int, window_ms: int) -> tuple[np.ndarray, int]:
    """Flags of the sightings that are taken, and the expiry they leave."""
    flags = np.zeros(len(times), dtype=bool)
    at = int(np.searchsorted(times, expiry))
    while at < len(times):
        flags[at] = True
        expiry = int(times[at]) + window_ms
        at = int(np.searchsorted(times, expiry))
    return flags, expiry


def dedup_stream(
    messages: DataFrame,
    window_ms: int = DEFAULT_DEDUP_WINDOW_MS,
    forget_after_ms: int | None = DEFAULT_FORGET_AFTER_MS,
) -> DataFrame:
    """(queue_url, message_id, receipt_handle, t_ms, duplicate) for every message of
    a stream. An id not seen for ``forget_after_ms`` after its window leaves the state,
    by clock time. Such a query never runs out of work; None keeps every id, for a
    stream that is to end under an available-now trigger."""
    timeout = GroupStateTimeout.NoTimeout
    if forget_after_ms is not None:
        timeout = GroupStateTimeout.ProcessingTimeTimeout

    def step(key, chunks, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        waiting = None
        for chunk in chunks:
            rows = chunk if waiting is None else pd.concat([waiting, chunk])
            waiting, surely = first_per_instant(rows)
            if len(surely):
                yield flagged_rows(surely, np.ones(len(surely), dtype=bool))
        if waiting is None:
            return
        before = state.get[0] if state.exists else np.iinfo("int64").min
        flags, expiry = accepted(waiting["t_ms"].to_numpy(), before, window_ms)
        state.update((expiry,))
        if forget_after_ms is not None:
            state.setTimeoutDuration(window_ms + forget_after_ms)
        yield flagged_rows(waiting, ~flags)

    sightings = messages.select(
        "queue_url", "message_id", "receipt_handle",
        F.unix_millis("received_at").alias("t_ms"), dedup_id().alias("dedup_key"),
    )
    exempt = sightings.where(F.col("dedup_key").isNull()).drop("dedup_key")
    flagged = (
        sightings.where(F.col("dedup_key").isNotNull())
        .groupBy("queue_url", "dedup_key")
        .applyInPandasWithState(
            step, f"{SIGHTING}, duplicate boolean", "expiry bigint", "append", timeout
        )
    )
    return flagged.unionByName(exempt.withColumn("duplicate", F.lit(False)))
