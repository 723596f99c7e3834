"""Receiving from live queues into a landing folder.

A queue cannot be read twice, so what is received is written down first and
processed from there. A task that is lost leaves its messages undeleted; the queue
delivers them again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.schemas import DEFAULT_RECEIVE_BATCH, DEFAULT_WAIT_SECONDS, MESSAGE_SCHEMA
from tidegate.sources.messages import MAX_RECEIVE_BATCH, MAX_WAIT_SECONDS, promote_attributes

Receive = Callable[[str, int, int], Iterable[dict]]
"""``receive(queue_url, max_messages, wait_seconds)`` -> message dicts by column name."""


#: Messages handed to Spark together.
ROWS_AT_ONCE = 500


def check_receive_options(batch: int, wait_seconds: int) -> None:
    if not 1 <= batch <= MAX_RECEIVE_BATCH:
        raise ValueError(f"a receive takes 1 to {MAX_RECEIVE_BATCH} messages")
    if not 0 <= wait_seconds <= MAX_WAIT_SECONDS:
        raise ValueError(f"a receive waits 0 to {MAX_WAIT_SECONDS} seconds")


def receive_messages(
    spark: SparkSession,
    queues: list[str],
    receive: Receive,
    workers_per_queue: int = 1,
    batch: int = DEFAULT_RECEIVE_BATCH,
    wait_seconds: int = DEFAULT_WAIT_SECONDS,
    max_polls: int | None = None,
    max_seconds: float | None = 60.0,
) -> DataFrame:
    """One task per (queue, worker) polls until the queue is empty, ``max_polls`` times
    or for ``max_seconds``, so a queue that is never empty keeps no other waiting and the
    job ends. The frame is to be written once, not to be evaluated twice."""
    check_receive_options(batch, wait_seconds)
    work = [(queue, worker) for queue in queues for worker in range(workers_per_queue)]
    layout = to_arrow_schema(MESSAGE_SCHEMA)
    names = MESSAGE_SCHEMA.fieldNames()

    def poll(batches):
        for rows in batches:
            for unit in rows.column("id").to_pylist():
                queue = work[unit][0]
                began, polls, held = time.monotonic(), 0, []
                while (max_polls is None or polls < max_polls) and (
                    max_seconds is None or time.monotonic() - began < max_seconds
                ):
                    polls += 1
                    messages = list(receive(queue, batch, wait_seconds))
                    if not messages:
                        break
                    held += [{**dict.fromkeys(names), **m, "queue_url": queue} for m in messages]
                    if len(held) >= ROWS_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(held, schema=layout)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=layout)

    # A range has exactly one unit in each of its partitions.
    return spark.range(len(work), numPartitions=max(len(work), 1)).mapInArrow(poll, MESSAGE_SCHEMA)


def land_messages(received: DataFrame, path: str, promoted: list[str] = ()) -> None:
    """Append what was received to the landing folder, the attributes most policies
    ask for also as columns."""
    rows = promote_attributes(received, list(promoted)) if promoted else received
    rows.write.mode("append").parquet(path)
