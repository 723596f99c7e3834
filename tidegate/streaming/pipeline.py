"""The pipeline over a stream of message files.

Each micro-batch runs the same plans as a table. States go from batch to batch as
small tables in the checkpoint folder, one version per batch: a batch reads the
version before its own and writes its own, so replaying it changes nothing.
Records are written first, acknowledgements after them.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.operators.dedup import KEYS as DEDUP_KEYS, dedup_states
from tidegate.operators.gated import final_states
from tidegate.operators.retry import KEYS as RETRY_KEYS, retry_states
from tidegate.plans.pipeline import FOLD_COLUMNS, LEDGER_COLUMNS, Outcome, Pipeline, emitted
from tidegate.sinks.topics import (
    Delete, append_ledger, batch_path, delete_acknowledged, write_topic,
)

# Fixed value: a queue keeps a message for two weeks at most.
RETENTION_MS = 14 * 86_400_000


@dataclass(frozen=True)
class StreamFolders:
    """Where a stream keeps its results and its progress."""

    records: str
    ledger: str
    undeleted: str
    metrics: str
    progress: str

    @staticmethod
    def below(root: str) -> "StreamFolders":
        names = ("records", "ledger", "undeleted", "metrics", "progress")
        return StreamFolders(*(os.path.join(root, n) for n in names))


class MicroBatches:
    """``foreachBatch`` body. ``lateness_ms``: how far behind the newest message a
    later one may lie and still meet its duplicate."""

    def __init__(
        self,
        pipeline: Pipeline,
        folders: StreamFolders,
        lateness_ms: int,
        delete: Delete | None = None,
    ):
        self.pipeline = pipeline
        self.folders = folders
        self.lateness_ms = lateness_ms
        self.delete = delete

    def stored(self, spark, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        path = batch_path(os.path.join(self.folders.progress, name), batch_id)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def before(self, spark, name: str, keys: list[str], batch_id: int) -> DataFrame:
        """States the batch before left; an empty table ahead of the first batch."""
        schema = ", ".join([f"{k} string" for k in keys] + [
            "segment bigint", "layer_in bigint", "gate_in bigint"])
        if batch_id == 0:
            return final_states(spark.createDataFrame([], schema), keys)
        path = batch_path(os.path.join(self.folders.progress, name), batch_id - 1)
        return final_states(spark.read.schema(schema).parquet(path), keys)

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        pipe = self.pipeline
        # The source is read twice, for these narrow columns and for the values.
        received = pipe.receive(messages).select(*LEDGER_COLUMNS, "received_at", "passed")
        received = self.stored(spark, received, "received", batch_id)
        newest = received.agg(F.max(F.unix_millis("received_at"))).first()[0]
        newest = 0 if newest is None else newest
        carry = {
            "finals": True,
            "keep_after_ms": newest - self.lateness_ms,
            "forget_before_ms": newest - RETENTION_MS,
        }
        converted = self.stored(spark, pipe.convert(messages), "converted", batch_id)
        retry = self.stored(
            spark,
            retry_states(
                converted.select(*FOLD_COLUMNS), pipe.retry_policy(),
                initial=self.before(spark, "retry", RETRY_KEYS, batch_id), **carry,
            ),
            "retry", batch_id,
        )
        # Stored, since de-duplication reads it several times.
        decided = self.stored(spark, pipe.decide(converted, retry), "retried", batch_id)
        dedup = self.stored(
            spark,
            dedup_states(
                decided, pipe.dedup_window_ms, eligible=emitted(), fifo=pipe.ordered(),
                initial=self.before(spark, "dedup", DEDUP_KEYS, batch_id), **carry,
            ),
            "dedup", batch_id,
        )
        decided = self.stored(spark, pipe.deduplicate(decided, dedup), "decided", batch_id)
        outcome = Outcome(pipe, received, converted, decided)
        write_topic(outcome.output(), self.folders.records, batch_id)
        append_ledger(outcome.ledger(), self.folders.ledger, batch_id)
        if self.delete is not None:
            written = spark.read.parquet(batch_path(self.folders.ledger, batch_id))
            missed = delete_acknowledged(written, self.delete)
            missed.write.mode("overwrite").parquet(batch_path(self.folders.undeleted, batch_id))
        outcome.metrics().write.mode("overwrite").parquet(batch_path(self.folders.metrics, batch_id))


def start_stream(
    messages: DataFrame,
    pipeline: Pipeline,
    root: str,
    lateness_ms: int = 60_000,
    available_now: bool = True,
    interval: str = "10 seconds",
    delete: Delete | None = None,
):
    """Start the stream; results lie in the folders below ``root``. With ``delete``
    the executors also send the delete requests of each batch, after its records and
    ledger are written; what could not be deleted is listed and comes again."""
    folders = StreamFolders.below(root)
    writer = (
        messages.writeStream.foreachBatch(MicroBatches(pipeline, folders, lateness_ms, delete))
        .option("checkpointLocation", os.path.join(folders.progress, "offsets"))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start(), folders


def run_available(
    messages: DataFrame,
    pipeline: Pipeline,
    root: str,
    lateness_ms: int = 60_000,
    delete: Delete | None = None,
):
    """Work off everything that is there, then stop."""
    query, folders = start_stream(messages, pipeline, root, lateness_ms, delete=delete)
    query.awaitTermination()
    return folders


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)
