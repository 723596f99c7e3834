"""The whole message path as one plan: filter, convert, retry, de-duplicate, emit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.operators.ack import ack_ledger
from tidegate.operators.claimcheck import claim_check, decode_and_fetch
from tidegate.operators.deadletter import dead_letter_columns
from tidegate.operators.decompress import decompress_body
from tidegate.operators.dedup import flag_duplicates
from tidegate.operators.errors import track_errors
from tidegate.operators.extract import extract_field
from tidegate.operators.filtering import filter_messages, flag_messages
from tidegate.operators.metrics import pipeline_metrics
from tidegate.operators.ordering import group_id, sequence
from tidegate.operators.records import is_fifo, record_columns
from tidegate.operators.retry import RetryPolicy, retry_decisions
from tidegate.schemas import DEFAULT_DEDUP_WINDOW_MS
from tidegate.session import materialize
from tidegate.sources.messages import project_attributes

Step = Callable[[DataFrame], DataFrame]

LEDGER_COLUMNS = ["queue_url", "message_id", "receipt_handle"]
FOLD_COLUMNS = ["delivery_id", *LEDGER_COLUMNS, "received_at", "attributes", "error_class"]


def emitted() -> Column:
    return F.col("decision") == "emit"


@dataclass(frozen=True)
class Pipeline:
    """What happens to messages. Steps run in the order they were added; any
    function from frame to frame is a step, and marks failures in ``error_class``."""

    topic: str
    partition: int | None = None
    attributes_enabled: bool = True
    attribute_names: str | None = None
    policy: str | None = None
    steps: tuple[Step, ...] = field(default=())
    extract_path: str | None = None
    extract_fail_on_missing: bool = False
    retry: RetryPolicy = RetryPolicy()
    dedup_window_ms: int = DEFAULT_DEDUP_WINDOW_MS
    dlq_topic: str | None = None
    delete_enabled: bool = True
    fifo: bool = False
    fifo_auto_detect: bool = True

    def then(self, step: Step) -> "Pipeline":
        return replace(self, steps=self.steps + (step,))

    def decompress(self, fmt: str = "AUTO", try_base64: bool = True, path: str | None = None):
        return self.then(lambda df: decompress_body(df, fmt, try_base64, path))

    def claim_check(self, objects, path=None, fmt=None, try_base64=True):
        return self.then(lambda df: claim_check(df, objects, path, fmt, try_base64))

    def decode_and_fetch(self, objects, path, fmt="AUTO", try_base64=True):
        return self.then(lambda df: decode_and_fetch(df, objects, path, fmt, try_base64))

    # --- stages ---

    def projected(self, messages: DataFrame) -> DataFrame:
        """Messages with the attributes the queue was asked for."""
        ordered = True if self.fifo else None if self.fifo_auto_detect else False
        return project_attributes(messages, self.attributes_enabled, self.attribute_names, ordered)

    def receive(self, messages: DataFrame) -> DataFrame:
        """All messages with a ``passed`` flag, for acknowledgement and counters."""
        return flag_messages(self.projected(messages), self.policy)

    def convert(self, messages: DataFrame) -> DataFrame:
        """The ``value`` of each message that passes, or its error, and the body as
        it came. To be stored once: the folds after it only read narrow columns. A
        message without a receive time cannot be placed in time and is an error."""
        df = self.converted(track_errors(filter_messages(self.projected(messages), self.policy)))
        return df.withColumn("delivery_id", F.monotonically_increasing_id())

    def convert_all(self, messages: DataFrame) -> DataFrame:
        """The same for a stream, in one pass: messages that the policy rejects stay, without
        a value and with ``passed`` false. Steps see them as failed and leave them alone."""
        df = track_errors(self.receive(messages))
        mark = lambda c, text: F.when(F.col("passed"), F.col(c)).otherwise(text)
        df = df.withColumns({
            "error_class": mark("error_class", F.lit("Rejected")),
            "original_body": mark("original_body", F.lit(None).cast("string")),
            "body": mark("body", F.lit(None).cast("string")),
        })
        df = self.converted(df)
        return df.withColumns({
            c: mark(c, F.lit(None).cast("string")) for c in ("error_class", "error_message", "value")
        })

    def converted(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = step(df)
        df = df.withColumn("value", F.col("body")).drop("body", "promoted")
        late = F.col("received_at").isNull() & F.col("error_class").isNull()
        df = df.withColumns({
            "error_message": F.when(late, "no receive time").otherwise(F.col("error_message")),
            "error_class": F.when(late, "MissingTimestamp").otherwise(F.col("error_class")),
        })
        return extract_field(df, self.extract_path, self.extract_fail_on_missing)

    def retry_policy(self) -> RetryPolicy:
        named = bool(self.dlq_topic and self.dlq_topic.strip())
        return replace(self.retry, dead_letter=named)

    def decide(self, converted: DataFrame, states: DataFrame | None = None) -> DataFrame:
        """Retry decisions of stored rows, without their bodies."""
        return retry_decisions(converted.select(*FOLD_COLUMNS), self.retry_policy(), states)

    def deduplicate(self, decided: DataFrame, states: DataFrame | None = None) -> DataFrame:
        """Only converted messages count as sightings, so a message that failed
        first is not lost as its own duplicate."""
        return flag_duplicates(
            decided, self.dedup_window_ms, states=states, eligible=emitted(), fifo=self.ordered()
        )

    def ordered(self) -> Column:
        return is_fifo(self.fifo, self.fifo_auto_detect)

    def run(self, spark: SparkSession, messages: DataFrame) -> "Outcome":
        """The whole path over a table. What is expensive to compute and read more
        than once lies in the shared folder, so lost executors cost little."""
        received = self.receive(messages)
        converted = materialize(spark, self.convert(messages), "converted")
        decided = self.deduplicate(materialize(spark, self.decide(converted), "retried"))
        return Outcome(self, received, converted, materialize(spark, decided, "decided"))


@dataclass(frozen=True)
class Outcome:
    """Results: ``converted`` has the values, ``decided`` what becomes of each row."""

    pipeline: Pipeline
    received: DataFrame
    converted: DataFrame
    decided: DataFrame

    def output(self) -> DataFrame:
        """Topic records and dead letters from one pass over the values.

        Messages of ordered queues stand in (queue, group, sequence) order over range
        partitions: a hot group is split, each part in order and behind the one before.
        The others go around that exchange."""
        pipe = self.pipeline
        leaving = self.decided.where((emitted() & ~F.col("duplicate")) | (F.col("decision") == "dlq"))
        rows = self.converted.join(leaving.select("delivery_id", "decision", "attempt"), "delivery_id")
        good = record_columns(
            pipe.topic, pipe.partition, pipe.attributes_enabled, fifo=pipe.fifo,
            fifo_auto_detect=pipe.fifo_auto_detect, value=F.col("value"),
        )
        dead = dead_letter_columns(pipe.dlq_topic, pipe.retry.max_retries, "original_body")
        record = F.when(emitted(), F.struct(*good)).otherwise(F.struct(*dead))
        keyed = rows.select(
            record.alias("record"), pipe.ordered().alias("ordered"), "queue_url",
            group_id().alias("group"), sequence().alias("sequence"), "received_at",
        )
        keys = ["queue_url", "group", "sequence", "received_at"]
        # The topic leads, so that a writer that splits by topic has nothing left to sort.
        ordered = keyed.where("ordered").repartitionByRange(*keys).sortWithinPartitions("record.topic", *keys)
        others = keyed.where(~F.col("ordered")).sortWithinPartitions("record.topic")
        return ordered.select("record.*").unionByName(others.select("record.*"))

    def ledger(self) -> DataFrame:
        """Acknowledgements: emitted, duplicate, dead, dropped and filtered-out messages."""
        done = self.decided.where(F.col("decision").isin("emit", "dlq", "drop"))
        rejected = self.received.where(~F.col("passed"))
        handled = done.select(*LEDGER_COLUMNS).unionByName(rejected.select(*LEDGER_COLUMNS))
        return ack_ledger(handled, self.pipeline.delete_enabled)

    def metrics(self) -> DataFrame:
        seen = self.decided.select("queue_url", F.lit(True).alias("passed"), "decision", "duplicate")
        rejected = self.received.where(~F.col("passed")).select(
            "queue_url", "passed", F.lit(None).cast("string").alias("decision"),
            F.lit(False).alias("duplicate"),
        )
        return pipeline_metrics(seen.unionByName(rejected), self.pipeline.delete_enabled)
