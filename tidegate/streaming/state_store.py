"""The pipeline as two streaming queries whose states live in Spark's state store.

``convert``: filter and convert messages, row by row, into a folder of converted rows. The
source is read once and each file is there whole or not at all.

``decide``: the narrow columns of that folder go through two stateful operators, retry per
(queue, message) and de-duplication per (queue, id). A batch rewrites the states it touched,
nothing else; event-time timers drop a state when the watermark has passed it. Bodies never
enter Python: decisions are joined back to the files they came from, then records,
acknowledgements and counters of the batch are written, in that order.

Spark asks for a state over a socket and writes an Arrow batch per group. The retry operator's
groups are therefore hashes of message ids with a map of states each, which is asked for
nothing while it is empty, and rows that no id concerns leave it packed, many to a row.

A message behind the watermark is left to its queue: it is listed under ``late``, neither
sent nor acknowledged, and is delivered again with a new receive time.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegate.operators.dedup import dedup_id
from tidegate.operators.retry import RetryPolicy, keyed_rows
from tidegate.plans.pipeline import LEDGER_COLUMNS, Outcome, Pipeline, emitted
from tidegate.sinks.topics import Delete, append_ledger, batch_path, delete_acknowledged, write_topic
from tidegate.streaming.pipeline import RETENTION_MS

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch uploads the changes it made; whole snapshots are taken in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Groups that rows share which no state concerns.
EXEMPT_GROUPS = 1024
#: Groups of message ids per queue, and rows at most that are packed into one.
RETRY_GROUPS, PACKED_ROWS = 2048, 1000

#: What the sink gets of a row; packed rows are JSON lists of these.
FOUND = "file string, place bigint, decision string, attempt int, backoff_ms bigint"
DECIDED = (
    f"{FOUND}, queue_url string, message_id string, received_at timestamp, t_ms bigint, dedup_key string, packed string"
)


def names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


FOUND_NAMES = names(FOUND)


class RetryStates(StatefulProcessor):
    """Failures so far and the end of the back-off, per message that is being retried."""

    def __init__(self, policy: RetryPolicy, retention_ms: int):
        self.max_retries = max(1, policy.max_retries)
        self.limit = policy.max_retries
        self.given_up = "dlq" if policy.dead_letter else "drop"
        self.retention_ms = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = handle.getMapState("retry", "message_id string", "failures int, gate_ms bigint, seen_ms bigint")
        self.swept = set()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        per_message = {}
        for r in rows:
            per_message.setdefault(r.message_id, []).append(r)
        kept = self.states.exists()
        packed, latest = [], None
        for message_id, own in per_message.items():
            for r, *decided in self.message(message_id, own, kept):
                if decided[0] == "emit" and r.dedup_key is not None:
                    yield self.row(key, r.received_at, r.file, r.place, *decided, message_id, r.t_ms, r.dedup_key)
                    continue
                packed.append((r.file, r.place, *decided))
                latest = r.received_at if latest is None else max(latest, r.received_at)
                if len(packed) == PACKED_ROWS:
                    yield self.row(key, latest, packed=packed)
                    packed, latest = [], None
        if packed:
            yield self.row(key, latest, packed=packed)

    def row(
        self, key, received_at, file=None, place=None, decision=None, attempt=None, backoff_ms=None, message_id=None,
        t_ms=None, dedup_key=None, packed=None,
    ) -> Row:
        if packed is not None:
            packed = json.dumps([dict(zip(FOUND_NAMES, p)) for p in packed])
        return Row(
            file=file, place=place, decision=decision, attempt=attempt, backoff_ms=backoff_ms, queue_url=key[0],
            message_id=message_id, received_at=received_at, t_ms=t_ms, dedup_key=dedup_key, packed=packed,
        )

    def message(self, message_id, rows: list, kept: bool) -> Iterator[tuple]:
        """(row, decision, attempt, back-off) of the rows of a message in their order. ``kept``
        says whether its group has any state."""
        before = self.states.getValue((message_id,)) if kept else None
        failures, gate = (before[0], before[1]) if before else (0, None)
        seen = None
        for r in sorted(rows, key=lambda r: (r.t_ms, r.failed, r.tie_order)):
            attempt = wait = 0
            if gate is not None and r.t_ms < gate:
                decision = "backoff"
            elif not r.failed:
                decision, failures, gate = "emit", 0, None
            else:
                attempt = failures + 1
                if attempt >= self.max_retries:
                    decision, failures, gate = self.given_up, 0, None
                else:
                    wait = r.waits[failures]
                    decision, failures, gate = "retry", attempt, r.t_ms + wait
                seen = r.t_ms
            yield r, decision, attempt, wait
        if failures == 0:
            if before:
                self.states.removeKey((message_id,))
        elif not before or (failures, gate) != (before[0], before[1]):
            self.states.updateValue((message_id,), (failures, gate, seen))
            self.handle.registerTimer(seen + self.retention_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """No delivery since: the queue has dropped the message itself. The first timer of a
        group drops all that the watermark has passed."""
        if key not in self.swept:
            self.swept.add(key)
            bound = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            if self.states.exists():
                for id_ in [i for i, state in self.states.iterator() if state[2] + self.retention_ms <= bound]:
                    self.states.removeKey(id_)
        return iter(())

    def close(self) -> None:
        pass


class SeenIds(StatefulProcessor):
    """The end of the window of each id that was taken."""

    def __init__(self, window_ms: int):
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "expiry_ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[1].startswith("\0"):
            for r in rows:
                yield Row(**r.asDict(), duplicate=False)
            return
        before = self.state.get()
        expiry = before[0] if before else None
        for r in sorted(rows, key=lambda r: (r.t_ms, r.message_id)):
            duplicate = expiry is not None and r.t_ms < expiry
            if not duplicate:
                expiry = r.t_ms + self.window_ms
            yield Row(**r.asDict(), duplicate=duplicate)
        if not before or expiry != before[0]:
            self.state.update((expiry,))
            self.handle.registerTimer(expiry)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.state.get()
        if state and state[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


@dataclass(frozen=True)
class StateFolders:
    converted: str
    records: str
    ledger: str
    undeleted: str
    metrics: str
    late: str
    decided: str
    progress: str

    @staticmethod
    def below(root: str) -> "StateFolders":
        names = StateFolders.__dataclass_fields__
        return StateFolders(*(os.path.join(root, n) for n in names))


def decisions(rows: DataFrame, pipeline: Pipeline, lateness_ms: int, retention_ms: int = RETENTION_MS) -> DataFrame:
    """Decision and duplicate flag of every converted row of a stream that passed the filter
    and has a receive time, and a marker row per file."""
    policy = pipeline.retry_policy()
    placed = rows.withColumns({"file": F.col("_metadata.file_name"), "place": F.col("_metadata.row_index")})
    timed = placed.where("passed and received_at is not null").withWatermark("received_at", f"{lateness_ms} milliseconds")
    window = pipeline.dedup_window_ms
    key = dedup_id(pipeline.ordered()) if window > 0 else F.lit(None).cast("string")
    hashed = F.pmod(F.xxhash64("message_id"), F.lit(RETRY_GROUPS)).cast("int")
    keyed = keyed_rows(timed, policy).withColumn("dedup_key", key).select(
        "queue_url", hashed.alias("hashed"), "file", "place", "message_id", "received_at", "t_ms", "failed",
        "tie_order", "dedup_key", F.when(F.col("failed"), F.col("waits")).alias("waits"),
    )
    decided = keyed.groupBy("queue_url", "hashed").transformWithState(
        RetryStates(policy, retention_ms), T.StructType.fromDDL(DECIDED), "append", "EventTime",
        eventTimeColumnName="received_at",
    )
    group = F.concat(F.lit("\0"), F.pmod(F.xxhash64("packed"), F.lit(EXEMPT_GROUPS)).cast("string"))
    flagged = decided.withColumn("group", F.coalesce("dedup_key", group)).select(
        "queue_url", "group", *[n for n in names(DECIDED) if n != "queue_url"]
    )
    layout = T.StructType(flagged.schema.fields + [T.StructField("duplicate", T.BooleanType())])
    flagged = flagged.groupBy("queue_url", "group").transformWithState(
        SeenIds(window), layout, "append", "EventTime", eventTimeColumnName="received_at"
    )
    fields = ", ".join(f"{n}: {kind}" for n, kind in (c.split() for c in FOUND.split(", ")))
    packed = F.from_json("packed", f"array<struct<{fields}>>")
    flagged = flagged.select(
        F.explode(F.when(F.col("packed").isNull(), F.array(F.struct(*FOUND_NAMES))).otherwise(packed)).alias("row"), "duplicate"
    ).select("row.*", "duplicate")
    wanted = [*FOUND_NAMES, "duplicate"]
    first = placed.where("place = 0")
    markers = first.select(
        *[F.col(c) if c in ("file", "place") else F.lit(None).cast(flagged.schema[c].dataType).alias(c) for c in wanted]
    )
    return flagged.select(*wanted).unionByName(markers)


class DecidedBatches:
    """``foreachBatch`` body of ``decide``."""

    def __init__(self, pipeline: Pipeline, folders: StateFolders, layout: T.StructType, delete: Delete | None):
        self.pipeline, self.folders, self.layout, self.delete = pipeline, folders, layout, delete

    def stored(self, spark: SparkSession, df: DataFrame, folder: str, batch_id: int) -> DataFrame:
        path = batch_path(folder, batch_id)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def __call__(self, found: DataFrame, batch_id: int) -> None:
        spark, pipe, folders = found.sparkSession, self.pipeline, self.folders
        found = self.stored(spark, found, os.path.join(folders.progress, "found"), batch_id)
        # As many names as files in a batch, which the source's own limit bounds.
        files = [r.file for r in found.where("decision is null").collect()]
        if not files:
            return
        converted = spark.read.schema(self.layout).parquet(*[os.path.join(folders.converted, f) for f in files])
        converted = converted.withColumn(
            "delivery_id", F.concat_ws(":", "_metadata.file_name", F.col("_metadata.row_index").cast("string"))
        )
        made = found.where("decision is not null").select(
            F.concat_ws(":", "file", F.col("place").cast("string")).alias("delivery_id"),
            "decision", "attempt", "backoff_ms", "duplicate",
        )
        given_up = "dlq" if pipe.retry_policy().dead_letter else "drop"
        untimed = F.col("received_at").isNull()
        decided = converted.where("passed").select("delivery_id", *LEDGER_COLUMNS, "received_at").join(
            made, "delivery_id", "left"
        ).withColumns({
            "decision": F.coalesce("decision", F.when(untimed, given_up).otherwise("late")),
            "attempt": F.coalesce("attempt", F.when(untimed, pipe.retry.max_retries).otherwise(0)),
            "backoff_ms": F.coalesce("backoff_ms", F.lit(0)),
            "duplicate": F.coalesce("duplicate", F.lit(False)),
        })
        decided = self.stored(spark, decided, folders.decided, batch_id)
        outcome = Outcome(pipe, converted.select(*LEDGER_COLUMNS, "passed"), converted, decided)
        write_topic(outcome.output(), folders.records, batch_id)
        append_ledger(outcome.ledger(), folders.ledger, batch_id)
        if self.delete is not None:
            missed = delete_acknowledged(spark.read.parquet(batch_path(folders.ledger, batch_id)), self.delete)
            missed.write.mode("overwrite").parquet(batch_path(folders.undeleted, batch_id))
        late = decided.where("decision = 'late'").select(*LEDGER_COLUMNS, "received_at")
        late.write.mode("overwrite").parquet(batch_path(folders.late, batch_id))
        outcome.metrics().write.mode("overwrite").parquet(batch_path(folders.metrics, batch_id))


def start_converting(messages: DataFrame, pipeline: Pipeline, folders: StateFolders, trigger: dict):
    out = pipeline.convert_all(messages)
    query = (
        out.writeStream.format("parquet").option("path", folders.converted)
        .option("checkpointLocation", os.path.join(folders.progress, "convert")).trigger(**trigger).start()
    )
    return query, out.schema


def start_deciding(
    spark: SparkSession, layout: T.StructType, pipeline: Pipeline, folders: StateFolders, trigger: dict,
    lateness_ms: int, delete: Delete | None = None, max_files_per_trigger: int | None = None,
):
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    reader = spark.readStream.schema(layout)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    found = decisions(reader.parquet(folders.converted), pipeline, lateness_ms)
    return (
        found.writeStream.foreachBatch(DecidedBatches(pipeline, folders, layout, delete))
        .option("checkpointLocation", os.path.join(folders.progress, "decide")).trigger(**trigger).start()
    )


def start_stateful(
    messages: DataFrame, pipeline: Pipeline, root: str, lateness_ms: int = 60_000, interval: str = "1 second",
    delete: Delete | None = None, max_files_per_trigger: int | None = None,
):
    """Both queries, running until they are stopped; results lie below ``root``."""
    folders, trigger = StateFolders.below(root), {"processingTime": interval}
    convert, layout = start_converting(messages, pipeline, folders, trigger)
    decide = start_deciding(
        messages.sparkSession, layout, pipeline, folders, trigger, lateness_ms, delete, max_files_per_trigger
    )
    return [convert, decide], folders


def run_stateful(
    messages: DataFrame, pipeline: Pipeline, root: str, lateness_ms: int = 60_000, delete: Delete | None = None,
    max_files_per_trigger: int | None = None,
) -> StateFolders:
    """Work off everything that is there, then stop. A later run goes on from its states."""
    folders, trigger = StateFolders.below(root), {"availableNow": True}
    convert, layout = start_converting(messages, pipeline, folders, trigger)
    convert.awaitTermination()
    start_deciding(
        messages.sparkSession, layout, pipeline, folders, trigger, lateness_ms, delete, max_files_per_trigger
    ).awaitTermination()
    return folders


# The stateful operators by number, from the sink back, their states and columns.
SEEN_STATE = 0, "seen", ("key.*", "value.*")
RETRY_STATE = 1, "retry", ("key.queue_url", "user_map_key.*", "user_map_value.*")


def kept_states(spark: SparkSession, folders: StateFolders, which: tuple[int, str, tuple[str, ...]]) -> DataFrame:
    """(key.., value..) of the states that ``decide`` keeps now, read from its checkpoint."""
    operator, name, columns = which
    reader = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", name)
    return reader.load(os.path.join(folders.progress, "decide")).select(*columns)


def states_per_queue(spark: SparkSession, folders: StateFolders) -> DataFrame:
    """(queue_url, messages_in_retry, ids_tracked) as of the last batch."""
    retry = kept_states(spark, folders, RETRY_STATE).select("queue_url", F.lit(1).alias("r"), F.lit(0).alias("s"))
    seen = kept_states(spark, folders, SEEN_STATE).select("queue_url", F.lit(0).alias("r"), F.lit(1).alias("s"))
    return retry.unionByName(seen).groupBy("queue_url").agg(
        F.sum("r").alias("messages_in_retry"), F.sum("s").alias("ids_tracked")
    )
