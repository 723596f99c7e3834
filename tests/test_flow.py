import os
import tempfile

from pyspark.sql import functions as F

from tidegate.operators.claimcheck import claim_check
from tidegate.operators.retry import RetryPolicy
from tidegate.plans.pipeline import Pipeline
from tidegate.sources.messages import read_messages
from tidegate.sources.objects import read_objects
from tidegate.streaming.pipeline import read_batches, run_available
from tests.helpers import frame, gz64, message

FIFO = "orders.fifo"


def fail_on(word):
    """A step a user brings along."""

    def step(df):
        bad = F.col("body").contains(word) & F.col("error_class").isNull()
        return df.withColumns({
            "error_class": F.when(bad, "Refused").otherwise(F.col("error_class")),
            "error_message": F.when(bad, "bad word").otherwise(F.col("error_message"))})

    return step


def ordered(message_id, body, at_ms, key, receipt=None):
    return message(message_id, body, queue=FIFO, at_ms=at_ms, receipt=receipt,
                   attributes={"MessageGroupId": "g", "MessageDeduplicationId": key, "SequenceNumber": str(at_ms)},
                   user={"Type": "order"})


MESSAGES = [
    ordered("m-1", gz64('{"v":1}'), 0, "a"),
    ordered("m-2", gz64('{"v":2}'), 100, "a"),                      # duplicate of m-1
    ordered("m-3", '{"v":"bad"}', 200, "b", "r1"),                  # fails, tried again later
    message("m-4", "x", at_ms=300, user={"Type": "other"}),         # filtered out
    ordered("m-3", '{"v":"bad"}', 700, "b", "r2"),                  # too early
    ordered("m-5", '{"v":5}', 1300, "c"),
    ordered("m-3", '{"v":"bad"}', 1400, "b", "r3"),                 # second failure: dead letter
    ordered("m-6", '{"v":6}', 2100, "a"),                           # after the window: new again
    ordered("m-7", '{"v":7}', 2200, "b"),                           # failed sightings do not count
]


def pipeline():
    return Pipeline(
        "orders", policy='{"Type":["order"]}', extract_path="v", dlq_topic="dead",
        retry=RetryPolicy(2, 1000, jitter=0.0), dedup_window_ms=2000,
    ).decompress().then(fail_on("bad"))


EXPECTED = {("orders", "m-1", "1"), ("orders", "m-5", "5"), ("dead", "m-3", '{"v":"bad"}'), ("orders", "m-6", "6"), ("orders", "m-7", "7")}


def test_table(spark):
    done = pipeline().run(spark, frame(spark, MESSAGES))
    out = done.output()
    assert {(r.topic, r.message_id, r.value) for r in out.collect()} == EXPECTED
    assert {r.key for r in out.where("topic = 'orders'").collect()} == {"g"}
    fates = {(r.message_id, r.receipt_handle): (r.decision, r.duplicate) for r in done.decided.collect()}
    assert fates["m-2", "receipt-m-2"] == ("emit", True)
    assert [fates["m-3", f"r{i}"][0] for i in (1, 2, 3)] == ["retry", "backoff", "dlq"]
    acked = {(r.message_id, r.receipt_handle) for r in done.ledger().collect()}
    assert acked == {(m, f"receipt-{m}") for m in ("m-1", "m-2", "m-4", "m-5", "m-6", "m-7")} | {("m-3", "r3")}
    counts = {r.queue_url: r for r in done.metrics().collect()}[FIFO]
    assert (counts.messages_received, counts.messages_sent, counts.messages_deleted) == (8, 5, 6)
    assert (counts.messages_failed, counts.messages_retried, counts.messages_deduplicated, counts.messages_in_backoff) == (2, 1, 1, 1)


def test_without_dead_letters_and_deletes(spark):
    from dataclasses import replace

    done = replace(pipeline(), dlq_topic=None, delete_enabled=False).run(spark, frame(spark, MESSAGES))
    assert {t for t, in done.output().select("topic").collect()} == {"orders"}
    assert done.decided.where("decision = 'drop'").count() == 1
    assert done.ledger().count() == 0


def test_stream_equals_table_and_resumes(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    landing = os.path.join(root, "landing")
    for part in (MESSAGES[:3], MESSAGES[3:6]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(landing)
    stream = lambda: read_messages(spark, landing, streaming=True, max_files_per_trigger=1)
    folders = run_available(stream(), pipeline(), root)
    frame(spark, MESSAGES[6:]).coalesce(1).write.mode("append").parquet(landing)
    run_available(stream(), pipeline(), root)  # goes on where the first run stopped
    out = read_batches(spark, folders.records)
    assert {(r.topic, r.message_id, r.value) for r in out.collect()} == EXPECTED and out.count() == len(EXPECTED)
    assert {r.batch_id for r in out.collect()} == {0, 1, 2}
    assert read_batches(spark, folders.ledger).count() == 7
    total = read_batches(spark, folders.metrics).agg(F.sum("messages_sent")).first()[0]
    assert total == 5


def keep_the_fifth(queue, entries):
    assert queue in (FIFO, "https://queue.example.com/123456789012/test-queue") and len(entries) <= 10
    return [m for m, _ in entries if m == "m-5"]


def test_stream_deletes_after_writing(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    frame(spark, MESSAGES).coalesce(1).write.parquet(f"{root}/landing")
    source = read_messages(spark, f"{root}/landing", streaming=True)
    folders = run_available(source, pipeline(), root, delete=keep_the_fifth)
    assert [r.message_id for r in read_batches(spark, folders.undeleted).collect()] == ["m-5"]
    assert read_batches(spark, folders.ledger).count() == 7


def test_replayed_batch_changes_nothing(spark):
    from tidegate.streaming.pipeline import MicroBatches, StreamFolders

    folders = StreamFolders.below(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    body = MicroBatches(pipeline(), folders, 60_000)
    parts = [frame(spark, MESSAGES[:5]), frame(spark, MESSAGES[5:])]
    for n in (0, 1, 1):
        body(parts[n], n)
    assert read_batches(spark, folders.records).count() == len(EXPECTED)


def test_lookup_on_a_stream(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    os.makedirs(f"{root}/objects")
    for name in "ab":
        with open(f"{root}/objects/{name}", "w") as f:
            f.write(f"content {name}")
    frame(spark, [message(f"m-{n}", f"s3://bucket/{n}") for n in "abc"]).write.parquet(f"{root}/in")
    objects = read_objects(spark, f"{root}/objects", "bucket")
    done = claim_check(read_messages(spark, f"{root}/in", streaming=True), objects)
    query = (done.select("message_id", "body", "error_class").writeStream.trigger(availableNow=True)
             .option("checkpointLocation", f"{root}/progress").start(f"{root}/out", format="parquet"))
    query.awaitTermination()
    got = {r.message_id: (r.body, r.error_class) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {"m-a": ("content a", None), "m-b": ("content b", None), "m-c": ("s3://bucket/c", "ObjectNotFound")}


def test_pipeline_filter_reaches_the_scan(spark, tmp_path):
    from tidegate.sources.queues import land_messages

    rows = [message(f"msg-{i}", user={"vip": "gold"} if i % 2 else {}) for i in range(6)]
    land_messages(frame(spark, rows[:4]), str(tmp_path / "in"), ["vip"])
    land_messages(frame(spark, rows[4:]), str(tmp_path / "in"))
    landed = read_messages(spark, str(tmp_path / "in"), promoted=["vip"])
    pipe = Pipeline(topic="t", policy='{"vip":["gold"]}')
    converted = pipe.convert(landed)
    assert sorted(r.message_id for r in converted.collect()) == ["msg-1", "msg-3", "msg-5"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = pipe.convert(landed)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(promoted.vip.text,gold)" in plan and "IsNull(promoted.vip.present)" in plan


def test_every_queue_is_read_though_one_is_never_empty(spark):
    from tidegate.sources.queues import receive_messages

    queues = [f"q{i}" for i in range(15)]

    def receive(queue, most, wait):
        state = globals().setdefault("_polled", {})
        state[queue] = state.get(queue, 0) + 1
        if queue != "q3" and state[queue] > 1:
            return []
        return [message(f"{queue}-{state[queue]}-{k}", "b") for k in range(most)]

    got = receive_messages(spark, queues, receive, max_seconds=2.0)
    assert got.rdd.getNumPartitions() == 15
    counts = {r.queue_url: r["count"] for r in got.groupBy("queue_url").count().collect()}
    assert set(counts) == set(queues) and counts["q3"] > 10


def test_untimed_messages_disturb_nobody(spark):
    rows = [message("msg-0", "a"), {**message("msg-1", "b"), "received_at": None}]
    done = Pipeline(topic="t", dlq_topic="dead", retry=RetryPolicy(max_retries=5)).run(spark, frame(spark, rows))
    assert {r.message_id: r.topic for r in done.output().collect()} == {"msg-0": "t", "msg-1": "dead"}
    assert done.ledger().count() == 2


def test_parts_land_in_a_file_per_task(spark, sf_dir, tmp_path):
    from pathlib import Path

    from tidegate.plans.flow_queries import landed_stream, packed_events
    from tidegate.plans.live_queries import halves, run_in_parts

    messages = packed_events(spark, sf_dir)
    tasks = messages.rdd.getNumPartitions()
    assert tasks > 2
    landed_stream(spark, messages, str(tmp_path / "a"))
    assert len(list(Path(tmp_path / "a/landing").glob("part-*"))) == 3 * tasks
    run_in_parts(spark, messages, halves(), Pipeline(topic="events"), str(tmp_path / "b"), 60 * 86_400_000)
    assert len(list(Path(tmp_path / "b/landing").glob("part-*"))) == 2 * tasks


def test_order_across_slices_of_files(spark, monkeypatch):
    from tidegate.plans.flow_queries import order_by_slices

    rows = [("a", 1, "f", 0, 0), ("a", 2, "f", 1, 0), ("a", 3, "f", 2, 1), ("a", 4, "g", 0, 0),
            ("b", 1, "f", 3, 1), ("b", 9, "f", 4, 2), ("b", 5, "g", 1, 0),
            ("c", 2, "f", 5, 2), ("c", 1, "f", 6, 2), (None, None, "g", 2, 1), (None, 7, "g", 3, 1)]
    placed = spark.createDataFrame(rows, "group_id string, sequence bigint, file string, row bigint, slice bigint")
    found = {r.group_id: (r.records, r.in_order) for r in order_by_slices(placed).collect()}
    assert found == {"a": (4, True), "b": (3, False), "c": (2, False), None: (2, True)}
