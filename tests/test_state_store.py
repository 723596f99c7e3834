"""The stateful pipeline: equal to the table's plan, over several runs and a failure."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegate.operators.retry import RetryPolicy
from tidegate.plans.envelopes import event_messages
from tidegate.plans.flow_queries import flow, packed_events, record_summary
from tidegate.plans.pipeline import Pipeline
from tidegate.sources.messages import read_messages
from tidegate.streaming.state_store import (
    RETRY_STATE, SEEN_STATE, StateFolders, kept_states, run_stateful, states_per_queue,
)
from tests.helpers import frame, message

DAY_MS = 86_400_000


def land(df, root):
    df.coalesce(2).write.mode("append").parquet(f"{root}/landing")


def stream(spark, root):
    return read_messages(spark, f"{root}/landing", streaming=True, max_files_per_trigger=2)


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def fails_by_body(df):
    bad = (F.col("body") == "bad") & F.col("error_class").isNull()
    return df.withColumn("error_class", F.when(bad, "Refused").otherwise(F.col("error_class")))


def decided(spark, folders):
    return spark.read.parquet(folders.decided)


def test_records_ledger_and_counters_equal_the_table(spark, sf_dir, tmp_path):
    messages = packed_events(spark, sf_dir)
    for part in (F.dayofmonth("received_at") <= 12, F.dayofmonth("received_at") > 12):
        land(messages.where(part), tmp_path)
        folders = run_stateful(stream(spark, tmp_path), flow(), str(tmp_path / "out"), lateness_ms=30 * DAY_MS)
    want = flow().run(spark, messages)
    got = record_summary(spark.read.parquet(folders.records)).collect()
    assert sorted(map(key, got)) == sorted(map(key, record_summary(want.output()).collect()))
    ledger = ["queue_url", "message_id", "receipt_handle"]
    assert sorted(map(key, spark.read.parquet(folders.ledger).select(*ledger).collect())) == sorted(
        map(key, want.ledger().select(*ledger).collect()))
    counts = spark.read.parquet(folders.metrics)
    names = [c for c in want.metrics().columns if c != "queue_url"]
    summed = counts.groupBy("queue_url").agg(*[F.sum(n).alias(n) for n in names]).collect()
    assert sorted(map(key, summed)) == sorted(map(key, want.metrics().collect()))
    assert spark.read.parquet(folders.late).count() == 0


@pytest.fixture
def pipe():
    return Pipeline(topic="t", retry=RetryPolicy(3, 1000, jitter=0.0), dedup_window_ms=5000, dlq_topic="dead").then(fails_by_body)


def runs(spark, tmp_path, pipe, parts, lateness_ms=60_000):
    for part in parts:
        land(frame(spark, part), tmp_path)
        folders = run_stateful(stream(spark, tmp_path), pipe, str(tmp_path / "out"), lateness_ms=lateness_ms)
    return folders


def delivery(id_, second, n, body="bad"):
    return message(id_, body=body, at_ms=round(second * 1000), receipt=f"{id_}-{n}")


def test_retries_go_on_from_run_to_run(spark, tmp_path, pipe):
    # Failures at 0 and 1 s, too early at 1.5 s, the third at 10 s; success clears.
    parts = [
        [delivery("a", 0, 1), delivery("b", 0, 1)],
        [delivery("a", 1, 2), delivery("a", 1.5, 3), delivery("b", 5, 2, "good")],
        [delivery("a", 10, 4), delivery("b", 11, 3)],
    ]
    folders = runs(spark, tmp_path, pipe, parts)
    got = {r.receipt_handle: (r.decision, r.attempt, r.backoff_ms) for r in decided(spark, folders).collect()}
    assert got == {
        "a-1": ("retry", 1, 1000), "a-2": ("retry", 2, 2000), "a-3": ("backoff", 0, 0), "a-4": ("dlq", 3, 0),
        "b-1": ("retry", 1, 1000), "b-2": ("emit", 0, 0), "b-3": ("retry", 1, 1000),
    }
    kept = kept_states(spark, folders, RETRY_STATE).collect()
    assert [(r.message_id, r.failures) for r in kept] == [("b", 1)]
    assert {r.receipt_handle for r in spark.read.parquet(folders.ledger).collect()} == {"a-4", "b-2"}


def fifo(id_, second, dedup):
    return message(id_, queue="q.fifo", at_ms=round(second * 1000),
                   attributes={"MessageDeduplicationId": dedup, "MessageGroupId": "g"})


def test_windows_expire_with_the_watermark(spark, tmp_path, pipe):
    parts = [
        [fifo("1", 0, "x"), fifo("2", 1, "x"), fifo("3", 0, "y")],
        [fifo("4", 4.999, "x"), fifo("5", 5, "x")],
        [fifo("6", 200, "z")],
    ]
    folders = runs(spark, tmp_path, pipe, parts, lateness_ms=10_000)
    flags = {r.message_id: r.duplicate for r in decided(spark, folders).collect()}
    assert flags == {"1": False, "2": True, "3": False, "4": True, "5": False, "6": False}
    assert [r.group for r in kept_states(spark, folders, SEEN_STATE).collect()] == ["z"]
    assert [tuple(r) for r in states_per_queue(spark, folders).collect()] == [("q.fifo", 0, 1)]


def test_rows_behind_the_bound_are_left_to_the_queue(spark, tmp_path, pipe):
    parts = [[fifo("1", 100, "x")], [fifo("2", 95, "y"), fifo("3", 20, "z"), fifo("4", 101, "w")]]
    folders = runs(spark, tmp_path, pipe, parts, lateness_ms=10_000)
    assert [r.message_id for r in spark.read.parquet(folders.late).collect()] == ["3"]
    assert sorted(r.message_id for r in spark.read.parquet(folders.ledger).collect()) == ["1", "2", "4"]
    assert sorted(r.message_id for r in spark.read.parquet(folders.records).collect()) == ["1", "2", "4"]


def test_rejected_and_untimed_messages(spark, tmp_path):
    pipe = Pipeline(topic="t", dlq_topic="dead", policy='{"Type":["a"]}')
    rows = [message(f"m{i}", user={"Type": k}) for i, k in enumerate("abab")]
    rows = rows[:2] + [{**m, "received_at": None} for m in rows[2:]]
    folders = runs(spark, tmp_path, pipe, [rows])
    assert {(r.message_id, r.topic) for r in spark.read.parquet(folders.records).collect()} == {("m0", "t"), ("m2", "dead")}
    assert sorted(r.message_id for r in spark.read.parquet(folders.ledger).collect()) == ["m0", "m1", "m2", "m3"]


def test_a_failed_batch_is_decided_once(spark, tmp_path, pipe, monkeypatch):
    """The sink breaks after the states were touched; the replay starts from those before."""
    from tidegate.streaming import state_store

    land(frame(spark, [delivery("a", 0, 1)]), tmp_path)
    real, broken = state_store.write_topic, []

    def write_topic(records, root, batch_id):
        if not broken:
            broken.append(1)
            raise RuntimeError("the sink is down")
        real(records, root, batch_id)

    monkeypatch.setattr(state_store, "write_topic", write_topic)
    with pytest.raises(Exception, match="sink is down"):
        run_stateful(stream(spark, tmp_path), pipe, str(tmp_path / "out"))
    folders = run_stateful(stream(spark, tmp_path), pipe, str(tmp_path / "out"))
    assert [(r.decision, r.attempt) for r in decided(spark, folders).collect()] == [("retry", 1)]
    assert [r.failures for r in kept_states(spark, folders, RETRY_STATE).collect()] == [1]


def test_a_batch_writes_only_the_states_it_touched(spark, tmp_path, pipe):
    import glob
    import os

    first = [fifo(str(i), i / 1000, f"id{i}") for i in range(4000)]
    folders = runs(spark, tmp_path, pipe, [first, [fifo("last", 4, "one more")]], lateness_ms=10**9)
    assert kept_states(spark, folders, SEEN_STATE).count() == 4001
    changes = glob.glob(f"{folders.progress}/decide/state/0/*/**/*.changelog", recursive=True)
    by_version = Counter()
    for path in changes:
        by_version[os.path.basename(path).split(".")[0].split("_")[0]] += os.path.getsize(path)
    sizes = [by_version[v] for v in sorted(by_version, key=int)]
    assert len(sizes) > 1 and min(sizes[1:]) < max(sizes) / 4
