import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidegate.functions.backoff import MAX_BACKOFF_MS, backoff_ms, backoff_schedule, unit_draw
from tidegate.operators.ack import ack_ledger, pending
from tidegate.operators.dedup import dedup_states, drop_duplicates, flag_duplicates, tracked_ids
from tidegate.operators.gated import final_states
from tidegate.operators.ordering import fifo_order, group_positions
from tidegate.operators.retry import RetryPolicy, retry_decisions, retry_status
from tidegate.sinks.topics import delete_acknowledged
from tests.helpers import frame, in_order, message


def sightings(spark, rows, queue="q.fifo"):
    return frame(spark, [
        message(f"msg-{i}", attributes={} if key is None else {"MessageDeduplicationId": key}, queue=queue, at_ms=t)
        for i, (key, t) in enumerate(rows)])


def dedup_model(rows, window):
    expiry, out = {}, []
    for i, (key, t) in sorted(enumerate(rows), key=lambda r: (r[1][1], f"msg-{r[0]}")):
        duplicate = bool(key) and key in expiry and t < expiry[key]
        if key and not duplicate:
            expiry[key] = t + window
        out.append((i, duplicate))
    return [d for _, d in sorted(out)]


def test_window_rule(spark):
    rows = [("a", 0), ("a", 10), ("a", 49), ("a", 50), ("a", 99), ("a", 110), (None, 0), (None, 1), ("", 0), ("", 1)]
    flags = in_order(flag_duplicates(sightings(spark, rows), 50), "duplicate")
    assert flags == [False, True, True, False, True, False] + [False] * 4
    assert drop_duplicates(sightings(spark, rows, "plain-queue"), 50).count() == len(rows)
    assert flag_duplicates(sightings(spark, rows), 0).where("duplicate").count() == 0


def test_keys_are_per_queue(spark):
    a, b = sightings(spark, [("a", 0)]), sightings(spark, [("a", 1)], "other.fifo")
    assert flag_duplicates(a.unionByName(b), 1000).where("duplicate").count() == 0


def test_tracked(spark):
    flagged = flag_duplicates(sightings(spark, [("a", 0), ("a", 10), ("b", 60), (None, 70)]), 50)
    start = F.unix_millis(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    counts = {n: tracked_ids(flagged, start + n, 50).first().tracked_count for n in (0, 49, 50, 109, 110)}
    assert counts == {0: 2, 49: 2, 50: 1, 109: 1, 110: 0}


@pytest.mark.parametrize("window,segment,batch", [(300, 1000, 4096), (700, 200, 97), (50, 10, 33), (5000, 3000, 10), (1, 7, 500)])
def test_hot_key_matches_model(spark, window, segment, batch):
    """One id holds two fifths of the rows; segments, windows and Arrow batches of
    many sizes give what one sequential pass gives."""
    draw = random.Random(window)
    rows = [(draw.choice(["hot"] * 4 + [None, ""] + [f"k{draw.randrange(40)}"] * 4), draw.randrange(30000)) for _ in range(2500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        flags = in_order(flag_duplicates(sightings(spark, rows), window, segment), "duplicate")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4096)
    assert flags == dedup_model(rows, window)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 400)), min_size=1, max_size=60),
       st.integers(1, 120), st.integers(1, 300))
def test_dedup_property(spark, rows, window, segment):
    assert in_order(flag_duplicates(sightings(spark, rows), window, segment), "duplicate") == dedup_model(rows, window)


def test_dedup_in_slices_matches_one_pass(spark):
    """States carried over three frames in time order give the flags of one frame."""
    draw = random.Random(5)
    rows = sorted([(draw.choice(["hot", "hot", f"k{draw.randrange(9)}"]), draw.randrange(3000)) for _ in range(600)], key=lambda r: r[1])
    df = sightings(spark, rows)
    base = df.select(F.min(F.unix_millis("received_at"))).first()[0]
    got, before = {}, None
    for low in (0, 1000, 2000):
        part = df.where((F.unix_millis("received_at") - base >= low) & (F.unix_millis("received_at") - base < low + 1000))
        states = dedup_states(part, 170, 90, initial=before, finals=True, keep_after_ms=base + low)
        got.update((r.message_id, r.duplicate) for r in flag_duplicates(part, 170, 90, states=states).collect())
        kept = final_states(states, ["queue_url", "dedup_key"])
        before = spark.createDataFrame(kept.collect(), kept.schema)
    base_row = dedup_model([(k, v - rows[0][1]) for k, v in rows], 170)
    assert [got[f"msg-{i}"] for i in range(len(rows))] == base_row


# --- retry --------------------------------------------------------------------------

def deliveries(spark, rows):
    messages = [message(key, queue="q", at_ms=t, receipt=f"r{i:05d}") for i, (key, t, _) in enumerate(rows)]
    failed = [f"r{i:05d}" for i, r in enumerate(rows) if r[2]]
    df = frame(spark, messages)
    bad = F.col("receipt_handle").isin(*failed) if failed else F.lit(False)
    return df.withColumns({"error_class": F.when(bad, "E"), "error_message": F.when(bad, F.concat(F.lit("at "), "receipt_handle"))})


def retry_model(rows, policy):
    state, out = {}, {}
    for i, (key, t, failed) in sorted(enumerate(rows), key=lambda r: (r[1][1], r[1][2], r[0])):
        n, gate = state.get(key, (0, -1))
        if t < gate:
            out[i] = ("backoff", 0, 0)
        elif not failed:
            state.pop(key, None)
            out[i] = ("emit", 0, 0)
        elif n + 1 >= policy.max_retries:
            state.pop(key, None)
            out[i] = ("dlq" if policy.dead_letter else "drop", n + 1, 0)
        else:
            wait = min(MAX_BACKOFF_MS, max(1, int(policy.base_ms * policy.multiplier**n)))
            state[key] = (n + 1, t + wait)
            out[i] = ("retry", n + 1, wait)
    return [out[i] for i in range(len(rows))]


def decisions(spark, rows, policy, states=None):
    got = retry_decisions(deliveries(spark, rows), policy).orderBy("receipt_handle").collect()
    return [(r.decision, r.attempt, r.backoff_ms) for r in got]


def test_retry_life(spark):
    rows = [("m", 0, True), ("m", 500, True), ("m", 1000, True), ("m", 2000, False), ("m", 3000, True), ("n", 0, False), ("m", 3001, False)]
    policy = RetryPolicy(3, 1000, jitter=0.0)
    assert decisions(spark, rows, policy) == [
        ("retry", 1, 1000), ("backoff", 0, 0), ("retry", 2, 2000), ("backoff", 0, 0), ("dlq", 3, 0), ("emit", 0, 0), ("emit", 0, 0)]
    assert decisions(spark, [("m", 0, True)], RetryPolicy(0)) == [("dlq", 1, 0)]
    assert decisions(spark, [("m", 0, True)], RetryPolicy(1, dead_letter=False)) == [("drop", 1, 0)]


@pytest.mark.parametrize("policy", [
    RetryPolicy(3, 100, jitter=0.0, segment_ms=1000), RetryPolicy(5, 500, jitter=0.0, segment_ms=300),
    RetryPolicy(1, 100, jitter=0.0), RetryPolicy(4, 20, 3.0, jitter=0.0, segment_ms=50)])
def test_retry_hot_key_matches_model(spark, policy):
    draw = random.Random(policy.max_retries)
    rows = [(draw.choice(["hot", f"k{draw.randrange(30)}"]), draw.randrange(40000), draw.random() < 0.6) for _ in range(2000)]
    assert decisions(spark, rows, policy) == retry_model(rows, policy)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 2000), st.booleans()), min_size=1, max_size=50),
       st.integers(0, 4), st.integers(1, 400), st.integers(1, 900))
def test_retry_property(spark, rows, max_retries, base, segment):
    policy = RetryPolicy(max_retries, base, jitter=0.0, segment_ms=segment)
    assert decisions(spark, rows, policy) == retry_model(rows, policy)


def test_retry_status(spark):
    rows = [("a", 0, True), ("a", 1000, True), ("a", 1001, True), ("b", 0, True), ("b", 2000, False), ("c", 0, False)]
    status = retry_status(retry_decisions(deliveries(spark, rows), RetryPolicy(3, 1000, jitter=0.0))).collect()
    assert [(r.message_id, r.retry_count, r.last_error) for r in status] == [("a", 2, "at r00001")]


def test_backoff(spark):
    rows = spark.range(1, 5).select(backoff_ms(F.col("id"), 1000, 2.0, 0.0).alias("w")).collect()
    assert [r.w for r in rows] == [1000, 2000, 4000, 8000]
    assert spark.range(1).select(backoff_ms(F.lit(5), 100000, 10.0, 0.0)).first()[0] == MAX_BACKOFF_MS
    assert spark.range(1).select(backoff_ms(F.lit(5000), 1000, 2.0, 0.0)).first()[0] == MAX_BACKOFF_MS
    jittered = spark.range(500).select(backoff_ms(F.lit(1), 1000, 2.0, 0.5, unit_draw("id", F.lit(1))).alias("w"))
    waits = [r.w for r in jittered.collect()]
    assert all(500 <= w <= 1500 for w in waits) and len(set(waits)) > 100
    assert waits == [r.w for r in jittered.collect()]
    wide = spark.range(500).select(backoff_ms(F.lit(1), 1000, 2.0, 7.0, unit_draw("id")).alias("w")).collect()
    assert all(1 <= r.w <= 2000 for r in wide)
    assert spark.range(1).select(F.size(backoff_schedule(F.lit("m"), 4, 10))).first()[0] == 3


# --- acknowledgement and order --------------------------------------------------------

def refuse_some(queue, entries):
    assert 1 <= len(entries) <= 10
    return [m for m, _ in entries if m.endswith("7")]


def test_ack(spark):
    df = frame(spark, [message(f"msg-{i}", queue=f"q{i % 2}") for i in range(95)])
    ledger = ack_ledger(df, lanes=2)
    sizes = ledger.groupBy("queue_url", "lane", "ack_batch").count().collect()
    assert max(r["count"] for r in sizes) == 10 and sum(r["count"] for r in sizes) == 95
    assert ack_ledger(df, False).count() == 0
    left = pending(df, ack_ledger(df.where("queue_url = 'q0'")))
    assert {r.queue_url for r in left.collect()} == {"q1"} and left.count() == 47
    missed = delete_acknowledged(ledger, refuse_some).collect()
    assert sorted(r.message_id for r in missed) == sorted(f"msg-{i}" for i in range(95) if i % 10 == 7)


def test_order(spark):
    rows = [(g, s) for g in ("a", "b") for s in (10, 9, 100, 99, 18446744073709551615)]
    df = frame(spark, [message(f"msg-{i}", queue="q.fifo", attributes={"MessageGroupId": g, "SequenceNumber": str(s)})
                       for i, (g, s) in enumerate(rows)])
    placed = {(r.group_id, int(r.sequence)): r.position for r in group_positions(df, 50).collect()}
    assert placed == {(g, s): p for g in ("a", "b") for p, s in enumerate((9, 10, 99, 100, 18446744073709551615), 1)}
    lost = df.withColumn("attributes", F.map_filter("attributes", lambda k, v: k == "MessageGroupId"))
    assert group_positions(lost, 50).count() == len(rows)  # rows without a sequence stay
    seen = fifo_order(df, 3).select("group_id", "sequence").collect()
    assert [(r.group_id, int(r.sequence)) for r in seen] == sorted((g, s) for g, s in rows)
