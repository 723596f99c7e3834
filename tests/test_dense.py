"""Dense hot keys: segments cut by rows, single milliseconds too, against sequential models."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegate.operators.dedup import KEYS as DEDUP_KEYS, dedup_states, flag_duplicates, keyed_rows as dedup_rows
from tidegate.operators.gated import cut_dense
from tidegate.operators.retry import KEYS, RetryPolicy, cut_rows, retry_decisions, retry_states
from tests.helpers import in_order
from tests.test_state import decisions, dedup_model, deliveries, retry_model, sightings


def crowded(n, seed, span, most_at=None):
    """Rows of a hot key and some others within ``span`` ms, many at one instant."""
    draw = random.Random(seed)
    when = lambda: most_at if most_at is not None and draw.random() < 0.7 else draw.randrange(span)
    return [(draw.choice(["hot"] * 6 + ["k1", "k2", None]), when()) for _ in range(n)]


@pytest.mark.parametrize("window, span, most_at, dense", [(3, 200, None, 10), (50, 300, 17, 5), (1, 20, 3, 2), (7, 5000, None, 1)])
def test_dense_dedup(spark, window, span, most_at, dense):
    rows = crowded(900, window, span, most_at)
    got = in_order(flag_duplicates(sightings(spark, rows), window, 100, dense_rows=dense), "duplicate")
    assert got == dedup_model(rows, window)


@pytest.mark.parametrize("policy, span, most_at", [
    (RetryPolicy(3, 5, jitter=0.0, segment_ms=100, dense_rows=6), 300, None),
    (RetryPolicy(2, 1, jitter=0.0, segment_ms=1000, dense_rows=4), 100, 40),
    (RetryPolicy(1, 10, jitter=0.0, dense_rows=3), 30, 7),
    (RetryPolicy(5, 2, 1.0, jitter=0.0, segment_ms=10, dense_rows=2), 60, 11),
])
def test_dense_retries(spark, policy, span, most_at):
    draw = random.Random(span)
    rows = [(k or "n", t, draw.random() < 0.7) for k, t in crowded(800, span, span, most_at)]
    assert decisions(spark, rows, policy) == retry_model(rows, policy)


def test_no_part_holds_more_than_its_share(spark):
    policy = RetryPolicy(3, 5, jitter=0.0, dense_rows=50)
    rows = [("hot", 7 if i % 2 else i % 400, i % 3 > 0) for i in range(4000)]
    cut = cut_rows(deliveries(spark, rows), policy)
    sizes = [r["count"] for r in cut.groupBy(*KEYS, "segment").count().collect()]
    # Those of one instant are dealt by a hash, so a part is about that large.
    assert sum(sizes) == 4000 and max(sizes) <= 150 and len(sizes) > 40


def test_numbers_follow_time_and_do_not_depend_on_the_frame(spark):
    rows = crowded(500, 3, 200, 50)
    keyed = dedup_rows(sightings(spark, rows), 100, None, None).where(~F.col("exempt"))
    first = cut_dense(keyed, DEDUP_KEYS, "message_id", None, 5)
    again = cut_dense(keyed.repartition(7), DEDUP_KEYS, "message_id", None, 5)
    numbers = lambda df: {r.message_id: r.segment for r in df.collect()}
    assert numbers(first) == numbers(again)
    lines = first.groupBy(*DEDUP_KEYS, "segment").agg(F.min("t_ms").alias("a"), F.max("t_ms").alias("b")).collect()
    lines.sort(key=lambda r: (r.dedup_key, r.segment))
    for x, y in zip(lines, lines[1:]):
        assert x.dedup_key != y.dedup_key or x.b <= y.a


def test_states_of_a_cut_frame_serve_its_decisions(spark):
    policy = RetryPolicy(3, 5, jitter=0.0, dense_rows=4)
    rows = [("hot", t % 60, t % 4 > 0) for t in range(300)]
    df = deliveries(spark, rows)
    got = retry_decisions(df, policy, retry_states(df, policy)).orderBy("receipt_handle").collect()
    assert [(r.decision, r.attempt, r.backoff_ms) for r in got] == retry_model(rows, policy)
    sight = sightings(spark, [("hot", t % 90) for t in range(300)])
    states = dedup_states(sight, 11, dense_rows=4)
    got = in_order(flag_duplicates(sight, 11, states=states, dense_rows=4), "duplicate")
    assert got == dedup_model([("hot", t % 90) for t in range(300)], 11)
