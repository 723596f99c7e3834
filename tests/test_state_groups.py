"""The retry operator over groups of message ids: what it asks of the store, and its decisions."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import Row

from tidegate.operators.retry import RetryPolicy
from tidegate.streaming.state_store import FOUND_NAMES, PACKED_ROWS, RetryStates

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
WAITS = [1000, 2000]


class Store:
    """States of one group, with the calls that were made."""

    def __init__(self):
        self.kept, self.timers, self.calls = {}, set(), []

    def getMapState(self, name, key, value):  # noqa: N802
        return self

    def exists(self):
        self.calls.append("exists")
        return bool(self.kept)

    def getValue(self, key):  # noqa: N802
        self.calls.append("get")
        return self.kept.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.calls.append("update")
        self.kept[key] = value

    def removeKey(self, key):  # noqa: N802
        self.calls.append("remove")
        del self.kept[key]

    def iterator(self):
        return iter(list(self.kept.items()))

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)


class Times:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs  # noqa: N815


def operator(store, retention_ms=10**9):
    states = RetryStates(RetryPolicy(3, 1000, jitter=0.0), retention_ms)
    states.init(store)
    return states


def delivery(place, id_, t_ms, failed=False, dedup=None):
    return Row(
        queue_url="q", hashed=0, file="f", place=place, message_id=id_, received_at=START + timedelta(milliseconds=t_ms),
        t_ms=t_ms, failed=failed, tie_order=f"{place:09d}", dedup_key=dedup, waits=WAITS if failed else None,
    )


def found(rows):
    """(place, decision, attempt, back-off) of every row, packed or not."""
    out = []
    for r in rows:
        for p in [r.asDict()] if r.packed is None else json.loads(r.packed):
            assert set(FOUND_NAMES) <= set(p)
            out.append((p["place"], p["decision"], p["attempt"], p["backoff_ms"]))
    return sorted(out)


def plain(batches):
    """The fold over each message, batch by batch."""
    states, out = {}, []
    for batch in batches:
        for r in sorted(batch, key=lambda r: (r.t_ms, r.failed, r.tie_order)):
            failures, gate = states.pop(r.message_id, (0, None))
            if gate is not None and r.t_ms < gate:
                found, states[r.message_id] = ("backoff", 0, 0), (failures, gate)
            elif not r.failed:
                found = ("emit", 0, 0)
            elif failures + 1 == 3:
                found = ("dlq", 3, 0)
            else:
                wait = WAITS[failures]
                found, states[r.message_id] = ("retry", failures + 1, wait), (failures + 1, r.t_ms + wait)
            out.append((r.place, *found))
    return sorted(out), states


def test_messages_without_a_state_cost_no_call_each():
    store = Store()
    n = 2 * PACKED_ROWS + 1
    rows = [delivery(i, f"m{i}", i) for i in range(n)]
    got = list(operator(store).handleInputRows(("q", 0), iter(rows), None))
    assert store.calls == ["exists"] and not store.timers
    assert len(got) == 3 and found(got) == [(i, "emit", 0, 0) for i in range(n)]
    assert got[-1].received_at == rows[-1].received_at and got[0].packed is not None


def test_rows_with_an_id_stay_rows():
    got = list(operator(Store()).handleInputRows(("q", 0), iter([
        delivery(0, "a", 5, dedup="x"), delivery(1, "b", 6), delivery(2, "c", 7, failed=True, dedup="y"),
    ]), None))
    assert [(r.message_id, r.dedup_key, r.t_ms) for r in got if r.packed is None] == [("a", "x", 5)]
    assert found(got) == [(0, "emit", 0, 0), (1, "emit", 0, 0), (2, "retry", 1, 1000)]


def test_a_group_decides_as_each_of_its_messages():
    draw = random.Random(3)
    ids = [None, *(f"m{i}" for i in range(20))]
    batches, place = [], 0
    for start in (0, 4000, 8000):
        batch = []
        for _ in range(80):
            batch.append(delivery(place, draw.choice(ids), start + draw.randrange(4000), draw.random() < 0.6))
            place += 1
        batches.append(batch)
    store = Store()
    got = [r for b in batches for r in operator(store).handleInputRows(("q", 0), iter(b), None)]
    want, states = plain(batches)
    assert found(got) == want
    assert {i: (f, g) for (i,), (f, g, _) in store.kept.items()} == states and states


def test_timers_drop_what_the_watermark_passed():
    store = Store()
    states = operator(store, retention_ms=100)
    rows = [delivery(0, "a", 10, True), delivery(1, "b", 20, True), delivery(2, "c", 900, True)]
    list(states.handleInputRows(("q", 0), iter(rows), None))
    assert store.timers == {110, 120, 1000}
    for at in (110, 120):
        assert list(states.handleExpiredTimer(("q", 0), Times(500), Times(at))) == []
    assert list(store.kept) == [("c",)]
