"""The catalog under several writers: dense versions, one id per schema, nothing lost."""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

import pytest

from tidegate.sinks.schema_log import SchemaLog

LAYOUT = "subject string, profile string, schema_json string"


def candidates(spark, *rows):
    return spark.createDataFrame([(s, "json", j) for s, j in rows], LAYOUT)


def checked(log):
    rows = log.read().collect()
    versions, ids = defaultdict(list), defaultdict(set)
    for r in rows:
        versions[r.subject].append(r.version)
        ids[r.fingerprint].add(r.schema_id)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in versions.values())
    assert all(len(i) == 1 for i in ids.values())
    assert len({(r.subject, r.fingerprint) for r in rows}) == len(rows)
    return {(r.subject, r.schema_json) for r in rows}


def test_a_slower_writer_computes_anew(spark, tmp_path, monkeypatch):
    log, other = SchemaLog(spark, str(tmp_path)), SchemaLog(spark, str(tmp_path))
    real, times = SchemaLog.claim, []

    def claim(self, number, name):
        if self is log and not times:
            times.append(number)
            assert other.register(candidates(spark, ("a", "{1}"), ("a", "{2}"))).count() == 2
        return real(self, number, name)

    monkeypatch.setattr(SchemaLog, "claim", claim)
    added = log.register(candidates(spark, ("a", "{2}"), ("a", "{3}"), ("b", "{2}")))
    assert sorted((r.subject, r.schema_json) for r in added.collect()) == [("a", "{3}"), ("b", "{2}")]
    assert {r.schema_json: r.version for r in added.where("subject = 'a'").collect()} == {"{3}": 3}
    assert checked(log) == {("a", "{1}"), ("a", "{2}"), ("a", "{3}"), ("b", "{2}")}
    assert len(log.commits()) == 2


def test_writers_at_once(spark, tmp_path):
    def write(n):
        rows = [("s", f"{{{k}}}") for k in range(n, n + 4)] + [(f"own{n}", "{}")]
        return SchemaLog(spark, str(tmp_path)).register(candidates(spark, *rows)).count()

    with ThreadPoolExecutor(4) as pool:
        added = list(pool.map(write, range(5)))
    log = SchemaLog(spark, str(tmp_path))
    assert checked(log) == {("s", f"{{{k}}}") for k in range(8)} | {(f"own{n}", "{}") for n in range(5)}
    assert sum(added) == log.read().count()


def test_nothing_new_is_no_commit(spark, tmp_path):
    log = SchemaLog(spark, str(tmp_path))
    assert log.read().count() == 0
    log.register(candidates(spark, ("a", "{}"), ("a", "{}")))
    assert log.register(candidates(spark, ("a", "{}"))).count() == 0 and len(log.commits()) == 1


def test_a_mark_is_set_once(spark, tmp_path):
    log = SchemaLog(spark, str(tmp_path))
    assert log.claim(1, "x") and not log.claim(1, "y") and log.table_of(1).endswith("/x")
    log.local = None  # by rename, as on file systems without links
    assert not log.claim(1, "z") and log.claim(2, "z") and log.table_of(2).endswith("/z")


def test_it_gives_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SchemaLog, "claim", lambda self, number, name: False)
    with pytest.raises(RuntimeError, match="3 times"):
        SchemaLog(spark, str(tmp_path), tries=3).register(candidates(spark, ("a", "{}")))
