"""Live queues as a stream: every message once, replays from what was landed."""

from __future__ import annotations

import json
import os
from collections import Counter

import pytest

from tidegate.plans.envelopes import event_messages
from tidegate.plans.stand_in import FileQueues, fill
from tidegate.sources.queue_stream import Landing, QueueReader, stream_queues

RECEIVER = "tidegate.plans.stand_in:FileQueues"


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    return event_messages(spark, sf_dir).limit(900).cache()


@pytest.fixture
def service(messages, tmp_path):
    fill(messages, str(tmp_path / "queues"))
    queues = sorted(r.queue_url for r in messages.select("queue_url").distinct().collect())
    return str(tmp_path / "queues"), queues


def started(spark, service, tmp_path, sink, **options):
    root, queues = service
    options = {"max_polls": 7, "wait_seconds": 1, **options}
    stream = stream_queues(
        spark, queues, RECEIVER, str(tmp_path / "landing"), receiver_options={"root": root}, **options
    )
    return (
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(processingTime="0 seconds").start()
    )


def drain(query):
    query.processAllAvailable()
    query.stop()


@pytest.mark.parametrize("workers", [1, 3])
def test_every_message_once(spark, messages, service, tmp_path, workers):
    seen, batches = Counter(), []

    def sink(df, batch_id):
        # Two reads of one batch see the same rows.
        ids = [r.message_id for r in df.select("message_id").collect()]
        assert sorted(ids) == sorted(r.message_id for r in df.select("message_id").collect())
        seen.update(ids)
        batches.append(len(ids))

    drain(started(spark, service, tmp_path, sink, workers_per_queue=workers))
    assert seen == Counter(r.message_id for r in messages.select("message_id").collect())
    assert len(batches) > 1 and max(batches) <= 3 * workers * 70


def test_a_failed_batch_is_replayed_from_its_files(spark, messages, service, tmp_path):
    written, failed = {}, []

    def sink(df, batch_id):
        ids = sorted(r.message_id for r in df.select("message_id").collect())
        if batch_id == 1 and not failed:
            failed.append(ids)
            raise RuntimeError("the sink is down")
        written[batch_id] = ids

    query = started(spark, service, tmp_path, sink)
    with pytest.raises(Exception, match="sink is down"):
        query.processAllAvailable()
    query.stop()
    drain(started(spark, service, tmp_path, sink))
    assert written[1] == failed[0] and failed[0]
    got = Counter(i for ids in written.values() for i in ids)
    assert got == Counter(r.message_id for r in messages.select("message_id").collect())


def test_committed_rounds_are_removed_and_the_count_goes_on(spark, service, tmp_path):
    drain(started(spark, service, tmp_path, lambda df, i: df.count()))
    root, queues = service
    landing = Landing(str(tmp_path / "landing"))
    done = landing.committed()
    assert all(done[q] > 1 for q in queues)
    left = [n for q in queues for n in landing.rounds(q)]
    assert all(n >= min(done.values()) for n in left)
    again = QueueReader({"queues": ",".join(queues), "receiver": RECEIVER, "landing": str(tmp_path / "landing"),
                         "receiver_options": json.dumps({"root": root})})
    # Nothing waits: no round is planned, and none is counted twice.
    assert all(again.latestOffset()[q] >= done[q] for q in queues)


def test_a_round_polls_once(service, tmp_path):
    root, queues = service
    options = {"queues": queues[0], "receiver": RECEIVER, "landing": str(tmp_path / "landing"),
               "receiver_options": json.dumps({"root": root}), "max_polls": "2"}
    reader = QueueReader(options)
    [part] = reader.partitions(reader.initialOffset(), reader.latestOffset())
    first = [r for b in reader.read(part) for r in b.column("message_id").to_pylist()]
    waiting = FileQueues(root).backlog(queues[0])
    second = [r for b in QueueReader(options).read(part) for r in b.column("message_id").to_pylist()]
    assert first == second and len(first) == 20 and FileQueues(root).backlog(queues[0]) == waiting


def test_a_file_of_a_round_stays_as_it_was_first_landed(tmp_path):
    import pyarrow as pa

    landing = Landing(str(tmp_path))
    layout = pa.schema([("n", pa.int64())])
    path = landing.path("q", 3, 0)
    for n in (1, 2):
        landing.write(path, iter([pa.RecordBatch.from_pydict({"n": [n]}, schema=layout)]), layout)
    assert [b.to_pydict() for b in landing.read(path)] == [{"n": [1]}]
    assert os.listdir(landing.folder("q")) == [os.path.basename(path)]


@pytest.mark.parametrize("change", [{"queues": " , "}, {"batch": "11"}, {"wait_seconds": "21"}, {"workers_per_queue": "-1"}])
def test_options_are_checked(change, tmp_path):
    options = {"queues": "q", "receiver": RECEIVER, "landing": str(tmp_path)}
    with pytest.raises(ValueError):
        QueueReader({**options, **change})


def test_a_process_holds_a_row_group_of_a_queue_and_counts_without_reading(spark, messages, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from tidegate.plans import stand_in

    monkeypatch.setattr(stand_in, "GROUP_BYTES", 4096)
    root = str(tmp_path / "queues")
    fill(messages, root)
    queue = messages.first().queue_url
    names = messages.where(messages.queue_url == queue).orderBy(
        "received_at", messages.message_id.cast("long")
    ).select("message_id").collect()
    read = []
    real = pq.ParquetFile.read_row_group
    monkeypatch.setattr(pq, "read_table", lambda *a, **k: pytest.fail("a whole file is read"))
    monkeypatch.setattr(pq.ParquetFile, "read_row_group", lambda self, n, **k: read.append(n) or real(self, n, **k))
    service = FileQueues(root)
    assert service.backlog(queue) == len(names) and not read
    got = []
    while rows := service.receive(queue, 10, 0):
        assert len(rows) == min(10, len(names) - len(got))
        got += [r["message_id"] for r in rows]
    # In order, each group read once.
    assert got == [r.message_id for r in names] and service.backlog(queue) == 0
    assert len(read) == len(service.groups(queue)[1]) > 1
