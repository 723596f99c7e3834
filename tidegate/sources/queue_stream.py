"""Live queues as a stream: receiving without an end, each message written down once.

A queue cannot be read twice, and Spark may read a part of a stream several times. So the
unit of work is a round: one task of one queue polls for a while. It lands what it received
as a file before it hands it on, and whoever reads the round again, after a failure, a
restart or from a second job of the micro-batch, finds the file and polls nothing. The
offset of a queue is its number of rounds. Once a batch is committed the rounds behind it
have served their purpose: the commit hook notes how far it came and removes their files.

Messages that a dying task had received and not landed stay undeleted; the queue delivers
them again. Deleting is the pipeline's business, after its records are written.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.schemas import DEFAULT_RECEIVE_BATCH, DEFAULT_WAIT_SECONDS, MESSAGE_SCHEMA
from tidegate.sources.messages import attribute_names
from tidegate.sources.queues import ROWS_AT_ONCE, check_receive_options

FORMAT = "tidegate_queues"


def named_client(name: str, options: dict):
    """The client that ``module:factory`` makes of the options."""
    module, _, factory = name.partition(":")
    if not factory:
        raise ValueError(f"{name!r} is not of the form module:factory")
    return getattr(importlib.import_module(module), factory)(**options)


class Landing:
    """The files of rounds below a folder of any file system that Arrow knows."""

    def __init__(self, uri: str):
        self.files, self.root = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")

    def folder(self, queue: str) -> str:
        return f"{self.root}/{hashlib.sha256(queue.encode()).hexdigest()[:32]}"

    def path(self, queue: str, round_: int, worker: int) -> str:
        return f"{self.folder(queue)}/{round_:012d}-{worker:04d}.arrow"

    def exists(self, path: str) -> bool:
        return self.files.get_file_info(path).type == fs.FileType.File

    def rounds(self, queue: str) -> dict[int, list[str]]:
        """Files by round, those of unfinished writers left out."""
        found: dict[int, list[str]] = {}
        for info in self.files.get_file_info(fs.FileSelector(self.folder(queue), allow_not_found=True)):
            if info.base_name.endswith(".arrow"):
                found.setdefault(int(info.base_name.split("-")[0]), []).append(info.path)
        return found

    def write(self, path: str, batches: Iterator[pa.RecordBatch], layout: pa.Schema) -> None:
        """The file appears whole or not at all; one that is there already stays."""
        self.files.create_dir(path.rpartition("/")[0], recursive=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(part) as out, pa.ipc.new_stream(out, layout) as writer:
            for batch in batches:
                writer.write_batch(batch)
        if self.exists(path):
            self.files.delete_file(part)
        else:
            self.files.move(part, path)

    def read(self, path: str) -> Iterator[pa.RecordBatch]:
        with self.files.open_input_stream(path) as source, pa.ipc.open_stream(source) as reader:
            yield from reader

    @property
    def mark(self) -> str:
        return f"{self.root}/committed.json"

    def committed(self) -> dict[str, int]:
        if not self.exists(self.mark):
            return {}
        with self.files.open_input_stream(self.mark) as source:
            return json.loads(source.read())

    def commit(self, offsets: dict[str, int]) -> None:
        self.files.create_dir(self.root, recursive=True)
        with self.files.open_output_stream(f"{self.mark}.new") as out:
            out.write(json.dumps(offsets).encode())
        self.files.move(f"{self.mark}.new", self.mark)


class Round(InputPartition):
    def __init__(self, queue: str, number: int, worker: int):
        super().__init__((queue, number, worker))


class QueueReader(DataSourceStreamReader):
    """See the module's docstring. A client has ``receive(queue, max, wait)``; with
    ``backlog(queue)`` a round is planned only for queues that have messages waiting,
    without it every trigger plans one for each queue."""

    def __init__(self, options: dict):
        self.queues = list(dict.fromkeys(attribute_names(options.get("queues"))))
        if not self.queues:
            raise ValueError("name at least one queue")
        self.receiver = options["receiver"]
        self.receiver_options = json.loads(options.get("receiver_options") or "{}")
        self.landing_uri = options["landing"]
        self.workers = int(options.get("workers_per_queue") or 1)
        self.batch = int(options.get("batch") or DEFAULT_RECEIVE_BATCH)
        self.wait = int(options.get("wait_seconds") or DEFAULT_WAIT_SECONDS)
        self.max_polls = int(options["max_polls"]) if options.get("max_polls") else None
        self.max_seconds = float(options.get("max_seconds") or 60)
        check_receive_options(self.batch, self.wait)
        if self.workers < 1:
            raise ValueError("workers_per_queue must be at least 1")
        self.reached: dict[str, int] | None = None

    def known(self) -> dict[str, int]:
        """Rounds that were planned before, by this reader or one before a restart."""
        if self.reached is None:
            landing = Landing(self.landing_uri)
            done = landing.committed()
            self.reached = {q: max([done.get(q, 0), *(n + 1 for n in landing.rounds(q))]) for q in self.queues}
        return self.reached

    def initialOffset(self) -> dict:
        return {q: 0 for q in self.queues}

    def latestOffset(self) -> dict:
        reached = self.known()
        backlog = getattr(named_client(self.receiver, self.receiver_options), "backlog", None)
        for queue in self.queues:
            if backlog is None or backlog(queue) > 0:
                reached[queue] += 1
        return dict(reached)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        for queue, n in end.items():
            if queue in self.known():
                self.reached[queue] = max(self.reached[queue], n)
        return [
            Round(queue, number, worker)
            for queue, n in end.items()
            for number in range(start.get(queue, 0), n)
            for worker in range(self.workers)
        ] or [Round("", 0, 0)]

    def received(self, queue: str, layout: pa.Schema) -> Iterator[pa.RecordBatch]:
        client = named_client(self.receiver, self.receiver_options)
        receive = getattr(client, "receive", client)
        names = layout.names
        began, polls, held = time.monotonic(), 0, []
        while (self.max_polls is None or polls < self.max_polls) and time.monotonic() - began < self.max_seconds:
            polls += 1
            messages = list(receive(queue, self.batch, self.wait))
            if not messages:
                break
            held += [{**dict.fromkeys(names), **m, "queue_url": queue} for m in messages]
            if len(held) >= ROWS_AT_ONCE:
                yield pa.RecordBatch.from_pylist(held, schema=layout)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=layout)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        queue, number, worker = partition.value
        if not queue:
            return
        landing, layout = Landing(self.landing_uri), to_arrow_schema(MESSAGE_SCHEMA)
        path = landing.path(queue, number, worker)
        if not landing.exists(path):
            landing.write(path, self.received(queue, layout), layout)
        yield from landing.read(path)

    def commit(self, end: dict) -> None:
        landing = Landing(self.landing_uri)
        landing.commit({**landing.committed(), **end})
        for queue, n in end.items():
            for number, paths in landing.rounds(queue).items():
                if number < n:
                    for path in paths:
                        landing.files.delete_file(path)


class QueueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return MESSAGE_SCHEMA

    def streamReader(self, schema) -> QueueReader:
        return QueueReader(dict(self.options))


def stream_queues(
    spark: SparkSession,
    queues: list[str],
    receiver: str,
    landing: str,
    receiver_options: dict | None = None,
    workers_per_queue: int = 1,
    batch: int = DEFAULT_RECEIVE_BATCH,
    wait_seconds: int = DEFAULT_WAIT_SECONDS,
    max_polls: int | None = None,
    max_seconds: float = 60.0,
) -> DataFrame:
    """Messages of live queues as a stream. ``receiver`` names a factory as
    ``module:factory``, which the executors import and call with ``receiver_options``;
    ``landing`` is a folder that all of them reach, one per stream."""
    check_receive_options(batch, wait_seconds)
    spark.dataSource.register(QueueSource)
    options = {
        "queues": ",".join(queues), "receiver": receiver, "landing": landing,
        "receiver_options": json.dumps(receiver_options or {}), "workers_per_queue": str(workers_per_queue),
        "batch": str(batch), "wait_seconds": str(wait_seconds), "max_seconds": str(max_seconds),
    }
    if max_polls is not None:
        options["max_polls"] = str(max_polls)
    return spark.readStream.format(FORMAT).options(**options).load()
