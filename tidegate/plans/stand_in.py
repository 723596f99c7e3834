"""A queue service made of files, for queries and tests of live receiving.

Messages lie in Parquet files per queue, in order, in small row groups. A queue's cursor, a
file that a receive locks, says how many were handed out; whoever receives moves it on by
ten. A process holds the files' row counts and one row group per queue, never a queue.
"""

from __future__ import annotations

import bisect
import fcntl
import os

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

TAKEN_AT_ONCE = 10
#: Bytes of a row group: what a process holds of a queue.
GROUP_BYTES = 4 << 20
_GROUPS: dict[str, tuple[list[int], list[tuple[str, int]]]] = {}
_OPEN: dict[str, tuple[int, object]] = {}


def local(path: str) -> str:
    return path.removeprefix("file://")


def queue_folder(root: str, queue: str) -> str:
    return os.path.join(local(root), "queue_name=" + queue.rpartition("/")[2])


def fill(messages: DataFrame, root: str) -> None:
    """Put messages into the queues below ``root``, by receive time. Many tasks share a
    queue; their files follow each other by name."""
    named = messages.withColumn("queue_name", F.substring_index("queue_url", "/", -1))
    order = ["queue_name", "received_at", F.col("message_id").cast("long")]
    spread = named.repartitionByRange(*order).sortWithinPartitions(*order)
    spread.write.option("parquet.block.size", GROUP_BYTES).partitionBy("queue_name").parquet(root)


class FileQueues:
    """``receive`` and ``backlog`` of such queues."""

    def __init__(self, root: str):
        self.root = root

    def groups(self, queue: str) -> tuple[list[int], list[tuple[str, int]]]:
        """The row groups (file, number) of a queue and the row behind each, out of the footers."""
        folder = queue_folder(self.root, queue)
        if folder not in _GROUPS:
            ends, places, rows = [], [], 0
            for name in sorted(n for n in os.listdir(folder) if n.endswith(".parquet")):
                path = os.path.join(folder, name)
                footer = pq.read_metadata(path)
                for number in range(footer.num_row_groups):
                    rows += footer.row_group(number).num_rows
                    ends.append(rows)
                    places.append((path, number))
            _GROUPS[folder] = ends, places
        return _GROUPS[folder]

    def total(self, queue: str) -> int:
        ends, _ = self.groups(queue)
        return ends[-1] if ends else 0

    def taken(self, queue: str, more: int = 0) -> int:
        """How many were handed out before; ``more`` are handed out now."""
        cursor = os.open(os.path.join(queue_folder(self.root, queue), "taken"), os.O_RDWR | os.O_CREAT)
        try:
            fcntl.flock(cursor, fcntl.LOCK_EX)
            before = int(os.pread(cursor, 20, 0) or 0)
            if more and before < self.total(queue):
                os.pwrite(cursor, str(min(before + more, self.total(queue))).encode(), 0)
            return before
        finally:
            os.close(cursor)

    def backlog(self, queue: str) -> int:
        return self.total(queue) - self.taken(queue)

    def rows(self, queue: str, start: int, end: int) -> list[dict]:
        ends, places = self.groups(queue)
        folder = queue_folder(self.root, queue)
        found = []
        while start < end:
            at = bisect.bisect_right(ends, start)
            if _OPEN.get(folder, (None,))[0] != at:
                path, number = places[at]
                with pq.ParquetFile(path) as file:
                    _OPEN[folder] = at, file.read_row_group(number, use_threads=False)
            first = ends[at - 1] if at else 0
            stop = min(end, ends[at])
            found += _OPEN[folder][1].slice(start - first, stop - start).to_pylist()
            start = stop
        return found

    def receive(self, queue: str, max_messages: int, wait_seconds: int) -> list[dict]:
        start = self.taken(queue, TAKEN_AT_ONCE)
        rows = self.rows(queue, start, min(start + TAKEN_AT_ONCE, self.total(queue)))
        for row in rows:
            for name in ("attributes", "message_attributes"):
                row[name] = dict(row[name]) if row[name] is not None else None
        return rows
