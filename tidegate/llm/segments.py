"""Token ids of whole texts from the ids of their segments, each different one encoded once."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

#: Bytes that a memo holds, its dictionary entries included.
MEMO_BYTES = 96 << 20
#: What an entry takes beside its bytes and ids.
ENTRY_BYTES = 150


def runs_of(data: np.ndarray, start: np.ndarray) -> pa.Array:
    """The byte runs between one start and the next as a binary array over the same memory."""
    places = np.append(start, data.size).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), start.size, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))]
    )


def strings_of(array: pa.LargeBinaryArray) -> list[bytes]:
    """The array's strings, without a scalar for each."""
    if not len(array):
        return []
    places = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    first, data = int(places[0]), array.buffers()[2]
    whole = data.slice(first, int(places[-1]) - first).to_pybytes() if data is not None else b""
    places = (places - first).tolist()
    return [whole[a:b] for a, b in zip(places[:-1], places[1:])]


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... size[0] of them, then those of the next."""
    if not size.size:
        return np.zeros(0, np.int64)
    total = np.cumsum(size)
    n = int(total[-1])
    # Half the memory where the numbers are small enough.
    kind = np.int32 if n + int(start.max()) < 1 << 31 else np.int64
    out = np.repeat((start - (total - size)).astype(kind), size)
    out += np.arange(n, dtype=kind)
    return out


def end_to_end(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all lists end to end, size of each)."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes


def release_memory() -> None:
    """Give back to the system what a task has freed: the worker stays for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only one C library has it
        pass


class GrowingLists:
    """Lists of numbers end to end, read many at once."""

    def __init__(self, kind=np.int64) -> None:
        self.flat = np.zeros(1 << 14, kind)
        self.starts = np.zeros(1 << 12, np.int64)
        self.sizes = np.zeros(1 << 12, np.int64)
        self.count = self.filled = 0

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        while self.filled + values.size > self.flat.size:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + sizes.size > self.starts.size:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        own = slice(self.count, self.count + sizes.size)
        self.flat[self.filled : self.filled + values.size] = values
        self.starts[own] = self.filled + np.cumsum(sizes) - sizes
        self.sizes[own] = sizes
        self.count += sizes.size
        self.filled += values.size

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of the lists end to end, size of each)."""
        sizes = self.sizes[slots]
        return self.flat[ranges(self.starts[slots], sizes)], sizes


class ByteMemo:
    """Numbers for byte strings, compared byte by byte. Beyond MEMO_BYTES all is forgotten."""

    def __init__(self, most: int = MEMO_BYTES) -> None:
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0

    def full(self) -> bool:
        return self.held > self.most

    def slots(self, strings: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """(slot of each, which of them are new); new ones get the next slots. The strings
        differ from each other."""
        known = self.known
        found = list(map(known.get, strings))
        fresh = [i for i, slot in enumerate(found) if slot is None]
        new = [strings[i] for i in fresh]
        for slot, i in enumerate(fresh, len(known)):
            found[i] = slot
        known.update(zip(new, range(len(known), len(known) + len(new))))
        self.held += sum(map(len, new)) + ENTRY_BYTES * len(new)
        return np.array(found, np.int64), fresh


class SegmentIds:
    """Ids of texts that are cut into segments; equal segments have equal ids.

    tokenize gives the ids of each of a list of segments, as lists or as end_to_end does.
    """

    def __init__(self, tokenize: Callable[[list[bytes]], list], most: int = MEMO_BYTES) -> None:
        self.tokenize = tokenize
        self.memo = ByteMemo(most)
        self.ids = GrowingLists(np.uint32)

    def forget(self) -> None:
        self.memo.forget()
        self.ids = GrowingLists(np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, where each text's ids start); cut marks segment
        starts beside those of the texts."""
        n = offsets.size - 1
        if not data.size:
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        if self.memo.full():
            self.forget()
        cut = cut.copy()
        cut[offsets[:-1][offsets[:-1] < data.size]] = True
        start = np.flatnonzero(cut)
        coded = runs_of(data, start).dictionary_encode()
        segments = strings_of(coded.dictionary)
        slot, fresh = self.memo.slots(segments)
        if fresh:
            found = self.tokenize([segments[i] for i in fresh])
            found, sizes = found if isinstance(found, tuple) else end_to_end(found)
            self.ids.extend(found, sizes)
            self.memo.held += 4 * int(sizes.sum())
        ids, size = self.ids.take(slot[coded.indices.to_numpy()])
        return ids, np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, offsets)]
