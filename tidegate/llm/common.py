"""Byte hashing over Arrow batches, document keys, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.session import configure, materialize

#: Results that are read again lie in tables of the shared folder, so the shuffle files of a
#: finished query are of no more use.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Rows that hold whole arrays: what goes to a Python worker at once is bounded in bytes too.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    "spark.sql.parquet.enableNestedColumnVectorizedReader": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def discard(spark: SparkSession, table: DataFrame) -> None:
    """Remove the files of a table that materialize wrote, once nothing reads it any more."""
    files = table.inputFiles()
    if files:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of text handled by one round of array operations.
PIECE_BYTES = 1 << 21
GOLDEN = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit words, the same on every machine."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(GOLDEN)
    return mix(steps + np.uint64((seed * 0xD1342543DE82EF95) & MASK))


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A quick hash of the `size` bytes (a power of two) from each place on, for choices
    that need not tell all strings apart."""
    out = stream(1, 256)[data]
    step = 1
    while step < size:
        out = out[:-step] * np.uint64(GOLDEN + 2 * step) + out[step:] if out.size > step else out[:0]
        step *= 2
    return mix(out)


#: Modulus of names: a prime, so that strings with a pattern collide no more than others.
PRIME = (1 << 61) - 1
_P = np.uint64(PRIME)
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_S61, _S31, _S30, _ONE = np.uint64(61), np.uint64(31), np.uint64(30), np.uint64(1)


def reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _S61)
    return np.where(x >= _P, x - _P, x)


def shifted(x: np.ndarray) -> np.ndarray:
    """x * 2**31 modulo the prime, not fully reduced, for x below 2**62."""
    return (x >> _S30) + ((x & _LOW30) << _S31)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product modulo the prime of numbers below it."""
    a1, a0, b1, b0 = a >> _S31, a & _LOW31, b >> _S31, b & _LOW31
    return reduced(reduced(((a1 * b1) << _ONE) + shifted(a1 * b0 + a0 * b1)) + reduced(a0 * b0))


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while out.size < n:
        step = np.full(out.size, pow(base, out.size, PRIME), np.uint64)
        out = np.concatenate([out, times(out, step)])
    return out[:n]


class Names:
    """Names of any byte range: values of the polynomial of its bytes modulo a prime.

    Bytes are replaced by random numbers. Sums run inside blocks of ROW bytes, whose tables
    stay small, and from block to block; dividing by the power of the start makes the
    name independent of the place.
    """

    BASE = 0x0D3A_2B1F_7C59_6E43
    ROW = 1024

    def __init__(self) -> None:
        inverse = pow(self.BASE, -1, PRIME)
        self.down = powers(inverse, self.ROW)
        terms = times(
            np.repeat(powers(self.BASE, self.ROW), 256), np.tile(reduced(stream(1, 256)), self.ROW)
        )
        self.low, self.high = (terms & _LOW31).astype(np.uint32), (terms >> _S31).astype(np.uint32)
        self.place = (np.arange(self.ROW, dtype=np.int32) * 256)[None]
        self.row_base, self.row_inverse = pow(self.BASE, self.ROW, PRIME), pow(inverse, self.ROW, PRIME)

    def sums(self, data: np.ndarray) -> "Sums":
        return Sums(self, data)


class Sums:
    def __init__(self, names: Names, data: np.ndarray) -> None:
        self.names = names
        rows = data.size // names.ROW + 1
        padded = np.zeros(rows * names.ROW, np.uint8)
        padded[: data.size] = data
        at = padded.reshape(rows, names.ROW) + names.place
        inside = np.cumsum(names.high[at], axis=1, dtype=np.uint64)
        inside = shifted(inside)
        inside += np.cumsum(names.low[at], axis=1, dtype=np.uint64)
        self.inside = reduced(inside)
        self.scale = powers(names.row_base, rows)
        whole = times(self.scale, self.inside[:, -1])
        before = reduced(shifted(np.cumsum(whole >> _S31)) + np.cumsum(whole & _LOW31))
        self.before = np.concatenate([np.zeros(1, np.uint64), before])

    def upto(self, end: np.ndarray) -> np.ndarray:
        row, at = end // self.names.ROW, end % self.names.ROW
        here = np.where(at > 0, self.inside[row, np.maximum(at - 1, 0)], np.uint64(0))
        return reduced(self.before[row] + times(self.scale[row], here))

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit names of the ranges, spread by a bijection."""
        if not start.size:
            return np.zeros(0, np.uint64)
        found = reduced(self.upto(end) + (_P - self.upto(start)))
        row, at = start // self.names.ROW, start % self.names.ROW
        down = times(self.names.down[at], powers(self.names.row_inverse, int(row.max()) + 1)[row])
        return mix(times(found, down))


_NAMES: list[Names] = []


def names() -> Names:
    """The worker's own tables, of fixed size."""
    if not _NAMES:
        _NAMES.append(Names())
    return _NAMES[0]


def word_names(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A name for each word (ascending byte ranges that do not touch), each different word
    named once."""
    size = end - start
    places = np.zeros(start.size + 1, np.int64)
    np.cumsum(size, out=places[1:])
    level = np.zeros(data.size + 1, np.int8)
    level[start] = 1
    level[end] -= 1
    letters = data[np.cumsum(level[:-1], dtype=np.int8).view(bool)]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), start.size, [None, pa.py_buffer(places), pa.py_buffer(letters)]
    ).dictionary_encode()
    found = words.dictionary
    if not len(found):
        return np.zeros(0, np.uint64)
    edge = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, found.offset * 8)
    own = names().sums(np.frombuffer(found.buffers()[2], np.uint8)).ranges(edge[:-1], edge[1:])
    return own[words.indices.to_numpy()]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and where each row starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about that many bytes; a longer row stands alone."""
    first, n = 0, offsets.size - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def byte_table(text: str) -> np.ndarray:
    """Which bytes belong to a set, given by one ASCII character each."""
    table = np.zeros(256, bool)
    table[list(text.encode())] = True
    return table


#: `[^\\x20\\x09-\\x0D]`: what words of text are made of.
WORD_BYTES = ~byte_table(" \t\n\x0b\x0c\r")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD_BYTES) -> tuple[pa.Array, np.ndarray]:
    """(words as a binary array, the row of each): the longest runs of `inside` bytes in
    every row, with A-Z in lower case. Every byte of a multi-byte character is inside."""
    keep = inside[data]
    first, last = keep.copy(), keep.copy()
    first[1:] &= ~keep[:-1]
    last[:-1] &= ~keep[1:]
    # Rows touch each other, words do not go on from one to the next.
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[at] = keep[at]
    last[at[1:] - 1] = keep[at[1:] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    places = np.zeros(start.size + 1, np.int64)
    np.cumsum(end - start, out=places[1:])
    letters = _LOWER[data[keep]]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), start.size, [None, pa.py_buffer(places), pa.py_buffer(letters)]
    )
    return words, np.searchsorted(offsets, start, "right") - 1


def per_text(
    df: DataFrame,
    function: Callable[[np.ndarray, np.ndarray, pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """Run function(bytes, offsets, rows) over bounded runs of whole texts, in Arrow."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(text))
            for first, last in pieces(offsets):
                part = data[offsets[first] : offsets[last]]
                out = function(part, offsets[first : last + 1] - offsets[first], batch.slice(first, last - first))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def text_tie(column="text"):
    """64 bits of the text; with the id they name a row."""
    return F.xxhash64(column)


def with_key(docs: DataFrame) -> DataFrame:
    """doc_id, tie and text. doc_id and tie name a row for joins; a null id has a place of
    its own, and rows that agree in both are the same text under the same id."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        text_tie().alias("tie"),
        F.col("text").cast("string").alias("text"),
    )


def real_id(column="doc_id"):
    """Undo the stand-in of with_key for a null id."""
    return F.when(F.col(column) != F.lit(-(1 << 63)), F.col(column))


def keep_repeated(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows whose key occurs at least twice, by one exchange.

    A task reads its rows in key order and needs one row of memory to see whether a
    neighbour has the same key, however long the run is.
    """
    schema = rows.schema
    sorted_rows = rows.repartition(key).sortWithinPartitions(key, *order)

    def run(batches):
        held = None
        last_kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            same = keys[1:] == keys[:-1]
            keep = np.zeros(keys.size, bool)
            keep[1:] |= same
            keep[:-1] |= same
            if last_kept is not None and keys[0] == last_kept:
                keep[0] = True
            held = batch.slice(batch.num_rows - 1)
            last_kept = keys[-1] if keep[-1] else None
            keep = keep[:-1]
            if keep.any():
                yield batch.slice(0, batch.num_rows - 1).filter(pa.array(keep))
        if held is not None and last_kept is not None:
            yield held

    return sorted_rows.mapInArrow(run, schema)


def connected_components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node of the edges (a, b), both long.

    Each round points every node at the neighbour with the smallest hash under the
    round's seed, and replaces edges by edges between those. A hub costs one partial
    aggregate per task. Rounds grow with the logarithm of the graph, and each one is a
    table in the shared folder, so a lost executor repeats one round at most.
    """
    edges = materialize(spark, edges.select("a", "b").where("a <> b").distinct(), name)
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        seed = len(maps)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("h"), F.col(c).alias("id"))
        best = both.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("other"))
        own = F.struct(F.xxhash64(F.lit(seed), "node").alias("h"), F.col("node").alias("id"))
        target = materialize(
            spark, best.select("node", F.least(own, F.col("other"))["id"].alias("to")), f"{name}-map"
        )
        maps.append(target)
        left = target.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        right = target.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        edges = materialize(
            spark,
            edges.join(left, "a").join(right, "b")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .where("a <> b").distinct(),
            name,
        )
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    # Later rounds know only what survived the earlier ones: compose from the last back.
    out = maps[-1].select("node", F.col("to").alias("component"))
    for earlier in reversed(maps[:-1]):
        step = out.select(F.col("node").alias("to"), "component")
        out = earlier.join(step, "to", "left").select(
            "node", F.coalesce("component", "to").alias("component")
        )
    return out
