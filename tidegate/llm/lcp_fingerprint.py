"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing cuts a sequence into blocks of two or three by what stands
next to a place, whatever its offset; blocks get names, names are cut again. Equal
substrings so share all names but those at their ends. The fingerprint keeps the smallest
hash of each of 128 classes of names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegate.llm.common import mix, pieces, prepare, stream, text_buffer, with_key

#: Levels of names; the fingerprint is made of the last two. Classes of names.
LEVELS = 3
BINS = 128
#: Ranges of ids per shuffle partition, so that hashing them to partitions evens out.
RANGES_PER_PARTITION = 4


def tossed(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Coin tossing: twice the lowest bit in which a label differs from the one before it,
    plus that bit. Neighbours stay different; the first of a text has no one before it."""
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[:1] = 0
    differ = x ^ before
    differ[first] = 1
    low = differ & (~differ + x.dtype.type(1))
    place = np.bitwise_count(low - x.dtype.type(1))
    bit = ((x & low) != 0).astype(np.uint8)
    return place * np.uint8(2) + bit


def landmarks(x: np.ndarray, first: np.ndarray, rounds: int) -> np.ndarray:
    """Where blocks start: true at places two or three apart, by near neighbours only."""
    n = x.size
    label = x
    for _ in range(rounds):
        label = tossed(label, first)
    label = np.where(first & (label > 5), np.uint8(0), label)
    last = np.append(first[1:], True)
    none = np.uint8(99)
    # Six labels to three: each place of the highest label takes the least one that its
    # neighbours leave free.
    for high in range(int(label.max(initial=0)), 2, -1):
        at = np.flatnonzero(label == high)
        left = np.where(first[at], none, label[at - 1])
        right = np.where(last[at], none, label[np.minimum(at + 1, n - 1)])
        free = np.zeros(at.size, np.uint8)
        for _ in range(2):
            free += (free == left) | (free == right)
        label[at] = free
    left = np.empty_like(label)
    left[1:], left[:1] = label[:-1], none
    right = np.empty_like(label)
    right[:-1], right[-1:] = label[1:], none
    peak = (label > left) & (label > right) & ~first & ~last
    near = peak.copy()
    near[1:] |= peak[:-1]
    near[:-1] |= peak[1:]
    valley = (label < left) & (label < right) & ~near & ~first & ~last
    return peak | valley | first


def named(x: np.ndarray, starts: np.ndarray, lengths: np.ndarray, salt: int) -> np.ndarray:
    """A name for each block, from its symbols in order."""
    inner = np.arange(x.size) - np.repeat(starts, lengths)
    place = stream(10 + salt, 64)
    return mix(np.add.reduceat(mix(x + place[np.minimum(inner, 63)]), starts) + lengths.astype(np.uint64))


def parsed_names(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, name) of the blocks of each text, level by level."""
    row = np.repeat(np.arange(offsets.size - 1), np.diff(offsets))
    x = data.astype(np.uint64)
    out = []
    for level in range(LEVELS):
        if not x.size:
            out.append((row, x))
            continue
        # Runs of one symbol become one symbol, so that neighbours differ.
        new = np.ones(x.size, bool)
        new[1:] = (x[1:] != x[:-1]) | (row[1:] != row[:-1])
        if not new.all():
            starts = np.flatnonzero(new)
            lengths = np.diff(np.append(starts, x.size))
            run = x[starts]
            x = np.where(lengths > 1, mix(run + mix(lengths.astype(np.uint64))) | np.uint64(256), run)
            row = row[starts]
        first = np.ones(x.size, bool)
        first[1:] = row[1:] != row[:-1]
        start = np.flatnonzero(landmarks(x, first, 4))
        lengths = np.diff(np.append(start, x.size))
        x = named(x, start, lengths, level)
        row = row[start]
        out.append((row, x))
    return out


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of BINS 16-bit values per text; all zero for an empty text.

    Empty classes take the value of the next filled one, changed by the distance, as in
    densified one-permutation hashing.
    """
    n = offsets.size - 1
    levels = parsed_names(data, offsets)[-2:]
    row = np.concatenate([r for r, _ in levels])
    name = np.concatenate([mix(x + np.uint64(7)) for _, x in levels])
    least = np.full(n * BINS, np.iinfo(np.uint64).max, np.uint64)
    if name.size:
        slot = row * BINS + (name >> np.uint64(57)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slot = slot[order]
        starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        least[slot[starts]] = np.minimum.reduceat(name[order], starts)
    least = least.reshape(n, BINS)
    filled = least != np.iinfo(np.uint64).max
    any_filled = filled.any(1)
    # Distance to the next filled class, going round.
    twice = np.concatenate([filled, filled], axis=1)
    at = np.where(twice, np.arange(2 * BINS), 4 * BINS)
    nearest = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    distance = np.where(any_filled[:, None], nearest - np.arange(BINS), 0)
    source = np.take_along_axis(least, (np.arange(BINS) + distance) % BINS, axis=1)
    value = mix(source + distance.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)).astype(np.uint16)
    value[~any_filled] = 0
    return value


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(1)


def in_ranges(keyed: DataFrame, ranges: int) -> DataFrame:
    """Rows with the range of their id (range) and guest: the first rows of each range are
    also guests of the range before it, those of the first one of the last.

    Only ids are looked at to choose the ranges; the driver holds one id per range.
    """
    spark = keyed.sparkSession
    steps = [i / ranges for i in range(1, ranges)]
    cuts = keyed.agg(F.percentile_approx("doc_id", steps or [0.5], 10_000).alias("c")).first().c or []
    bounds = np.unique(np.array(cuts if steps else [], np.int64))

    @F.pandas_udf(T.IntegerType())
    def range_of(ids):
        return pd.Series((bounds.size - np.searchsorted(bounds, ids.to_numpy(), "right")).astype(np.int32))

    heads = {
        r["range"]: r["head"]
        for r in keyed.select(range_of("doc_id").alias("range"), "doc_id").groupBy("range")
        .agg(F.max("doc_id").alias("head")).collect()
    }
    order = sorted(heads)
    # Each head id and the range it is a guest of, by head for a search.
    host = {heads[order[i]]: order[i - 1] for i in range(len(order))}
    head_ids = np.array(sorted(host), np.int64)
    host_of = np.array([host[h] for h in sorted(host)], np.int32)

    @F.pandas_udf(T.IntegerType())
    def host_range(ids):
        ids = ids.to_numpy()
        at = np.minimum(np.searchsorted(head_ids, ids), head_ids.size - 1)
        return pd.Series(np.where(head_ids[at] == ids, host_of[at], -1).astype(np.int32))

    placed = keyed.select(range_of("doc_id").alias("own"), host_range("doc_id").alias("host"), "doc_id", "tie", "text")
    stays = F.struct(F.col("own").alias("range"), F.lit(False).alias("guest"))
    visits = F.struct(F.col("host").alias("range"), F.lit(True).alias("guest"))
    return placed.select(
        F.explode(F.when(F.col("host") >= 0, F.array(stays, visits)).otherwise(F.array(stays))).alias("at"),
        "doc_id", "tie", "text",
    ).select("at.range", "at.guest", "doc_id", "tie", "text")


def locally_consistent_fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third (code points, rounded down) replaced by as many of
    the next document, or all it has; next is by descending doc_id, then by a hash of the
    text and the text, and the first follows the last. Null texts are empty, null ids come
    last; a single document follows itself. Other columns are ignored. Texts cross one
    exchange; a task holds one document beyond the batch it works on.
    """
    prepare(spark)
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = in_ranges(with_key(docs), ranges)
    rows = rows.repartition("range").sortWithinPartitions("range", "guest", F.desc("doc_id"), "tie", "text")

    def finish(ids: list[int], texts: list[str], after: list[str]):
        """Rows of texts, each with the text that follows it."""
        edited = []
        for text, following in zip(texts, after):
            k = len(text) // 3
            edited.append((text[: len(text) - k] + following[:k]).encode("utf-8", "surrogatepass"))
        plain = [t.encode("utf-8", "surrogatepass") for t in texts]
        prints = [of_bytes(x) for x in (plain, edited, [t.encode("utf-8", "surrogatepass") for t in after[-1:]])]
        own, changed = prints[0], prints[1]
        following = np.concatenate([own[1:], prints[2]])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array([len(t) for t in texts]),
             pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
             pa.array([r.tobytes().hex() for r in own]), pa.array([r.tobytes().hex() for r in changed]),
             pa.array(likeness(own, changed)), pa.array(likeness(own, following))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def of_bytes(values: list[bytes]) -> np.ndarray:
        column = pa.array(values, pa.large_binary())
        data, offsets = text_buffer(column)
        return np.concatenate([
            fingerprints(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in pieces(offsets)
        ]) if values else np.zeros((0, BINS), np.uint16)

    def run(batches):
        ids, texts, size, current = [], [], 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("range", "guest", "doc_id"))
            for at, guest, doc_id, text in zip(*columns, batch.column("text")):
                text = text.as_py() or ""
                if at != current:
                    ids, texts, size, current = [], [], 0, at
                if guest:
                    # The first guest follows the last of the range; the rest of its id is of no use.
                    if ids:
                        yield finish(ids, texts, texts[1:] + [text])
                        ids, texts, size = [], [], 0
                    continue
                if size > (1 << 21):
                    yield finish(ids, texts, texts[1:] + [text])
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text)

    out = rows.mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")))
