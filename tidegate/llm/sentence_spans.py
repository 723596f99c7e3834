"""Removal of repeated runs of sentences.

Every run of several consecutive sentences is hashed and met with all others by one
exchange; sentences that lie in a repeated run go, except in its first place. A run is
measured in words: from each sentence on, as few sentences as hold WORDS words, so a few
short phrases that happen to follow each other are none and one long sentence may be.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegate.llm.common import (
    mix, per_text, pieces, prepare, signed, stream, text_buffer, text_tie, with_key, word_names,
)
from tidegate.session import materialize

#: Words that a run holds at least.
WORDS = 20
#: Bytes that end a sentence when a blank or the end follows; … is E2 80 A6.
ENDS = b".!?"


def sentences(data: np.ndarray, offsets: np.ndarray):
    """(row, start, hash, words) of each sentence of each text, in order.

    Words are runs without space and control blanks. A sentence ends behind a word that
    closes with . ! ? or …, and at a line feed; its hash is of its words, so blanks do not
    matter. start is its first byte.
    """
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    inside = ~blank[data]
    edge = np.zeros(data.size + 1, bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    if not start.size:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), empty
    word = word_names(data, start, end)
    row = np.searchsorted(offsets, start, "right") - 1
    last = data[end - 1]
    closes = np.isin(last, np.frombuffer(ENDS, np.uint8))
    long = end - start >= 3
    closes |= long & (last == 0xA6) & (data[end - 2] == 0x80) & (data[np.maximum(end - 3, 0)] == 0xE2)
    feeds = np.concatenate([[0], np.cumsum(data == 10)])
    follows = np.append(start[1:], data.size)
    closes |= feeds[follows] > feeds[end]
    first = np.ones(start.size, bool)
    first[1:] = closes[:-1] | (row[1:] != row[:-1])
    at = np.flatnonzero(first)
    words = np.diff(np.append(at, start.size))
    inner = np.arange(start.size) - np.repeat(at, words)
    # Words count by their place, through a spread that no pattern of places undoes.
    value = mix(np.add.reduceat(mix(word + stream(6, int(inner.max()) + 1)[inner]), at) + words.astype(np.uint64))
    return row[at], start[at], value, words


def run_lengths(row: np.ndarray, words: np.ndarray, least: int) -> np.ndarray:
    """For each sentence how many from it on make a run; 0 where its text ends before."""
    total = np.concatenate([[0], np.cumsum(words)])
    end = np.searchsorted(total, total[:-1] + least)
    inside = end <= np.searchsorted(row, row, "right")
    return np.where(inside, end - np.arange(row.size), 0)


def runs(docs: DataFrame, least: int) -> DataFrame:
    """(run, doc_id, tie, at): a row per run, with the number of its first sentence."""

    def function(data, offsets, batch):
        row, _, value, words = sentences(data, offsets)
        length = run_lengths(row, words, least)
        start = np.flatnonzero(length)
        if not start.size:
            return None
        counts = np.bincount(row, minlength=offsets.size - 1)
        nth = np.arange(row.size) - np.repeat(np.cumsum(counts) - counts, counts)
        place = stream(5, int(length.max()))
        total = length[start].astype(np.uint64)
        for k in range(int(length.max())):
            use = np.flatnonzero(length[start] > k)
            total[use] += mix(value[start[use] + k] + place[k])
        at = pa.array(row[start])
        return pa.RecordBatch.from_arrays(
            [signed(mix(total)), batch.column("doc_id").take(at), batch.column("tie").take(at), pa.array(nth[start])],
            ["run", "doc_id", "tie", "at"],
        )

    return per_text(docs, function, "run long, doc_id long, tie long, at long")


def later_places(found: DataFrame) -> DataFrame:
    """The rows that are not the first of their run in order of (doc_id, tie, at).

    Rows are read in that order; a task remembers one row. Rows that agree in everything
    come from repeated rows of the input and share their lot.
    """
    key = ["run", "doc_id", "tie", "at"]
    ordered = found.repartition("run").sortWithinPartitions(*key)

    def run(batches):
        before, before_first = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in key]
            whole = [np.concatenate([[c[0] if before is None else b], c]) for c, b in zip(columns, before or columns)]
            new_run = whole[0][1:] != whole[0][:-1]
            again = ~new_run
            for c in whole[1:]:
                again &= c[1:] == c[:-1]
            if before is None:
                new_run[0], again[0] = True, False
            # A row equal to the one before it has that one's part.
            source = np.maximum.accumulate(np.where(again, -1, np.arange(new_run.size)))
            first = np.where(source >= 0, new_run[np.maximum(source, 0)], before_first)
            if (~first).any():
                yield batch.select(["doc_id", "tie", "at"]).filter(pa.array(~first))
            before, before_first = [c[-1] for c in columns], bool(first[-1])

    return ordered.mapInArrow(run, "doc_id long, tie long, at long")


def remove_repeated_sentences(spark: SparkSession, docs: DataFrame, words: int = WORDS) -> DataFrame:
    """All columns of docs with text cut, and n_sentences, n_removed, n_spans, kept_sha256.

    A run, the fewest sentences from one on that hold so many words, that stands in several places is kept in its first, by doc_id,
    then a hash of the text, then place; in all others its sentences go, with the blanks
    behind them. A null text has no sentences and stays null. Repeated rows are one place.
    Columns of docs named like the four new ones are replaced.
    """
    prepare(spark)
    keyed = with_key(docs)
    gone = materialize(
        spark,
        later_places(runs(keyed, words)).groupBy("doc_id", "tie").agg(F.collect_set("at").alias("gone")),
        "sentence-runs",
    )
    new = ["text", "n_sentences", "n_removed", "n_spans", "kept_sha256"]
    others = [c for c in docs.columns if c not in new]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        text_tie().alias("tie"), F.col("text").cast("string").alias("text"),
    ).join(gone, ["doc_id", "tie"], "left").select("row", "text", "gone")

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            lists, known = batch.column("gone").to_pylist(), batch.column("text").is_valid().to_pylist()
            for first, last in pieces(offsets):
                base = offsets[first]
                part = data[base : offsets[last]]
                row, start, _, held = sentences(part, offsets[first : last + 1] - base)
                length = run_lengths(row, held, words)
                cuts = np.searchsorted(row, np.arange(last - first + 1))
                out = [[], [], [], [], []]
                for i in range(first, last):
                    own = start[cuts[i - first] : cuts[i - first + 1]]
                    reach = length[cuts[i - first] : cuts[i - first + 1]]
                    lo, hi = offsets[i] - base, offsets[i + 1] - base
                    drop = np.zeros(own.size, bool)
                    for at in lists[i] or ():
                        drop[at : at + reach[at]] = True
                    body = part[lo:hi]
                    if drop.any():
                        level = np.zeros(hi - lo + 1, np.int64)
                        ends = np.append(own[1:], hi)
                        np.add.at(level, own[drop] - lo, 1)
                        np.add.at(level, ends[drop] - lo, -1)
                        body = body[np.cumsum(level[:-1]) == 0]
                    plain = body.tobytes()
                    spans = int(drop[:1].sum() + (drop[1:] & ~drop[:-1]).sum())
                    for column, value in zip(out, (
                        plain.decode("utf-8", "replace") if known[i] else None, own.size, int(drop.sum()), spans,
                        hashlib.sha256(plain).hexdigest(),
                    )):
                        column.append(value)
                kinds = pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, last - first), *(pa.array(c, k) for c, k in zip(out, kinds))],
                    ["row", *new],
                )

    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType)])
    for name, kind in zip(new, ("string", "long", "long", "long", "string")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in others], *new)
