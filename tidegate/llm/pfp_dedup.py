"""Exact removal of repeated byte strings by prefix-free parsing.

A rolling hash over 16 bytes triggers phrase ends, so equal strings are cut alike wherever
they stand. A window (a string of `length` bytes that starts at p) is named from its first
phrase end: a suffix of a phrase on the left (dictionary side), the text that follows on
the right (parse side). Windows whose first phrase end lies at a like distance form a
block and share a core; blocks with a core that no other text position has are dropped,
which leaves the repetitive part. Of that part each task builds the suffix array of its
dictionary and ranks of its parse sides, combines them into corpus order, and passes on
each run of equal windows as one row; sums over tasks then tell which windows repeat.

Strings may also be measured in words: a text then is the sequence of its words, each one
written as a name of WORD bytes, and windows start at words only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegate.llm.common import (
    WORD_BYTES, keep_repeated, mix, names, per_text, pieces, prepare, signed, text_buffer, text_tie,
    window_hashes, with_key, word_names,
)
from tidegate.session import materialize

LENGTH = 400
#: Bytes a trigger looks at, mean bytes between triggers (a power of two), windows of a block.
TRIGGER, GAP, BLOCK = 16, 64, 96
#: Bytes of a word's name, the unit of strings that are measured in words (of bytes: 1).
WORD = 8


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the words, the longest runs without blanks, of every text."""
    inside = WORD_BYTES[data]
    edge = np.zeros(data.size + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def compared(data: np.ndarray, offsets: np.ndarray, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts as they are compared: their bytes, or the names of their words."""
    if unit == 1:
        return data, offsets
    start, end = word_places(data, offsets)
    return word_names(data, start, end).view(np.uint8), np.searchsorted(start, offsets) * unit


def blocks_of(data: np.ndarray, offsets: np.ndarray, length: int, unit: int):
    """Blocks of windows: (row, first window, windows, core start, core end, kind).

    Windows start every `unit` bytes of a text, and triggers lie there.
    The kind is the block's distance from the phrase end, so equal windows are of equal
    kind. A window without a phrase end is a block of its own (kind -1). Every window of
    every text lies in exactly one block.
    """
    counts = np.diff(offsets)
    row_of = lambda at: np.searchsorted(offsets, at, "right") - 1
    hashes = window_hashes(data, TRIGGER)[::unit]
    ends = np.flatnonzero(hashes & np.uint64(GAP // unit - 1) == 0) * unit + TRIGGER
    # A trigger may not reach over the start of its text.
    ends = ends[ends - TRIGGER >= offsets[row_of(ends - 1)]] if ends.size else ends
    windows = np.maximum((counts - length) // unit + 1, 0)
    starts = np.repeat(offsets[:-1], windows) + unit * (
        np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    )
    if not starts.size:
        return None
    # First phrase end at or behind start + TRIGGER and within the window.
    nearest = np.searchsorted(ends, starts + TRIGGER)
    far = np.iinfo(np.int64).max
    end = np.append(ends, far)[nearest]
    distance = np.where(end <= starts + length, end - starts, -1)
    kind = np.where(distance >= 0, (distance - TRIGGER) // BLOCK, -1)
    anchor = np.where(distance >= 0, end, -starts - 1)
    new = np.ones(starts.size, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (kind[1:] != kind[:-1])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, starts.size))
    kind, anchor, begin = kind[first], anchor[first], starts[first]
    # The core lies in every window that a block of this kind can have, here or elsewhere.
    nearest_start = anchor - (TRIGGER + kind * BLOCK)
    farthest_start = anchor - (TRIGGER + kind * BLOCK + BLOCK - unit)
    core_start = np.where(kind >= 0, nearest_start, begin)
    core_end = np.where(kind >= 0, farthest_start + length, begin + length)
    return row_of(begin), begin, many, core_start, core_end, kind


def name_of(core: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return mix(core + kind.astype(np.uint64))


def cores(docs: DataFrame, length: int, unit: int) -> DataFrame:
    """A row per block: core (hash), whole (hash of all it covers), doc_id, tie, and place:
    its first window times 256 plus the number of windows, 0 for a window without a phrase
    end."""

    def function(data, offsets, batch):
        data, offsets = compared(data, offsets, unit)
        found = blocks_of(data, offsets, length, unit)
        if found is None:
            return None
        sums = names().sums(data)
        row, begin, many, start, end, kind = found
        core = name_of(sums.ranges(start, end), kind)
        whole = mix(sums.ranges(begin, begin + (many - 1) * unit + length) + many.astype(np.uint64))
        at = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [signed(core), signed(whole), batch.column("doc_id").take(at), batch.column("tie").take(at),
             pa.array((begin - offsets[row]) * 256 + np.where(kind < 0, 0, many))],
            ["core", "whole", "doc_id", "tie", "place"],
        )

    return per_text(docs, function, "core long, whole long, doc_id long, tie long, place long")


def repetitive_blocks(docs: DataFrame, length: int, unit: int) -> DataFrame:
    """The blocks whose core stands elsewhere too. repeated: all it covers does; first: it
    is the one that represents the equal ones in further comparisons."""
    blocks = keep_repeated(cores(docs, length, unit), "core", ["whole", "doc_id", "tie", "place"])

    def run(batches):
        before = None
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            yield from emit(batch, before, False)
            if batch.num_rows > 1:
                before = tuple(batch.column(c)[batch.num_rows - 2].as_py() for c in ("core", "whole"))
            held = batch.slice(batch.num_rows - 1)
        if held is not None:
            yield from emit(held, before, True)

    def emit(batch, before, last):
        core = batch.column("core").to_numpy(zero_copy_only=False)
        whole = batch.column("whole").to_numpy(zero_copy_only=False)
        same = (core[1:] == core[:-1]) & (whole[1:] == whole[:-1])
        back = np.concatenate([[before == (core[0], whole[0])], same])
        ahead = np.concatenate([same, [False]])
        n = batch.num_rows if last else batch.num_rows - 1
        if n:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(0, n) for c in ("doc_id", "tie", "place")),
                 pa.array((back | ahead)[:n]), pa.array((ahead & ~back)[:n])],
                ["doc_id", "tie", "place", "repeated", "first"],
            )

    return blocks.mapInArrow(run, "doc_id long, tie long, place long, repeated boolean, first boolean")


def contexts_of(docs: DataFrame, wanted: DataFrame, length: int, unit: int) -> DataFrame:
    """The blocks wanted with what their windows reach beyond the core: at most BLOCK - 1
    bytes of phrase suffix on the left and as many of following text on the right."""
    places = wanted.groupBy("doc_id", "tie").agg(
        F.sort_array(F.collect_set(F.struct(F.expr("place div 256").alias("at"), "times"))).alias("places")
    ).select("doc_id", "tie", F.col("places.at").alias("ats"), F.col("places.times").alias("times"))

    def function(data, offsets, batch):
        data, offsets = compared(data, offsets, unit)
        found = blocks_of(data, offsets, length, unit)
        if found is None:
            return None
        sums = names().sums(data)
        row, begin, many, start, end, kind = found
        ats, times = batch.column("ats"), batch.column("times")
        owner = np.repeat(np.arange(offsets.size - 1), ats.value_lengths().to_numpy(zero_copy_only=False))
        asked = ats.flatten().to_numpy(zero_copy_only=False) + offsets[owner]
        times = times.flatten().to_numpy(zero_copy_only=False)
        pick = np.searchsorted(begin, asked)
        row, begin, many, start, end, kind = (x[pick] for x in (row, begin, many, start, end, kind))
        core = name_of(sums.ranges(start, end), kind)
        reach = begin + (many - 1) * unit + length
        at = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [signed(core), batch.column("doc_id").take(at), batch.column("tie").take(at),
             pa.array(begin - offsets[row]), pa.array(many), pa.array(times),
             pa.array([data[a:b].tobytes() for a, b in zip(begin, start)], pa.binary()),
             pa.array([data[a:b].tobytes() for a, b in zip(end, reach)], pa.binary())],
            ["core", "doc_id", "tie", "at", "many", "times", "left", "right"],
        )

    texts = docs.join(places, ["doc_id", "tie"]).dropDuplicates(["doc_id", "tie"])
    return per_text(
        texts, function,
        "core long, doc_id long, tie long, at long, many long, times long, left binary, right binary",
    )


def aligned(values: list[bytes], at_end: bool) -> tuple[np.ndarray, np.ndarray]:
    """(rows of BLOCK bytes, lengths): the values flush right or left in rows of zeros."""
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    out = np.zeros((len(values), BLOCK), np.uint8)
    flat = np.frombuffer(b"".join(values), np.uint8)
    row = np.repeat(np.arange(len(values)), lengths)
    inner = np.arange(flat.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, inner + ((BLOCK - lengths)[row] if at_end else 0)] = flat
    return out, lengths


def suffix_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the rows and the common prefix of each with the one before it."""
    words = np.ascontiguousarray(rows).view(">u8")
    order = np.lexsort(words.T[::-1])
    differs = rows[order[1:]] != rows[order[:-1]]
    return order, np.where(differs.any(1), differs.argmax(1), rows.shape[1])


def classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """Numbers in order of the rows, equal where the first `depth` bytes are."""
    out = np.empty(order.size, np.int64)
    out[order] = np.concatenate([[0], np.cumsum(common < depth)])
    return out


def corpus_order(core, left: list[bytes], right: list[bytes], many, times, unit: int):
    """The windows of distinct contexts in corpus order, as runs of equal ones.

    The dictionary side is sorted from the core to the left, the parse side from the core
    to the right, once each. For every distance `back` of a window's start from the core
    the two ranks and the core put its windows in order; neighbours that share the whole
    window form a run. Yields back, contexts in order, run of each, and each run's times.
    """
    a, la = aligned(left, True)
    b, _ = aligned(right, False)
    left_order, left_common = suffix_order(a[:, ::-1])
    right_order, right_common = suffix_order(b)
    for back in range(0, BLOCK, unit):
        pick = np.flatnonzero((back <= la) & (back > la - many * unit))
        if not pick.size:
            continue
        x = classes(left_order, left_common, back)[pick]
        y = classes(right_order, right_common, BLOCK - unit - back)[pick]
        inner = np.lexsort((y, x, core[pick]))
        order, x, y = pick[inner], x[inner], y[inner]
        same = (core[order[1:]] == core[order[:-1]]) & (x[1:] == x[:-1]) & (y[1:] == y[:-1])
        run = np.concatenate([[0], np.cumsum(~same)])
        yield back, order, run, np.bincount(run, weights=times[order]).astype(np.int64)


def columns_of(part: pa.RecordBatch):
    number = lambda c: part.column(c).to_numpy(zero_copy_only=False)
    return (number("core"), part.column("left").to_pylist(), part.column("right").to_pylist(),
            number("many"), number("times"))


def spans_of(
    part: pa.RecordBatch, rows: np.ndarray, step: np.ndarray, length: int, unit: int
) -> pa.RecordBatch:
    """Runs of neighbouring windows (row, bytes from the block's first) as byte ranges."""
    order = np.lexsort((step, rows))
    rows, step = rows[order], step[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (step[1:] != step[:-1] + unit)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], rows.size) - 1
    at = part.column("at").to_numpy(zero_copy_only=False)[rows[first]]
    take = pa.array(rows[first])
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id").take(take), part.column("tie").take(take),
         pa.array(at + step[first]), pa.array(at + step[last] + length)],
        ["doc_id", "tie", "start", "stop"],
    )


SPAN = "doc_id long, tie long, start long, stop long"
#: Contexts put in order at once.
TOGETHER = 8192


def spans_by_core(contexts: DataFrame, length: int, unit: int) -> DataFrame:
    """Spans of contexts whose cores have at most TOGETHER contexts each."""

    def decide(part):
        core, left, right, many, times = columns_of(part)
        la = np.fromiter(map(len, left), np.int64, len(left))
        rows, steps = [], []
        for back, order, run, total in corpus_order(core, left, right, many, times, unit):
            hit = order[total[run] > 1]
            rows.append(hit)
            steps.append(la[hit] - back)
        rows, steps = np.concatenate(rows), np.concatenate(steps)
        if rows.size:
            yield spans_of(part, rows, steps, length, unit)

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            held = table.combine_chunks().to_batches()[0] if table.num_rows else held
            # Cut where the core changes, at most TOGETHER rows at once.
            while held is not None and held.num_rows > 2 * TOGETHER:
                core = held.column("core").to_numpy(zero_copy_only=False)
                change = np.flatnonzero(core[1 : TOGETHER + 1] != core[:TOGETHER])
                cut = int(change[-1]) + 1
                yield from decide(held.slice(0, cut))
                held = held.slice(cut)
        while held is not None and held.num_rows:
            core = held.column("core").to_numpy(zero_copy_only=False)
            cut = held.num_rows
            if cut > TOGETHER:
                cut = int(np.flatnonzero(core[1 : TOGETHER + 1] != core[:TOGETHER])[-1]) + 1
            yield from decide(held.slice(0, cut))
            held = held.slice(cut)

    return contexts.repartition("core").sortWithinPartitions("core").mapInArrow(run, SPAN)


def spans_of_large_cores(contexts: DataFrame, length: int, unit: int) -> DataFrame:
    """Spans of contexts of very frequent cores, which stay where they are: each task puts
    its own in order and passes on one row per run; sums over tasks decide."""

    def named(part, back, rows, left, right):
        buffer = b"".join(left[r][len(left[r]) - back :] + right[r][: BLOCK - unit - back] for r in rows)
        data = np.frombuffer(buffer, np.uint8)
        at = np.arange(rows.size) * (BLOCK - unit)
        return signed(names().sums(data).ranges(at, at + BLOCK - unit))

    def runs(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(first, TOGETHER)
                core, left, right, many, times = columns_of(part)
                for back, order, run, total in corpus_order(core, left, right, many, times, unit):
                    lead = order[np.concatenate([[True], run[1:] != run[:-1]])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(core[lead]), pa.array(np.full(lead.size, back, np.int32)),
                         named(part, back, lead, left, right), pa.array(total)],
                        ["core", "back", "name", "total"],
                    )

    def windows(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(first, TOGETHER)
                core, left, right, many, _ = columns_of(part)
                at = part.column("at").to_numpy(zero_copy_only=False)
                la = np.fromiter(map(len, left), np.int64, len(left))
                for back in range(0, BLOCK, unit):
                    rows = np.flatnonzero((back <= la) & (back > la - many * unit))
                    if rows.size:
                        take, start = pa.array(rows), at[rows] + la[rows] - back
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(core[rows]), pa.array(np.full(rows.size, back, np.int32)),
                             named(part, back, rows, left, right), part.column("doc_id").take(take),
                             part.column("tie").take(take), pa.array(start), pa.array(start + length)],
                            ["core", "back", "name", "doc_id", "tie", "start", "stop"],
                        )

    key = ["core", "back", "name"]
    counted = contexts.mapInArrow(runs, "core long, back int, name long, total long")
    repeated = counted.groupBy(*key).agg(F.sum("total").alias("total")).where("total > 1")
    all_windows = contexts.mapInArrow(windows, f"core long, back int, name long, {SPAN}")
    return all_windows.join(repeated.select(*key), key).select("doc_id", "tie", "start", "stop")


def repeated_spans(spark: SparkSession, keyed: DataFrame, length: int, unit: int = 1) -> DataFrame:
    """(doc_id, tie, start, stop): byte ranges that cover every repeated window, and only
    bytes of repeated windows. Ranges may overlap. With WORD as the unit the bytes are those
    of the words' names."""
    blocks = materialize(spark, repetitive_blocks(keyed, length, unit), "pfp-blocks")
    many = F.greatest(F.expr("place % 256"), F.lit(1))
    start = F.expr("place div 256")
    whole = blocks.where("repeated").select(
        "doc_id", "tie", start.alias("start"), (start + (many - 1) * unit + length).alias("stop")
    )
    wanted = blocks.where("(not repeated or first) and place % 256 > 0").select(
        "doc_id", "tie", "place", F.when(F.col("repeated"), 2).otherwise(1).cast("long").alias("times")
    )
    contexts = materialize(spark, contexts_of(keyed, wanted, length, unit), "pfp-contexts")
    large = materialize(
        spark, contexts.groupBy("core").count().where(F.col("count") > TOGETHER).select("core"), "pfp-large"
    )
    return whole.unionByName(
        spans_by_core(contexts.join(large, "core", "left_anti"), length, unit)
    ).unionByName(spans_of_large_cores(contexts.join(large, "core", "left_semi"), length, unit))


def remove_repeated_strings(
    spark: SparkSession, docs: DataFrame, length: int = LENGTH, words: int | None = None
) -> DataFrame:
    """All columns of docs with text cut, and n_bytes, n_removed, n_spans, kept_sha256.

    Every byte is removed that lies in a string of `length` bytes which also starts anywhere
    else in the texts of docs, as they come in; all copies lose it. With `words`, every
    passage of so many words that also starts anywhere else goes too, from its first word
    to its last, however few bytes it takes and whatever blanks part its words. Matches
    never cross rows. A null text is empty; texts shorter than both stay. Repeated rows are rows
    of their own, so long ones lose everything. A character cut in two is dropped from the
    text, while digest and counts are of the bytes. Columns of docs named like the four
    new ones are replaced.
    """
    if length <= TRIGGER + BLOCK:
        raise ValueError(f"length must be over {TRIGGER + BLOCK}")
    if words is not None and words * WORD <= TRIGGER + BLOCK:
        raise ValueError(f"words must be over {(TRIGGER + BLOCK) // WORD}")
    prepare(spark)
    keyed = with_key(docs)
    spans = repeated_spans(spark, keyed, length).withColumn("unit", F.lit(1))
    if words is not None:
        passages = repeated_spans(spark, keyed, words * WORD, WORD)
        spans = spans.unionByName(passages.withColumn("unit", F.lit(WORD)))
    cut = materialize(
        spark,
        spans.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("start", "stop", "unit")).alias("spans")),
        "pfp-spans",
    )
    new = ["text", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    others = [c for c in docs.columns if c not in new]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        text_tie().alias("tie"), F.col("text").cast("string").alias("text"),
    ).join(cut, ["doc_id", "tie"], "left").select(
        "row", "text", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"),
        F.col("spans.unit").alias("units"),
    )
    fields = rows.schema["row"].dataType

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            starts, stops, units = (batch.column(c).to_pylist() for c in ("starts", "stops", "units"))
            for first, last in pieces(offsets):
                out = [[], [], [], [], []]
                for i in range(first, last):
                    body = data[offsets[i] : offsets[i + 1]]
                    n_spans = 0
                    kept = body
                    if starts[i]:
                        start, stop, by_word = np.array(starts[i]), np.array(stops[i]), np.array(units[i]) == WORD
                        if by_word.any():
                            first_byte, end_byte = word_places(body, np.array([0, body.size]))
                            start[by_word] = first_byte[start[by_word] // WORD]
                            stop[by_word] = end_byte[stop[by_word] // WORD - 1]
                        level = np.zeros(body.size + 1, np.int64)
                        np.add.at(level, start, 1)
                        np.add.at(level, stop, -1)
                        gone = np.cumsum(level[:-1]) > 0
                        n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                        kept = body[~gone]
                    plain = kept.tobytes()
                    for column, value in zip(out, (
                        plain.decode("utf-8", "ignore"), body.size, body.size - kept.size, n_spans,
                        hashlib.sha256(plain).hexdigest(),
                    )):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, last - first), *(pa.array(c) for c in out)],
                    ["row", *new],
                )

    kinds = "string", "long", "long", "long", "string"
    schema = T.StructType([T.StructField("row", fields)])
    for name, kind in zip(new, kinds):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema).select(
        *[F.col("row").getField(c).alias(c) for c in others], *new
    )
