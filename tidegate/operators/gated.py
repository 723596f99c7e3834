"""Exact time-gated folds that stay parallel inside one key.

De-duplication and retry share one shape. Per key there is a small state: a layer
(how many failures so far; always 0 for de-duplication) and a gate (a time). Rows
come in time order; a row before the gate is skipped, the first row at or after
it is taken and sets the next layer and gate.

Such a fold looks sequential, and one key may hold a large share of all rows. So
each key's time line is cut into segments of fixed length, spread over tasks, and
segments with very many rows into parts of about equal size (``cut_dense``):

1. ``summaries``: a segment becomes a step function from the state it may be
   entered with to the state it is left with (only entries within the longest
   gate matter, and runs with the same outcome merge into one step);
2. ``entry_states``: per key, walk over segments (not rows) and note the state
   each segment is entered with; only states unlike the initial one are kept;
3. ``apply_gates``: every segment runs forward from its entry state, batch by
   batch, carrying one state.

No task ever holds the rows of a whole key; no row is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from tidegate.operators.ranking import null_safe_join

NEXT_ROW = -1  # gate value: the very next row is taken
ANY_LAYER = -1  # summary step that holds for every layer
SEGMENT_MS = 600_000
#: Rows from which a segment is cut further.
DENSE_ROWS = 200_000
#: Hash groups by which dense segments are looked for, and the most that are listed.
LOOK_GROUPS, LISTED_GROUPS = 1 << 16, 1_000
#: A segment's number is the millisecond where it begins times INSTANT, so that parts of one
#: millisecond, SPLITS of each kind at most, find room behind it.
INSTANT, SPLITS = 1 << 12, 2_000
BEFORE, FINAL = -(2**62), 2**62  # segment numbers ahead of and behind all others


def cut_dense(df: DataFrame, keys: list[str], tie: str, kind: str | None, dense_rows: int = DENSE_ROWS) -> DataFrame:
    """``df`` with ``segment``, the millisecond where a row's segment begins, made into
    numbers that also cut segments of more than ``dense_rows`` rows.

    They are cut between milliseconds at about equal numbers of rows. A millisecond with
    more rows than that is cut too: rows of one ``kind`` and time do the same to a key's
    state, so only which of them come first matters, at most two (the last failure and one
    after it). Those two by ``tie`` lead, the others are spread by a hash.

    Numbers follow the order of rows and depend on the rows alone, so the frame may be cut
    again. Rows are counted by hash groups first, which costs one small aggregate; where no
    group is large there is nothing to cut.
    """
    by = keys + ["segment"]
    group = F.pmod(F.xxhash64(*by), F.lit(LOOK_GROUPS))
    large = [
        r.g for r in df.groupBy(group.alias("g")).count().where(F.col("count") > dense_rows).collect()
    ]
    if not large:
        return df.withColumn("segment", F.col("segment") * INSTANT)
    looked = df if len(large) > LISTED_GROUPS else df.where(group.isin(large))
    kinds = F.lit(0) if kind is None else F.col(kind).cast("int")
    # One row per instant: at most a segment's milliseconds meet in a window.
    line = W.partitionBy(*by)
    instants = (
        looked.groupBy(*by, "t_ms").agg(F.count("*").alias("dense_n"))
        .withColumns({
            "dense_total": F.sum("dense_n").over(line),
            "dense_before": F.sum("dense_n").over(line.orderBy("t_ms")) - F.col("dense_n"),
        })
        .where(F.col("dense_total") > dense_rows)
        .withColumn("dense_part", F.floor(F.col("dense_before") / dense_rows))
        .select(
            *by, "t_ms", F.min("t_ms").over(W.partitionBy(*by, "dense_part")).alias("dense_start"),
            F.when(
                F.col("dense_n") > dense_rows, F.least(F.ceil(F.col("dense_n") / dense_rows), F.lit(SPLITS))
            ).alias("dense_splits"),
        )
    )
    rows = null_safe_join(df, instants, by + ["t_ms"], "left").withColumn("dense_kind", kinds)
    crowd = by + ["t_ms", "dense_kind"]
    split = rows.where("dense_splits is not null").select(*crowd, tie)
    first = split.groupBy(*crowd).agg(F.min(tie).alias("dense_first"))
    second = (
        null_safe_join(split, first, crowd, "inner").where(F.col(tie) > F.col("dense_first"))
        .groupBy(*crowd).agg(F.min(tie).alias("dense_second"))
    )
    heads = null_safe_join(first, second, crowd, "left").select(
        *crowd, F.coalesce("dense_second", "dense_first").alias("dense_head")
    )
    placed = null_safe_join(rows, heads, crowd, "left")
    spread = F.pmod(F.xxhash64(tie), F.col("dense_splits")) + 1
    inside = F.col("dense_kind") * (F.col("dense_splits") + 1) + F.when(F.col(tie) <= F.col("dense_head"), 0).otherwise(spread)
    number = F.coalesce("dense_start", "segment") * INSTANT + F.coalesce(inside, F.lit(0))
    return placed.withColumn("segment", number.cast("bigint")).drop(
        "dense_start", "dense_splits", "dense_kind", "dense_head"
    )


@dataclass(frozen=True)
class Machine:
    """``steps(batch) -> (next_layer, gate)``, both of shape (layers, rows), from the
    batch's ``t_ms`` and the machine's own columns. ``reach_ms`` bounds gate - t_ms."""

    layers: int
    reach_ms: int
    columns: tuple[str, ...]
    steps: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def run_starts(batch, names: list[str]) -> np.ndarray:
    """Indexes where a new run of equal values begins."""
    rows = batch.num_rows
    change = np.zeros(rows, dtype=bool)
    if rows:
        change[0] = True
    for name in names:
        values = batch.column(name)
        if values.null_count:
            values = column(batch, name)
            change[1:] |= values[1:] != values[:-1]
        elif rows > 1:
            differs = pc.not_equal(values.slice(1), values.slice(0, rows - 1))
            change[1:] |= differs.to_numpy(zero_copy_only=False)
    return np.flatnonzero(change)


class Chains:
    """The taken-next links between the (layer, row) nodes of sorted groups."""

    def __init__(self, t, starts, next_layer, gate):
        rows = len(t)
        self.rows = rows
        self.starts = starts
        self.ends = np.append(starts[1:], rows)
        self.group = np.repeat(np.arange(len(starts)), self.ends - starts)
        self.origin = t[starts]
        longest = int((t - self.origin[self.group]).max(initial=0))
        self.span = max(longest, int((gate - t).max(initial=0)) + longest) + 2
        self.code = self.group * self.span + (t - self.origin[self.group])
        index = np.arange(rows)
        at = np.searchsorted(
            self.code, self.group * self.span + np.maximum(gate - self.origin[self.group], 0)
        )
        at = np.where(gate == NEXT_ROW, index + 1, at)
        own = np.arange(gate.size).reshape(gate.shape)
        leaves = at >= self.ends[self.group]
        self.link = np.where(leaves, own, next_layer * rows + np.minimum(at, rows - 1)).ravel()
        self.next_layer = next_layer.ravel()
        self.gate = gate.ravel()

    def final(self) -> np.ndarray:
        """For each node, the last node of its chain in the group (pointer doubling)."""
        link = self.link
        while True:
            further = link[link]
            if np.array_equal(further, link):
                return link
            link = further

    def first_nodes(self, layer, gate):
        """Per group the node taken first from a given state; -1 where none is."""
        wanted = np.maximum(gate - self.origin, 0)
        beyond = wanted >= self.span
        at = np.searchsorted(
            self.code, np.arange(len(self.starts)) * self.span + np.minimum(wanted, self.span - 1)
        )
        none = beyond | (at >= self.ends)
        return np.where(none, -1, layer * self.rows + np.minimum(at, self.rows - 1))

    def reached(self, first) -> np.ndarray:
        """All nodes on the chains that begin at ``first`` (reach by doubling)."""
        seen = np.zeros(len(self.link), dtype=bool)
        seen[first] = True
        jump = self.link
        while True:
            seen[jump[np.flatnonzero(seen)]] = True
            further = jump[jump]
            if np.array_equal(further, jump):
                return seen
            jump = further


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Re-cut sorted batches so that no group of equal ``names`` is split."""
    pending: list[pa.RecordBatch] = []

    def joined(parts):
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        if pending:
            same = all(
                pending[-1].column(n)[-1] == batch.column(n)[-1] for n in names
            )
            if same:
                pending.append(batch)
                continue
            batch = joined(pending + [batch])
        cut = int(run_starts(batch, names)[-1])
        if cut:
            yield batch.slice(0, cut)
        pending = [batch.slice(cut)]
    if pending:
        yield joined(pending)


def summarise_segments(machine: Machine, keys: list[str], every_entry: bool):
    names = keys + ["segment"]

    def run(batches):
        for batch in whole_groups(batches, names):
            t = column(batch, "t_ms")
            starts = run_starts(batch, names)
            next_layer, gate = machine.steps(batch)
            chains = Chains(t, starts, next_layer, gate)
            last = chains.final()
            out_layer = chains.next_layer[last].reshape(gate.shape)
            out_gate = chains.gate[last].reshape(gate.shape)

            first = np.zeros(len(t), dtype=bool)
            first[starts] = True
            previous = np.roll(t, 1)
            # No gate set before a segment reaches farther than this behind its first row.
            horizon = t[starts][chains.group] + machine.reach_ms
            entry = np.flatnonzero(first | every_entry | (previous < horizon))
            group = chains.group[entry]
            parts = []
            for layer in range(machine.layers):
                ol, og = out_layer[layer][entry], out_gate[layer][entry]
                keep = np.ones(len(entry), dtype=bool)  # last entry of a run of equal outcomes
                keep[:-1] = (ol[1:] != ol[:-1]) | (og[1:] != og[:-1]) | (group[1:] != group[:-1])
                parts.append((np.full(int(keep.sum()), layer), entry[keep], ol[keep], og[keep]))
            if machine.layers > 1 and all(
                len(p[1]) == len(parts[0][1])
                and all(np.array_equal(a, b) for a, b in zip(p[1:], parts[0][1:]))
                for p in parts[1:]
            ):
                parts = [(np.full(len(parts[0][1]), ANY_LAYER), *parts[0][1:])]
            layer, rows, ol, og = (np.concatenate(c) for c in zip(*parts))
            picked = batch.select(names).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                picked.columns
                + [pa.array(a.astype("int64")) for a in (layer, t[rows], ol, og)],
                names=names + ["layer", "entry_ms", "out_layer", "out_gate"],
            )

    return run


def group_finals(batch, starts):
    """Final state of keys that need no walk: the outcome of their first fresh entry."""
    layer = column(batch, "layer")
    group = np.repeat(np.arange(len(starts)), np.append(starts[1:], batch.num_rows) - starts)
    fresh = np.flatnonzero((layer == 0) | (layer == ANY_LAYER))
    groups, at = np.unique(group[fresh], return_index=True)
    rows = fresh[at]
    return groups, rows


def walk_segments(keys: list[str], finals: bool, keep_after_ms: int, forget_before_ms: int):
    """Entry states of segments and, if wanted, the final state of each key under
    the segment number ``FINAL``. A final gate that no later row can meet is left out."""

    def lasting(layer, gate):
        return gate > (keep_after_ms if layer == 0 else forget_before_ms)

    def run(batches):
        key = segment = None
        state, entered, matched = (0, NEXT_ROW), None, False
        fields = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if fields is None:
                fields = [batch.schema.field(k) for k in keys] + [
                    pa.field(n, pa.int64()) for n in ("segment", "layer_in", "gate_in")
                ]
            # Keys that lie within one segment of this batch need no walk, unless
            # they may go on in a neighbouring batch.
            starts = run_starts(batch, keys)
            ends = np.append(starts[1:], batch.num_rows)
            segments = column(batch, "segment")
            walk = segments[starts] != segments[ends - 1]
            walk[0] = walk[-1] = True
            found = []
            if finals and not walk.all():
                groups, rows = group_finals(batch, starts)
                rows = rows[~walk[groups]]
                part = batch.take(pa.array(rows))
                for *row_key, layer, gate in zip(
                    *[part.column(n).to_pylist() for n in keys + ["out_layer", "out_gate"]]
                ):
                    if lasting(layer, gate):
                        found.append((*row_key, FINAL, layer, gate))
            part = batch.take(pa.array(np.flatnonzero(np.repeat(walk, ends - starts))))
            columns = [part.column(n).to_pylist() for n in part.schema.names]
            for *row_key, row_segment, layer, entry_ms, out_layer, out_gate in zip(*columns):
                if row_key != key:
                    if finals and key is not None and lasting(*state):
                        found.append((*key, FINAL, *state))
                    key, segment, state = row_key, None, (0, NEXT_ROW)
                if row_segment != segment:
                    segment, entered, matched = row_segment, state, False
                    if state != (0, NEXT_ROW):
                        found.append((*key, segment, *state))
                if not matched and layer in (entered[0], ANY_LAYER) and entry_ms >= entered[1]:
                    state, matched = (out_layer, out_gate), True
            if found:
                arrays = [pa.array(v, type=f.type) for v, f in zip(zip(*found), fields)]
                yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))
        if finals and key is not None and lasting(*state):
            arrays = [pa.array([v], type=f.type) for v, f in zip((*key, FINAL, *state), fields)]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    return run


def run_forward(machine: Machine, keys: list[str]):
    names = keys + ["segment"]

    def run(batches):
        last_key, carried = None, (0, NEXT_ROW)
        for batch in batches:
            if not batch.num_rows:
                continue
            t = column(batch, "t_ms")
            starts = run_starts(batch, names)
            chains = Chains(t, starts, *machine.steps(batch))
            layer, gate = column(batch, "layer_in")[starts], column(batch, "gate_in")[starts]
            first_key = [batch.column(n)[0].as_py() for n in names]
            if first_key == last_key:
                layer, gate = layer.copy(), gate.copy()
                layer[0], gate[0] = carried
            first = chains.first_nodes(layer, gate)
            seen = chains.reached(first[first >= 0]).reshape(machine.layers, len(t))
            taken = np.where(seen.any(axis=0), seen.argmax(axis=0), -1)
            last_key = [batch.column(n)[-1].as_py() for n in names]
            carried = (int(layer[-1]), int(gate[-1]))
            if first[-1] >= 0:
                end = np.flatnonzero(seen[:, starts[-1]:].any(axis=0))[-1] + starts[-1]
                node = taken[end] * len(t) + end
                carried = (int(chains.next_layer[node]), int(chains.gate[node]))
            yield batch.append_column("taken_layer", pa.array(taken.astype("int64")))

    return run


def add_fields(df: DataFrame, names: list[str]):
    return T.StructType(df.schema.fields + [T.StructField(n, T.LongType()) for n in names])


def entry_states(
    df: DataFrame,
    machine: Machine,
    keys: list[str],
    order: list[str],
    initial: DataFrame | None = None,
    finals: bool = False,
    keep_after_ms: int = NEXT_ROW,
    forget_before_ms: int = NEXT_ROW,
) -> DataFrame:
    """(keys, segment, layer_in, gate_in) of the segments not entered afresh.

    ``initial`` (keys, layer_in, gate_in) holds states left by earlier rows; with
    ``finals`` the states this frame leaves are added, see ``final_states``."""
    by = keys + ["segment"]
    narrow = df.select(*by, "t_ms", *dict.fromkeys((*machine.columns, *order)))
    steps = ["layer", "entry_ms", "out_layer", "out_gate"]
    summaries = (
        narrow.repartition(*by)
        .sortWithinPartitions(*by, "t_ms", *order)
        .mapInArrow(
            # A carried gate may lie beyond late rows: then every entry counts.
            summarise_segments(machine, keys, initial is not None),
            add_fields(narrow.select(*by), steps),
        )
    )
    if initial is not None:
        before = initial.select(
            *keys, F.lit(BEFORE).alias("segment"), F.lit(ANY_LAYER).cast("bigint").alias("layer"),
            F.lit(FINAL).alias("entry_ms"), F.col("layer_in").alias("out_layer"),
            F.col("gate_in").alias("out_gate"),
        )
        summaries = summaries.unionByName(before)
    return (
        summaries.repartition(*keys)
        .sortWithinPartitions(*by, "entry_ms")
        .mapInArrow(
            walk_segments(keys, finals, keep_after_ms, forget_before_ms),
            add_fields(narrow.select(*by), ["layer_in", "gate_in"]),
        )
    )


def final_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """The states to start the next frame with."""
    return states.where(F.col("segment") == FINAL).select(*keys, "layer_in", "gate_in")


def apply_gates(
    df: DataFrame,
    machine: Machine,
    keys: list[str],
    order: list[str],
    entries: DataFrame,
) -> DataFrame:
    """Run every segment forward from its entry state. Adds ``taken_layer``: the
    layer a row was taken in, -1 for a row the gate held back."""
    by = keys + ["segment"]
    entries = entries.where(F.col("segment") != FINAL)
    started = null_safe_join(df, entries, by, "left").withColumns(
        {
            "layer_in": F.coalesce("layer_in", F.lit(0).cast("bigint")),
            "gate_in": F.coalesce("gate_in", F.lit(NEXT_ROW).cast("bigint")),
        }
    )
    sorted_rows = started.repartition(*by).sortWithinPartitions(*by, "t_ms", *order)
    return sorted_rows.mapInArrow(
        run_forward(machine, keys), add_fields(sorted_rows, ["taken_layer"])
    ).drop("layer_in", "gate_in")
