"""Packing documents into sequences: cutting stock by column generation.

Documents are tokenized once. Whole sequences are cut from long ones; what remains falls
into length classes. A linear program over patterns (how many pieces of each class share a
sequence) is grown column by column, each priced by knapsack dynamic programming over the
dual prices. Rounded patterns are then dealt to the pieces by their rank in their class.
The program sees only the histogram, whose size is fixed, so it is the same small work for
any corpus; everything that grows is Spark's.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidegate.llm.byte_bpe import byte_level_encoder
from tidegate.llm.common import pieces, prepare, text_buffer
from tidegate.llm.segments import SegmentIds, release_memory
from tidegate.session import materialize

CAPACITY = 1024
#: Tokens by which lengths are rounded up to classes.
GRAIN = 8
END_ID = 0
#: Steps after which the kept inverse is computed anew.
RENEWED = 200
#: Weight of the best known dual prices in those that price the next pattern.
SMOOTH = 0.6

#: White space beyond ASCII's, which the pre-tokenizer treats like a blank.
_STRANGE_BLANKS = [chr(c) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


_STRANGE_BYTES = [c.encode() for c in _STRANGE_BLANKS]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14), *range(28, 32)]] = True
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b".,;:!?")] = True


def byte_level_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where byte-level pre-tokenization parts a text for sure.

    It cuts before a blank that stands alone between characters that are none, behind it
    if it is a line feed, and between a letter and a stop or comma. So a text is the
    segments between such places and its ids are those of its segments in order. Texts
    with blanks other than space, line feed and the like are not cut.
    """
    is_blank = _BLANK[data]
    cut = np.zeros(data.size, bool)
    alone = (data == 32) | (data == 10)
    cut[1:-1] = alone[1:-1] & ~is_blank[:-2] & ~is_blank[2:]
    cut[1:] |= cut[:-1] & (data[:-1] == 10)
    cut[1:] |= _MARK[data[1:]] & _LETTER[data[:-1]]
    text = data.tobytes()
    for mark in _STRANGE_BYTES:
        at = text.find(mark)
        while at >= 0:
            i = int(np.searchsorted(offsets, at, "right")) - 1
            cut[offsets[i] : offsets[i + 1]] = False
            at = text.find(mark, int(offsets[i + 1]))
    return cut


class Encoder:
    """Token ids of whole texts by the tokenizer file, remembering words."""

    def __init__(self, path: str) -> None:
        self.segments = SegmentIds(byte_level_encoder(path))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, where each text's ids start)."""
        return self.segments.encode(data, offsets, byte_level_cuts(data, offsets))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut_documents(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """Pieces of every document: whole sequences first, then the rest.

    copy numbers the documents of a task, so that repeated ids stay apart.
    """

    def run(batches):
        try:
            yield from encoded(batches, encoder(path))
        finally:
            encoder(path).segments.forget()
            release_memory()

    def encoded(batches, work):
        copy = 0
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for first, last in pieces(offsets, 1 << 20):
                part = data[offsets[first] : offsets[last]]
                ids, starts = work.encode(part, offsets[first : last + 1] - offsets[first])
                out = [], [], [], [], [], []
                for i in range(last - first):
                    own = np.append(ids[starts[i] : starts[i + 1]], np.uint32(END_ID)).astype("<u4")
                    plain = memoryview(own.tobytes())
                    for at in range(0, own.size, capacity):
                        length = min(capacity, own.size - at)
                        for column, value in zip(out, (
                            first + i, copy, at, length, zlib.crc32(plain[4 * at : 4 * (at + length)]), own.size,
                        )):
                            column.append(value)
                    copy += 1
                rows, *rest = (pa.array(c, pa.int64()) for c in out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), *rest],
                    ["doc_id", "copy", "start", "length", "ids_crc32", "doc_tokens"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(
        run, "doc_id long, copy long, start long, length long, ids_crc32 long, doc_tokens long"
    )


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row exchanges. The matrices are small, and a library's threaded
    routine has been seen to stand still beside a JVM."""
    n = matrix.shape[0]
    work = np.concatenate([matrix, np.eye(n)], axis=1)
    for k in range(n):
        pivot = k + int(np.abs(work[k:, k]).argmax())
        work[[k, pivot]] = work[[pivot, k]]
        work[k] /= work[k, k]
        factors = work[:, k].copy()
        factors[k] = 0
        work -= factors[:, None] * work[k][None]
    return work[:, n:]


def best_pattern(prices: np.ndarray, slots: int) -> tuple[float, np.ndarray]:
    """The dearest set of classes (sizes 1..slots grains, any number of each) in one
    sequence, by dynamic programming over the filled slots."""
    worth = np.zeros(slots + 1)
    chosen = np.zeros(slots + 1, np.int64)
    for filled in range(1, slots + 1):
        options = prices[:filled] + worth[filled - 1 :: -1][:filled]
        k = int(options.argmax())
        if options[k] > worth[filled - 1]:
            worth[filled], chosen[filled] = options[k], k + 1
        else:
            worth[filled], chosen[filled] = worth[filled - 1], 0
    pattern = np.zeros(slots, np.int64)
    filled = slots
    while filled:
        if chosen[filled]:
            pattern[chosen[filled] - 1] += 1
            filled -= int(chosen[filled])
        else:
            filled -= 1
    return float(worth[slots]), pattern


def solve_patterns(demand: np.ndarray, gap: float = 0.002, most_rounds: int = 4000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to use each, from the linear program's optimum.

    Revised simplex: the basis starts with one pattern per class, the dual prices come
    from the kept inverse, and the dearest pattern enters. The sum in use is at most the
    worth of the dearest pattern times the optimum, so the search ends within `gap` of it;
    most_rounds too only ends the search for a still better mix, as any basis covers the
    whole demand.
    """
    slots = demand.size
    live = np.flatnonzero(demand)
    if not live.size:
        return []
    basis = np.zeros((live.size, slots), np.int64)
    basis[np.arange(live.size), live] = slots // (live + 1)
    inverse = np.diag(1.0 / basis[np.arange(live.size), live])
    amount = inverse @ demand[live]
    cost = np.ones(live.size)
    need, held, best = demand.astype(float), None, 0.0
    for step in range(most_rounds):
        if step % RENEWED == RENEWED - 1:
            inverse = inverse_of(basis[:, live].T.astype(float))
            amount = np.maximum(inverse @ demand[live], 0)
        prices = np.zeros(slots)
        prices[live] = cost @ inverse
        lowest = int(prices.argmin())
        if prices[lowest] < -1e-7:
            # Holding more of a class than asked for is free: let its surplus enter.
            pattern = np.zeros(slots, np.int64)
            pattern[lowest] = -1
        else:
            # Prices between the current and the best known ones waver less.
            calm = prices if held is None else SMOOTH * held + (1 - SMOOTH) * prices
            worth, pattern = best_pattern(calm, slots)
            if pattern @ prices <= 1 + 1e-9:
                worth, pattern = best_pattern(prices, slots)
                held = None
                if worth <= 1 + gap:
                    break
            bound = prices @ need / worth
            if held is None or bound > best:
                held, best = calm, bound
        direction = inverse @ pattern[live]
        limits = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(limits.argmin())
        if not np.isfinite(limits[out]):
            break
        amount -= limits[out] * direction
        amount[out] = limits[out]
        amount = np.maximum(amount, 0)
        row = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, row)
        inverse[out] = row
        basis[out], cost[out] = pattern, pattern.min() >= 0
    return [(p, a) for p, a in zip(basis, amount) if a > 1e-9 and p.min() >= 0]


def fill_rest(demand: np.ndarray) -> list[np.ndarray]:
    """Patterns for the few pieces that rounding left over: largest first into the fullest
    sequence with room."""
    slots = demand.size
    open_: list[tuple[int, np.ndarray]] = []
    for size in range(slots, 0, -1):
        for _ in range(int(demand[size - 1])):
            fits = [i for i, (room, _) in enumerate(open_) if room >= size]
            if fits:
                i = min(fits, key=lambda i: open_[i][0])
            else:
                open_.append((slots, np.zeros(slots, np.int64)))
                i = len(open_) - 1
            room, pattern = open_[i]
            pattern[size - 1] += 1
            open_[i] = (room - size, pattern)
    return [p for _, p in open_]


def plan(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole numbers of sequences that hold exactly the demand.

    Amounts are rounded down, and what is left is solved again while rounding leaves more
    than a few sequences; the last of it is filled in directly.
    """
    left = demand.astype(np.int64).copy()
    sizes = np.arange(1, demand.size + 1)
    out = []
    while (before := int(left @ sizes)) > 4 * demand.size:
        for pattern, amount in sorted(solve_patterns(left), key=lambda x: -x[1]):
            used = np.flatnonzero(pattern)
            count = min(int(np.floor(amount + 1e-6)), int((left[used] // pattern[used]).min()))
            if count > 0:
                out.append((pattern, count))
                left -= pattern * count
        if int(left @ sizes) > 0.7 * before:
            break
    return out + [(p, 1) for p in fill_rest(left)]


def dealing(patterns: list[tuple[np.ndarray, int]], grain: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (class, first rank, last rank, first sequence, pieces per sequence): the pieces
    of a class with these ranks go to consecutive sequences."""
    rows, reached, sequence = [], {}, 0
    for pattern, count in patterns:
        for k in np.flatnonzero(pattern):
            each = int(pattern[k])
            first = reached.get(k, 0)
            rows.append((int(k), first, first + each * count - 1, sequence, each))
            reached[k] = first + each * count
        sequence += count
    return rows


def pack_documents(
    spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY, grain: int = GRAIN
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document (null text: empty) is its ids and the end id; each id lies in one piece.
    Sequence numbers are dense; within one, pieces follow without gaps from 0. Repeated
    rows and null ids are documents of their own. Other columns are ignored.
    """
    prepare(spark)
    cut = materialize(spark, cut_documents(docs, path, capacity), "packing-pieces")
    full = cut.where(F.col("length") == capacity)
    rest = cut.where(F.col("length") < capacity).withColumn(
        "class", F.expr(f"int((length + {grain - 1}) div {grain} - 1)")
    )
    # Rank within the class, without gathering a class: a count per class and slice of the
    # table first, then ranks inside the slices.
    rest = rest.withColumn("slice", F.pmod(F.xxhash64("doc_id", "copy", "ids_crc32"), F.lit(64)).cast("int"))
    counts = rest.groupBy("class", "slice").count().collect()
    demand = np.zeros(capacity // grain, np.int64)
    before: dict[tuple[int, int], int] = {}
    for r in sorted(counts):
        before[(r["class"], r["slice"])] = int(demand[r["class"]])
        demand[r["class"]] += r["count"]
    steps = dealing(plan(demand), grain)
    used = max((s + (b - a + 1) // each for _, a, b, s, each in steps), default=0)
    offsets = spark.createDataFrame(
        [(k, s, n) for (k, s), n in before.items()] or [(-1, 0, 0)], "class int, slice int, before long"
    )
    # At most one row per class and pattern, both of which the capacity bounds.
    table = spark.createDataFrame(steps or [(-1, 0, 0, 0, 1)], "class int, low long, high long, sequence long, each long")
    order = Window.partitionBy("class", "slice").orderBy("doc_id", "copy", "ids_crc32")
    ranked = (
        rest.withColumn("nth", F.row_number().over(order) - 1)
        .join(F.broadcast(offsets), ["class", "slice"])
        .withColumn("rank", F.col("nth") + F.col("before"))
    )
    dealt = ranked.join(F.broadcast(table), "class").where("rank between low and high").withColumn(
        "sequence_id", F.expr("sequence + (rank - low) div each")
    )
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank", "class")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    dealt = dealt.withColumn(
        "offset", F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    )
    # Whole sequences need no dealing; their numbers follow, dense by place in the table.
    numbered = dense_numbers(spark, full, used)
    return dealt.select(*columns).unionByName(numbered.withColumn("offset", F.lit(0).cast("long")).select(*columns))


def dense_numbers(spark: SparkSession, rows: DataFrame, first: int) -> DataFrame:
    """rows with sequence_id = first, first + 1, ...: counted per slice, then ranked inside."""
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "copy", "start", "ids_crc32"), F.lit(1024)).cast("int"))
    total = first
    before = []
    for r in sorted(rows.groupBy("slice").count().collect()):
        before.append((r["slice"], total))
        total += r["count"]
    offsets = spark.createDataFrame(before or [(-1, 0)], "slice int, before long")
    order = Window.partitionBy("slice").orderBy("doc_id", "copy", "start", "ids_crc32")
    return rows.join(F.broadcast(offsets), "slice").withColumn(
        "sequence_id", F.col("before") + F.row_number().over(order) - 1
    )
