"""Jaccard join of word n-gram sets: a size-aware heavy-light join.

Equal sets are one node. Shingles are ordered light first (by hash) and heavy last (by
count), and linked sets must share the first shingles of that order. Small sets enumerate
their fixed-size subsets (pairs) of those and meet on a whole subset; large sets scan the
inverted lists of single shingles. The boundary is the size at which the subsets of a set
cost more rows than scanning its lists, from counts over all documents. Lists are scanned
twice: against two pivots each, then only between members not yet connected.
Every pair is checked on its whole sets before it links.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidegate.llm.common import (
    GOLDEN, connected_components, discard, keep_repeated, mix, per_text, pieces, prepare, real_id,
    signed, stream, text_buffer, text_tie, with_key, word_names,
)
from tidegate.session import materialize

WORDS = 5
PERCENT = 75
#: Most shingles in the table of heavy ones, so that it may be broadcast (16 bytes each).
#: A shingle beyond it counts as light: only the order differs, never a result.
HEAVY_ROWS = 50_000
#: Times from which a shingle counts as heavy.
HEAVY = 8
#: Shingles that a task counts in one run, and of one part of all counts; parts are 2 to the
#: power of PART_BITS at least.
COUNTED = 1 << 21
PART = 1 << 20
PART_BITS = 10
#: Words of 64 bits in a set's parity sketch, and bits of the wide one of candidates.
SKETCH = 8
WIDE = 8192


def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    return lower, blank


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int):
    """(row, hash), sorted and distinct per row: the shingles of each text.

    A-Z are lower-cased; words are runs without space and control blanks; a text of fewer
    words has its whole sequence as one shingle, and one without words has none.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if not data.size:
        return none
    lower, blank = byte_tables()
    data = lower[data]
    inside = ~blank[data]
    edge = np.zeros(data.size + 1, bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    if not start.size:
        return none
    word = word_names(data, start, end)
    row = np.searchsorted(offsets, start, "right") - 1
    counts = np.bincount(row, minlength=offsets.size - 1)
    place = stream(2, words) | np.uint64(1)
    # Position of a word among those of its text.
    nth = np.arange(row.size) - np.repeat(np.cumsum(counts) - counts, counts)
    here = counts[row]
    full = nth <= here - words
    out_rows, out_hashes = [], []
    at = np.flatnonzero(full)
    if at.size:
        total = word[at] * place[0]
        for k in range(1, words):
            total += word[at + k] * place[k]
        out_rows.append(row[at])
        out_hashes.append(mix(total))
    short = np.flatnonzero(here < words)
    if short.size:
        part = word[short] * place[nth[short]]
        firsts = np.flatnonzero(nth[short] == 0)
        out_rows.append(row[short][firsts])
        out_hashes.append(mix(np.add.reduceat(part, firsts) + here[short][firsts].astype(np.uint64)))
    row, value = np.concatenate(out_rows), np.concatenate(out_hashes)
    if len(out_rows) > 1:
        order = np.argsort(row, kind="stable")
        row, value = row[order], value[order]
    # Each text's own part alone: far quicker than an order by row and value.
    cuts = np.searchsorted(row, np.arange(offsets.size)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        value[a:b].sort()
    first = np.ones(row.size, bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[first], value[first]


def least_overlap(size, percent):
    """The least overlap of a set of this size with any set it can link to."""
    return -(-percent * size // 100)


def describe(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: set size, a hash of the set (the node) and its parity sketch."""

    def function(data, offsets, batch):
        row, value = shingle_sets(data, offsets, words)
        n = offsets.size - 1
        sizes = np.bincount(row, minlength=n)
        bits = np.bincount(row * 64 * SKETCH + (value >> np.uint64(7)).astype(np.int64) % (64 * SKETCH),
                           minlength=n * 64 * SKETCH) & 1
        sketch = np.packbits(bits.astype(np.uint8).reshape(n, -1), axis=1).view(np.int64)
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value + stream(3, 1)))])
        ends = np.cumsum(sizes)
        node = signed(mix(running[ends] - running[ends - sizes] + sizes.astype(np.uint64)))
        names = ["doc_id", "tie", "n_shingles", "node", *(f"s{i}" for i in range(SKETCH))]
        columns = [batch.column("doc_id"), batch.column("tie"), pa.array(sizes.astype(np.int64)), node]
        columns += [pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH)]
        return pa.RecordBatch.from_arrays(columns, names)

    fields = ", ".join(f"s{i} long" for i in range(SKETCH))
    return per_text(docs, function, f"doc_id long, tie long, n_shingles long, node long, {fields}")


def heavy_shingles(docs: DataFrame, words: int, total: int, most: int = HEAVY_ROWS):
    """(shingles, counts, squares): the most frequent shingles in order, at most `most`, and
    the sum of squared counts of all others that repeat. Counts are over all documents.

    A task counts within runs of whole texts and passes on every shingle it saw, packed by
    ranges of hashes: 8 bytes for one seen once, 12 for others. A range of some PART of the
    `total` shingles is counted at a time, and a frequent shingle comes once per run.
    """
    bits = max(PART_BITS, (total // PART).bit_length())

    def packed(held):
        value, n = np.unique(np.concatenate(held), return_counts=True)
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        once = n == 1
        cuts = [np.append(np.searchsorted(v, edges), v.size) for v in (value[once], value[~once])]

        def binary(values, cut):
            offsets = pa.py_buffer((cut * values.itemsize).astype(np.int32))
            return pa.Array.from_buffers(pa.binary(), cut.size - 1, [None, offsets, pa.py_buffer(values)])

        some = pa.array(np.diff(cuts[0]) + np.diff(cuts[1]) > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(1 << bits)), binary(value[once], cuts[0]), binary(value[~once], cuts[1]),
             binary(n[~once].astype(np.uint32), cuts[1])],
            ["part", "once", "more", "n"],
        ).filter(some)

    def seen(batches):
        held, size = [], 0
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for first, last in pieces(offsets):
                part = data[offsets[first] : offsets[last]]
                _, value = shingle_sets(part, offsets[first : last + 1] - offsets[first], words)
                held.append(value)
                size += value.size
                if size >= COUNTED:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)

    def summed(held):
        once, more, n = ([x.as_buffer() for x in column] for column in zip(*held))
        once = [np.frombuffer(x, np.uint64) for x in once]
        value = np.concatenate(once + [np.frombuffer(x, np.uint64) for x in more])
        n = np.concatenate([np.ones(sum(x.size for x in once), np.int64), *(np.frombuffer(x, np.uint32) for x in n)])
        order = np.argsort(value)
        value, n = value[order], n[order].astype(np.int64)
        firsts = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        value, n = value[firsts], np.add.reduceat(n, firsts)
        often = n >= HEAVY
        light = n[(n >= 2) & ~often]
        shingles = pa.concat_arrays([signed(value[often]), pa.array([None], pa.int64())])
        return pa.RecordBatch.from_arrays(
            [shingles, pa.array(np.append(n[often], int((light * light).sum())))], ["shingle", "n"]
        )

    def count(batches):
        at, held = None, []
        for batch in batches:
            for part, *row in zip(*(batch.column(c) for c in ("part", "once", "more", "n"))):
                part = part.as_py()
                if part != at and held:
                    yield summed(held)
                    held = []
                at = part
                held.append(row)
        if held:
            yield summed(held)

    parts = docs.select("text").mapInArrow(seen, "part long, once binary, more binary, n binary")
    counted = materialize(
        docs.sparkSession,
        parts.repartition("part").sortWithinPartitions("part").mapInArrow(count, "shingle long, n long"),
        "ngram-counts",
    )
    heavy = counted.where("shingle is not null")
    top = heavy.orderBy(F.desc("n"), "shingle").limit(most).toPandas()
    light, rest = counted.agg(
        F.sum(F.when(F.col("shingle").isNull(), F.col("n"))),
        F.sum(F.when(F.col("shingle").isNotNull(), F.col("n").cast("double") * F.col("n"))),
    ).first()
    value = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(value)
    # Heavy shingles beyond the table are ordered as light ones and count among them.
    counts = top["n"].to_numpy(np.int64)[order]
    squares = (light or 0) + (rest or 0) - float((counts.astype(float) ** 2).sum())
    return value[order], counts, squares


def boundary_size(load: float, percent: int) -> int:
    """The largest set size whose pairs of prefix shingles are no more rows than its prefix
    shingles times what scanning their lists costs (1 + load)."""
    best = 0
    for size in range(3, 200):
        prefix = size - least_overlap(size, percent) + 1
        if comb(prefix + 1, 2) <= prefix * (1 + load):
            best = size
        else:
            break
    return best


def signatures(docs: DataFrame, words: int, percent: int, heavy, boundary: int) -> DataFrame:
    """Rows (sig, doc_id, tie, pos): what a document must have in common with a linked one.

    pos is the place of the shingle in the document's order, -1 for a subset.
    """
    tokens, counts = heavy
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tokens, counts))

    def function(data, offsets, batch):
        row, value = shingle_sets(data, offsets, words)
        if not row.size:
            return None
        tokens, counts = shared.value
        weight = np.zeros(value.size, np.int64)
        if tokens.size:
            at = np.minimum(np.searchsorted(tokens, value), tokens.size - 1)
            weight = np.where(tokens[at] == value, counts[at], 0)
        # Light ones stand in order already; heavy ones go behind them, by count.
        light, often = np.flatnonzero(weight == 0), np.flatnonzero(weight)
        often = often[np.lexsort((weight[often], row[often]))]
        order = np.concatenate([light, often])
        order = order[np.argsort(row[order], kind="stable")]
        row, value = row[order], value[order]
        sizes = np.bincount(row, minlength=offsets.size - 1)
        starts = np.cumsum(sizes) - sizes
        pos = np.arange(row.size) - starts[row]
        size = sizes[row]
        prefix = size - least_overlap(size, percent) + 1
        # A set just above the smallest partner of a large set is looked up in the lists too.
        listed = (size * 100 >= percent * (boundary + 1)) & (pos < prefix)
        parts = [(value[listed], row[listed], pos[listed])]
        for n in range(3, boundary + 1):
            rows = np.flatnonzero(sizes == n)
            if not rows.size:
                continue
            take = n - least_overlap(n, percent) + 2
            table = value[starts[rows][:, None] + np.arange(min(take, n))]
            for i in range(table.shape[1]):
                for j in range(i + 1, table.shape[1]):
                    low, high = np.minimum(table[:, i], table[:, j]), np.maximum(table[:, i], table[:, j])
                    subset = mix(low * np.uint64(GOLDEN) + mix(high))
                    parts.append((subset, rows, np.full(rows.size, -1)))
        sig, at, pos = (np.concatenate(x) for x in zip(*parts))
        at = pa.array(at)
        return pa.RecordBatch.from_arrays(
            [signed(sig), batch.column("doc_id").take(at), batch.column("tie").take(at),
             pa.array(pos.astype(np.int32))],
            ["sig", "doc_id", "tie", "pos"],
        )

    return per_text(docs, function, "sig long, doc_id long, tie long, pos int")


def fits(percent: int):
    """Sizes and places in the order allow members a and b of a list to be linked."""
    need = F.ceil((F.col("na") + F.col("nb")) * F.lit(percent) / F.lit(100 + percent))
    left = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) & (
        (F.col("pa") < 0) | (F.col("pb") < 0) | (left >= need)
    )


def near(percent: int):
    """The parity sketches of a and b differ in no more places than linked sets can."""
    apart = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(SKETCH)), F.lit(0))
    return apart * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)


def side(lists: DataFrame, s: str, more: list | None = None) -> DataFrame:
    sketch = [F.col(f"s{i}").alias(f"{s}{i}") for i in range(SKETCH)]
    return lists.select(
        "sig", F.col("node").alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("pos").alias(f"p{s}"),
        *sketch, *(more or []),
    )


def verified(spark: SparkSession, docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int,
             percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole shingle sets are alike enough.

    Sets are made of the texts of the nodes in question only. A pair is first tested on
    wide parity sketches, which no linked pair fails, and the rest on the sets.
    """

    def members(data, offsets, batch):
        row, value = shingle_sets(data, offsets, words)
        cuts = np.searchsorted(row, np.arange(offsets.size))
        sets = [value[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        place = (value % np.uint64(WIDE)).astype(np.int64)
        bits = [np.bincount(place[a:b], minlength=WIDE) & 1 for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(np.diff(cuts)),
             pa.array([np.packbits(x.astype(np.uint8)).tobytes() for x in bits], pa.binary()),
             pa.array([x.tobytes() for x in sets], pa.binary())],
            ["node", "n", "sketch", "members"],
        )

    def could(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y, total) in enumerate(zip(
                batch.column("sa"), batch.column("sb"), batch.column("total").to_numpy(zero_copy_only=False)
            )):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                keep[i] = int(np.bitwise_count(x ^ y).sum()) * (100 + percent) <= total * (100 - percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def compare(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                common = np.intersect1d(x, y, assume_unique=True).size
                keep[i] = 100 * common >= percent * (x.size + y.size - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def with_both(rows, column):
        for s in "ab":
            rows = rows.join(sets.select(
                F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col(column).alias(f"s{s}")), s)
        return rows

    pairs = materialize(spark, pairs, "ngram-pairs")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = docs.join(nodes.join(asked, "node").select("doc_id", "tie", "node"), ["doc_id", "tie"])
    made = per_text(texts, members, "node long, n long, sketch binary, members binary")
    sets = materialize(spark, made.dropDuplicates(["node"]), "ngram-members")
    left = with_both(pairs, "sketch").select("a", "b", "sa", "sb", (F.col("na") + F.col("nb")).alias("total"))
    close = materialize(spark, left.mapInArrow(could, "a long, b long"), "ngram-close")
    links = with_both(close, "members").select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")
    links = materialize(spark, links, "ngram-links")
    discard(spark, sets)
    return links


def ngram_jaccard_join(
    spark: SparkSession, docs: DataFrame, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text).

    Two documents link when 100 * |intersection| >= percent * |union| of their shingle
    sets. component_id is the smallest doc_id reachable by links, itself included. Null or
    blank texts have no shingles, link with nothing and are their own component; a null
    doc_id stays null and, having no order, never names a component unless it stands alone.
    Repeated rows come back as often as they came in. Other columns are ignored.
    """
    prepare(spark)
    member = grouped(spark, with_key(docs), words, percent)
    named = member.where("component is not null").groupBy("component").agg(
        F.min(real_id()).alias("component_id")
    )
    return member.join(named, "component", "left").select(
        real_id().alias("doc_id"), "tie", "n_shingles",
        F.coalesce("component_id", real_id()).alias("component_id"),
    ).drop("tie")


def grouped(spark: SparkSession, keyed: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, tie, n_shingles and component, null without words, of every row of keyed."""
    about = materialize(spark, describe(keyed, words), "ngram-sets")
    full = about.where("n_shingles > 0")
    sketch = [f"s{i}" for i in range(SKETCH)]
    # Any document of a node can stand for it: the one that sorts first.
    first = F.min_by(F.struct("doc_id", "tie", "n_shingles", *sketch), F.struct("doc_id", "tie"))
    nodes = materialize(spark, full.groupBy("node").agg(first.alias("of")).select("node", "of.*"), "ngram-nodes")
    total = about.agg(F.sum("n_shingles")).first()[0] or 0
    heavy = heavy_shingles(keyed, words, total)
    # Lists that are scanned are those of light shingles: how many others one meets there.
    load = heavy[2] / max(total, 1)
    boundary = boundary_size(load, percent)
    repeated = keep_repeated(signatures(keyed, words, percent, heavy[:2], boundary), "sig", ["doc_id", "tie"])
    lists = materialize(
        spark, repeated.join(nodes.select("doc_id", "tie", "node", "n_shingles"), ["doc_id", "tie"])
        .select("sig", "node", "n_shingles", "pos"), "ngram-lists",
    )

    # First scan: every member of a list against its two pivots. Each list draws its own,
    # so that members who share many lists meet many pivots.
    member = F.struct("node", "n_shingles", "pos")
    draw = F.struct(F.xxhash64("sig", "node"), "node")
    pivots = lists.groupBy("sig").agg(
        F.array(F.max_by(member, draw), F.min_by(member, draw)).alias("drawn"),
        F.min("node").alias("low"), F.max("node").alias("high"),
    ).where("low < high").select("sig", F.explode("drawn").alias("p")).select(
        "sig", F.col("p.node").alias("b"), F.col("p.n_shingles").alias("nb"), F.col("p.pos").alias("pb")
    )
    starred = lists.select(
        "sig", F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("pos").alias("pa")
    ).join(pivots, "sig").where("a <> b").where(fits(percent))
    starred = starred.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for s in "ab":
        starred = starred.join(
            nodes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n{s}"),
                         *[F.col(c).alias(f"{s}{i}") for i, c in enumerate(sketch)]), s)
    pairs = starred.where(near(percent)).select("a", "b")
    links = verified(spark, keyed, nodes, pairs, words, percent)
    groups = materialize(spark, connected_components(spark, links, "ngram-groups"), "ngram-grouped")

    # Second scan: within a list, only members of different groups, the largest group of
    # the list on one side only.
    placed = lists.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    weight = placed.groupBy("sig", "component").agg(F.count("*").alias("n"))
    major = weight.groupBy("sig").agg(
        F.max_by("component", F.struct("n", "component")).alias("major"), F.count("*").alias("groups")
    ).where("groups > 1").select("sig", "major")
    open_lists = materialize(
        spark, placed.join(major, "sig").join(nodes.select("node", *sketch), "node"), "ngram-open"
    )
    minor = side(open_lists.where("component <> major"), "a", [F.col("component").alias("ca")])
    every = side(
        open_lists, "b", [F.col("component").alias("cb"), (F.col("component") == F.col("major")).alias("in_major")]
    )
    crossed = minor.join(every, "sig").where(
        (F.col("ca") != F.col("cb")) & (F.col("in_major") | (F.col("a") < F.col("b")))
    ).where(fits(percent) & near(percent))
    pairs = crossed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    late = verified(spark, keyed, nodes, pairs, words, percent)
    star = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = connected_components(spark, late.unionByName(star), "ngram-components")

    member = about.join(final, "node", "left").withColumn(
        "component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node"))
    )
    return materialize(spark, member.select("doc_id", "tie", "n_shingles", "component"), "ngram-out")


def oracle_sql(words: int = WORDS, percent: int = PERCENT) -> str:
    """The same rows in DuckDB's SQL: shingles as rows, every pair that shares one, closure."""
    gram = ", ".join(f"ws[i + {k}]" for k in range(words))
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT r, [{gram}] AS g FROM d, unnest(range(1, len(ws) - {words - 2})) AS t(i) WHERE len(ws) >= {words}
  UNION ALL
  SELECT r, ws FROM d WHERE len(ws) BETWEEN 1 AND {words - 1}),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pair AS (
  SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN n na ON na.r = a JOIN n nb ON nb.r = b
  WHERE 100 * c >= {percent} * (na.n + nb.n - c)),
reach(r, o) AS (
  SELECT a, b FROM link
  UNION
  SELECT reach.r, link.b FROM reach JOIN link ON link.a = reach.o)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles,
       least(d.doc_id, min(other.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN reach ON reach.r = d.r LEFT JOIN d other ON other.r = reach.o
GROUP BY d.r, d.doc_id
"""


def keep_first_of_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs without the near copies of another row: of each component one row stays, that
    of the smallest doc_id, nulls last, and of its texts the one with the least hash. Rows
    without words all stay; of repeated rows one stays."""
    prepare(spark)
    member = grouped(spark, with_key(docs), WORDS, PERCENT)
    order = F.struct(real_id().isNull().alias("last"), "doc_id", "tie")
    first = member.where("component is not null").groupBy("component").agg(F.min(order).alias("of")).select("of.*")
    kept = first.select("doc_id", "tie").unionByName(
        member.where("component is null").select("doc_id", "tie").distinct()
    ).toDF("_key", "_tie")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    # One exchange of the texts serves the join and the choice among repeated rows.
    out = docs.withColumn("_key", key).withColumn("_tie", text_tie()).join(kept, ["_key", "_tie"], "left_semi")
    repeated = Window.partitionBy("_key", "_tie", F.xxhash64("text")).orderBy(F.lit(0))
    return out.withColumn("_nth", F.row_number().over(repeated)).where("_nth = 1").drop("_nth", "_key", "_tie")
