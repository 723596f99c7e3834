"""Ranked lexical search: best documents of every query by intervals and range maxima.

The index has a row per shard, a run of whole texts: posting lists of all its terms in
document order. A search reads the lists of the query terms, gives each list a sparse table
of range maxima over its impacts, and splits document intervals best first: an interval's
bound is the weighted sum of its lists' maxima, it is cut at the document of the largest
one, and small intervals are scored outright. What a task has found bounds its next shards.
Queries go by blocks of bounded size, each against the whole index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidegate.llm.common import byte_table, lower_words, pieces, prepare, text_buffer
from tidegate.session import materialize

TOP = 10
#: Bytes of text in a shard; a longer text is a shard by itself.
SHARD_BYTES = 8 << 20
#: Pairs of a query and a term in a block.
BLOCK_PAIRS = 400_000
#: Documents of an interval that is scored outright, and intervals taken up together.
LEAF, TOGETHER = 128, 16
#: Groups in which the tasks' results are ranked before they meet.
MERGE_GROUPS = 64

#: `[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]`: digits, letters, all beyond ASCII.
TERM_BYTES = byte_table("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
TERM_BYTES[128:] = True

#: Spark reads up to 4,096 rows of a row group at once and Parquet looks at the size of a page
#: and of a row group every 100 rows only. A row here takes megabytes: each is a row group.
ROW_GROUPS = {"parquet.block.row.count.limit": "1"}

INDEX_SCHEMA = (
    "n_docs long, n_terms long, doc_ids array<long>, sizes array<int>, terms array<binary>, "
    "lengths array<int>, docs array<int>, tfs array<int>"
)


# --- the index --------------------------------------------------------------------


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, small batches put together up to about that many bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches([b for b in held if b.num_rows]).combine_chunks().to_batches()[0]


def shard_of(ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch | None:
    """The index row of some texts. Documents stand by ascending id, null ids last; those
    without a term are left out, as no score counts them."""
    words, row = lower_words(data, offsets, TERM_BYTES)
    if not len(words):
        return None
    size = np.bincount(row, minlength=len(ids))
    with_terms = np.flatnonzero(size)
    null = ids.is_null().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = with_terms[np.lexsort((values[with_terms], null[with_terms]))]
    place = np.zeros(len(ids), np.int64)
    place[order] = np.arange(order.size)
    coded = words.dictionary_encode()
    pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * order.size + place[row], return_counts=True)
    lengths = np.bincount(pair // order.size, minlength=len(coded.dictionary))
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([order.size], pa.int64()), pa.array([len(words)], pa.int64()),
            one(ids.take(pa.array(order))), one(pa.array(size[order], pa.int32())),
            one(coded.dictionary.cast(pa.binary())), one(pa.array(lengths, pa.int32())),
            one(pa.array(pair % order.size, pa.int32())), one(pa.array(tf, pa.int32())),
        ],
        [c.split()[0] for c in INDEX_SCHEMA.split(", ")],
    )


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A row per shard with the posting lists of every term of every text."""

    def run(batches):
        for batch in gathered(batches, shard_bytes):
            data, offsets = text_buffer(batch.column("text"))
            for first, last in pieces(offsets, shard_bytes):
                part = data[offsets[first] : offsets[last]]
                shard = shard_of(batch.column("doc_id").slice(first, last - first), part, offsets[first : last + 1] - offsets[first])
                if shard is not None:
                    yield shard

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.where("text is not null").mapInArrow(run, INDEX_SCHEMA)


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, term): the different terms of each item."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            words, row = lower_words(data, offsets, TERM_BYTES)
            items = batch.column("item_id").take(pa.array(row))
            yield pa.RecordBatch.from_arrays([items, words.cast(pa.binary())], ["item_id", "term"])

    texts = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "item_id long, term binary").distinct()


# --- one shard --------------------------------------------------------------------


class Shard:
    """The lists of some terms in a shard, with impacts and their range maxima.

    Lists lie end to end; keys (list, document) are ascending. top[j][i] is where the
    largest impact of the 2**j postings from i on stands.
    """

    def __init__(self, row: pa.RecordBatch, i: int, terms: pa.Array, n_docs: int, n_terms: int) -> None:
        values = lambda name: row.column(name).slice(i, 1).flatten()
        ids = values("doc_ids")
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.size = self.ids.size
        length = values("lengths").to_numpy().astype(np.int64)
        own = pc.fill_null(pc.index_in(terms, value_set=values("terms")), -1).to_numpy(zero_copy_only=False)
        here = own >= 0
        n = np.where(here, length[own], 0)
        #: Where each term's list begins and ends; empty for terms that the shard lacks.
        self.end = np.cumsum(n)
        self.begin = self.end - n
        total = int(self.end[-1]) if n.size else 0
        source = (np.cumsum(length) - length)[own]
        at = np.repeat(source - self.begin, n) + np.arange(total)
        docs = values("docs").to_numpy()[at].astype(np.int64)
        tf = values("tfs").to_numpy()[at].astype(np.int64)
        norm = 10 + (90 * values("sizes").to_numpy().astype(np.int64) * n_docs) // max(1, n_terms)
        self.docs = docs
        self.keys = np.repeat(np.arange(n.size), n) * self.size + docs
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * norm[docs])
        self.top = self.maxima(int(n.max()) if n.size else 0)
        self.depth = np.zeros(max(2, int(n.max()) + 1 if n.size else 2), np.int64)
        for k in range(2, self.depth.size):
            self.depth[k] = self.depth[k >> 1] + 1

    def maxima(self, longest: int) -> list[np.ndarray]:
        top = [np.arange(self.impact.size, dtype=np.int32)]
        while 2 << (len(top) - 1) <= longest:
            last, half = top[-1], 1 << (len(top) - 1)
            level = last.copy()
            left, right = last[:-half], last[half:]
            level[:-half] = np.where(self.impact[right] > self.impact[left], right, left)
            top.append(level)
        return top

    def largest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the largest impact of each non-empty range of postings stands."""
        depth = self.depth[b - a]
        out = np.empty(a.size, np.int64)
        for j in np.unique(depth):
            own = np.flatnonzero(depth == j)
            left, right = self.top[j][a[own]], self.top[j][b[own] - (1 << int(j))]
            out[own] = np.where(self.impact[right] > self.impact[left], right, left)
        return out

    def bounds(self, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bound of every interval, document of its largest summand); rows of a and b are
        intervals, columns lists."""
        worth = np.zeros(a.shape, np.int64)
        place = np.zeros(a.shape, np.int64)
        some = b > a
        place[some] = self.largest(a[some], b[some])
        worth[some] = (self.impact[place] * weight)[some]
        best = worth.argmax(axis=1)
        return worth.sum(axis=1), self.docs[place[np.arange(best.size), best]]


class Best:
    """The best documents so far: by score, then by id, null ids last."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def offer(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        some = score > (self.score[-1] - 1 if self.score.size == self.most else 0)
        if some.any():
            score, doc, null = (np.concatenate(x) for x in (
                (self.score, score[some]), (self.id, doc[some]), (self.null, null[some])
            ))
            order = np.lexsort((doc, null, -score))[: self.most]
            self.score, self.id, self.null = score[order], doc[order], null[order]

    def may_enter(self, bound: np.ndarray, first: np.ndarray, null: np.ndarray) -> np.ndarray:
        """Whether a document of an interval can still enter, given its bound and its first
        document, which has the smallest id."""
        if self.score.size < self.most:
            return bound > 0
        earlier = (null < self.null[-1]) | ((null == self.null[-1]) & (first < self.id[-1]))
        return (bound > self.score[-1]) | ((bound == self.score[-1]) & earlier)


def search(shard: Shard, lists: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Offer the shard's best documents of a query; returns how many were scored."""
    lists = lists[shard.end[lists] > shard.begin[lists]]
    weight = weight[lists]
    if not lists.size:
        return 0
    base = lists * shard.size
    a, b = shard.begin[lists][None], shard.end[lists][None]
    lo, hi = np.array([0]), np.array([shard.size])
    bound, split = shard.bounds(a, b, weight)
    scored = 0
    score_of = np.zeros(shard.size, np.int64)
    while True:
        open_ = best.may_enter(bound, shard.ids[lo], shard.null[lo])
        a, b, lo, hi, bound, split = (x[open_] for x in (a, b, lo, hi, bound, split))
        if not lo.size:
            return scored
        order = np.argsort(-bound, kind="stable")
        now, later = order[:TOGETHER], order[TOGETHER:]
        small = hi[now] - lo[now] <= LEAF
        leaves, wide = now[small], now[~small]
        if leaves.size:
            n = (b - a)[leaves].ravel()
            at = np.repeat(a[leaves].ravel() - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            docs = shard.docs[at]
            np.add.at(score_of, docs, shard.impact[at] * np.repeat(np.tile(weight, leaves.size), n))
            docs = np.unique(docs)
            best.offer(score_of[docs], shard.ids[docs], shard.null[docs])
            score_of[docs] = 0
            scored += docs.size
        cut = split[wide]
        wanted = base[None] + cut[:, None]
        place = np.searchsorted(shard.keys, wanted)
        hit = (place < b[wide]) & (shard.keys[np.minimum(place, shard.keys.size - 1)] == wanted)
        exact = (np.where(hit, shard.impact[np.minimum(place, shard.keys.size - 1)], 0) * weight).sum(axis=1)
        best.offer(exact, shard.ids[cut], shard.null[cut])
        scored += cut.size
        new_a = np.concatenate([a[wide], np.maximum(place + hit, a[wide])])
        new_b = np.concatenate([np.minimum(place, b[wide]), b[wide]])
        new_lo, new_hi = np.concatenate([lo[wide], cut + 1]), np.concatenate([cut, hi[wide]])
        full = new_lo < new_hi
        new_a, new_b, new_lo, new_hi = new_a[full], new_b[full], new_lo[full], new_hi[full]
        if new_lo.size:
            new_bound, new_split = shard.bounds(new_a, new_b, weight)
        else:
            new_bound, new_split = bound[:0], split[:0]
        a, b = np.concatenate([a[later], new_a]), np.concatenate([b[later], new_b])
        lo, hi = np.concatenate([lo[later], new_lo]), np.concatenate([hi[later], new_hi])
        bound, split = np.concatenate([bound[later], new_bound]), np.concatenate([split[later], new_split])


# --- all shards -------------------------------------------------------------------


def document_counts(index: DataFrame, terms: list[bytes]) -> np.ndarray:
    """In how many documents each term stands: summed up per task, then over tasks."""
    shipped = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        wanted = pa.array(shipped.value, pa.binary())
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                own = pc.fill_null(pc.index_in(wanted, value_set=batch.column("terms").slice(i, 1).flatten()), -1)
                own = own.to_numpy(zero_copy_only=False)
                lengths = batch.column("lengths").slice(i, 1).flatten().to_numpy()
                total[own >= 0] += lengths[own[own >= 0]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["term", "df"])

    out = np.zeros(len(terms), np.int64)
    for r in index.select("terms", "lengths").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


def search_block(index: DataFrame, items: list[tuple[int | None, list[bytes]]], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): every task's best documents of each item of the block."""
    terms = sorted({t for _, own in items for t in own})
    slot = {t: i for i, t in enumerate(terms)}
    lists = [np.array([slot[t] for t in own], np.int64) for _, own in items]
    weight = np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in document_counts(index, terms).tolist()], np.int64
    )
    shipped = index.sparkSession.sparkContext.broadcast((terms, [i for i, _ in items], lists, weight))

    def run(batches):
        terms, item_ids, lists, weight = shipped.value
        wanted = pa.array(terms, pa.binary())
        best = [Best(top) for _ in lists]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch, i, wanted, n_docs, n_terms)
                for own, found in zip(lists, best):
                    search(shard, own, weight, found)
        n = [b.score.size for b in best]
        ids = pa.array(np.concatenate([b.id for b in best]), mask=np.concatenate([b.null for b in best]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item_ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(n)), n))), ids,
                pa.array(np.concatenate([b.score for b in best])),
            ],
            ["item_id", "doc_id", "score"],
        )

    columns = index.select("doc_ids", "sizes", "terms", "lengths", "docs", "tfs")
    return columns.mapInArrow(run, "item_id long, doc_id long, score long")


def ranked(rows: DataFrame, top: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked_search(spark: SparkSession, index: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the top documents of every item, by a built index.

    Items of one id, null too, are one item with the terms of all. Null and empty texts
    have no terms, on both sides. Equal scores stand by ascending doc_id, null ids last;
    repeated rows are documents of their own. An item without a scored document has no row.
    """
    prepare(spark)
    totals = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("t")).first()
    pairs = materialize(spark, query_terms(queries), "search-queries")
    blocks = max(1, -(-pairs.count() // BLOCK_PAIRS))
    found = []
    for block in range(blocks if totals.n else 0):
        mine = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        items = [
            (r.item_id, [bytes(t) for t in r.terms])
            for r in mine.groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        ]
        if items:
            found.append(search_block(index, items, totals.n, totals.t, top))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rows = reduce(DataFrame.unionByName, found)
    rows = ranked(rows.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))), top, "item_id", "part")
    return ranked(rows.drop("rank"), top, "item_id").select("item_id", "rank", "doc_id", "score")


def search_documents(spark: SparkSession, docs: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """ranked_search over an index of docs, built into the shared folder first."""
    prepare(spark)
    index = materialize(spark, build_index(docs), "search-index", **ROW_GROUPS)
    return ranked_search(spark, index, queries, top)


def oracle_sql(top: int = TOP) -> str:
    """The same scores by counting all terms."""
    terms = (
        "list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), x -> x <> '')"
    )
    return f"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS doc_row, doc_id, {terms} AS terms FROM documents),
docs AS (SELECT doc_row, doc_id, terms, len(terms)::BIGINT AS n FROM doc_terms WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
queries AS (
  SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
tokens AS (SELECT doc_row, doc_id, n, unnest(terms) AS term FROM docs),
postings AS (
  SELECT doc_row, doc_id, n, term, count(*)::BIGINT AS tf FROM tokens
  WHERE term IN (SELECT term FROM queries) GROUP BY ALL),
counts AS (SELECT term, count(*)::BIGINT AS df FROM postings GROUP BY term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM counts, totals),
impacts AS (
  SELECT p.*, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)) AS impact
  FROM postings p, totals),
scores AS (
  SELECT q.item_id, i.doc_row, i.doc_id, sum(w.w * i.impact)::BIGINT AS score
  FROM queries q JOIN impacts i USING (term) JOIN weights w USING (term) GROUP BY ALL),
ranks AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= {top}
"""
