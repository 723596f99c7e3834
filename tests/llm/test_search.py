"""Ranked search against plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, SCHEMA, docs_frame
from tidegate.llm import rmq_search

TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top=10):
    found = [(i, Counter(terms_of(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in queries.items():
        scores = []
        for i, c in found:
            size = sum(c.values())
            m = 10 + (90 * size * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(scores[:top])]
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def corpus(n, seed):
    draw = random.Random(seed)
    words = [f"t{int(draw.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[i % min(n, 7)][1]) for i in range(40)]  # many equal scores
    items = [(k, " ".join(draw.choices(words, k=draw.randint(1, 25)))) for k in range(12)]
    return docs, items + [(100, "nowhere"), (101, ""), (102, None), (None, docs[3][1]), (7, "another row of 7 t1 t5")]


def frames(spark, docs, items):
    queries = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    return docs_frame(spark, docs).repartition(5), queries


@pytest.mark.parametrize("shard_bytes, leaf, together", [(8 << 20, 128, 16), (2_000, 1, 1), (4_000, 3, 4), (1, 2, 2)])
def test_search_equals_scoring_all(spark, monkeypatch, shard_bytes, leaf, together):
    monkeypatch.setattr(rmq_search, "LEAF", leaf)
    monkeypatch.setattr(rmq_search, "TOGETHER", together)
    docs, items = corpus(150, 5)
    docs = docs + AWKWARD
    frame, queries = frames(spark, docs, items)
    index = rmq_search.build_index(frame, shard_bytes).cache()
    got = rmq_search.ranked_search(spark, index, queries).collect()
    assert order(map(tuple, got)) == order(plain(docs, items))


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(rmq_search, "BLOCK_PAIRS", 40)
    docs, items = corpus(60, 9)
    frame, queries = frames(spark, docs, items)
    got = rmq_search.search_documents(spark, frame, queries, top=3).collect()
    assert order(map(tuple, got)) == order(plain(docs, items, 3))


def test_empty_sides(spark):
    frame, queries = frames(spark, *corpus(5, 1))
    nothing = spark.createDataFrame([], SCHEMA)
    assert rmq_search.search_documents(spark, nothing, queries).count() == 0
    assert rmq_search.search_documents(spark, frame, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert rmq_search.search_documents(spark, docs_frame(spark, [(1, None), (2, "-.-")]), queries).count() == 0


def test_a_shard_is_a_row_group(spark, monkeypatch):
    """Readers and writers hold a row group of a file, whatever the number of its shards."""
    real, written = rmq_search.materialize, {}

    def kept(session, df, name, *args, **options):
        written[name] = real(session, df, name, *args, **options)
        return written[name]

    monkeypatch.setattr(rmq_search, "materialize", kept)
    docs = spark.range(0, 4, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 500_000).alias("text"))
    queries = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert [r.doc_id for r in rmq_search.search_documents(spark, docs, queries).orderBy("rank").collect()] == [0, 1, 2, 3]
    files = [pq.read_metadata(f.removeprefix("file://")) for f in written["search-index"].inputFiles()]
    assert [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)] == [1] * 4


def test_bounds_spare_documents():
    texts = [f"common word{i % 500} filler" for i in range(6000)] + ["rare common word3 gem jewel stone"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row = rmq_search.shard_of(pa.array(range(len(texts)), pa.int64()), data, offsets)
    terms = [b"gem", b"jewel", b"stone", b"word3"]
    shard = rmq_search.Shard(row, 0, pa.array(terms, pa.binary()), len(texts), 3 * len(texts))
    best = rmq_search.Best(1)
    scored = rmq_search.search(shard, np.arange(4), np.array([9000, 9000, 9000, 5000]), best)
    assert best.id.tolist() == [6000] and scored < 10


def test_range_maxima():
    draw = np.random.default_rng(2)
    shard = rmq_search.Shard.__new__(rmq_search.Shard)
    shard.impact = draw.integers(0, 50, 300)
    shard.top = shard.maxima(300)
    shard.depth = np.array([0] + [n.bit_length() - 1 for n in range(1, 301)])
    a = draw.integers(0, 299, 500)
    b = np.array([draw.integers(x + 1, 301) for x in a])
    got = shard.largest(a, b)
    assert ((a <= got) & (got < b)).all()
    assert shard.impact[got].tolist() == [shard.impact[x:y].max() for x, y in zip(a, b)]
