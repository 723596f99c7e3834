"""The stages of the pipeline, each against a plain version on its own input."""

from __future__ import annotations

import collections
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
import __spark_entry__ as driver
from tests.llm.helpers import docs_frame, passage
from tests.llm.test_operators import BPE, plain_components, plain_quality, plain_removal, short_words
from tidegate.llm.toxicity import toxicity_scores
from tidegate.session import materialize


def test_stages_on_their_own_input(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, names = {}, [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES:
        before[name] = docs
        docs = materialize(spark, stage(spark, docs, sf_dir), "test-stage")
        if name != names[-1]:
            assert docs.columns == corpus_pipeline.COLUMNS
    after = {a: before[b] for a, b in zip(names, names[1:])} | {names[-1]: docs}
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    quality = dict(rows(after["quality rules"]))
    for doc_id, text in rows(before["quality rules"]):
        if plain_quality(text)[-1]:
            assert doc_id not in quality
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [i for i, t in rows(before["quality rules"]) if i in labels and labels[i].quality == 1]
    assert np.mean([i in quality for i in good]) > 0.9

    table = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = toxicity_scores(spark, before["toxicity"], table).collect()
    assert {r.doc_id for r in scores if not r.predicted} == {i for i, _ in rows(after["toxicity"])}

    groups = plain_components(rows(before["n-gram jaccard join"]))
    assert {i for i, _ in rows(after["n-gram jaccard join"])} == {i for i, n, c in groups if i == c or n == 0}

    want = {i: n - gone for i, n, gone, _, _ in plain_removal(rows(before["suffix-array dedup"]), 400)}
    got = {i: len((t or "").encode()) for i, t in rows(after["suffix-array dedup"])}
    # A cut may go through a character, of which the text then keeps nothing.
    assert set(got) == set(want) and all(0 <= want[i] - got[i] < 64 for i in want)

    tokenizer = Tokenizer.from_file(BPE)
    want = collections.Counter()
    for i, t in rows(before["packing"]):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for at in range(0, len(ids), 1024):
            want[i, at, zlib.crc32(ids[at : at + 1024].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.start, r.ids_crc32) for r in docs.collect()) == want


def test_passages_of_few_bytes_are_cut(spark):
    """The last text stage cuts passages of over 50 words, however few bytes they take."""
    one, fifty = short_words(3, 51), short_words(4, 50)
    rows = [(i, passage(200 + i, 40) + " " + one + " " + passage(300 + i, 9)) for i in range(4)]
    rows += [(i, passage(400 + i, 30) + " " + fifty + " " + passage(500 + i, 30)) for i in range(4, 7)]
    out = corpus_pipeline.repeated_passages(spark, docs_frame(spark, rows).select(*corpus_pipeline.COLUMNS), "")
    assert out.columns == corpus_pipeline.COLUMNS
    want = {i: t.replace(one, "") for i, t in rows}
    assert {r.doc_id: r.text for r in out.collect()} == want and sum(one in t for _, t in rows) == 4


def test_registered():
    queries = driver.queries()
    assert "pipeline" in queries
    assert sorted(int(n[2:].split("_")[0]) for n in queries if n.startswith("op") and n[2].isdigit()) == list(range(1, 11))
