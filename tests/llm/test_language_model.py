"""The hidden Markov model against plain sums over all paths, the base against plain counts."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, SCHEMA, docs_frame
from tidegate.llm import hidden_markov as hm


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [""]


def remainder(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def plain_base(rows):
    counts = Counter(w for i, t in rows if remainder(i) != 1 for w in words_of(t))
    total, different = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        logs = [math.log10((counts[w] + 0.5) / (total + 0.5 * (different + 1))) for w in words_of(t)]
        out.append((i, remainder(i) == 1, len(logs), sum(counts[w] > 0 for w in words_of(t)), total, sum(logs)))
    return out


def by_row(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5]))


@pytest.mark.parametrize("most", [None, 5])
def test_base_scores(spark, monkeypatch, most):
    if most:  # nearly all words reach their tokens by the join, and share classes
        monkeypatch.setattr(hm, "BROADCAST_WORDS", most)
        monkeypatch.setattr(hm, "OWN_CLASSES", 2)
    rows = AWKWARD + [(i, f"Common words {i} and Common things, x{i % 3}") for i in range(20, 60)]
    got = by_row(tuple(r) for r in hm.language_model_scores(spark, docs_frame(spark, rows).repartition(3), rounds=2).collect())
    want = by_row(plain_base(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-8) and g[6] < 0 and math.isfinite(g[6])


def test_nothing_to_learn_from(spark):
    assert hm.language_model_scores(spark, spark.createDataFrame([], SCHEMA)).count() == 0
    out = next(i for i in range(100) if remainder(i) == 1)
    got = hm.language_model_scores(spark, docs_frame(spark, [(out, "never seen")]), rounds=1).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(True, 3, 0, 0, 0.0)]


def some_model(states=3, classes=5):
    draw = np.random.default_rng(3)
    start, move, emit = draw.random(states), draw.random((states, states)), draw.random((classes, states))
    return hm.HiddenMarkov(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def all_paths(model, ids):
    """(likelihood, expected starts, moves and emissions) by listing every path of states."""
    states = model.start.size
    total, start, move, emit = 0.0, np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
    for path in itertools.product(range(states), repeat=len(ids)):
        p = model.start[path[0]]
        for t, (s, x) in enumerate(zip(path, ids)):
            p *= model.emit[x, s] * (model.move[path[t - 1], s] if t else 1)
        total += p
        start[path[0]] += p
        for t, (s, x) in enumerate(zip(path, ids)):
            emit[x, s] += p
            if t:
                move[path[t - 1], s] += p
    return total, start / total, move / total, emit / total


@pytest.mark.parametrize("steps", [1, 2, 3, 100])
def test_recursions_equal_sums_over_all_paths(steps):
    model, draw = some_model(), np.random.default_rng(1)
    texts = [draw.integers(0, 5, n) for n in (1, 7, 2, 6, 3, 7)]
    ids, offsets = np.concatenate(texts), np.concatenate([[0], np.cumsum([t.size for t in texts])])
    want = [all_paths(model, t.tolist()) for t in texts]
    assert hm.likelihoods(model, ids, offsets, steps) == pytest.approx(np.log([w[0] for w in want]), abs=1e-10)
    found = hm.ExpectedCounts(model)
    found.add(ids, offsets, steps)
    for got, k in ((found.start, 1), (found.move, 2), (found.emit, 3)):
        assert got == pytest.approx(sum(w[k] for w in want), abs=1e-9)


def test_probabilities_of_words_sum_to_one():
    v = hm.Vocabulary(30, 4, [], np.zeros(0, int), np.zeros(0, int), 0, 5, np.full(hm.SHARED_CLASSES, 8.0), np.full(hm.SHARED_CLASSES, 2.0))
    counts = np.array([3, 5, 0])  # two known words of a class, and its unknown one
    assert (10 ** hm.inside_log(v, counts, np.array([9, 9, 9]))).sum() == pytest.approx(1)
    assert v.unigram().sum() == pytest.approx(1)


def test_model_beats_the_base_on_texts_it_did_not_learn(spark, sf_dir):
    from tidegate.llm.queries import op12_hidden_markov

    rows = op12_hidden_markov(spark, sf_dir).where("held_out").collect()
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_long_words_go_by_digest():
    import pyarrow as pa

    words = pa.array([b"short", b"x" * 500, b"y" * 500, b"\0odd"], pa.large_binary())
    names, _ = hm.names_of(words)
    assert len(set(names.to_pylist())) == 4 and max(map(len, names.to_pylist())) <= hm.NAME_BYTES
