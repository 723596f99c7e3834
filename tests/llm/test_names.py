"""Texts that weak hashes take for each other."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import SCHEMA, docs_frame, passage
from tidegate.llm import common, ngram_join
from tidegate.llm.column_packing import inverse_of, pack_documents
from tidegate.llm.ngram_join import ngram_jaccard_join
from tidegate.llm.pfp_dedup import remove_repeated_strings
from tidegate.llm.piece_scan import decode_pieces, encode_pieces
from tidegate.llm.sentence_spans import remove_repeated_sentences

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def patterned(bits: int) -> tuple[str, str]:
    """The Thue-Morse text of a and b, and its mirror: equal under any polynomial modulo
    2**64 with an odd base, from 2**10 characters on."""
    plain = "".join("ab"[i.bit_count() & 1] for i in range(1 << bits))
    return plain, plain.translate(str.maketrans("ab", "ba"))


PAIRS = [patterned(bits) for bits in (10, 11, 12)]
TEXTS = [(2 * k + side, text) for k, pair in enumerate(PAIRS) for side, text in enumerate(pair)]


def flat(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])])


def test_names_follow_the_bytes_alone():
    draw = np.random.default_rng(4)
    data = draw.integers(0, 4, 70_000).astype(np.uint8)
    data[60_000:61_500] = data[100:1_600]
    sums = common.names().sums(data)
    start = np.array([100, 60_000, 101, 100, 1024, 2047, 0, 69_999])
    end = np.array([1_600, 61_500, 1_601, 1_599, 2048, 2048, 70_000, 70_000])
    got = sums.ranges(start, end)
    assert got[0] == got[1] and len(set(got.tolist())) == 7
    plain = []
    for a, b in zip(start.tolist(), end.tolist()):
        words = common.reduced(common.stream(1, 256)).tolist()
        plain.append(sum(words[x] * pow(common.Names.BASE, i, common.PRIME) for i, x in enumerate(data[a:b].tolist())) % common.PRIME)
    assert got.tolist() == common.mix(np.array(plain, np.uint64)).tolist()


@pytest.mark.parametrize("pair", PAIRS)
def test_patterned_texts_have_names_of_their_own(pair):
    data, offsets = flat(pair)
    assert len(set(common.names().sums(data).ranges(offsets[:-1], offsets[1:]).tolist())) == 2
    spaced, at = flat([pair[0], " ", pair[1]])
    assert len(set(common.word_names(spaced, at[[0, 2]], at[[1, 3]]).tolist())) == 2


def test_operators_tell_patterned_texts_apart(spark):
    docs = docs_frame(spark, TEXTS).coalesce(1)
    tokenizer = Tokenizer.from_file(BPE)
    want = {}
    for i, text in TEXTS:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        want[i] = zlib.crc32(np.array(ids, "<u4").tobytes())
    packed = pack_documents(spark, docs, BPE, capacity=8192).collect()
    assert {r.doc_id: r.ids_crc32 for r in packed} == want
    groups = {r.doc_id: r.component_id for r in ngram_jaccard_join(spark, docs).collect()}
    assert groups == {i: i for i, _ in TEXTS}
    decoded = decode_pieces(encode_pieces(spark, docs, PIECES), PIECES).collect()
    assert {r.doc_id: r.decoded for r in decoded} == dict(TEXTS)
    assert {r.n_removed for r in remove_repeated_sentences(spark, docs).collect()} == {0}
    # Strings of 400 bytes do stand in several of these texts: compare with a plain search.
    seen: dict[str, int] = {}
    for _, text in TEXTS:
        for at in range(len(text) - 399):
            seen[text[at : at + 400]] = seen.get(text[at : at + 400], 0) + 1
    for r in remove_repeated_strings(spark, docs).collect():
        text = dict(TEXTS)[r.doc_id]
        gone = set()
        for at in range(len(text) - 399):
            if seen[text[at : at + 400]] > 1:
                gone.update(range(at, at + 400))
        assert r.n_removed == len(gone)


def test_null_ids_whose_texts_share_a_32_bit_hash(spark):
    # These two texts have one hash of Spark's 32 bits.
    first, second = ("ab cd. " * 74 + f"x{n}" for n in (429, 110984))
    body = passage(31, 90)
    rows = [(None, first), (None, second), (1, first), (None, body), (2, body)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x", "y", 7) for i, t in rows], SCHEMA)
    hashes = docs.limit(2).select(F.hash("text").alias("h")).collect()
    assert hashes[0].h == hashes[1].h
    out = {r.text_end: r for r in remove_repeated_strings(
        spark, docs.withColumn("text_end", F.substring_index("text", " ", -1))).collect()}
    assert out["x429"].n_removed == len(first) and 0 < out["x110984"].n_removed < len(second)


def test_inverse_needs_row_exchanges():
    matrix = np.array([[0.0, 2, 1], [1, 0, 3], [4, 1, 0]])
    assert np.allclose(inverse_of(matrix) @ matrix, np.eye(3))


def test_shingles_are_in_order_where_short_and_long_texts_mix():
    data, offsets = flat(["one two", "", passage(1, 90), "x", " ", passage(1, 90) + " " + passage(1, 90), "one two"])
    row, value = ngram_join.shingle_sets(data, offsets, 5)
    pairs = list(zip(row.tolist(), value.tolist()))
    assert pairs == sorted(set(pairs))
    assert np.bincount(row, minlength=7).tolist() == [1, 0, 86, 1, 0, 90, 1]
    assert value[row == 0].tolist() == value[row == 6].tolist()
