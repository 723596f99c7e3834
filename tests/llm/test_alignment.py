"""Alignment of two tokenizers against both libraries and plain loops over whole texts."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, SCHEMA, docs_frame
from tidegate.llm import segments, token_alignment as ta

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = AWKWARD + [
    (30, "a <|endoftext|> b</s><s><unk>"), (31, "low▁line"), (32, "  two  blanks \n\n lines\t\ttabs  "), (33, " lead"),
    (34, "tail "), (35, " hard blank"), (36, "x" * 700 + " 日本語 テキスト"), (37, "don't we'll 12345 3.14,$5"),
    (38, "\x00nul\x07bell"), (39, "é é ﬁ ½ ǆ"), (40, "<0x41> <0x0A>"), (41, "\n"), (42, " "), (43, "🙂🙃👩‍👩‍👧"),
]


@pytest.fixture(scope="module")
def libraries():
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def both(libraries, text):
    """[(id, bytes)] by A and by B, whole; None where their bytes are not blank and text."""
    tokenizer, processor = libraries
    if not text:
        return None
    want = (" " + text).encode()
    of = ta.byte_characters()
    a = [(i, bytes(of[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in processor.encode(text):
        piece = processor.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("▁", " ").encode()))
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return None
    return a, b


def plain(libraries, rows):
    per_text, counts = [], Counter()
    for i, text in rows:
        found = both(libraries, text)
        if found is None:
            per_text.append((i, 0, 0, 0, [], ""))
            continue
        spans = []
        for side in found:
            at, out = 0, []
            for t, data in side:
                out.append((t, at, at + len(data)))
                at += len(data)
            spans.append(out)
        a, b = spans
        links = [(x, y) for x, s, e in a for y, s2, e2 in b if s < e2 and s2 < e]
        shared = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for e in shared:
            groups.append("|".join(",".join(str(t) for t, s, _ in side if low <= s < e) for side in (a, b)))
            low = e
        per_text.append((i, len(a), len(b), len(shared), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        counts.update(links)
    best = Counter()
    for (_, y), c in counts.items():
        best[y] = max(best[y], c)
    return [
        (i, n_a, n_b, g, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), d)
        for i, n_a, n_b, g, links, d in per_text
    ]


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


SHORT = [(i, t) for i, t in TEXTS if len(t or "") < 4000]


@pytest.mark.parametrize("broadcast", [ta.BROADCAST_PAIRS, 20, 0])
def test_alignment_equals_plain_loops(spark, libraries, broadcast):
    got = ta.align_tokenizers(spark, docs_frame(spark, SHORT, 2).repartition(4), BPE, PIECES, broadcast)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(libraries, SHORT * 2), key=key)


def flat(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])])


def test_ids_equal_the_libraries(libraries, spark, sf_dir):
    texts = [" " + t for _, t in TEXTS if t]
    texts += [" " + r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if r.text]
    data, offsets = flat(texts)
    tokenizer, processor = libraries
    a, at = ta.byte_level_side(BPE).encode(data, offsets)
    assert [a[x:y].tolist() for x, y in zip(at, at[1:])] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    b, at = ta.piece_side(PIECES).encode(data, offsets)
    assert [b[x:y].tolist() for x, y in zip(at, at[1:])] == processor.encode([t[1:] for t in texts])


def test_ranks_encode_as_the_file_does(libraries, tmp_path):
    import json

    from tidegate.llm import byte_bpe

    texts = [t.encode() for _, t in TEXTS if t] + [b"<|endoftext|>", b"a<|endoftext|>b", b"  x", b"\xff broken"]
    plain = Tokenizer.from_file(BPE)
    for special, tokenizer in ((True, libraries[0]), (False, plain)):
        want = [tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
        assert byte_bpe.byte_level_encoder(BPE, special)(texts) == want
    assert 50256 in byte_bpe.byte_level_encoder(BPE)([b"a<|endoftext|>b"])[0]
    # A file that is no table of ranks goes to the tokenizer.
    layout = json.load(open(BPE, encoding="utf-8"))
    layout["model"]["merges"] = layout["model"]["merges"][::-1]
    (tmp_path / "odd.json").write_text(json.dumps(layout), encoding="utf-8")
    odd = str(tmp_path / "odd.json")
    assert byte_bpe.ranks_of(odd) is None and byte_bpe.ranks_of(BPE)
    want = [Tokenizer.from_file(odd).encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
    assert byte_bpe.byte_level_encoder(odd)(texts) == want


def test_memos_forget_and_stay_right(libraries, monkeypatch):
    monkeypatch.setattr(ta, "WINDOW_MEMO_BYTES", 500)
    monkeypatch.setattr(ta, "SEGMENT_MEMO_BYTES", 500)
    work = ta.Aligner(BPE, PIECES)
    for i, text in SHORT * 2:
        found = work.run(*flat([text or ""]))
        want = plain(libraries, [(i, text)])[0]
        assert (found["n_a"][0], found["n_b"][0], found["n_groups"][0], found["n_links"][0], found["digest"][0]) == (*want[1:5], want[7])
    work.forget()
    assert not work.windows.memo.known and not work.a.segments.memo.known


def test_digests_in_parts(monkeypatch):
    texts, codes = [b"1|2", b"3,4|5"], [0, 1, 1, 0, 1]
    whole = ta.digest_of(texts, codes, 0, 5)
    monkeypatch.setattr(ta, "HASHED_TOGETHER", 2)
    assert ta.digest_of(texts, codes, 0, 5) == whole == hashlib.sha256(b";".join(texts[c] for c in codes)).hexdigest()


def test_empty_table(spark):
    assert ta.align_tokenizers(spark, spark.createDataFrame([], SCHEMA), BPE, PIECES).count() == 0


def test_strings_of_slices_and_empty_texts():
    words = [b"a", b"", "ñ\x00".encode(), b" b" * 40, b"c"]
    array = pa.array(words, pa.large_binary())
    assert segments.strings_of(array) == words
    assert segments.strings_of(array.slice(1, 3)) == words[1:4]
    assert segments.strings_of(array[:0]) == []
    ids = segments.SegmentIds(lambda parts: [list(p) for p in parts])
    data, offsets = np.frombuffer(b"abcab", np.uint8), np.array([0, 0, 2, 2, 5, 5])
    found, starts = ids.encode(data, offsets, np.array([0, 1, 0, 1, 0], bool))
    assert found.tolist() == list(b"abcab") and starts.tolist() == [0, 0, 2, 2, 5, 5]
