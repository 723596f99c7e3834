"""The operators against plain versions, on small documents with the awkward cases."""

from __future__ import annotations

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, SCHEMA, docs_frame, passage
from tidegate.llm import arc_convert, line_quality, piece_scan, toxicity, url_aliases
from tidegate.llm.column_packing import pack_documents, plan, solve_patterns
from tidegate.llm.common import connected_components, keep_repeated
from tidegate.llm.lcp_fingerprint import locally_consistent_fingerprints
from tidegate.llm.ngram_join import keep_first_of_groups, ngram_jaccard_join
from tidegate.llm.pfp_dedup import remove_repeated_strings
from tidegate.llm.sentence_spans import remove_repeated_sentences

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def awkward(spark):
    return docs_frame(spark, AWKWARD).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple(("", "") if v is None else (type(v).__name__, str(v)) for v in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# --- helpers ----------------------------------------------------------------------


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, j) for j in range(1001, 1300)] + [(5000, 5000)]
    got = connected_components(spark, spark.createDataFrame(edges, "a long, b long"), "cc").collect()
    groups = collections.defaultdict(set)
    for r in got:
        groups[r.component].add(r.node)
    assert sorted(map(len, groups.values())) == [201, 300]
    assert connected_components(spark, spark.createDataFrame([], "a long, b long"), "cc").count() == 0


def test_keep_repeated_over_batches(spark):
    rows = [(k, i) for k in range(50) for i in range(1 if k % 3 else 300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    got = keep_repeated(spark.createDataFrame(rows, "k long, i long"), "k", ["i"]).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    same(got, [r for r in rows if r[0] % 3 == 0])


# --- 1 archives -------------------------------------------------------------------


PAGES = [
    (1, "http://a.example.com/x", "<p>same</p>"), (2, "http://b.example.com/with blank", "<p>same</p>"),
    (3, None, None), (4, "", ""), (5, "https://c/ü", "Grüße\r\n\r\nfiledesc://x 1 2 3 4\n"), (None, "http://n/", "null id"),
    (7, "http://a.example.com/x", "WARC/1.0\r\n\r\n" * 40), (8, "ftp://z", "x" * 200_000),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, head string")
    got = {r.page_id: r for r in arc_convert.pages_through_archives(spark, pages.repartition(2)).collect()}
    assert len(got) == len(PAGES)
    owner = {}
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        owner[body] = max(owner.get(body, -1), -1 if page_id is None else page_id)
    for page_id, _, html in PAGES:
        body, row = (html or "").encode(), got[page_id]
        assert row.payload_bytes == len(body)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = owner[body] in (page_id, -1)
        assert (row.record_type, row.refers_to) == (("response", None) if first else ("revisit", owner[body]))
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert arc_convert.pages_through_archives(spark, empty).count() == 0


def test_arc_versions_and_members():
    import gzip

    one = b"URL IP-address Archive-date Content-type Archive-length\n"
    head = b"1 0 me\n" + one
    opening = b"filedesc://a 0.0.0.0 19960923142103 text/plain %d\n" % len(head) + head + b"\n"
    record = b"dns:x.org 1.2.3.4 199609231421 text/dns 5\nhello\n"
    for content in (opening + record, gzip.compress(opening) + gzip.compress(record)):
        ((fields, version, block),) = list(arc_convert.arc_records(content))
        assert (version, block, fields["URL"]) == (1, b"hello", "dns:x.org")
        assert arc_convert.iso_date(fields["Archive-date"]) == "1996-09-23T14:21:00Z"
    with pytest.raises(ValueError):
        list(arc_convert.arc_records(opening + record[:-3]))


# --- 2 toxicity -------------------------------------------------------------------


def test_toxicity_learns_and_holds_out(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, passage(i, 40) + (" you utter grobblewort" if bad else "")))
        labels.append((i, 1, int(bad)))
    rows += [(1000, None), (1001, ""), (None, "no id here"), (5, "a second text of an id")]
    docs = docs_frame(spark, rows)
    got = toxicity.toxicity_scores(
        spark, docs, spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    ).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    kept = toxicity.toxicity_scores(
        spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        keep=["doc_id", "lang"],
    )
    assert kept.columns == ["doc_id", "lang", "score", "predicted"] and kept.count() == len(rows)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.95


def test_toxicity_without_two_classes(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = toxicity.toxicity_scores(spark, awkward, none).collect()
    assert len(scores) == len(AWKWARD) and {r.score for r in scores} == {0.0}
    assert toxicity.toxicity_scores(spark, nothing, none).count() == 0


# --- 3 repeated strings -----------------------------------------------------------


def plain_removal(rows, length):
    seen = collections.Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        seen.update(b[p : p + length] for p in range(len(b) - length + 1))
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for q, g in enumerate(gone) if g and (q == 0 or not gone[q - 1]))
        yield i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("length", [150, 400])
def test_repeated_strings(spark, awkward, length):
    got = remove_repeated_strings(spark, awkward, length)
    assert set(awkward.columns) < set(got.columns)
    same(got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), plain_removal(AWKWARD, length))


def test_repeated_strings_of_one_core(spark, nothing, monkeypatch):
    """More texts around one passage than are put in order at once."""
    from tidegate.llm import pfp_dedup

    monkeypatch.setattr(pfp_dedup, "TOGETHER", 16)
    rows = [(i, passage(100 + i, 30 + i % 5) + passage(1, 120) + passage(300 + i, 20)) for i in range(60)]
    got = remove_repeated_strings(spark, docs_frame(spark, rows))
    same(got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), plain_removal(rows, 400))
    assert remove_repeated_strings(spark, nothing).count() == 0


def plain_passages(rows, length, words):
    """plain_removal, with the passages of so many words that stand elsewhere."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)] for _, b in texts]
    seen = collections.Counter()
    name = lambda b, at, p: tuple(b[x:y] for x, y in at[p : p + words])
    for (_, b), at in zip(texts, places):
        seen.update(b[p : p + length] for p in range(len(b) - length + 1))
        seen.update(name(b, at, p) for p in range(len(at) - words + 1))
    for (i, b), at in zip(texts, places):
        gone = bytearray(len(b))
        cuts = [(p, p + length) for p in range(len(b) - length + 1) if seen[b[p : p + length]] > 1]
        cuts += [(at[p][0], at[p + words - 1][1]) for p in range(len(at) - words + 1) if seen[name(b, at, p)] > 1]
        for first, last in cuts:
            gone[first:last] = b"\1" * (last - first)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for q, g in enumerate(gone) if g and (q == 0 or not gone[q - 1]))
        yield i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def short_words(seed, n):
    """n words of at most two bytes."""
    return " ".join(w[1:3] for w in passage(seed, n).split())


DIGESTS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_repeated_passages_of_few_bytes(spark, nothing):
    """Passages of 51 words go though they take fewer than 400 bytes, those of 50 stay."""
    one, fifty = short_words(3, 51), short_words(4, 50)
    rows = [(i, passage(200 + i, 40) + " " + one + "\n" + passage(300 + i, 9 + i)) for i in range(5)]
    rows += [(i, passage(400 + i, 30) + " " + fifty + " " + passage(500 + i, 30)) for i in range(5, 9)]
    # Other blanks, no blank at the texts' ends, the same text twice over, and one word again and again.
    rows += [(9, one.replace(" ", " \t")), (10, one + "\u00a0x"), (11, "x" + one), (12, one), (13, "a " * 70)]
    rows += [(14, None), (15, ""), (16, " \n "), (None, one), (16, "b " + one + "\n\n" + one)]
    assert len(one) < 400
    got = remove_repeated_strings(spark, docs_frame(spark, rows).repartition(3), words=51)
    want = list(plain_passages(rows, 400, 51))
    same(got.select(*DIGESTS).collect(), want)
    removed = {r[0]: r[2] for r in want}
    assert all(removed[i] == len(one) for i in range(5)) and not any(removed[i] for i in range(5, 9))
    assert remove_repeated_strings(spark, nothing, words=51).count() == 0


def test_repeated_passages_of_awkward_texts(spark, awkward):
    got = remove_repeated_strings(spark, awkward, 400, words=20)
    same(got.select(*DIGESTS).collect(), plain_passages(AWKWARD, 400, 20))


def test_repeated_passages_of_one_core(spark, monkeypatch):
    """More texts around one passage of few bytes than are put in order at once."""
    from tidegate.llm import pfp_dedup

    monkeypatch.setattr(pfp_dedup, "TOGETHER", 16)
    rows = [(i, short_words(100 + i, 30 + i % 5) + " " + short_words(1, 60) + " " + short_words(300 + i, 20)) for i in range(60)]
    got = remove_repeated_strings(spark, docs_frame(spark, rows), words=51)
    same(got.select(*DIGESTS).collect(), plain_passages(rows, 400, 51))


# --- 4 fingerprints ---------------------------------------------------------------


def test_fingerprints(spark, awkward, nothing):
    got = locally_consistent_fingerprints(spark, awkward).collect()
    assert len(got) == len(AWKWARD)
    prints = collections.defaultdict(set)
    by_id = collections.defaultdict(list)
    for i, t in AWKWARD:
        by_id[i].append(t or "")
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(by_id[r.doc_id]) == 1:
            text = by_id[r.doc_id][0]
            prints[text].add(r.fingerprint)
            assert r.n_chars == len(text)
    assert all(len(v) == 1 for v in prints.values())
    unique = [r for r in got if r.doc_id in (12, 11, 13, 10)]
    order = {14: 13, 13: 12, 12: 11, 11: 10}
    for r in unique:
        if r.doc_id in order:
            text, after = by_id[r.doc_id][0], by_id[order[r.doc_id]][0]
            k = len(text) // 3
            assert r.edited_sha256 == hashlib.sha256((text[: len(text) - k] + after[:k]).encode()).hexdigest()
    assert locally_consistent_fingerprints(spark, nothing).count() == 0


def test_equal_interiors_share_names(spark):
    base = passage(5, 2000)
    rows = [(2, base), (1, "x" + base[:-1]), (0, passage(6, 2000))]
    got = {r.doc_id: r for r in locally_consistent_fingerprints(spark, docs_frame(spark, rows)).collect()}
    assert got[2].near_next > 0.9 and got[1].near_next < 0.1
    assert 0.35 < got[2].near_edited


# --- 5 line quality ---------------------------------------------------------------


def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_line_quality(spark, awkward, nothing):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = AWKWARD + [(20, "\n".join(["a b c d e f."] * 4 + [passage(9, 60)])), (21, "| a | b | c | d\n" * 30), (22, "z " * 120)]
    docs = docs_frame(spark, rows).withColumn("_words", F.lit(1)).withColumn("row", F.lit("clash"))
    got = line_quality.clean_lines(docs)
    same(got.select("doc_id", *names).collect(), [(i, *plain_quality(t)) for i, t in rows])
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert kept[5] and kept[20] and not kept[21] and not kept[1]
    assert line_quality.clean_lines(nothing).count() == 0
    plan_text = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan_text and "Arrow" not in plan_text and "Exchange" not in plan_text


def test_failing_lines_go(spark):
    text = "\n".join([passage(4, 60), "Home | News | Sport | More", "All rights reserved.", passage(5, 60)])
    row = line_quality.clean_lines(docs_frame(spark, [(1, text)])).first()
    assert row.kept and row.clean_text == passage(4, 60) + "\n" + passage(5, 60)


# --- 6 url aliases ----------------------------------------------------------------


def test_aliases_inherit_blocks(spark):
    link = '<html><link rel="canonical" href="{}"></html>'
    refresh = '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        (1, "http://alias.org/a", link.format("http://example.com/en/1")), (2, "http://example.com/en/1", ""),
        (3, "http://chain.org/b", refresh.format("http://alias.org/a")), (4, "http://free.org/", None),
        (5, "https://www.example.com/en/9", link.format("http://example.com/en/1")), (6, None, None), (7, "no scheme", ""),
        (8, "HTTP://X.NET/es/", ""), (8, "HTTP://X.NET/es/", ""), (9, "http://example.com", ""),
        (10, "https://logged.org/z?q=1#f", ""), (None, "http://com/", ""),
    ]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, node string")
    logged = spark.createDataFrame([("http://chain.org/b", "http://logged.org/z?q=1"), ("junk", "more junk"), (None, "http://y.org/")], "url string, target string")
    got = url_aliases.judge_urls(spark, pages, url_aliases.RULES, logged).collect()
    assert len(got) == len(rows)
    verdict = {r.page_id: (r.rule, r.verdict) for r in got}
    assert verdict[1] == verdict[3] == verdict[10] == (None, "block")
    assert verdict[2] == ("example.com/en/", "block") and verdict[5] == ("www.example.com/en/", "allow")
    assert verdict[4] == verdict[6] == verdict[7] == verdict[9] == (None, "allow")
    assert verdict[8] == ("net/es/", "block") and verdict[None] == ("com/", "allow")
    hosts = {r.page_id: (r.host, r.path) for r in got}
    assert hosts[8] == ("x.net", "/es/") and hosts[6] == hosts[7] == ("", "") and hosts[9] == ("example.com", "")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_aliases.judge_urls(spark, empty, url_aliases.RULES).count() == 0


# What a browser makes of each target on a page.
TARGETS = [
    ("http://a.org/x/y/p.html?q=1#f", "b.html", "http://a.org/x/y/b.html"),
    ("http://a.org/x/y/p.html", "../b", "http://a.org/x/b"),
    ("http://a.org/x/y/p.html", "./b/./c/..", "http://a.org/x/y/b/"),
    ("http://a.org/x/y/p.html", "../../../..", "http://a.org/"),
    ("http://a.org/x/y/", "%2E%2e/b", "http://a.org/x/b"),
    ("http://a.org/x/p?q=1", "?p=2", "http://a.org/x/p?p=2"),
    ("http://a.org", "?p=2", "http://a.org/?p=2"),
    ("http://a.org?q=/z/", "b", "http://a.org/b"),
    ("http://a.org/x/p?q=1#f", "#g", "http://a.org/x/p?q=1#g"),
    ("https://a.org/x/", "//b.org/c/../d", "https://b.org/d"),
    ("http://a.org/x/", "/c/./d?e=/../f", "http://a.org/c/d?e=/../f"),
    ("http://a.org/x/", "c?d&amp;e=1&#38;f&#x26;g&copy=2&eacute;", "http://a.org/x/c?d&e=1&f&g&copy=2é"),
    ("http://a.org/x/", "https://b.org/c?a&amp;b", "https://b.org/c?a&b"),
    ("http://a.org/x/", "mailto:me@a.org", None), ("http://a.org/x/", "a/b:c", "http://a.org/x/a/b:c"),
    ("no scheme", "b", None), ("no scheme", "/b", None),
]


def test_targets_resolve_as_in_browsers(spark):
    rows = [(k, u, t) for k, (u, t, _) in enumerate(TARGETS)]
    frame = spark.createDataFrame(rows, "k int, url string, target string").select("k", "url", url_aliases.decoded(F.col("target")).alias("target"))
    got = {r.k: r.out for r in frame.select("k", url_aliases.absolute(F.col("target"), F.col("url")).alias("out")).collect()}
    assert [got[k] for k in range(len(TARGETS))] == [want for _, _, want in TARGETS]


def test_relative_links_carry_blocks(spark):
    link, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    rules = [("block", "bad.org", "/en/")]
    forms = ["../en/1", "/en/1", "//bad.org/en/1", "../de/../en/1?a=1&amp;b=2", "http://bad.org/x/../en/2"]
    rows = [(k, f"http://bad.org/a{k}/p", tag.format(t)) for k, (tag, t) in enumerate((g, t) for g in (link, refresh) for t in forms)]
    rows += [
        (20, "http://free.org/p", '<base href="//bad.org/en/"><link rel=canonical href="1">'),
        (21, "http://free.org/q", refresh.format("p")), (22, "http://free.org/r?a=1&b=2", link.format("q")),
        (23, "http://free.org/s", refresh.format("?a=1")), (24, "http://free.org/t", refresh.format("r?a=1&amp;b=2")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    verdict = {r.page_id: r.verdict for r in url_aliases.judge_urls(spark, pages, rules).collect()}
    assert verdict == {k: "allow" if k == 23 else "block" for k, _, _ in rows}


# --- 7 pieces ---------------------------------------------------------------------


def total_weight(model, ids):
    weights = {i: w for i, w in model.pieces.values()}
    return sum(weights.get(i, 0) for i in ids)


@pytest.mark.parametrize("chunk", [40, 8192])
def test_pieces_of_chunks(spark, awkward, chunk):
    model = piece_scan.Model(PIECES)
    encoded = piece_scan.encode_pieces(spark, awkward, PIECES, chunk)
    got = collections.defaultdict(list)
    for r in encoded.collect():
        got[r.doc_id].append(list(r.ids))
    assert sum(map(len, got.values())) == len(AWKWARD)
    texts = collections.defaultdict(list)
    for i, t in AWKWARD:
        texts[-(1 << 63) if i is None else i].append(t or "")
    for i, some in texts.items():
        weigh = lambda x: (total_weight(model, x), len(x))
        want = [model.best_ids((" " + t).replace(" ", piece_scan.MARK)) if t else [] for t in some]
        assert sorted(map(weigh, got[i])) == sorted(map(weigh, want))
    decoded = collections.Counter(r.decoded for r in piece_scan.decode_pieces(encoded, PIECES).collect())
    assert decoded == collections.Counter(t or "" for _, t in AWKWARD)


def test_max_plus_is_associative():
    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(-1000, 0, (16, 16)) for _ in range(3))
    assert (piece_scan.max_plus(piece_scan.max_plus(a, b), c) == piece_scan.max_plus(a, piece_scan.max_plus(b, c))).all()


def test_matrices_are_stored_as_a_column_and_a_row():
    model = piece_scan.Model(PIECES)
    text = " " + passage(1, 400) + " 日本 ▁ñ😀 " + "x" * 90 + passage(2, 30)
    cut = [text[at : at + 150 + model.reach - 1] for at in range(0, len(text), 150)]
    bodies = [(b, min(150, len(text) - 150 * k)) for k, b in enumerate(cut)]
    stored = piece_scan.chunk_matrices(model, bodies)
    plain = [model.matrix(b.replace(" ", piece_scan.MARK), own) for b, own in bodies]
    assert sum(m.size == 2 * model.reach for m in stored) >= len(stored) - 2
    seen = lambda m: np.maximum(m, piece_scan.NONE // 2)
    for a, b in zip(stored, plain):
        assert (seen(piece_scan.spread(a)) == seen(b)).all()
    for a, b, c, d in zip(stored, stored[1:], plain, plain[1:]):
        assert (seen(piece_scan.spread(piece_scan.combined(a, b))) == seen(piece_scan.max_plus(c, d))).all()
        assert (seen(piece_scan.spread(piece_scan.combined(c, b))) == seen(piece_scan.max_plus(c, d))).all()
        assert (seen(piece_scan.spread(piece_scan.combined(a, d))) == seen(piece_scan.max_plus(c, d))).all()


def test_segments_in_step_are_those_of_the_plain_search():
    model = piece_scan.Model(PIECES)
    words = [w.encode() for t in (passage(1), "the of and 日本語 ñandú ​ \x00 😀▁a " + "z" * 70) for w in (t, *t.split(" "))]
    words = [w for w in words if w] * 2 + [b" ", b"  a"]
    ids, sizes = model.segments(words)
    want = [model.best_ids(w.decode().replace(" ", piece_scan.MARK)) for w in words]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


# --- 8 packing --------------------------------------------------------------------


def test_packing(spark, awkward, nothing):
    got = pack_documents(spark, awkward, BPE).collect()
    tokenizer = Tokenizer.from_file(BPE)
    want = collections.Counter()
    for i, t in AWKWARD:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for at in range(0, len(ids), 1024):
            part = ids[at : at + 1024]
            want[i, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert pack_documents(spark, nothing, BPE).count() == 0


def test_patterns_hold_the_demand_near_the_optimum():
    rng = np.random.default_rng(3)
    demand = rng.integers(0, 400, 64)
    # Large sizes that fit with little else set the optimum, not the sum of all sizes.
    least = sum(amount for _, amount in solve_patterns(demand, gap=0))
    total = sum((p * n for p, n in plan(demand)), np.zeros(64, np.int64))
    assert (total == demand).all()
    assert all((p * np.arange(1, 65)).sum() <= 64 for p, _ in plan(demand))
    assert sum(n for _, n in plan(demand)) <= 1.005 * least + 2
    assert plan(np.zeros(64, np.int64)) == []


# --- 9 sentence spans -------------------------------------------------------------


def sentences_of(text):
    out, current, start = [], [], None
    found = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
    for k, m in enumerate(found):
        start = m.start() if start is None else start
        current.append(m[0])
        following = found[k + 1].start() if k + 1 < len(found) else len(text)
        if m[0][-1] in ".!?…" or "\n" in text[m.end() : following]:
            out.append((start, tuple(current)))
            current, start = [], None
    return out + ([(start, tuple(current))] if current else [])


def test_repeated_sentences(spark, nothing):
    shared = " ".join(f"Sentence {i} of the shared part." for i in range(6))
    rows = [(i, f"Own start {i}. Own too {i}! {shared} Own end {i}…") for i in range(5)]
    rows += [(9, None), (10, ""), (11, "Short. Text."), (12, "Short. Text."), (13, "\n\n"), (14, shared + "\n" + shared)]
    got = {r.doc_id: r for r in remove_repeated_sentences(spark, docs_frame(spark, rows, 2)).collect()}
    first, gone = {}, collections.defaultdict(set)
    for i, t in rows:
        parts = [s for _, s in sentences_of(t or "")]
        for p in range(len(parts)):
            q, held = p, 0
            while q < len(parts) and held < 20:
                held += len(parts[q])
                q += 1
            if held >= 20 and first.setdefault(tuple(parts[p:q]), (i, p)) != (i, p):
                gone[i] |= set(range(p, q))
    for i, t in rows:
        found = sentences_of(t or "")
        assert got[i].n_removed == len(gone[i]) and got[i].n_sentences == len(found)
        assert got[i].n_spans == sum(k in gone[i] and k - 1 not in gone[i] for k in range(len(found)))
        assert (got[i].text is None) == (t is None)
        # Every sentence reaches to the next one's first byte; blanks before the first stay.
        whole, places = (t or "").encode(), [len(t[:at].encode()) for at, _ in found]
        ends = [*places[1:], len(whole)]
        kept = whole[: places[0]] if places else whole
        kept += b"".join(whole[x:y] for k, (x, y) in enumerate(zip(places, ends)) if k not in gone[i])
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert got[0].n_removed == 0 and "Sentence 3" not in got[1].text and "Own end 1" in got[1].text
    assert remove_repeated_sentences(spark, nothing).count() == 0


# --- 10 n-gram join ---------------------------------------------------------------


def plain_components(rows, words=5, percent=75):
    def shingles(t):
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(sets[k]), least.get(find(k), i)) for k, (i, _) in enumerate(rows)]


def test_ngram_join_awkward(spark, awkward, nothing):
    same(ngram_jaccard_join(spark, awkward).collect(), plain_components(AWKWARD))
    assert ngram_jaccard_join(spark, nothing).count() == 0


def near_rows():
    rng = np.random.default_rng(7)
    rows = []
    for base in range(4):
        words = passage(base, 70).split()
        for _ in range(40):
            own = list(words)
            for at in rng.integers(0, len(own), rng.integers(0, 5)):
                own[at] = "x" + str(rng.integers(1000))
            rows.append((len(rows), " ".join(own)))
    # Small sets of every size, and chains whose ends are not alike.
    for size in range(5, 40):
        words = passage(900 + size, size).split()
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words + ["tail"]))]
    long = passage(77, 400).split()
    return rows + [(len(rows) + k, " ".join(long[10 * k : 10 * k + 120])) for k in range(20)]


@pytest.mark.parametrize("boundary", [None, 60])
def test_ngram_join_near_copies(spark, monkeypatch, boundary):
    from tidegate.llm import ngram_join

    if boundary:
        monkeypatch.setattr(ngram_join, "boundary_size", lambda load, percent: boundary)
    rows = near_rows()
    same(ngram_jaccard_join(spark, docs_frame(spark, rows)).collect(), plain_components(rows))


@pytest.mark.parametrize("runs", [1, 40])
def test_shingles_are_counted_over_all_runs(spark, monkeypatch, runs):
    from tidegate.llm import ngram_join

    monkeypatch.setattr(ngram_join, "COUNTED", 500)
    common = passage(5, 30)
    # The passage comes once in each of 40 texts, another in 3.
    rows = [(k, common + " " + passage(100 + k, 30) + (" " + passage(6, 14) if k < 3 else "")) for k in range(40)]
    docs = docs_frame(spark, rows).repartition(runs, "doc_id") if runs > 1 else docs_frame(spark, rows).coalesce(1)
    names, counts, squares = ngram_join.heavy_shingles(docs, 5, 40 * 60)
    assert names.size == 26 and (counts == 40).all() and (np.diff(names.view(np.uint64)) > 0).all()
    assert squares == 10 * 3**2
    few = ngram_join.heavy_shingles(docs, 5, 40 * 60, most=6)
    assert few[0].size == 6 and few[2] == 10 * 3**2 + 20 * 40**2


def test_one_of_each_group_stays(spark, awkward):
    kept = keep_first_of_groups(spark, awkward)
    ids = [r.doc_id for r in kept.collect()]
    assert 5 in ids and 6 not in ids and 7 not in ids and 8 in ids and ids.count(9) <= 2
    assert kept.columns == awkward.columns


def test_one_of_each_group_stays_with_null_and_repeated_ids(spark):
    a, b, c, d = (passage(300 + k) for k in range(4))
    rows = [
        (None, a), (None, a + " more"), (None, a),  # null ids only
        (1, b), (None, b), (None, b + " more"),  # null copies of a numbered one
        (3, c), (4, d), (4, c + " more"),  # its namesake stands for another group
        (5, ""), (None, None),
    ]
    kept = sorted((r.doc_id or 0, r.text or "") for r in keep_first_of_groups(spark, docs_frame(spark, rows)).collect())
    assert kept[1][0] == 0 and kept[1][1] in (a, a + " more")
    assert kept[:1] + kept[2:] == [(0, ""), (1, b), (3, c), (4, d), (5, "")]
