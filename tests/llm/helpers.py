"""Small documents with the awkward cases, and frames of them."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tie string, row string, node long"


def docs_frame(spark, rows, repeat=1):
    """rows of (doc_id, text); the other columns clash with names used inside."""
    full = [(i, t, "en", "s", len(t or ""), "x", "y", 7) for i, t in rows]
    return spark.createDataFrame(full * repeat, SCHEMA)


def passage(seed: int, words: int = 80) -> str:
    out, x = [], seed * 7919 + 1
    for i in range(words):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("w" + format(x % 100_000, "x") + ("." if i % 9 == 8 else ""))
    return " ".join(out) + "."


AWKWARD = [
    (None, "a null id has a text too"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"),
    (5, passage(1)), (6, passage(1)), (7, passage(1) + " more words here."), (8, passage(2) + "\n" + passage(1)),
    (9, "ÄÖÜ ßé " * 60), (9, "ÄÖÜ ßé " * 60), (9, "another text of the same id"), (10, "a" * 3000),
    (11, "ab" * 2500), (12, passage(3, 6000)), (13, "😀 smile 😀 " * 50), (14, passage(3, 6000)[5000:9000]),
]
