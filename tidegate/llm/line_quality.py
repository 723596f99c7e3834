"""Line-first cleaning with built-in functions only.

Each line is judged by itself on punctuation, navigation and boilerplate; failing lines
go, and a document that loses too much of its text to that is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Blanks that separate words, symbols that are counted, ends of a sentence.
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
SENTENCE_ENDS = [".", "!", "?", "…", ":", ";", '"', "'", "”", "’", "»", ")", "]"]
#: Phrases of page furniture, in lower case.
BOILERPLATE = [
    "all rights reserved", "terms of use", "privacy policy", "cookie policy", "we use cookies",
    "enable javascript", "lorem ipsum", "click here to", "sign in to", "subscribe to our",
]
WORD = r"[^\x20\x09-\x0D]"
GAP = r"[\x20\x09-\x0D]+"
#: Separators from which a line counts as navigation, symbols per words from which it
#: counts as markup, and the share of word characters a document must keep, in percent.
MOST_SEPARATORS = 3
MOST_SYMBOLS_PERCENT = 50
LEAST_KEPT_PERCENT = 50
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(value: Column) -> Column:
    """value, computed where it stands. A filter on the result is else pushed below, with
    the columns it needs written out in full: words would be split again for every word."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def count_chars(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def word_chars(text: Column) -> Column:
    return F.char_length(F.translate(text, BLANKS, ""))


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, GAP)).otherwise(F.array().cast("array<string>"))


def repeated_words(windows: Column) -> Column:
    """Words that lie in windows found at least twice, from the windows' hashes in order.

    Sorting (hash, place) brings equal windows together; the places so found are sorted
    again and their unions of three words are added up. Texts without a repeated window,
    which are most, stop at a set of hashes.
    """
    empty = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reach"))

    def places(order: Column) -> Column:
        near = F.filter(
            order,
            lambda x, i: x["h"].eqNullSafe(F.get(order, i + 1)["h"])
            | x["h"].eqNullSafe(F.get(order, i - 1)["h"]),
        )
        return F.sort_array(F.transform(near, lambda x: x["at"].cast("long")))

    def add(so_far: Column, at: Column) -> Column:
        return F.struct(
            (so_far["total"] + at + 3 - F.greatest(at, so_far["reach"])).alias("total"),
            (at + 3).alias("reach"),
        )

    tagged = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    total = F.aggregate(let(tagged, places), empty, add, lambda x: x["total"])
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), total).otherwise(F.lit(0).cast("long"))


def good_line(line: Column) -> Column:
    """A line stays if it ends like a sentence, is no navigation, no markup, no boilerplate.
    Lines without a word are neutral and stay."""
    bare = F.btrim(line, F.lit(BLANKS))
    lower = F.lower(line)
    furniture = F.lit(False)
    for phrase in BOILERPLATE:
        furniture = furniture | F.contains(lower, F.lit(phrase))
    words = F.size(F.split(bare, GAP))
    return (bare == "") | (
        F.right(bare, F.lit(1)).isin(SENTENCE_ENDS)
        & (count_chars(line, "|»›•·") < MOST_SEPARATORS)
        & (count_chars(line, SYMBOLS) * 100 <= words * MOST_SYMBOLS_PERCENT)
        & ~furniture
    )


def clean_lines(docs: DataFrame, least_kept_percent: int = LEAST_KEPT_PERCENT) -> DataFrame:
    """All columns of docs, and clean_text, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, kept_chars, base_failed, kept.

    A null or blank text has no words and fails the base rules; clean_text is the text
    without its failing lines (null for null). Each row is judged alone: repeated rows and
    ids do not matter, and columns of docs named like the new ones are replaced. One row
    costs time in proportion to n log n of its own words; nothing is exchanged.
    """
    new = ["clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "kept_chars", "base_failed", "kept"]
    others = [c for c in docs.columns if c not in new]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    step = docs.select(row, once(words_of(text)).alias("_words"), once(F.split(text, "\n")).alias("_lines"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    step = step.select(
        "row", "_lines", F.size("_words").cast("long").alias("n_words"),
        once(F.when(
            F.size("_words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - 3),
                lambda i: F.xxhash64(
                    F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)
                ),
            ),
        ).otherwise(F.array().cast("array<long>"))).alias("_windows"),
        F.filter("_lines", lambda x: x.rlike(WORD)).alias("_full"),
        once(F.filter("_lines", good_line)).alias("_good"),
    )
    step = step.select(
        *[F.col("row").getField(c).alias(c) for c in others],
        F.when(F.col("row.text").isNotNull(), F.array_join("_good", "\n")).alias("clean_text"),
        "n_words",
        word_chars(text).cast("long").alias("word_chars"),
        count_chars(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        once(repeated_words(F.col("_windows"))).alias("n_repeat_words"),
        F.coalesce(word_chars(F.array_join("_good", "\n")), F.lit(0)).cast("long").alias("kept_chars"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    enough = F.col("kept_chars") * 100 >= F.col("word_chars") * least_kept_percent
    return step.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)


def quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def oracle_sql(least_kept_percent: int = LEAST_KEPT_PERCENT) -> str:
    """The same columns in DuckDB's SQL, by windows as rows instead of arrays."""
    gap, word = "[\\x20\\x09-\\x0D]+", "[^\\x20\\x09-\\x0D]+"
    symbols = "".join(SYMBOLS)
    furniture = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '{word}') AS ws FROM d),
win AS (
  SELECT r, i, struct_pack(a := ws[i], b := ws[i + 1], c := ws[i + 2]) AS g
  FROM w, unnest(range(1, len(ws) - 1)) AS t(i)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM hit, unnest([0, 1, 2]) AS t(k) GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
b AS (SELECT *, regexp_replace(regexp_replace(line, '^{gap}', ''), '{gap}$', '') AS bare FROM l),
j AS (
  SELECT r, bare <> '' AS wordy, line, length(regexp_replace(line, '{gap}', '', 'g')) AS chars,
         bare = '' OR (
           right(bare, 1) IN ({quoted(SENTENCE_ENDS)})
           AND length(line) - length(translate(line, '|»›•·', '')) < {MOST_SEPARATORS}
           AND (length(line) - length(translate(line, '{symbols}', ''))) * 100
               <= len(regexp_extract_all(bare, '{word}')) * {MOST_SYMBOLS_PERCENT}
           AND NOT ({furniture})) AS good
  FROM b),
ln AS (
  SELECT r, count(*) FILTER (WHERE wordy) - count(DISTINCT line) FILTER (WHERE wordy) AS dup,
         coalesce(sum(chars) FILTER (WHERE good), 0) AS kept_chars
  FROM j GROUP BY r),
m AS (
  SELECT doc_id, len(ws) AS n_words,
         length(regexp_replace(text, '{gap}', '', 'g')) AS word_chars,
         length(text) - length(translate(text, '{symbols}', '')) AS n_symbols,
         ln.dup AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, kept_chars
  FROM d JOIN w USING (r) JOIN ln USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words)
         AND kept_chars * 100 >= word_chars * {least_kept_percent} AS kept
FROM m
"""
