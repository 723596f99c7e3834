"""The registered queries of the training-text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import arc_convert, line_quality, ngram_join, rmq_search, url_aliases
from tidegate.llm.column_packing import pack_documents
from tidegate.llm.hidden_markov import language_model_scores
from tidegate.llm.lcp_fingerprint import locally_consistent_fingerprints
from tidegate.llm.pfp_dedup import remove_repeated_strings
from tidegate.llm.piece_scan import encode_pieces, encoding_digests
from tidegate.llm.sentence_spans import remove_repeated_sentences
from tidegate.llm.token_alignment import align_tokenizers
from tidegate.llm.toxicity import is_held_out, toxicity_scores


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_arc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_convert.pages_through_archives(spark, table(spark, sf_dir, "pages"))


def op4_lcp_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locally_consistent_fingerprints(spark, table(spark, sf_dir, "documents"))


def op7_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encoding_digests(encode_pieces(spark, table(spark, sf_dir, "documents"), path), path)


def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_sentences(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_sentences", "n_removed", "n_spans", "kept_sha256")


def op6_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_aliases.judge_urls(spark, table(spark, sf_dir, "pages"), url_aliases.RULES)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity_scores(spark, docs, labels).select(
        "doc_id", F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_strings(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op8_column_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(spark, table(spark, sf_dir, "documents"), path)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(spark, table(spark, sf_dir, "documents"))


def op11_rmq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rmq_search.search_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(spark, table(spark, sf_dir, "documents"))


def op13_token_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_tokenizers(spark, table(spark, sf_dir, "documents"), *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_arc_convert": op1_arc_convert,
    "op4_lcp_fingerprint": op4_lcp_fingerprint,
    "op7_piece_scan": op7_piece_scan,
    "op9_sentence_spans": op9_sentence_spans,
    "op6_url_aliases": op6_url_aliases,
    "op2_toxicity": op2_toxicity,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op5_line_quality": op5_line_quality,
    "op8_column_packing": op8_column_packing,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_rmq_search": op11_rmq_search,
    "op12_hidden_markov": op12_hidden_markov,
    "op13_token_windows": op13_token_windows,
}

ORACLES: dict[str, str] = {
    "op1_arc_convert": arc_convert.ORACLE_SQL,
    "op5_line_quality": line_quality.oracle_sql(),
    "op6_url_aliases": url_aliases.oracle_sql(url_aliases.RULES),
    "op10_ngram_jaccard_join": ngram_join.oracle_sql(),
    "op11_rmq_search": rmq_search.oracle_sql(),
}
