"""From raw documents to packed sequences: clean, drop toxic text and near copies, cut
repeated passages, pack.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), with docs as
the stage before it wrote them, and returns a DataFrame. run(spark, sf_dir) applies them
in order, writing every result to the shared folder before the next stage reads it.

In every stage a null text counts as empty, rows with a null id and repeated rows are rows
of their own, columns beyond those of documents are dropped, and an empty table gives an
empty one. Row order decides nothing: where one of several rows stays, ids decide, then the
text's hash, null ids last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm.column_packing import pack_documents
from tidegate.llm.common import prepare, text_tie
from tidegate.llm.line_quality import clean_lines
from tidegate.llm.ngram_join import keep_first_of_groups
from tidegate.llm.pfp_dedup import remove_repeated_strings
from tidegate.llm.toxicity import toxicity_scores
from tidegate.session import materialize

#: SQL has no counterpart of the classifier and the tokenizer; tests compare the stages
#: with plain versions instead.
ORACLE_SQL = None
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a passage that is cut where it repeats: over 50.
PASSAGE_WORDS = 51


def recounted(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted anew from the text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without their failing lines. A null or empty text
    has too few words and goes; repeated rows share their fate."""
    prepare(spark)
    kept = clean_lines(docs).where("kept")
    return recounted(kept.drop("text").withColumnRenamed("clean_text", "text"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, judged by a model learned from the labelled ones here. A
    row with a null id is judged too and never learned from; without labels nothing goes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # Scores go by id and a hash of the text; only those two pass through the model.
    keyed = docs.withColumn("tie", text_tie())
    scored = toxicity_scores(spark, keyed, labels, keep=["doc_id", "tie"]).where("predicted = 0")
    clean = scored.select(F.col("doc_id").alias("clean_id"), F.col("tie").alias("clean_tie")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("clean_id")) & (F.col("tie") == F.col("clean_tie"))
    return keyed.join(clean, same, "left_semi").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id; of equal rows one.
    Texts without words are copies of none and stay."""
    return keep_first_of_groups(spark, docs).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the byte strings and the passages of over 50 words that also
    stand elsewhere. A null text comes back empty; every place of a repeated string is cut."""
    return recounted(remove_repeated_strings(spark, docs, words=PASSAGE_WORDS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens. An empty text is its end id;
    ties between pieces are broken by id, place and digest."""
    return pack_documents(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("n-gram jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
