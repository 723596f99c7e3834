"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned too: words and word beginnings that mark toxic training documents.
Features are densities per text; trees and calibration are Spark ML models.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm.common import prepare
from tidegate.session import materialize

#: Labelled rows used at most, per class: the bound of the training sample.
SAMPLE_PER_CLASS = 12_000
#: Entries of the learned lexicon at most, and letters of a word beginning.
LEXICON_ROWS = 4_000
STEMS = (4, 5, 6)
#: Words that address the reader, in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine ihr euch sie tu te ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro vuestra".split()
)
WORD = re.compile(r"\w+")
#: A word written to escape a word list: letters mixed with signs or digits, or drawn out.
OBFUSCATED = re.compile(r"[^\W\d_][@$*!|0-9]+[^\W\d_]|([^\W\d_])\1{3,}")
#: Signs read as letters.
PLAIN = str.maketrans("@$!|01345", "asiioieas")
NEAR = 5
FEATURES = [
    "lexicon_strong", "lexicon_strong_hits", "lexicon_weak", "lexicon_weak_hits", "lexicon_best",
    "second_person", "second_person_near", "capital_words", "capital_letters", "marks", "mark_runs",
    "obfuscated", "spelled_out", "words", "mean_word",
]
#: What a token adds to the sums of its text, and tokens remembered at once.
STRONG, WEAK, BEST, PERSON, CAPITAL, CAPITALS, CHARS, MARKS, RUNS, OBFUSCATION, SINGLE = range(11)
REMEMBERED = 400_000


def grams(word: str):
    """The lexicon keys of a lower-case word: itself, and its beginnings marked with *."""
    yield word
    for n in STEMS:
        if len(word) > n:
            yield word[:n] + "*"


def is_held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def learn_lexicon(train: DataFrame) -> dict[str, float]:
    """Key to log odds of toxic over other training documents, for the keys that say most.

    Tasks count keys once per document and pass on partial counts.
    """

    def count(batches):
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                keys = {g for w in set(WORD.findall((text or "").lower())) for g in grams(w)}
                seen[toxic].update(keys)
            keys = list({*seen[0], *seen[1]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()),
                 pa.array([seen[0][k] for k in keys], pa.int64())],
                ["key", "toxic", "other"],
            )

    total = train.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, other = float(total[0] or 0), float(total[1] or 0)
    least = max(2.0, 0.002 * toxic)
    counted = train.select("text", "toxic").mapInArrow(count, "key string, toxic long, other long")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("other") + 0.5) / (other + 1))
    rows = (
        counted.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where(F.col("toxic") >= least).withColumn("odds", odds).where("odds > 2")
        .orderBy(F.desc(F.col("odds") * F.col("toxic")), "key").limit(LEXICON_ROWS).collect()
    )
    return {r.key: r.odds for r in rows}


class Tokens(dict):
    """Token to its row in a table of what it adds; computed when first met."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon
        self.table = np.zeros((1 << 12, 11))

    def __missing__(self, token: str) -> int:
        at = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        row = self.table[at]
        words = WORD.findall(token)
        get = self.lexicon.get
        best = 0.0
        for word in words:
            lower = word.lower()
            best = max(best, max(get(g, 0.0) for g in grams(lower)))
            row[PERSON] += lower in SECOND_PERSON
        if not token.isalpha() and OBFUSCATED.search(token):
            row[OBFUSCATION] = 1
            best = max(best, get(token.lower().strip(".,;:!?").translate(PLAIN), 0.0))
        row[STRONG], row[WEAK], row[BEST] = best > 4, 0 < best <= 4, best
        if token != token.lower():
            row[CAPITALS] = sum(map(str.isupper, token))
            row[CAPITAL] = row[CAPITALS] >= 2 and token.isupper()
        row[CHARS] = len(token)
        row[MARKS] = token.count("!") + token.count("?")
        row[RUNS] = "!!" in token
        row[SINGLE] = len(words) == 1 and len(words[0]) == 1 and words[0].isalpha()
        self[token] = at
        return at


def features(text: str, tokens: Tokens) -> np.ndarray:
    parts = text.split()
    n = len(parts)
    if not n:
        return np.zeros(len(FEATURES))
    if len(tokens) > REMEMBERED:
        tokens.clear()
        tokens.table[:] = 0
    rows = np.fromiter(map(tokens.__getitem__, parts), np.int64, n)
    table = tokens.table[rows]
    total = table.sum(0)
    near = spelled = 0
    if total[PERSON] and total[BEST]:
        person, hit = np.flatnonzero(table[:, PERSON]), np.flatnonzero(table[:, BEST])
        k = np.searchsorted(person, hit)
        after = np.abs(person[np.minimum(k, person.size - 1)] - hit)
        before = np.abs(person[np.maximum(k - 1, 0)] - hit)
        near = int((np.minimum(after, before) <= NEAR).sum())
    if total[SINGLE] >= 4:
        single = table[:, SINGLE] > 0
        spelled = int((single[3:] & single[2:-1] & single[1:-2] & single[:-3]).sum())
    return np.array([
        total[STRONG] / n, total[STRONG], total[WEAK] / n, total[WEAK], table[:, BEST].max(),
        total[PERSON] / n, near / n, total[CAPITAL] / n, total[CAPITALS] / total[CHARS],
        total[MARKS] / total[CHARS], total[RUNS] / n, total[OBFUSCATION] / n, spelled / n,
        np.log1p(n), total[CHARS] / n,
    ])


def with_features(docs: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        tokens = Tokens(shared.value)
        for batch in batches:
            table = [features(t or "", tokens) for t in batch.column("text").cast(pa.string()).to_pylist()]
            columns = np.array(table, np.float64).reshape(-1, len(FEATURES)).T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(c) for c in columns)], [*keep, *FEATURES]
            )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    fields = ", ".join(f"{c} double" for c in FEATURES)
    return docs.select(*keep, "text").mapInArrow(run, f"{kept}, {fields}")


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of training rows: at most SAMPLE_PER_CLASS of each class, chosen
    by a hash of their ids, so that a rerun takes the same."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)").where(~is_held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for kind, n in sizes.items():
        share = F.when(F.col("toxic") == kind, F.lit(min(1.0, SAMPLE_PER_CLASS / n))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    known = known.where(place < share)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample is bounded, so its ids go to the texts instead of the texts to them.
    return texts.join(F.broadcast(known), "doc_id")


class ToxicityModel:
    """Lexicon, trees and calibration; constant where there is only one class to learn from."""

    def __init__(self, lexicon, trees, calibration, prior: float) -> None:
        self.lexicon, self.trees, self.calibration, self.prior = lexicon, trees, calibration, prior

    def score(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """keep and score of every row."""
        if self.trees is None:
            return docs.select(*keep, F.lit(self.prior).alias("score"))
        table = assemble(with_features(docs, self.lexicon, keep))
        raw = with_margin(self.trees.transform(table)).select(*keep, "margin")
        out = self.calibration.transform(raw)
        return out.select(*keep, F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))


def assemble(table: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(table)


def with_margin(table: DataFrame) -> DataFrame:
    return table.withColumn("margin", vector_to_array("rawPrediction")[1])


def train_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from the labels whose crc32(doc_id) mod 5 is not 0.

    Three quarters of the sampled rows grow the trees, the other quarter calibrates; the
    calibration weighs rows back to the shares of all labelled rows. A row that grows the
    trees is seen through a lexicon learned from the other half of them, so that words
    that are rare by chance do not look telling. Without two classes on each side the
    score is the share of toxic rows (0 without any).
    """
    rows = materialize(spark, labelled(docs, labels), "toxicity-train")
    known = labels.where(~is_held_out() & F.col("toxic").isin(0, 1))
    totals = known.agg(F.sum("toxic"), F.count("*")).first()
    prior = float((totals[0] or 0) / totals[1]) if totals[1] else 0.0
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4))
    grow, tune = rows.where(part > 0), rows.where(part == 0)
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    seen = {(r.part, r.toxic): r["count"] for r in rows.groupBy((part > 0).alias("part"), "toxic").count().collect()}
    if len(seen) < 4:
        return ToxicityModel({}, None, None, prior)
    lexicon = learn_lexicon(grow)
    keep = ["doc_id", "toxic"]
    views = [with_features(grow.where(half == i), learn_lexicon(grow.where(half != i)), keep) for i in (0, 1)]
    table = views[0].unionByName(views[1]).unionByName(with_features(tune, lexicon, keep))
    table = materialize(spark, table.withColumn("grow", part > 0), "toxicity-features")
    table = assemble(table)
    trees = GBTClassifier(
        labelCol="toxic", featuresCol="_features", maxIter=20, maxDepth=4, stepSize=0.2, maxBins=64, seed=7,
    ).fit(table.where("grow"))
    share = {1: prior / seen[(False, 1)], 0: (1 - prior) / seen[(False, 0)]}
    # Rows of one margin are one point, so the fit sees at most as many points as the
    # trees have distinct sums.
    points = (
        with_margin(trees.transform(table.where("not grow")))
        .groupBy(F.round("margin", 3).alias("margin"))
        .agg(F.sum("toxic").alias("ones"), F.sum(1 - F.col("toxic")).alias("zeros"))
        .select(
            "margin", (F.col("ones") * share[1] + F.col("zeros") * share[0]).alias("weight"),
            (F.col("ones") * share[1] / (F.col("ones") * share[1] + F.col("zeros") * share[0])).alias("rate"),
        )
    )
    calibration = IsotonicRegression(featuresCol="margin", labelCol="rate", weightCol="weight").fit(points)
    return ToxicityModel(lexicon, trees, calibration, prior)


def toxicity_scores(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, keep: list[str] | None = None
) -> DataFrame:
    """doc_id (or keep), score and predicted of every row of docs.

    A text's score depends on the text alone; null and empty texts have all features 0.
    Rows are scored one by one, so repeated rows get equal scores; ids may be null. Labels
    that are null or neither 0 nor 1 are not learned from, of repeated labels the toxic
    one counts. Other columns are ignored.
    """
    prepare(spark)
    model = train_toxicity(spark, docs, labels)
    scored = model.score(docs, keep or ["doc_id"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
