"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on labelled documents; every path from a root gives a
rule, a conjunction of thresholds. A logistic regression with an L1 penalty
keeps the few rules that matter, and these are compiled into one Spark column
expression that scores all documents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample, held_out, materialize, once, words

#: Labelled documents the model is fitted on at most, in the order of a hash of their doc_id.
SAMPLE = 20_000
TREES, DEPTH = 30, 3
PENALTY = 0.0003
SEED = 11

STATS = (
    "n_words", "word_length", "longest_word", "line_words", "symbols", "upper", "digits", "punctuation",
    "closing", "lone_marks", "same_again", "distinct_words", "distinct_lines", "spaces",
)


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows as a struct ``row`` beside the ``STATS`` of their whole texts, as doubles (NULL counts as empty).

    Shares are per character, word or line; all are 0 for a text without words.
    """
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = once(rows, words(F.col("text")), "w")
    rows = once(rows, F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != ""), "lines")
    text, w, lines = F.col("text"), F.col("w"), F.col("lines")

    def count(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    following = F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0)))
    chars, n = F.length(text), F.size(w)
    stats = {
        "n_words": n,
        "word_length": F.length(F.array_join(w, "")) / n,
        "longest_word": F.array_max(F.transform(w, lambda x: F.length(x))),
        "line_words": n / F.size(lines),
        "symbols": count(r"[#*$%&|<>{}\[\]=_~^\\@]") / chars,
        "upper": count(r"\p{Lu}") / chars,
        "digits": count(r"[0-9]") / chars,
        "punctuation": count(r"[.,;:!?]") / chars,
        "closing": F.size(F.filter(w, lambda x: x.rlike(r"[.!?]$"))) / n,
        "lone_marks": F.size(F.filter(w, lambda x: ~x.rlike(r"[\p{L}\p{N}]"))) / n,
        "same_again": F.size(F.filter(F.zip_with(w, following, lambda a, b: a == b), lambda x: x)) / n,
        "distinct_words": F.size(F.array_distinct(w)) / n,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "spaces": count(r"[\x20\x09-\x0D]") / chars,
    }
    numbers = F.struct(*[F.when(F.size("w") > 0, stats[s]).otherwise(0).cast("double").alias(s) for s in STATS])
    return once(rows, numbers, "s").select("row", "s.*")


class Rule(NamedTuple):
    """A conjunction: ``(statistic, threshold, whether it must be above it)``."""

    terms: tuple[tuple[str, float, bool], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for stat, threshold, above in self.terms:
            out = out & ((F.col(stat) > threshold) if above else (F.col(stat) <= threshold))
        return out


class Ensemble(NamedTuple):
    """Weighted rules; the score is the logistic function of their sum."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """One column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def tree_rules(model, stats: Sequence[str]) -> list[Rule]:
    """The distinct paths from the root to every node of every tree, shortened to one threshold a side."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict[tuple[str, bool], float]) -> None:
        if bounds:
            found[Rule(tuple(sorted((s, t, above) for (s, above), t in bounds.items())))] = None
        if node.getClass().getSimpleName() != "InternalNode":
            return
        stat, threshold = stats[node.split().featureIndex()], node.split().threshold()
        for child, above in ((node.leftChild(), False), (node.rightChild(), True)):
            old = bounds.get((stat, above), threshold)
            walk(child, bounds | {(stat, above): max(old, threshold) if above else min(old, threshold)})

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def fit(labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Ensemble:
    """Fit on ``doc_id, label`` (0 or 1) and the statistics; at most ``sample`` rows are used.

    With one class or none the score is a constant: the share of ones, two half labels added.
    """
    rows = hash_sample(labelled, sample, "doc_id", *STATS)
    rows = materialize(rows.select(F.col("label").cast("double"), *STATS))
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        share = (ones + 0.5) / (n + 1)
        return Ensemble(_logit(share), ())
    stats = rows.select("label", array_to_vector(F.array(*STATS)).alias("stats"))
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="stats", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=SEED, minInstancesPerNode=5
    ).fit(stats)
    rules = tree_rules(forest, STATS)
    if not rules:
        return Ensemble(_logit(ones / n), ())
    fired = rows.select("label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("fired"))
    lasso = LogisticRegression(
        labelCol="label", featuresCol="fired", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100
    ).fit(fired)
    kept = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if w)
    return Ensemble(float(lasso.intercept), kept)


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def classify(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Learns from the labels of documents that are not held out; a document with
    several labels counts by their mean, a tie as 0; NULL labels and labels of
    unknown documents are left out. Empty and NULL texts have all statistics 0
    and are scored like any other. Repeated rows are scored one by one.
    """
    stats = statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    stats = materialize(stats.select("row.doc_id", *STATS))
    train = labels.select("doc_id", F.col(label_col).cast("double").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    train = train.where(~held_out(F.col("doc_id"), 4, 2)).groupBy("doc_id").agg((F.avg("label") > 0.5).cast("int").alias("label"))
    score = fit(materialize(stats.join(train, "doc_id"))).score()
    rows = stats.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
