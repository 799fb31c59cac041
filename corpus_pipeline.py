"""The corpus pipeline: from raw documents to a mixed training corpus.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps,
with all their columns; its result is written as Parquet and read again as the
next stage's documents. The last stage returns every document as often as the
mix takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, lines, mixing, quality_rules, simhash
from tessera.llm.common import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules.quality_rules(docs, _table(spark, sf_dir, "labels"))
    return judged.where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks they have in common with earlier ones; those with nothing left go."""
    return lines.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: 4-word shingles, at most 4 differing bits."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: sources at their target weights, a row for every copy taken."""
    return mixing.take_copies(docs, weights=(5, 2, 1), total_share=1.5, limit=2.0)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mixing", mix),
]

#: SQL has no counterpart of the fingerprints' hash, the alignment and the draws; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents."""
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
