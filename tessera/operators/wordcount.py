"""Word counts over line documents, three strategies, and statistics of the words.

A document is a line of text (a row's text is cut into lines first). Words are
split on the single space character with ``String.split(" ")`` rules.

Scale notes. ``explode`` streams tokens inside each task; every strategy ends in
a hash aggregate whose partial (map-side) step combines repeated words within a
task before the shuffle, so a word that holds a third of all tokens still sends
at most one row per task. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import char_length, split_words
from tessera.operators.partitioning import spread
from tessera.sources.text import lines


def tokenize(df: DataFrame, text_col: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """One row per word of each text: ``keep..., pos INT, word STRING``."""
    return df.where(F.col(text_col).isNotNull()).select(
        *keep, F.posexplode(split_words(F.col(text_col))).alias("pos", "word")
    )


def _words(docs: DataFrame, text_col: str, id_col: str, parts: int | None) -> DataFrame:
    docs = spread(docs.select(id_col, text_col), parts)
    ls = lines(docs, text_col, keep=(id_col,))
    return ls.select(id_col, "line_no", F.explode(split_words(F.col("line"))).alias("word"))


def doc_term_counts(df: DataFrame, text_col: str = "text", doc_cols: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per-document word histogram: ``doc_cols..., word, tf BIGINT``.

    The text of a document is split into words as a whole (no line cut).
    """
    words = df.select(*doc_cols, text_col).where(F.col(text_col).isNotNull()).select(
        *doc_cols, F.explode(split_words(F.col(text_col))).alias("word")
    )
    return words.groupBy(*doc_cols, "word").agg(F.count(F.lit(1)).alias("tf"))


def word_count(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Strategy 1: ``word, n BIGINT`` over all lines of all documents.

    The reference combines within each document and then sums by word. Here
    the partial aggregate combines within each task, which covers every
    document of the task, and the final aggregate sums by word: one exchange.
    """
    return _words(docs, text_col, id_col, parts).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_salted(
    docs: DataFrame,
    salts: int = 8,
    seed: int = 0,
    text_col: str = "text",
    id_col: str = "doc_id",
    parts: int | None = None,
) -> DataFrame:
    """Strategy 2: two rounds through a random key in [0, salts).

    Round 1 groups by (salt, word) and round 2 by word alone, so no reducer of
    round 1 sees more than about 1/salts of a hot word's rows even without the
    map-side combine. The key is a hash of (seed, document, line, word): every
    occurrence of a word in a line gets the same key (the per-document combine
    stays valid), and a retried task draws the same keys.
    """
    w = _words(docs, text_col, id_col, parts)
    salt = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col("line_no"), F.col("word")), F.lit(salts))
    salted = w.select(salt.alias("salt"), "word")
    partial = salted.groupBy("salt", "word").agg(F.count(F.lit(1)).alias("n"))
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def word_count_partitioned(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", parts: int | None = None
) -> DataFrame:
    """Strategy 2-bis: combine inside each partition, then sum by word.

    Spark's partial/final aggregate does this: the partial step is the
    per-partition combine. With ``parts`` (the reference's ``K``) the documents
    are dealt evenly into so many partitions first, which moves their texts;
    without it the plan is that of :func:`word_count`.
    """
    return word_count(docs, text_col, id_col, parts)


def distinct_word_count(counts: DataFrame) -> DataFrame:
    """One row ``distinct_words BIGINT`` from a ``word, n`` table."""
    return counts.agg(F.count(F.lit(1)).alias("distinct_words"))


def avg_distinct_word_length(counts: DataFrame, units: str = "codepoints") -> DataFrame:
    """One row ``avg_length DOUBLE``: mean length over distinct words (not weighted
    by count); NULL when there is no word. ``units='utf16'`` counts as Java does."""
    return counts.agg(F.avg(char_length(F.col("word"), units).cast("double")).alias("avg_length"))


STRATEGIES = ("word_count", "word_count_salted", "word_count_partitioned")


def word_count_report(
    docs: DataFrame,
    salts: int = 8,
    seed: int = 0,
    text_col: str = "text",
    id_col: str = "doc_id",
    parts: int | None = None,
    units: str = "codepoints",
) -> DataFrame:
    """``strategy, distinct_words, avg_length``: one row per strategy.

    The documents are dealt out (into ``parts``, if given), read, cut into
    words and combined within each task once for all strategies. The combined
    counts then go three ways to the sums by word: straight, through a salt,
    and through the partition. Lengths count in ``units``, as in
    :func:`avg_distinct_word_length`.
    """
    words = _words(docs, text_col, id_col, parts)
    salt = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col("line_no"), F.col("word")), F.lit(salts)).cast("int")
    combined = words.select("word", salt.alias("salt"), F.spark_partition_id().alias("task"))
    combined = combined.groupBy("word", "salt", "task").agg(F.count(F.lit(1)).alias("n"))
    ways = [F.struct(F.lit(i).alias("way"), k.alias("key")) for i, k in enumerate((F.lit(-1), F.col("salt"), F.col("task")))]
    keyed = combined.select("word", "n", F.inline(F.array(*ways)))
    counts = keyed.groupBy("way", "key", "word").agg(F.sum("n").alias("n")).groupBy("way", "word").agg(F.sum("n").alias("n"))
    measured = counts.groupBy("way").agg(
        F.count(F.lit(1)).alias("distinct_words"), F.avg(char_length(F.col("word"), units).cast("double")).alias("avg_length")
    )
    # A strategy that saw no word has its row, too.
    names = docs.sparkSession.range(len(STRATEGIES), numPartitions=1).select(
        F.col("id").cast("int").alias("way"), F.get(F.array(*map(F.lit, STRATEGIES)), F.col("id").cast("int")).alias("strategy")
    )
    out = names.join(F.broadcast(measured), "way", "left")  # at most one row a strategy
    return out.select("strategy", F.coalesce("distinct_words", F.lit(0)).alias("distinct_words"), "avg_length")
