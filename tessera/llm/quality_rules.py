"""Quality rules: plain text statistics and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into a fixed number of buckets. Two smoothed
multinomials over the buckets, one of a trusted target and one of the raw
corpus, give every bucket a log-likelihood ratio; a document's score is the
mean ratio of its n-grams, and documents below a fixed threshold go.
Every labelled document counts. DataFrame functions only; scoring moves no text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import once, words

BUCKETS = 8192
SMOOTHING = 1.0
#: Mean log-likelihood ratio (natural log) below which a document goes.
THRESHOLD = -0.1
WINDOW = 8


def _word_hashes(docs: DataFrame, text_col: str) -> DataFrame:
    """``text, w, h``: the text, its words and their hashes, each computed once a row."""
    out = docs.withColumn("text", F.coalesce(F.col(text_col), F.lit("")))
    return once(once(out, words(F.col("text")), "w"), F.transform("w", lambda x: F.xxhash64(x)), "h")


def _pair(a: Column, b: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(a, b), F.lit(buckets))


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how often each bucket's words and word pairs occur in the whole texts."""
    h = _word_hashes(docs.select(F.col(text_col).alias("text")), "text").select("h")
    pairs = h.select(F.inline(F.arrays_zip(F.col("h").alias("a"), F.slice("h", 2, F.greatest(F.size("h") - 1, F.lit(0))).alias("b")))).toDF("a", "b")
    one = F.pmod("a", F.lit(buckets))
    grams = F.when(F.col("b").isNull(), F.array(one)).otherwise(F.array(one, _pair(F.col("a"), F.col("b"), buckets)))
    return pairs.select(F.explode(grams).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def bucket_ratios(target: DataFrame, raw: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[float]:
    """The log-likelihood ratio of every bucket (``buckets`` numbers) from two ``bucket, n`` tables."""
    spark = raw.sparkSession
    both = target.select("bucket", F.col("n").alias("t"), F.lit(0).cast("long").alias("r")).unionAll(
        raw.select("bucket", F.lit(0).cast("long"), F.col("n"))
    )
    every = both.unionAll(spark.range(buckets).select("id", F.lit(0).cast("long"), F.lit(0).cast("long")))
    rows = sorted(every.groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("r").alias("r")).collect())
    if not any(r.t for r in rows):
        return [0.0] * buckets
    t_all, r_all = (sum(r[i] for r in rows) + smoothing * buckets for i in (1, 2))
    return [math.log((t + smoothing) / t_all) - math.log((r + smoothing) / r_all) for _, t, r in rows]


def _repeated_words(keys: Column) -> Column:
    """How many words lie in windows whose key occurs twice or more."""
    by_key = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    twice = F.transform(
        F.array(by_key),
        lambda s: F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["k"] == x["k"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False))),
    )[0]
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p + WINDOW - acc["end"])).alias("n"), (p + WINDOW).alias("end")),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(covered)


def judge(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as a struct ``row`` beside ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, llr, kept``.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated
    eight-word windows. ``llr`` is the mean bucket ratio of all words and word
    pairs (0 without words). ``kept`` is false if base_failed or if ``llr`` is
    under the threshold. NULL counts as empty; any other column only rides along.
    """
    buckets = len(ratios)
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    rows = _word_hashes(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), "text")
    windows = F.when(
        F.size("h") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("h") - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = once(rows, windows, "keys")
    text, w, h = F.col("text"), F.col("w"), F.col("h")
    rows = once(rows, F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), "lines")
    singles = F.aggregate(h, F.lit(0.0), lambda acc, x: acc + F.get(table, F.pmod(x, F.lit(buckets)).cast("int")))
    after = F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0)))
    pairs = F.aggregate(
        F.zip_with(h, after, lambda a, b: F.when(b.isNull(), 0.0).otherwise(F.get(table, _pair(a, b, buckets).cast("int")))),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    rows = once(
        rows,
        F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            _repeated_words(F.col("keys")).cast("long").alias("n_repeat_words"),
            F.when(F.size(h) > 0, (singles + pairs) / (2 * F.size(h) - 1)).otherwise(0.0).alias("llr"),
        ),
        "s",
    ).select("row", "s.*")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The target: every document labelled quality 1 (``doc_id, text``).

    The labels grow with the corpus, so their ids are not broadcast: both sides
    are dealt out by doc_id, which moves the texts once and sorts none.
    """
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.select("doc_id", "text").join(ids.hint("shuffle_hash"), "doc_id", "left_semi")


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """:func:`judge` with ratios between the trusted documents and all of ``docs``.

    Without any trusted document all ratios are 0, and only the plain rules decide.
    """
    ratios = bucket_ratios(bucket_counts(trusted(docs, labels)), bucket_counts(docs))
    return judge(docs, ratios, threshold)
