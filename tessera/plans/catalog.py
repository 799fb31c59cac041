"""The registered queries: each reads the driver's tables at ``sf_dir`` in full.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the SQL of :mod:`tessera.plans.oracle`. Doubles are rounded (9
digits for scalars, 6 for vector coordinates and distances) so that results
computed in a different summation order compare equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.vectors import round_vector
from tessera.operators import clustering as C
from tessera.operators import numeric as N
from tessera.operators import wordcount as W
from tessera.operators.partitioning import spread
from tessera.session import ensure_checkpoint_dir
from tessera.sources.points import parse_points, read_points
from tessera.sources.text import lines, parse_numbers, read_documents

# Fixed parameters of the registered clustering queries.
K = 4
PARTS = 4
SEED = 7
KMEDIAN_ITERATIONS = 3
CORESET_ITERATIONS = 2
LLOYD_ITERATIONS = 10
SALTS = 8

SCALAR_DIGITS = 9
VECTOR_DIGITS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _points(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label"
    )


def _seeds(spark, sf_dir):
    return C.seed_centers(_points(spark, sf_dir), K, seed=SEED)


def _r9(c):
    return F.round(c, SCALAR_DIGITS)


# ---- numbers


def q_max_value(spark, sf_dir):
    return N.max_value(table(spark, sf_dir, "lineitem"), "l_quantity")


def q_max_value_sorted(spark, sf_dir):
    return N.max_value_sorted(table(spark, sf_dir, "lineitem"), "l_quantity")


def q_normalize_by_max(spark, sf_dir):
    out = N.normalize_by_max(table(spark, sf_dir, "events"), "value", keep=("event_id",))
    return out.select("event_id", _r9(F.col("normalized")).alias("normalized"))


def q_harmonic_mean(spark, sf_dir):
    out = N.harmonic_mean(table(spark, sf_dir, "lineitem"), "l_quantity")
    return out.select(_r9(F.col("harmonic_mean")).alias("harmonic_mean"))


def q_parse_numbers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws(" ", F.col("l_quantity").cast("string"), F.col("l_tax").cast("string")).alias("value")
    )
    return parse_numbers(li, "value", keep=("l_orderkey", "l_linenumber"))


# ---- texts


def q_lines(spark, sf_dir):
    return lines(_docs(spark, sf_dir), "text", keep=("doc_id",))


def q_tokenize(spark, sf_dir):
    ls = lines(_docs(spark, sf_dir), "text", keep=("doc_id",))
    return W.tokenize(ls, "line", keep=("doc_id", "line_no"))


def q_doc_term_counts(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    return W.doc_term_counts(conv, "text", doc_cols=("conv_id", "turn"))


def q_word_count(spark, sf_dir):
    return W.word_count(_docs(spark, sf_dir))


def q_word_count_salted(spark, sf_dir):
    return W.word_count_salted(_docs(spark, sf_dir), salts=SALTS, seed=SEED)


def q_word_count_partitioned(spark, sf_dir):
    return W.word_count_partitioned(_docs(spark, sf_dir), parts=PARTS)


def q_distinct_word_count(spark, sf_dir):
    return W.distinct_word_count(W.word_count(_docs(spark, sf_dir)))


def q_avg_distinct_word_length(spark, sf_dir):
    out = W.avg_distinct_word_length(W.word_count(_docs(spark, sf_dir)))
    return out.select(_r9(F.col("avg_length")).alias("avg_length"))


def q_word_count_report(spark, sf_dir):
    out = W.word_count_report(_docs(spark, sf_dir), salts=SALTS, seed=SEED, parts=PARTS)
    return out.select("strategy", "distinct_words", _r9(F.col("avg_length")).alias("avg_length"))


def _as_text(spark, df, order, value):
    """A table written as text files, a line a row in the given order, into the shared folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-text-{uuid.uuid4().hex}"
    df.orderBy(*order).select(value).write.text(path)
    return path


def q_read_documents(spark, sf_dir):
    """The lines of all documents, written as a line-per-document text and read again."""
    ls = lines(_docs(spark, sf_dir), "text", keep=("doc_id",))
    return read_documents(spark, _as_text(spark, ls, ("doc_id", "line_no"), "line"))


# ---- points and clustering


def _points_file(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    value = F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), " ")
    return _as_text(spark, emb.select("vec_id", value.alias("value")), ("vec_id",), "value")


def q_read_points(spark, sf_dir):
    """All points, written a line each and read into at least PARTS partitions."""
    out = read_points(spark, _points_file(spark, sf_dir), min_partitions=PARTS)
    return out.select("id", round_vector("v", VECTOR_DIGITS).alias("v"))


def q_kmedian_file(spark, sf_dir):
    """The sequential program from its file on: read the points, cluster them, measure the cost."""
    pts = read_points(spark, _points_file(spark, sf_dir))
    centers = C.kmedian(pts, K, KMEDIAN_ITERATIONS, seed=SEED)
    cost = C.kmedian_cost(pts, centers).select(_r9(F.col("cost"))).scalar()
    return centers.select("label", round_vector("center", VECTOR_DIGITS).alias("center"), cost.alias("cost"))



def q_parse_points(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), " ").alias("value")
    )
    out = parse_points(emb, "value", id_col="vec_id")
    return out.select("id", round_vector("v", VECTOR_DIGITS).alias("v"))


def q_assign_parts(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").select("vec_id")
    return C.assign_parts(emb, PARTS, seed=SEED, id_col="vec_id")


def q_seed_centers(spark, sf_dir):
    s = _seeds(spark, sf_dir)
    return s.select("label", "id", round_vector("center", VECTOR_DIGITS).alias("center"))


def q_assign_nearest(spark, sf_dir):
    out = C.assign_nearest(_points(spark, sf_dir), _seeds(spark, sf_dir))
    return out.select("id", "label", F.round("dist", VECTOR_DIGITS).alias("dist"))


def q_cluster_sizes(spark, sf_dir):
    return C.cluster_sizes(_points(spark, sf_dir), _seeds(spark, sf_dir))


def q_cluster_weights(spark, sf_dir):
    pts = _points(spark, sf_dir).withColumn("weight", F.col("label") + 1)
    out = C.cluster_weights(pts, _seeds(spark, sf_dir), weight_col="weight")
    return out.select("label", _r9(F.col("weight")).alias("weight"))


def q_kmedian_cost(spark, sf_dir):
    out = C.kmedian_cost(_points(spark, sf_dir), _seeds(spark, sf_dir))
    return out.select(_r9(F.col("cost")).alias("cost"))


def q_lloyd_step(spark, sf_dir):
    out = C.lloyd_step(_points(spark, sf_dir), _seeds(spark, sf_dir))
    return out.select("label", round_vector("center", VECTOR_DIGITS).alias("center"))


def q_lloyd(spark, sf_dir):
    out = C.lloyd(_points(spark, sf_dir), _seeds(spark, sf_dir), LLOYD_ITERATIONS)
    return out.select("label", round_vector("center", VECTOR_DIGITS).alias("center"))


def q_kmedian(spark, sf_dir):
    out = C.kmedian(_points(spark, sf_dir), K, KMEDIAN_ITERATIONS, seed=SEED)
    return out.select("label", round_vector("center", VECTOR_DIGITS).alias("center"))


def q_kmedian_with_cost(spark, sf_dir):
    """Clustering of a whole point set as one part, then the mean distance of
    every point to the centers found (the sequential program's output)."""
    pts = _points(spark, sf_dir)
    centers = C.kmedian(pts, K, KMEDIAN_ITERATIONS, seed=SEED)
    cost = C.kmedian_cost(pts, centers).select(_r9(F.col("cost"))).scalar()
    return centers.select("label", round_vector("center", VECTOR_DIGITS).alias("center"), cost.alias("cost"))


def q_kmedian_weighted(spark, sf_dir):
    """Clustering of points that weigh label + 1."""
    pts = _points(spark, sf_dir).withColumn("weight", F.col("label") + 1)
    out = C.kmedian(pts, K, KMEDIAN_ITERATIONS, seed=SEED, weight_col="weight")
    return out.select("label", round_vector("center", VECTOR_DIGITS).alias("center"))


def q_kmedian_cost_parted(spark, sf_dir):
    """The cost over all points of centers without a part, from points that have one."""
    pts = C.assign_parts(_points(spark, sf_dir), PARTS, seed=SEED)
    out = C.kmedian_cost(pts, _seeds(spark, sf_dir))
    return out.select(_r9(F.col("cost")).alias("cost"))


def q_spread_lines(spark, sf_dir):
    """The lines of documents that were dealt evenly into partitions."""
    return lines(spread(_docs(spark, sf_dir), PARTS), "text", keep=("doc_id",))


def q_coreset(spark, sf_dir):
    out = C.coreset(_points(spark, sf_dir), K, PARTS, CORESET_ITERATIONS, seed=SEED)
    return out.select("part", "label", round_vector("center", VECTOR_DIGITS).alias("center"), "w")


def q_kmedian_mr(spark, sf_dir):
    out = C.kmedian_mr(_points(spark, sf_dir), K, PARTS, CORESET_ITERATIONS, seed=SEED)
    return out.select("label", round_vector("center", VECTOR_DIGITS).alias("center"), _r9(F.col("cost")).alias("cost"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "max_value": q_max_value,
    "max_value_sorted": q_max_value_sorted,
    "normalize_by_max": q_normalize_by_max,
    "harmonic_mean": q_harmonic_mean,
    "parse_numbers": q_parse_numbers,
    "lines": q_lines,
    "tokenize": q_tokenize,
    "doc_term_counts": q_doc_term_counts,
    "word_count": q_word_count,
    "word_count_salted": q_word_count_salted,
    "word_count_partitioned": q_word_count_partitioned,
    "distinct_word_count": q_distinct_word_count,
    "avg_distinct_word_length": q_avg_distinct_word_length,
    "word_count_report": q_word_count_report,
    "parse_points": q_parse_points,
    "assign_parts": q_assign_parts,
    "seed_centers": q_seed_centers,
    "assign_nearest": q_assign_nearest,
    "cluster_sizes": q_cluster_sizes,
    "cluster_weights": q_cluster_weights,
    "kmedian_cost": q_kmedian_cost,
    "lloyd_step": q_lloyd_step,
    "lloyd": q_lloyd,
    "kmedian": q_kmedian,
    "kmedian_with_cost": q_kmedian_with_cost,
    "coreset": q_coreset,
    "kmedian_mr": q_kmedian_mr,
    "kmedian_weighted": q_kmedian_weighted,
    "kmedian_cost_parted": q_kmedian_cost_parted,
    "spread_lines": q_spread_lines,
    "read_documents": q_read_documents,
    "read_points": q_read_points,
    "kmedian_file": q_kmedian_file,
}
