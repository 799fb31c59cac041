"""Points (dense vectors) from text lines or array columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import split_words
from tessera.sources.text import _number, numbered_lines, with_line_ids


def _checked(v):
    bad = F.exists(v, lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(bad, F.raise_error(F.lit("non-finite coordinate in a point"))).otherwise(v)


def parse_points(df: DataFrame, text_col: str = "value", id_col: str | None = None) -> DataFrame:
    """Doubles separated by single spaces, one point per row: ``id, v``.

    An empty token (two spaces in a row) fails the cast, as in Java. Without
    ``id_col`` the id comes from the line itself (:func:`with_line_ids`).
    """
    if id_col is None:
        df, id_col = with_line_ids(df, text_col, "id"), "id"
    v = F.transform(split_words(F.col(text_col)), _number)
    return df.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), _checked(v).alias("v"))


def read_points(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """A point-per-line text file or folder as ``id BIGINT, v ARRAY<DOUBLE>``.

    The id is the line's number (:func:`numbered_lines`). ``min_partitions``
    deals the points into so many partitions; without it Spark's settings decide.
    """
    points = parse_points(numbered_lines(spark, path, "id"), "value", id_col="id")
    return points.repartition(min_partitions, "id") if min_partitions else points
