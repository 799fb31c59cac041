"""Global maximum, normalization by it, and harmonic mean of the normalized values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import reciprocal

_ZERO_MAX = "the maximum is 0: normalization by it is undefined"


def max_value(df: DataFrame, col: str) -> DataFrame:
    """One row ``max_value``: the maximum of a column, NULL for no rows.

    Partial maxima per task, one row per task through the shuffle. NaN wins,
    as with ``Math.max``.
    """
    return df.agg(F.max(F.col(col).cast("double")).alias("max_value"))


def max_value_sorted(df: DataFrame, col: str) -> DataFrame:
    """The same maximum through an ordering (a top-1 per task, then merged).

    NaN sorts above every number, as with ``Double.compare``. NULLs are skipped.
    """
    x = F.col(col).cast("double")
    top = df.where(x.isNotNull()).select(x.alias("max_value")).orderBy(F.col("max_value").desc()).limit(1)
    # A global aggregate always yields one row, so no rows in gives NULL.
    return top.agg(F.max("max_value").alias("max_value"))


def normalize_by_max(
    df: DataFrame, col: str, keep: Sequence[str] = (), out: str = "normalized"
) -> DataFrame:
    """Each value divided by the global maximum: ``keep..., <out>``.

    The maximum is a scalar subquery: Spark computes it once (partial maxima,
    one row per task) and folds it into the projection, so no join and no
    data reaches the driver. A maximum of 0 raises an error.
    """
    x = F.col(col).cast("double")
    m = F.max(x)
    mx = df.agg(F.when(m == 0, F.raise_error(F.lit(_ZERO_MAX)).cast("double")).otherwise(m)).scalar()
    return df.where(x.isNotNull()).select(*keep, (x / mx).alias(out))


def harmonic_mean(df: DataFrame, col: str) -> DataFrame:
    """One row ``harmonic_mean`` of the values divided by their maximum: n / sum(1 / (x / max)).

    The same doubles as Java: a value of 0 makes its reciprocal infinite and
    the mean 0; a NaN value, or an infinite maximum, makes it NaN. NULL for no
    rows; a maximum of 0 raises an error. Two scans: the maximum is a scalar
    subquery, as in :func:`normalize_by_max`, since scaling the sum of 1/x
    afterwards would lose tiny and infinite values.
    """
    inverse = normalize_by_max(df, col).select(reciprocal(F.col("normalized")).alias("inv"))
    n, total = F.count("inv"), F.sum("inv")
    # An infinite sum gives 0 and a NaN one NaN; the sum is 0 only if infinities are missing, so never.
    mean = F.when(n == 0, F.lit(None).cast("double")).otherwise(n / total)
    return inverse.agg(mean.alias("harmonic_mean"))
