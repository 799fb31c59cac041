"""Dense vectors as ARRAY<DOUBLE> and distances between them.

The expressions are written as Spark SQL text and parsed once in the JVM:
building nested higher-order functions column by column from Python costs
far more driver time than running them on small inputs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance_sql(a: str, b: str) -> str:
    """Sum of squared differences, folded from the first coordinate on.

    Vectors of different length raise an error, as a linear-algebra library
    does; ``zip_with`` alone would pad with NULL.
    """
    return (
        f"CASE WHEN size({a}) != size({b}) THEN raise_error('vectors of different length') "
        f"ELSE aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), 0D, (s, e) -> s + e) END"
    )


def euclidean_sql(a: str, b: str) -> str:
    """Euclidean (not squared) distance."""
    return f"sqrt({squared_distance_sql(a, b)})"


def nearest_sql(v: str, centers: str) -> str:
    """Nearest of ``centers`` (ARRAY<STRUCT<label, center>> sorted by label).

    STRUCT<label INT, dist DOUBLE>; ties go to the lowest label.
    """
    ds = f"transform({centers}, c -> {euclidean_sql(v, 'c.center')})"
    return (
        f"aggregate(zip_with({centers}, {ds}, (c, d) -> named_struct('d', d, 'label', c.label)), "
        f"named_struct('d', double('Infinity'), 'label', -1), "
        f"(acc, e) -> IF(e.d < acc.d OR acc.label < 0, e, acc), "
        f"acc -> named_struct('label', acc.label, 'dist', acc.d))"
    )


def euclidean(a: str, b: str) -> Column:
    return F.expr(euclidean_sql(a, b))


def nearest(v: str, centers: str) -> Column:
    return F.expr(nearest_sql(v, centers))


def round_vector(v: str, digits: int = 6) -> Column:
    return F.expr(f"transform({v}, x -> round(x, {digits}))")
