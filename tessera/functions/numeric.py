"""Numeric helpers that keep Java's floating-point results under ANSI SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reciprocal(x: Column) -> Column:
    """1/x with 1/0 = +Infinity and 1/-0 = -Infinity, never an error."""
    infinite = F.when(x.cast("string") == "-0.0", F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(x == 0, infinite).otherwise(F.lit(1.0) / x)
