"""Reproducible randomness from a hash of (seed, round, id).

A draw is a pure function of its inputs, so a retried task or a lost
executor recomputes exactly the same value, and plain SQL can reproduce it.
The expressions are Spark SQL text: cheap to build on the driver once per
round.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits of md5 give 52 random bits.
HASH_HEX_DIGITS = 13
HASH_SPAN = 2**52


def _part(p) -> str:
    if isinstance(p, bool):
        raise TypeError("bool is not a hash input")
    if isinstance(p, (int, str)):
        return "'" + str(p).replace("'", "''") + "'"
    if isinstance(p, SqlText):
        return f"CAST({p.sql} AS STRING)"
    raise TypeError(f"hash inputs are ints, strings or SqlText, not {type(p).__name__}")


class SqlText:
    """A column or expression given as Spark SQL text."""

    def __init__(self, sql: str):
        self.sql = sql


def col(name: str) -> SqlText:
    return SqlText(f"`{name}`")


def hash52_sql(*parts) -> str:
    """Integer in [0, 2^52) from md5 of the parts joined by ':'."""
    joined = ", ".join(_part(p) for p in parts)
    return f"CAST(conv(substring(md5(concat_ws(':', {joined})), 1, {HASH_HEX_DIGITS}), 16, 10) AS BIGINT)"


def uniform_sql(*parts) -> str:
    """Uniform double in the open interval (0, 1)."""
    return f"(CAST({hash52_sql(*parts)} + 1 AS DOUBLE) / {float(HASH_SPAN + 1)!r})"


def bucket_sql(n: int, *parts) -> str:
    """Integer in [0, n) spread evenly by the hash of the parts."""
    return f"CAST(pmod({hash52_sql(*parts)}, {int(n)}) AS INT)"


def bucket(n: int, *parts) -> Column:
    return F.expr(bucket_sql(n, *parts))
