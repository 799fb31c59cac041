"""Even redistribution into a given number of pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.sources.text import conf_bytes


def spread(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Round-robin ``df`` evenly into ``parts`` pieces; without ``parts`` it stays as it is.

    The shuffle moves all of ``df``. A table of more than ``parts`` file splits
    (``spark.sql.files.maxPartitionBytes``) goes into a multiple of ``parts``,
    so that no task reads more than about a split, whatever the table's size.
    """
    if not parts:
        return df
    split = conf_bytes(df.sparkSession, "spark.sql.files.maxPartitionBytes")
    return df.repartition(parts * max(1, -(-_source_bytes(df) // (parts * split))))


def _source_bytes(df: DataFrame) -> int:
    """The bytes of the files and tables that ``df`` reads, by Catalyst's estimate; those of unknown size do not count."""
    unknown = int(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(n for n in sizes if n < unknown)
