"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: What separates words.
SPACE = r"[\x20\x09-\x0D]+"


def ship_by_value(module: str) -> None:
    """Pickle the functions of a module by value, so that workers need no install of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def materialize(df: DataFrame, *by: str) -> DataFrame:
    """Write a table into the shared folder, in folders by the columns ``by``, and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, in order (NULL: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that is computed once a row: Catalyst does not copy expressions through a generator."""
    return df.withColumn(name, F.explode(F.array(value)))


def row_key(text: Column) -> Column:
    """What tells rows with the same doc_id apart: a hash of the text (NULL and empty differ)."""
    return F.xxhash64(text, text.isNull())


def as_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (NULL: empty)."""
    return F.coalesce(text, F.lit("")).cast("binary")


def hash_sample(df: DataFrame, at_most: int, *key: str) -> DataFrame:
    """The ``at_most`` rows whose key has the smallest hash, for fitting a model.

    Rows far above that rank are filtered out before anything is sorted, so
    little more than the sample itself moves, whatever the size of the table.
    """
    total = df.count()
    share = min(1.0, (at_most + 6 * at_most**0.5 + 50) / max(1, total))
    rank = F.pmod(F.xxhash64(*key), F.lit(1 << 60))
    near = df.where(rank <= int(share * (1 << 60)))
    return near.orderBy(rank, *key).limit(at_most)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of the doc_id's digits leaves the remainder; a NULL doc_id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


ship_by_value(__name__)
