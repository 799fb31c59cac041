"""URL filter: host and path rules, then a list of URLs behind a blocked Bloom filter.

A URL that no rule decides is blocked when its canonical form is listed. The
filter is a bounded table of 64-bit blocks, broadcast to every task: a URL
probes one block, and only possible hits are shuffled to the exact hash join
with the list, which removes false positives. DataFrame functions only.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
QUERY = r"(?s)^.*?://[^?#]*\?([^#]*)"


class Rule(NamedTuple):
    """A verdict (allow or block) for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; empty for NULL and other strings."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, HOST_PATH, 1), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, HOST_PATH, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling per address: no scheme, default port, ``www.``, closing slashes, fragment or ``utm_``
    parameters; the other parameters sorted. NULL where the string has no ``://``."""
    params = F.filter(F.split(F.regexp_extract(url, QUERY, 1), "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    name = F.regexp_replace(F.regexp_replace(host(url), ":(80|443)$", ""), r"^www\.", "")
    query = F.array_join(F.array_sort(params), "&")
    return F.when(
        F.contains(url, F.lit("://")),
        F.concat(name, F.regexp_replace(path(url), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")),
    )


def _chain(rules: Sequence[Rule], fit, value) -> Column:
    out = F.lit(None).cast("string")
    # Built from the shortest up, so that the longest is asked first.
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r)):
        out = F.when(fit(r), F.lit(value(r))).otherwise(out)
    return out


def _mask(key: Column, probes: int) -> Column:
    """``probes`` bits of a 64-bit block."""
    h = F.xxhash64(key, F.lit("bits"))
    out = F.lit(0).cast("long")
    for i in range(probes):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def bloom_table(keys: DataFrame, key: str, blocks: int, probes: int = 4) -> DataFrame:
    """A blocked Bloom filter as a table ``block, word`` of at most ``blocks`` rows."""
    return keys.groupBy(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")).agg(F.bit_or(_mask(F.col(key), probes)).alias("word"))


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[Rule] = (),
    id_col: str = "page_id",
    url_col: str = "url",
    keys_per_block: int = 4,
    max_blocks: int = 1 << 20,
    probes: int = 4,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``listed`` is a table with a column ``url``. The longest rule that fits
    gives the verdict; without one, a page is blocked if its canonical URL is
    listed. The filter has one block per ``keys_per_block`` listed URLs but at
    most ``max_blocks`` (16 MB), which bounds the broadcast: a longer list only
    sends more false positives to the exact join. NULL URLs and strings without
    ``://`` have empty host and path, fit no rule and are allowed; repeated
    rows and repeated or NULL listed URLs are harmless; empty tables work.
    """
    keys = materialize(listed.select(canonical(F.col("url")).alias("listed")).where("listed IS NOT NULL").distinct())
    blocks, total = 1, keys.count()
    while blocks < max_blocks and blocks * keys_per_block < total:
        blocks *= 2
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canonical")
    )

    def fit(r: Rule) -> Column:
        return ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col("path").startswith(r.path)

    ruled = rows.withColumns(
        {"rule": _chain(rules, fit, lambda r: r.host + r.path), "decided": _chain(rules, fit, lambda r: r.verdict)}
    )
    word = bloom_table(keys, "listed", blocks, probes)
    mask = _mask(F.col("canonical"), probes)
    probed = ruled.withColumn("block", F.pmod(F.xxhash64("canonical"), F.lit(blocks))).join(F.broadcast(word), "block", "left")
    possible = F.coalesce(F.col("decided").isNull() & F.col("canonical").isNotNull() & (F.col("word").bitwiseAND(mask) == mask), F.lit(False))
    probed = probed.withColumn("possible", possible)
    columns = ["page_id", "host", "path", "rule"]
    clear = probed.where("NOT possible").select(*columns, F.coalesce("decided", F.lit("allow")).alias("verdict"))
    hits = (
        probed.where("possible")
        .join(keys.hint("shuffle_hash"), F.col("canonical") == F.col("listed"), "left")
        .select(*columns, F.when(F.col("listed").isNotNull(), "block").otherwise("allow").alias("verdict"))
    )
    return clear.unionAll(hits)
