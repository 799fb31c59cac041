"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies. The
fractional parts are rounded two by two: a pair moves words from one document
to the other, in a random direction that keeps both expectations, until one of
them is whole. Groups of one source and one hash bucket are rounded in
parallel, each leaves at most one fractional document, and these residuals are
paired again in a tree of ever fewer buckets. So the words that a source's
documents contribute stay at the target but for the root's last document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, row_key, ship_by_value, words

#: Documents of all sources together in one hash bucket, and residuals that meet in one bucket of the next level.
BUCKET_ROWS, FAN_IN = 1 << 11, 64

ROW = "doc_id long, row_key long, source string, size long, source_size long, target double, whole int, share double, bucket long"
_M64 = (1 << 64) - 1


def source_targets(
    sources: DataFrame, weights: Sequence[float] = (5, 2, 1), total_share: float = 1.5, limit: float = 2.0
) -> DataFrame:
    """``source, source_size`` to ``source, source_size, target``.

    Sources take the weights in turn by code point, NULL last, and share
    ``total_share`` of all sizes; a target stops at ``limit`` times its
    source's size and the excess is shared by weight among the others.
    """
    spark = sources.sparkSession
    ranked = sources.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    turn = tuple(float(w) for w in weights)
    ranked = ranked.map(lambda x: (x[0][0], x[0][1], turn[x[1] % len(turn)]))
    table = materialize(spark.createDataFrame(ranked, "source string, source_size long, weight double"))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    cap = limit * F.col("source_size")
    # The level at which the targets add up: it only rises as more sources reach their cap.
    level = 0.0
    while True:
        over = F.col("weight") * level > cap
        capped, open_ = table.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if open_ is None:
            break
        raised = (total_share * total - (capped or 0.0)) / open_
        if raised <= level:
            break
        level = raised
    return table.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))


def _draw(key: int, level: int) -> float:
    """A reproducible number in [0, 1) for a document and a level of the tree (splitmix64)."""
    x = (key + 0x9E3779B97F4A7C15 * (level + 1)) & _M64
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M64
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def pivot(size_i: float, p_i: float, size_j: float, p_j: float, u: float) -> tuple[float, float]:
    """Move words between two fractional documents until one is whole; ``u`` picks the direction."""
    up = min(size_i * (1 - p_i), size_j * p_j)
    down = min(size_i * p_i, size_j * (1 - p_j))
    if u * (up + down) < down:  # i gains with probability down / (up + down): both expectations stay
        if size_i * (1 - p_i) <= size_j * p_j:
            return 1.0, _whole(p_j - up / size_j)
        return _whole(p_i + up / size_i), 0.0
    if size_i * p_i <= size_j * (1 - p_j):
        return 0.0, _whole(p_j + down / size_j)
    return _whole(p_i - down / size_i), 1.0


def _whole(p: float) -> float:
    return 0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p


def _round_level(rows: DataFrame, level: int, buckets: int) -> DataFrame:
    """Round every (source, bucket) group, largest documents first; at most one row of each stays fractional."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, open_ = None, None  # open_: [row, share] that waits for a partner
        for b in batches:
            cols = {n: b.column(n).to_pylist() for n in ("source", "bucket", "size", "share", "row_key", "doc_id")}
            share, kept = cols["share"], []
            for k in range(b.num_rows):
                here = (cols["source"][k], cols["bucket"][k])
                if here != group:
                    if open_ is not None:
                        kept.append(open_)
                    group, open_ = here, None
                p = share[k]
                if not 0.0 < p < 1.0:
                    continue
                if open_ is None:
                    open_ = [b.slice(k, 1), p, k, b]
                    continue
                u = _draw((cols["row_key"][k] ^ hash((cols["doc_id"][k] or 0, 1))) & _M64, level)
                size = open_[0].column("size")[0].as_py()
                open_[1], share[k] = pivot(size, open_[1], cols["size"][k], p, u)
                if open_[1] in (0.0, 1.0):
                    kept.append(open_)
                    open_ = [b.slice(k, 1), share[k], k, b] if 0.0 < share[k] < 1.0 else None
            # Documents that were or are open are returned by themselves, once their share is known.
            mine = {x[2] for x in [*kept, *([open_] if open_ else [])] if x[3] is b}
            rest = [k for k in range(b.num_rows) if k not in mine]
            at = b.schema.get_field_index("share")
            if rest:
                yield b.set_column(at, "share", pa.array(share, pa.float64())).take(pa.array(rest))
            for row, p, _, _ in kept:
                yield row.set_column(at, "share", pa.array([p], pa.float64()))
        if open_ is not None:
            row = open_[0]
            yield row.set_column(row.schema.get_field_index("share"), "share", pa.array([open_[1]], pa.float64()))

    order = ["source", "bucket", F.col("size").desc(), "row_key", "doc_id"]
    parts = max(1, min(buckets, 10_000))
    return materialize(rows.repartition(parts, "source", "bucket").sortWithinPartitions(*order).mapInArrow(step, ROW))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    total_share: float = 1.5,
    limit: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per input row: ``doc_id, row_key, size, source, source_size, target, copies, taken``.

    ``size`` is the number of words (NULL text: 0), ``copies`` how often the
    mix takes the document and ``taken`` = copies x size. Draws depend on
    doc_id and text only, so reruns agree on any cluster; repeated rows are
    rounded one by one and are interchangeable. Documents without words cost
    nothing: each gets its copies by a draw of its own. A source without words
    has target 0 and keeps one copy of each. A NULL source is a source like any
    other, last in the order. An empty table gives an empty result.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), row_key(text).alias("row_key"), F.col(source_col).alias("source"),
        F.size(words(text)).cast("long").alias("size"),
    )
    rows = materialize(rows)
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sources, weights, total_share, limit))
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    rows = rows.withColumnRenamed("source", "of").join(targets, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    rows = rows.withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("int"))
    unit = F.shiftrightunsigned(F.xxhash64("doc_id", "row_key", F.lit("draw")), 11) / F.lit(float(1 << 53))
    fraction = F.col("rate") - F.col("whole")
    share = F.when(fraction < 1e-9, 0.0).when(fraction > 1 - 1e-9, 1.0).otherwise(fraction)
    rows = rows.select(
        "doc_id", "row_key", "source", "size", "source_size", "target", "whole",
        F.when(F.col("size") > 0, share).otherwise((unit < fraction).cast("double")).alias("share"),
        F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(buckets)).alias("bucket"),
    )
    done, level, whole = [], 0, F.col("share").isin(0.0, 1.0)
    while True:
        # Level 0 carries every document; the levels above only residuals, one per source and bucket at most.
        rounded = _round_level(rows, level, max(buckets, 8))
        done.append(rounded.where(whole))
        rows = rounded.where(~whole)
        if buckets == 1:
            break
        buckets = -(-buckets // FAN_IN)
        rows, level = rows.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN)), level + 1
    done.append(rows.withColumn("share", (unit < F.col("share")).cast("double")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("whole") + F.col("share").cast("int")).alias("copies")
    return out.select("doc_id", "row_key", "size", "source", "source_size", "target", copies).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def take_copies(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), total_share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """The mix itself: every document as often as :func:`mix` says, with its columns and ``copy`` (from 1).

    The new column is called ``copy_`` where the documents have a ``copy`` already, and so on.
    """
    mixed = materialize(mix(docs, weights, total_share, limit))
    key = ["doc_id", "row_key", "source"]
    counts = mixed.groupBy(*key).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    counts = materialize(counts.select(*[F.col(c).alias(f"m_{c}") for c in key], "copies", "rows"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), row_key(F.col("text")).alias("key"), F.col("source").alias("src"))
    same = F.col("id").eqNullSafe(F.col("m_doc_id")) & (F.col("key") == F.col("m_row_key")) & F.col("src").eqNullSafe(F.col("m_source"))
    # F.sequence counts down from an end below its start, so documents without copies go first.
    name = "copy"
    while name in map(str.lower, docs.columns):
        name += "_"
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(name)
    single = rows.join(counts.where("rows = 1 AND copies > 0").hint("merge"), same).select("row.*", copy)
    repeated = counts.where("rows > 1 AND copies > 0")
    if repeated.isEmpty():
        return single
    merged = rows.join(repeated, same).groupBy("id", "key", "src", "copies").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return single.unionByName(merged.select("row.*", copy))


ship_by_value(__name__)
