"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written, so that the join shuffles both sides and a hub's many edges can be split over tasks.
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(u, v)`` long pairs to ``(u, root)``: the smallest vertex of its component for every other vertex.

    Self loops are ignored; roots themselves are not listed. Every round is
    two aggregates and two joins over the edges, written to the shared folder;
    the number of rounds is logarithmic in the size of a component.
    """
    edges = materialize(edges.select("u", "v").where("u <> v").distinct())
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        edges = materialize(_small_star(materialize(_large_star(edges))))
        state, before = _state(edges), state
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select("u", F.col("v").alias("root"))
