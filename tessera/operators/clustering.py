"""k-median clustering on DataFrames.

Points are rows ``id BIGINT, v ARRAY<DOUBLE>`` with an optional weight column
and an optional ``part`` column. Every operator works per part: all parts
advance together inside one Spark job, grouped by ``part``; without a part
column the whole table is one part.

Distances are Euclidean and unsquared everywhere (seeding, assignment, cost),
so the objective is k-median, while a center moves to the weighted mean of its
members.

How it runs at scale
--------------------
* The points are read once, persisted (memory and disk) as they come (FLOAT
  vectors stay FLOAT). Seeding scans them about log2(k) times and measures
  about k distances a point in all: a scan tries as many rounds as there are
  centers so far and keeps the winners that it can prove (see
  :func:`tessera.functions.kernels.race`). A Lloyd pass is one scan. With many
  parts the points are first dealt out by (part, slice of the id's hash) and
  sorted by part, so a task holds few parts. A task returns few rows per part
  (seeding) or (part, label) (Lloyd), whatever the skew of the data.
* Centers come back to the driver as matrices and travel with the distance
  kernel. The parts are taken in blocks whose centers take at most
  ``tessera.maxBroadcastBytes`` (default 256 MiB) together, each block one job
  over a range of parts; the centers of one part must fit, which is checked
  before the first clustering job. No join is needed.
* A coreset is worked out in waves of parts and kept as a table in the shared
  folder, so its k·parts centers are never on the driver together.
* Sums are exact (limbs in whole numbers), so centers, costs and the stop test
  are the same bit by bit however the points are dealt out.
* Nothing but the centers changes between rounds: no lineage grows and a lost
  executor costs its own partitions only.
* Randomness is a hash of (seed, round, id): reruns, retried tasks and plain
  SQL all draw the same numbers.

The ``part`` column counts where both points and centers have one. Centers
without it apply to all points alike. A part without centers is an error, and
so are a NULL part and weights that are NULL, negative or not finite.

Deliberate differences from the reference (each has a test)
-----------------------------------------------------------
Q1  the next seed is drawn with probability w·d / sum(w·d) (the documented
    mass; the reference divides by the unweighted sum of d).
Q2/Q3 centers and weights are columns, so nothing is removed and reinserted.
Q4  an empty cluster keeps its former center (not the zero vector).
Q5  coreset points of weight 0 are dropped before round 2.
Q6  the stop test uses the weighted mean distance.
Q7  k < 1, parts < 1 or iterations < 0 raise ``ValueError``.
Q8  a part with fewer than k points keeps all of them (weight 1 each); k above
    the number of points raises ``ValueError``.
Q9  when every remaining w·d is 0 the lowest unchosen id is the next seed.
Q11 every draw is reproducible from ``seed``.
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tessera.functions.hashing import SqlText, bucket, col, uniform_sql
from tessera.functions.kernels import (
    CANDIDATES,
    MEASURED,
    Model,
    Race,
    cluster_sums,
    nearest_rows,
    others_moved,
    race,
    with_bounds,
)
from tessera.session import ensure_checkpoint_dir

# Fixed values.
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024  # centers of the parts of one job
DEFAULT_MAX_MODEL_BYTES = 2 * 1024 * 1024 * 1024  # all centers, on the driver
DEFAULT_WAVE_BYTES = 64 * 1024 * 1024  # centers of the parts of a coreset that are worked on at a time
STOP_TEST_EVERY = 8  # the objective is tested after iterations 0, 8, 16, ...
LEAST_ROUNDS, MOST_ROUNDS = 4, 256  # seeding rounds that one scan tries, at first and at most
BOUNDS_FROM, BOUNDS_PASSES = 32, 3  # centers of a part and passes to come from which on Lloyd keeps bounds

_INF = float("inf")

_CENTER_ROWS_SCHEMA = "part INT, label INT, center ARRAY<DOUBLE>"


# ---------------------------------------------------------------- plumbing


def _check_args(k: int | None = None, parts: int | None = None, iterations: int | None = None) -> None:
    if k is not None and k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    if parts is not None and parts < 1:
        raise ValueError(f"the number of parts must be at least 1, not {parts}")
    if iterations is not None and iterations < 0:
        raise ValueError(f"the number of iterations must be at least 0, not {iterations}")


def _limit(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(f"tessera.{name}", str(default)))


def _check_size(spark: SparkSession, k: int, dim: int, parts: int = 1) -> None:
    """Refuse a model whose centers of one part exceed a task's bound, or all of them the driver's."""
    if 8 * k * dim > _limit(spark, "maxBroadcastBytes", DEFAULT_MAX_BROADCAST_BYTES):
        raise ValueError(f"{k} centers of width {dim} exceed tessera.maxBroadcastBytes; the centers of a part must be small")
    if 8 * k * dim * parts > _limit(spark, "maxModelBytes", DEFAULT_MAX_MODEL_BYTES):
        raise ValueError(f"{parts} parts of {k} centers of width {dim} exceed tessera.maxModelBytes")


def _weight(weight_col: str | None) -> Column:
    if weight_col is None:
        return F.lit(1.0)
    w = F.col(weight_col).cast("double")
    bad = w.isNull() | F.isnan(w) | (w < 0) | (w == F.lit(_INF))
    return F.when(bad, F.raise_error(F.lit("a weight is NULL, negative or not finite")).cast("double")).otherwise(w)


def _points(
    df: DataFrame, id_col: str = "id", vec_col: str = "v", weight_col: str | None = None, part_col: str | None = "part"
) -> tuple[DataFrame, bool]:
    """``part INT, id BIGINT, v, w DOUBLE``; NULL ids and vectors dropped, weights checked."""
    has_part = part_col is not None and part_col in df.columns
    part = F.lit(0)
    if has_part:
        part = F.col(part_col).cast("int")
        part = F.when(part.isNull(), F.raise_error(F.lit("a part is NULL")).cast("int")).otherwise(part)
    floats = df.schema[vec_col].dataType.simpleString() in ("array<float>", "array<double>")
    v = F.col(vec_col) if floats else F.col(vec_col).cast("array<double>")
    pts = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        part.alias("part"), F.col(id_col).cast("long").alias("id"), v.alias("v"), _weight(weight_col).alias("w")
    )
    return pts, has_part


def _clustered(pts: DataFrame, parts: int) -> DataFrame:
    """Deal the points out by (part, slice), sorted by part, so that a task holds few of many parts.

    A part has enough slices for all tasks to share a few parts, however large they are.
    """
    if parts == 1:
        return pts
    tasks = int(pts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = -(-4 * tasks // parts)
    dealt = pts.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices))).repartition("part", "slice")
    return dealt.sortWithinPartitions("part").drop("slice")


def _blocks(spark: SparkSession, model: Model) -> list[tuple[Model, int | None, int | None]]:
    """The parts in blocks whose centers may travel together, each with its range of parts ``[low, high)``.

    The ranges cover all numbers, so that points of any other part meet a block and are seen there.
    """
    most, blocks, size = _limit(spark, "maxBroadcastBytes", DEFAULT_MAX_BROADCAST_BYTES), [{}], 0
    for p, c in sorted(model.items()):
        if blocks[-1] and size + c.nbytes > most:
            blocks.append({})
            size = 0
        blocks[-1][p], size = c, size + c.nbytes
    lows = [None, *(min(b) for b in blocks[1:])]
    return list(zip(blocks, lows, [*lows[1:], None], strict=True))


def _in_range(pts: DataFrame, low: int | None, high: int | None) -> DataFrame:
    """The points of the parts ``[low, high)``: two literals, however many parts there are."""
    if low is not None:
        pts = pts.where(F.col("part") >= low)
    return pts if high is None else pts.where(F.col("part") < high)


def _collect_centers(centers: DataFrame, by_part: bool) -> tuple[Model, dict[int, np.ndarray]]:
    """A centers table (``part?, label, center``) as matrices and labels by part, after a size check."""
    part = F.col("part").cast("int") if by_part else F.lit(0)
    c = centers.select(part.alias("part"), F.col("label").cast("int").alias("label"), F.col("center").cast("array<double>"))
    spark = centers.sparkSession
    n, dim = c.agg(F.count("*"), F.coalesce(F.max(F.size("center")), F.lit(0))).first()
    _check_size(spark, 0, dim)
    if 8 * n * dim > _limit(spark, "maxModelBytes", DEFAULT_MAX_MODEL_BYTES):
        raise ValueError(f"{n} centers of width {dim} exceed tessera.maxModelBytes")
    rows: dict[int, list] = {}
    for r in c.collect():
        if len(r.center) != dim:
            raise ValueError("vectors of different length")
        rows.setdefault(r.part, []).append((r.label, r.center))
    model, labels = {}, {}
    for p, cs in rows.items():
        cs.sort(key=lambda x: x[0])
        _check_size(spark, len(cs), dim)
        model[p] = np.array([v for _, v in cs], dtype=np.float64)
        labels[p] = np.array([lab for lab, _ in cs], dtype=np.int32)
    return model, labels


def _matched(points: DataFrame, centers: DataFrame, id_col, vec_col, weight_col, part_col) -> tuple[DataFrame, bool]:
    """The points, and whether both tables go by part; else all points are one part."""
    theirs = "part" in centers.columns
    pts, has_part = _points(points, id_col, vec_col, weight_col, part_col)
    if theirs and not has_part:
        raise ValueError("the centers have a part column but the points have none")
    return (pts, True) if theirs else (pts.withColumn("part", F.lit(0)), False)


def _sums(pts: DataFrame, model: Model, by_label: bool = True) -> DataFrame:
    """Sums by (part, label row), in one job or, for a large model, one per block of parts."""
    frames = [cluster_sums(_in_range(pts, low, high), b, by_label) for b, low, high in _blocks(pts.sparkSession, model)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


def _local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A driver-side result (a block of centers) as a DataFrame.

    Built from an Arrow table it plans as a JVM ``LocalTableScan`` and takes
    NumPy values whatever the session's Arrow settings are; a list of tuples
    would become a Python-backed RDD that every later job converts again.
    """
    kind = StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kind)
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, kind, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, kind.names), kind)


def _persist_points(df: DataFrame) -> DataFrame:
    """Keep the points between the rounds of a clustering.

    ``tessera.pointsStorageLevel`` (a ``StorageLevel`` name, default
    MEMORY_AND_DISK) chooses how; ``NONE`` re-reads the pruned source columns
    in every round instead, for inputs larger than the cluster's memory and
    local disks.
    """
    level = df.sparkSession.conf.get("tessera.pointsStorageLevel", "MEMORY_AND_DISK").upper()
    if level == "NONE":
        return df
    return df.persist(getattr(StorageLevel, level))


# ---------------------------------------------------------------- seeding


def _seed(
    pts: DataFrame, k: int, seed: int, parts: int = 1, scans: list | None = None
) -> dict[int, list[tuple[int, np.ndarray]]]:
    """Weighted k-means++ seeding per part: ``{part: [(id, v), ...]}`` in pick order.

    Round 0 takes the point of smallest u(seed, 0, id) (uniform, weights
    ignored). Round r takes, among unchosen points, the smallest
    -ln(u(seed, r, id)) / (w·d), ties to the lowest id: an exponential race
    that picks each point with probability w·d / sum(w·d), with no ordered
    prefix sum. When every w·d is 0 the key is +Infinity for all and the
    lowest unchosen id wins.

    A scan tries about as many rounds as there are centers so far
    (:func:`tessera.functions.kernels.race`): with distances to 1, 2, 4, ...
    centers that makes about k distances a point and log2(k) scans in all. Keys
    beyond a limit that few should pass, drawn from the mass of the scan
    before, are not sent. ``scans``, if given, receives ``(distances a point,
    rounds settled)`` of each scan, of the part that is furthest back.
    """
    spark = pts.sparkSession
    width = pts.select(F.size("v")).first()
    if width is not None:
        _check_size(spark, k, width[0], parts)

    def drawn(rows: DataFrame, first: int, end: int) -> DataFrame:
        one = uniform_sql(seed, SqlText("r"), col("id"))
        return rows.withColumn("u", F.expr(f"transform(sequence({first}, {end - 1}), r -> {one})"))

    chosen = {r.part: [(r.id, np.array(r.v))] for r in race(drawn(pts, 0, 1), None, None).where("rnd >= 0").collect()}
    limit = dict.fromkeys(chosen, _INF)
    live = set(chosen) if k > 1 else set()
    while live:
        model = {p: np.stack([v for _, v in chosen[p]]) for p in live}
        before, used = {p: len(chosen[p]) for p in live}, dict(limit)
        for block, low, high in _blocks(spark, model):
            ends = {p: min(k, before[p] + min(MOST_ROUNDS, max(LEAST_ROUNDS, before[p]))) for p in block}
            races = {p: Race(before[p], ends[p], limit[p], [i for i, _ in chosen[p]]) for p in block}
            first, end = min(r.first for r in races.values()), max(r.end for r in races.values())
            rows = drawn(_in_range(pts, low, high), first, end)
            for r in sorted(race(rows, block, races, first).collect(), key=lambda r: (r.part, r.rnd)):
                if r.rnd >= 0:
                    chosen[r.part].append((r.id, np.array(r.v)))
                else:
                    limit[r.part] = 2 * CANDIDATES / r.mass if r.mass > 0 else _INF
        if scans is not None:
            scans.append((min(before.values()), min(len(chosen[p]) - n for p, n in before.items())))
        for p, n in before.items():
            if len(chosen[p]) >= k:
                live.discard(p)
            elif len(chosen[p]) == n and used[p] == _INF:
                live.discard(p)  # all points of the part are chosen
            elif len(chosen[p]) == n:
                limit[p] = _INF  # it was too low
    return chosen


# ---------------------------------------------------------------- Lloyd


@dataclass
class _PartState:
    centers: np.ndarray
    best: float = _INF
    it: int = 0
    done: bool = False
    sizes: list[int] | None = None
    cost: float | None = None


def _pass(
    pts: DataFrame, model: Model, strict: bool, moved: Model | None = None
) -> tuple[dict[int, dict[int, tuple]], int]:
    """One scan: for each (part, label) the count, sum w, sum w·d and sum w·v; and how many distances it measured."""
    out: dict[int, dict[int, tuple]] = {}
    measured = 0
    for block, low, high in _blocks(pts.sparkSession, model):
        mine = None if moved is None else {p: moved[p] for p in block}
        for r in cluster_sums(_in_range(pts, low, high), block, strict=strict, moved=mine).collect():
            if r.label == MEASURED:
                measured += r.cnt
                continue
            out.setdefault(r.part, {})[r.label] = (r.cnt, r.sw, r.sd, np.array(r.sx))
            measured += 0 if mine is not None else r.cnt * len(model[r.part])
    return out, measured


class _Bounds:
    """Lloyd's scans with bounds on the distances, so that few points are measured against all centers.

    The points are kept with their nearest center and the distance to the
    next one, both at the centers of some pass (the anchor). A center is
    later no nearer to a point than it was then, less the way it has gone
    since. Where that leaves the point's own center the nearest, the scan
    measures that distance alone. The result is the same bit by bit.

    The rows with bounds always come from the points themselves by one narrow
    step, never from older bounds, so no lineage grows. Once bounds save less
    than half they are made anew from the centers of that pass; where this does not
    help, twice as many passes go by without before the next attempt. They
    take a second copy of the points in the cache, and making them costs a
    point about as much as measuring some ten centers, hence ``BOUNDS_FROM``.
    """

    def __init__(self, pts: DataFrame):
        self.pts, self.frame, self.model = pts, None, {}
        self.at, self.pause, self.next = 0, 1, 1
        self.kept = pts.sparkSession.conf.get("tessera.pointsStorageLevel", "MEMORY_AND_DISK").upper() != "NONE"

    def scan(self, number: int, model: Model, left: int) -> tuple[dict[int, dict[int, tuple]], int]:
        """Pass ``number`` (from 0) with ``left`` more to come at most."""
        made = 0
        large = self.kept and max(map(len, model.values())) >= BOUNDS_FROM
        if self.frame is None and number >= self.next and large and left >= BOUNDS_PASSES:
            frames = [with_bounds(_in_range(self.pts, low, high), b) for b, low, high in _blocks(self.pts.sparkSession, model)]
            out = frames[0]
            for f in frames[1:]:
                out = out.unionAll(f)
            self.frame, self.model, self.at, made = _persist_points(out), model, number, 1
        if self.frame is None:
            return _pass(self.pts, model, number == 0)
        moved = {p: others_moved(self.model[p], c) for p, c in model.items()}
        stats, measured = _pass(self.frame, model, False, moved)
        full = sum(x[0] * len(model[p]) for p, st in stats.items() for x in st.values())
        if not made and 2 * measured > full:
            # At least the pass after the anchor must have gained.
            self.pause = 2 * self.pause if number == self.at + 1 else 1
            self.next = number + self.pause
            self.close()
        return stats, measured + made * full

    def close(self) -> None:
        if self.frame is not None:
            self.frame.unpersist()
            self.frame = None


def _moved(center: np.ndarray, stats: tuple | None) -> np.ndarray:
    """The weighted mean of a cluster, or its former center if it weighs nothing (Q4)."""
    return stats[3] / stats[1] if stats and stats[1] > 0 else center


def _lloyd(
    pts: DataFrame, centers: Model, iterations: int, final_pass: bool, measured: list | None = None
) -> dict[int, _PartState]:
    """Lloyd steps per part with the reference's stop rule.

    Iteration ``it`` moves the centers to the weighted means; after iterations
    0, 8, 16, ... the objective of the new centers is compared with the best so
    far and the loop stops when it did not fall, keeping the latest centers.
    The objective of the centers of iteration ``it`` is computed by the scan of
    iteration ``it + 1``, which assigns the points to them anyway, so no scan is
    spent on the test. ``final_pass`` adds the scan that gives the sizes and the
    cost of the final centers. ``measured``, if given, receives the number of
    distances that each scan measured.
    """
    bounds = _Bounds(pts)
    try:
        return _steps(bounds, centers, iterations, final_pass, [] if measured is None else measured)
    finally:
        bounds.close()


def _steps(bounds: _Bounds, centers: Model, iterations: int, final_pass: bool, measured: list) -> dict[int, _PartState]:
    state = {p: _PartState(centers=c) for p, c in centers.items()}
    while True:
        for s in state.values():
            if not s.done and s.it >= iterations and not final_pass:
                s.done = True
        live = [p for p, s in state.items() if not s.done]
        if not live:
            return state
        # Later on, the parts that have stopped are left out.
        left = iterations - min(state[p].it for p in live)
        stats, n = bounds.scan(len(measured), {p: state[p].centers for p in live}, left)
        measured.append(n)
        for p in live:
            s = state[p]
            st = stats.get(p, {})
            tw = math.fsum(x[1] for x in st.values())
            obj = math.fsum(x[2] for x in st.values()) / tw if tw > 0 else math.nan
            s.sizes = [st[lab][0] if lab in st else 0 for lab in range(len(s.centers))]
            s.cost = obj
            if s.it >= 1 and (s.it - 1) % STOP_TEST_EVERY == 0:
                if obj < s.best:
                    s.best = obj
                else:
                    s.done = True
                    continue
            if s.it >= iterations:
                s.done = True
                continue
            s.centers = np.stack([_moved(c, st.get(lab)) for lab, c in enumerate(s.centers)])
            s.it += 1


# ---------------------------------------------------------------- public operators


def assign_parts(df: DataFrame, parts: int, seed: int = 0, id_col: str = "id", out: str = "part") -> DataFrame:
    """Add ``part`` in [0, parts): an even spread by a hash of the id.

    A column, not a physical repartition: every later step groups by it, and
    the value of a row never changes on a retry.
    """
    _check_args(parts=parts)
    return df.withColumn(out, bucket(parts, "part", seed, col(id_col)))


def seed_centers(
    points: DataFrame,
    k: int,
    seed: int = 0,
    id_col: str = "id",
    vec_col: str = "v",
    weight_col: str | None = None,
    part_col: str | None = "part",
    scans: list | None = None,
) -> DataFrame:
    """k seeds per part by weighted k-means++: ``part?, label, id, center``.

    ``label`` is the pick order. Runs about log2(k) small jobs now; the result
    is a DataFrame of at most k rows per part. ``scans``, if given, receives
    ``(distances a point, rounds settled)`` of every scan after the first.
    """
    _check_args(k=k)
    pts, has_part = _points(points, id_col, vec_col, weight_col, part_col)
    pts = _persist_points(pts)
    try:
        chosen = _seed(pts, k, seed, scans=scans)
    finally:
        pts.unpersist()
    if not has_part and chosen and len(chosen.get(0, [])) < k:
        raise ValueError(f"k = {k} is above the number of points")
    rows = [(p, label, i, v) for p, c in sorted(chosen.items()) for label, (i, v) in enumerate(c)]
    out = _local_frame(points.sparkSession, rows, "part INT, label INT, id BIGINT, center ARRAY<DOUBLE>")
    return out if has_part else out.drop("part")


def assign_nearest(
    points: DataFrame,
    centers: DataFrame,
    id_col: str = "id",
    vec_col: str = "v",
    part_col: str | None = "part",
) -> DataFrame:
    """Nearest center of each point: ``part?, id, label, dist``.

    Ties go to the lowest label. ``centers`` is ``part?, label, center``;
    centers without a part apply to all points.
    """
    pts, by_part = _matched(points, centers, id_col, vec_col, None, part_col)
    model, labels = _collect_centers(centers, by_part)
    frames = [nearest_rows(_in_range(pts, low, high), b, labels) for b, low, high in _blocks(points.sparkSession, model)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out if by_part else out.drop("part")


def _per_cluster(points, centers, value: str, name: str, kind: str, id_col, vec_col, weight_col, part_col) -> DataFrame:
    """A sum for every center; those nobody is nearest to have 0."""
    pts, by_part = _matched(points, centers, id_col, vec_col, weight_col, part_col)
    model, labels = _collect_centers(centers, by_part)
    names = [(p, i, int(lab), 0) for p, ls in labels.items() for i, lab in enumerate(ls)]
    zeros = _local_frame(points.sparkSession, names, f"part INT, row INT, label INT, {name} {kind}")
    per = _sums(pts, model).select("part", F.col("label").alias("row"), F.lit(None).cast("int").alias("label"), F.col(value).alias(name))
    out = per.unionByName(zeros).groupBy("part", "row").agg(F.max("label").alias("label"), F.sum(name).alias(name)).drop("row")
    return out if by_part else out.drop("part")


def cluster_sizes(
    points: DataFrame, centers: DataFrame, id_col: str = "id", vec_col: str = "v", part_col: str | None = "part"
) -> DataFrame:
    """Number of points nearest to each center: ``part?, label, size`` (0 for empty)."""
    return _per_cluster(points, centers, "cnt", "size", "BIGINT", id_col, vec_col, None, part_col)


def cluster_weights(
    points: DataFrame,
    centers: DataFrame,
    weight_col: str | None = None,
    id_col: str = "id",
    vec_col: str = "v",
    part_col: str | None = "part",
) -> DataFrame:
    """Total weight of the points nearest to each center: ``part?, label, weight``."""
    return _per_cluster(points, centers, "sw", "weight", "DOUBLE", id_col, vec_col, weight_col, part_col)


def kmedian_cost(
    points: DataFrame,
    centers: DataFrame,
    weight_col: str | None = None,
    id_col: str = "id",
    vec_col: str = "v",
    part_col: str | None = "part",
) -> DataFrame:
    """Mean distance to the nearest center, weighted: ``part?, cost``.

    One scan and one small aggregate. Without parts there is always one row,
    NULL for no points; centers without a part give the cost over all points.
    """
    pts, by_part = _matched(points, centers, id_col, vec_col, weight_col, part_col)
    model, _ = _collect_centers(centers, by_part)
    sums = _sums(pts, model, by_label=False)
    cost = F.try_divide(F.sum("sd"), F.sum("sw")).alias("cost")
    return sums.groupBy("part").agg(cost) if by_part else sums.agg(cost)


def lloyd_step(
    points: DataFrame,
    centers: DataFrame,
    weight_col: str | None = None,
    id_col: str = "id",
    vec_col: str = "v",
    part_col: str | None = "part",
) -> DataFrame:
    """One Lloyd step: each center moves to the weighted mean of its members.

    ``part?, label, center``; an empty cluster keeps its center (Q4). The step
    of :func:`lloyd`, run now.
    """
    pts, by_part = _matched(points, centers, id_col, vec_col, weight_col, part_col)
    model, labels = _collect_centers(centers, by_part)
    stats, _ = _pass(pts, model, True)
    rows = [
        (p, int(labels[p][i]), _moved(c, stats.get(p, {}).get(i))) for p, cs in sorted(model.items()) for i, c in enumerate(cs)
    ]
    out = _local_frame(points.sparkSession, rows, _CENTER_ROWS_SCHEMA)
    return out if by_part else out.drop("part")


def _run_kmedian(pts: DataFrame, k: int, iterations: int, seed: int, final_pass: bool, parts: int = 1):
    chosen = _seed(pts, k, seed, parts)
    centers = {p: np.stack([v for _, v in c]) for p, c in chosen.items()}
    return _lloyd(pts, centers, iterations, final_pass)


def lloyd(
    points: DataFrame,
    centers: DataFrame,
    iterations: int,
    weight_col: str | None = None,
    id_col: str = "id",
    vec_col: str = "v",
    part_col: str | None = "part",
    measured: list | None = None,
) -> DataFrame:
    """Lloyd refinement from given centers with the stop test: ``part?, label, center``.

    ``measured``, if given, receives the number of distances of each scan.
    """
    _check_args(iterations=iterations)
    pts, by_part = _matched(points, centers, id_col, vec_col, weight_col, part_col)
    model, labels = _collect_centers(centers, by_part)
    pts = _persist_points(pts)
    try:
        state = _lloyd(pts, model, iterations, False, measured)
    finally:
        pts.unpersist()
    rows = [(p, int(labels[p][i]), c) for p, s in sorted(state.items()) for i, c in enumerate(s.centers)]
    out = _local_frame(points.sparkSession, rows, _CENTER_ROWS_SCHEMA)
    return out if by_part else out.drop("part")


def kmedian(
    points: DataFrame,
    k: int,
    iterations: int,
    seed: int = 0,
    weight_col: str | None = None,
    id_col: str = "id",
    vec_col: str = "v",
    part_col: str | None = "part",
) -> DataFrame:
    """Weighted k-means++ seeding, then Lloyd refinement: ``part?, label, center``.

    With a part column each part is clustered by itself (all parts in the same
    jobs). Runs its jobs now and returns the k centers per part.
    """
    _check_args(k=k, iterations=iterations)
    pts, has_part = _points(points, id_col, vec_col, weight_col, part_col)
    pts = _persist_points(pts)
    try:
        state = _run_kmedian(pts, k, iterations, seed, False)
    finally:
        pts.unpersist()
    if not has_part and (0 not in state or len(state[0].centers) < k):
        raise ValueError(f"k = {k} is above the number of points")
    rows = [(p, i, c) for p, s in sorted(state.items()) for i, c in enumerate(s.centers)]
    out = _local_frame(points.sparkSession, rows, _CENTER_ROWS_SCHEMA)
    return out if has_part else out.drop("part")


def _coreset_table(pts: DataFrame, k: int, iterations: int, seed: int, parts: int) -> DataFrame:
    """``part, label, center, w`` as a table in the shared folder.

    The parts are clustered in waves whose centers take at most
    ``tessera.waveBytes`` (default 64 MiB) together, and each wave's rows
    are appended, so the driver holds one wave, however many parts there are.
    """
    spark = pts.sparkSession
    width = pts.select(F.size("v")).first()
    _check_size(spark, k, width[0] if width else 0)
    wave = max(1, _limit(spark, "waveBytes", DEFAULT_WAVE_BYTES) // (8 * k * max(1, width[0] if width else 1)))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-coreset-{uuid.uuid4().hex}"
    schema = "part INT, label INT, center ARRAY<DOUBLE>, w BIGINT"
    for low in range(0, parts, wave):
        mine = pts if wave >= parts else _in_range(pts, low, low + wave)
        state = _run_kmedian(mine, k, iterations, seed, True)
        rows = [(p, label, c, int(s.sizes[label])) for p, s in sorted(state.items()) for label, c in enumerate(s.centers)]
        _local_frame(spark, rows, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def coreset(
    points: DataFrame,
    k: int,
    parts: int,
    iterations: int,
    seed: int = 0,
    id_col: str = "id",
    vec_col: str = "v",
) -> DataFrame:
    """Round 1 of the MapReduce k-median: ``part, label, center, w``.

    The points are spread over ``parts`` by a hash of the id; each part is
    clustered by itself (k-means++ then Lloyd) and every center is weighted by
    the number of its part's points nearest to it. A part with fewer than k
    points yields all its points with weight 1.
    """
    _check_args(k=k, parts=parts, iterations=iterations)
    pts, _ = _points(assign_parts(points, parts, seed, id_col), id_col, vec_col, None, "part")
    pts = _persist_points(_clustered(pts, parts))
    try:
        return _coreset_table(pts, k, iterations, seed, parts)
    finally:
        pts.unpersist()


def kmedian_mr(
    points: DataFrame,
    k: int,
    parts: int,
    iterations: int,
    seed: int = 0,
    id_col: str = "id",
    vec_col: str = "v",
    timings: dict | None = None,
) -> DataFrame:
    """Three-round MapReduce k-median: ``label, center, cost``.

    Round 1: the coreset (k weighted centers per part). Round 2: weighted
    k-means++ and Lloyd on the coreset alone (k·parts rows), coreset ids ``part·k + label``, zero weights dropped (Q5).
    Round 3: the mean distance of all points to the k centers, one scan, as
    :func:`kmedian_cost` gives it. ``timings``, if given, receives the
    seconds spent in each round (``round1`` .. ``round3``).
    """
    clock = time.perf_counter
    marks = [clock()]
    _check_args(k=k, parts=parts, iterations=iterations)
    spark = points.sparkSession
    pts, _ = _points(assign_parts(points, parts, seed, id_col), id_col, vec_col, None, "part")
    pts = _persist_points(_clustered(pts, parts))
    try:
        table = _coreset_table(pts, k, iterations, seed, parts)
        if (table.agg(F.sum("w")).first()[0] or 0) < k:
            raise ValueError(f"k = {k} is above the number of points")
        marks.append(clock())
        core = table.where("w > 0").select(
            F.lit(0).alias("part"),
            (F.col("part").cast("long") * k + F.col("label")).alias("id"),
            F.col("center").alias("v"),
            F.col("w").cast("double").alias("w"),
        )
        state = _run_kmedian(core, k, iterations, seed, False)[0]
        marks.append(clock())
        everyone = cluster_sums(pts.withColumn("part", F.lit(0)), {0: state.centers}, by_label=False).first()
        cost = everyone.sd / everyone.sw
        marks.append(clock())
    finally:
        pts.unpersist()
    if timings is not None:
        timings.update({f"round{i + 1}": round(b - a, 3) for i, (a, b) in enumerate(zip(marks, marks[1:]))})
    return _local_frame(
        spark,
        [(i, c, float(cost)) for i, c in enumerate(state.centers)], "label INT, center ARRAY<DOUBLE>, cost DOUBLE"
    )
