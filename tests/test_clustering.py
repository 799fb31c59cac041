import hashlib
import math
import time

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera import (
    assign_nearest,
    assign_parts,
    cluster_sizes,
    cluster_weights,
    coreset,
    kmedian,
    kmedian_cost,
    kmedian_mr,
    lloyd,
    lloyd_step,
    seed_centers,
)
from tessera.functions import kernels
from tessera.functions.hashing import col, uniform_sql
from tessera.operators import clustering as C
from tests.conftest import SF_SMALL

POINTS = [(0, [0.0, 0.0]), (1, [0.0, 1.0]), (2, [10.0, 0.0]), (3, [10.0, 1.0])]
CENTERS = [(0, [0.0, 0.0]), (1, [10.0, 0.0])]


def pts(spark, rows=POINTS, w=None):
    if w is None:
        return spark.createDataFrame(rows, "id BIGINT, v ARRAY<DOUBLE>")
    return spark.createDataFrame([(i, v, float(x)) for (i, v), x in zip(rows, w)], "id BIGINT, v ARRAY<DOUBLE>, w DOUBLE")


def ctr(spark, rows=CENTERS):
    return spark.createDataFrame(rows, "label INT, center ARRAY<DOUBLE>")


def test_labels_distances_cost_sizes(spark):
    a = {r.id: (r.label, r.dist) for r in assign_nearest(pts(spark), ctr(spark)).collect()}
    assert a == {0: (0, 0.0), 1: (0, 1.0), 2: (1, 0.0), 3: (1, 1.0)}
    assert kmedian_cost(pts(spark), ctr(spark)).first().cost == 0.5
    assert {r.label: r.size for r in cluster_sizes(pts(spark), ctr(spark)).collect()} == {0: 2, 1: 2}


def test_lloyd_step_unit_and_weighted(spark):
    step = {r.label: r.center for r in lloyd_step(pts(spark), ctr(spark)).collect()}
    assert step == {0: [0.0, 0.5], 1: [10.0, 0.5]}
    new = ctr(spark, sorted(step.items()))
    assert kmedian_cost(pts(spark), new).first().cost == 0.5
    wstep = {r.label: r.center for r in lloyd_step(pts(spark, w=[1, 3, 1, 1]), ctr(spark), weight_col="w").collect()}
    assert wstep[0] == [0.0, 0.75] and wstep[1] == [10.0, 0.5]
    ws = {r.label: r.weight for r in cluster_weights(pts(spark, w=[1, 3, 1, 1]), ctr(spark), weight_col="w").collect()}
    assert ws == {0: 4.0, 1: 2.0}


def test_tie_goes_to_lowest_label(spark):
    p = pts(spark, [(9, [5.0, 0.0])])
    assert assign_nearest(p, ctr(spark)).first().label == 0


def test_empty_cluster_keeps_its_center(spark):
    c = ctr(spark, CENTERS + [(2, [99.0, 99.0])])
    sizes = {r.label: r.size for r in cluster_sizes(pts(spark), c).collect()}
    assert sizes == {0: 2, 1: 2, 2: 0}
    step = {r.label: r.center for r in lloyd_step(pts(spark), c).collect()}
    assert step[2] == [99.0, 99.0]


def test_vectors_of_different_length_fail(spark):
    p = pts(spark, [(0, [0.0, 0.0]), (1, [1.0, 2.0, 3.0])])
    with pytest.raises((PySparkException, ValueError)):
        assign_nearest(p, ctr(spark)).collect()


def test_seeds_are_distinct_input_points(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )
    s = seed_centers(emb, 5, seed=11).collect()
    ids = [r.id for r in s]
    assert len(set(ids)) == 5 and [r.label for r in s] == list(range(5))
    src = {r.id: r.v for r in emb.where(F.col("id").isin(ids)).collect()}
    assert all(src[r.id] == r.center for r in s)


def test_duplicates_only_take_lowest_unchosen_id(spark):
    p = pts(spark, [(i, [1.0, 1.0]) for i in (5, 3, 8, 4)])
    s = seed_centers(p, 2, seed=1).orderBy("label").collect()
    first = s[0].id
    assert s[1].id == min(i for i in (5, 3, 8, 4) if i != first)


def test_k_above_points_and_bad_arguments(spark):
    with pytest.raises(ValueError):
        kmedian(pts(spark), 5, 1)
    with pytest.raises(ValueError):
        kmedian(pts(spark), 0, 1)
    with pytest.raises(ValueError):
        coreset(pts(spark), 2, 0, 1)
    with pytest.raises(ValueError):
        kmedian(pts(spark), 2, -1)


def test_iter_zero_returns_seeds(spark):
    seeds = {r.label: r.center for r in seed_centers(pts(spark), 2, seed=4).collect()}
    km = {r.label: r.center for r in kmedian(pts(spark), 2, 0, seed=4).collect()}
    assert seeds == km


def test_kmedian_finds_the_two_groups(spark):
    km = sorted(tuple(r.center) for r in kmedian(pts(spark), 2, 3, seed=2).collect())
    assert km == [(0.0, 0.5), (10.0, 0.5)]


def test_lloyd_stop_rule_keeps_latest(spark):
    # Converged after one step: the test after iteration 8 sees no fall and stops.
    out = {r.label: r.center for r in lloyd(pts(spark), ctr(spark), 20).collect()}
    assert out == {0: [0.0, 0.5], 1: [10.0, 0.5]}


def test_coreset_weights_sum_to_n(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )
    n = emb.count()
    core = coreset(emb, 3, 4, 2, seed=5).collect()
    assert sum(r.w for r in core) == n
    assert len(core) == 12


def test_small_part_keeps_all_its_points(spark):
    core = coreset(pts(spark), 3, 2, 1, seed=0).collect()
    parts = assign_parts(pts(spark), 2, seed=0).groupBy("part").count().collect()
    for p in parts:
        mine = [r for r in core if r.part == p.part]
        assert len(mine) == min(3, p["count"])
        if p["count"] <= 3:
            assert all(r.w == 1 for r in mine)
    assert sum(r.w for r in core) == 4


def test_mr_cost_matches_cost_operator(spark):
    out = kmedian_mr(pts(spark), 2, 2, 2, seed=3).collect()
    centers = ctr(spark, [(r.label, r.center) for r in out])
    assert out[0].cost == pytest.approx(kmedian_cost(pts(spark), centers).first().cost)


def test_cost_never_rises_with_more_seeds(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )
    seeds = seed_centers(emb, 4, seed=9).collect()
    costs = [
        kmedian_cost(emb, ctr(spark, [(r.label, r.center) for r in seeds[:m]])).first().cost for m in range(1, 5)
    ]
    assert all(b <= a + 1e-12 for a, b in zip(costs, costs[1:]))


def test_exponential_race_is_unbiased(spark):
    # Three candidates with w·d = 1, 2, 7: the race must pick them 10%, 20%, 70%.
    trials = 20000
    cand = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 7.0)], "id BIGINT, wd DOUBLE")
    rows = cand.select("id", "wd", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))).alias("trial"))
    key = F.expr(f"-ln({uniform_sql(col('trial'), 1, col('id'))}) / wd")
    wins = rows.groupBy("trial").agg(F.min(F.struct(key.alias("k"), "id")).alias("m")).groupBy("m.id").count()
    freq = {r.id: r["count"] / trials for r in wins.collect()}
    for i, p in ((0, 0.1), (1, 0.2), (2, 0.7)):
        assert abs(freq[i] - p) < 4 * math.sqrt(p * (1 - p) / trials)


def test_parts_are_even_and_stable(spark):
    df = spark.range(20000).withColumnRenamed("id", "id")
    a = assign_parts(df, 8, seed=1)
    counts = [r["count"] for r in a.groupBy("part").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) < 400
    assert a.exceptAll(assign_parts(df, 8, seed=1)).count() == 0


def test_kernel_equals_sql_distance_bitwise(spark):
    from tessera.functions.vectors import nearest

    emb = _emb(spark)
    cs = [[float(x) * 0.5 + 0.01 for x in r.v] for r in emb.orderBy("id").limit(3).collect()]
    lit = F.array(*[F.struct(F.lit(i).alias("label"), F.array(*[F.lit(x) for x in c]).alias("center")) for i, c in enumerate(cs)])
    want = {r.id: (r.s.label, r.s.dist) for r in emb.withColumn("cs", lit).select("id", nearest("v", "cs").alias("s")).collect()}
    got = {r.id: (r.label, r.dist) for r in assign_nearest(emb, ctr(spark, list(enumerate(cs)))).collect()}
    assert got == want


def test_zero_weight_coreset_points_are_dropped(spark):
    same = pts(spark, [(i, [1.0, 2.0]) for i in range(4)])
    core = coreset(same, 2, 1, 1, seed=0).orderBy("label").collect()
    assert [r.w for r in core] == [4, 0]
    out = kmedian_mr(same, 2, 1, 1, seed=0).collect()
    assert len(out) == 1 and out[0].center == [1.0, 2.0] and out[0].cost == 0.0


def test_doubled_vectors_give_doubled_centers(spark):
    # Repeating every vector scales all distances by sqrt(2): the same seeds,
    # assignments and means, so each center is the 64-wide center repeated.
    emb = _emb(spark)
    wide = emb.select("id", F.concat("v", "v").alias("v"))
    narrow = {r.label: r.center for r in kmedian(emb, 3, 2, seed=1).collect()}
    doubled = {r.label: r.center for r in kmedian(wide, 3, 2, seed=1).collect()}
    assert narrow.keys() == doubled.keys()
    for lab in narrow:
        assert doubled[lab] == pytest.approx(narrow[lab] + narrow[lab], abs=1e-12)


def _emb(spark):
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )


def test_sizes_sum_to_n(spark):
    emb = _emb(spark)
    seeds = seed_centers(emb, 5, seed=2)
    assert sum(r.size for r in cluster_sizes(emb, seeds).collect()) == emb.count()


def test_one_part_no_iterations_is_plain_seeding(spark):
    emb = _emb(spark)
    core = {r.label: r.center for r in coreset(emb, 3, 1, 0, seed=6).collect()}
    plain = {r.label: r.center for r in seed_centers(emb.withColumn("part", F.lit(0)), 3, seed=6).collect()}
    assert core == plain


def test_same_seed_same_result(spark):
    emb = _emb(spark)
    a = [(r.label, r.center) for r in kmedian_mr(emb, 3, 2, 1, seed=13).orderBy("label").collect()]
    b = [(r.label, r.center) for r in kmedian_mr(emb, 3, 2, 1, seed=13).orderBy("label").collect()]
    assert a == b


def test_null_rows_are_dropped(spark):
    p = spark.createDataFrame(
        [(0, [0.0, 0.0]), (1, None), (None, [5.0, 5.0]), (3, [10.0, 0.0])], "id BIGINT, v ARRAY<DOUBLE>"
    )
    sizes = {r.label: r.size for r in cluster_sizes(p, ctr(spark)).collect()}
    assert sizes == {0: 1, 1: 1}


def test_equal_points_are_chosen_once_each(spark):
    p = pts(spark, [(i, [1.0, 1.0]) for i in (9, 2, 7, 4, 5, 1)])
    ids = [r.id for r in seed_centers(p, 6, seed=3).orderBy("label").collect()]
    assert sorted(ids) == [1, 2, 4, 5, 7, 9]
    assert ids[1:] == sorted(ids[1:])


def test_many_seeds_write_no_second_copy(spark):
    emb = _emb(spark)
    held = spark.sparkContext._jsc.getPersistentRDDs
    before = held().size()
    s = seed_centers(emb, 64, seed=2).collect()
    assert len({r.id for r in s}) == 64 and held().size() <= before


def test_centers_without_part_apply_to_every_point(spark):
    p = pts(spark).withColumn("part", F.col("id") % 2)
    assert kmedian_cost(p, ctr(spark)).collect() == kmedian_cost(pts(spark), ctr(spark)).collect()
    assert {r.id: r.label for r in assign_nearest(p, ctr(spark)).collect()} == {0: 0, 1: 0, 2: 1, 3: 1}
    assert {r.label: r.size for r in cluster_sizes(p, ctr(spark)).collect()} == {0: 2, 1: 2}
    assert {r.label: r.center for r in lloyd_step(p, ctr(spark)).collect()} == {0: [0.0, 0.5], 1: [10.0, 0.5]}
    assert {r.label: r.center for r in lloyd(p, ctr(spark), 3).collect()} == {0: [0.0, 0.5], 1: [10.0, 0.5]}


def test_mr_cost_on_parted_points(spark):
    emb = _emb(spark)
    out = kmedian_mr(emb, 3, 4, 1, seed=2).collect()
    cost = kmedian_cost(assign_parts(emb, 4, seed=2), ctr(spark, [(r.label, r.center) for r in out])).first().cost
    assert cost == pytest.approx(out[0].cost, rel=1e-12)


def test_part_without_centers_is_an_error(spark):
    p = pts(spark).withColumn("part", (F.col("id") % 2).cast("int"))
    c = ctr(spark).withColumn("part", F.lit(0))
    for run in (assign_nearest, cluster_sizes, cluster_weights, kmedian_cost, lloyd_step):
        with pytest.raises(Exception, match="no centers for part 1"):
            run(p, c).collect()
    with pytest.raises(Exception, match="no centers for part 1"):
        lloyd(p, c, 2)
    with pytest.raises(ValueError, match="points have none"):
        kmedian_cost(pts(spark), c)


@pytest.mark.parametrize("bad", [None, -1.0, float("nan"), float("inf")])
@pytest.mark.parametrize("parts", [1, 5])
def test_bad_weights_are_refused(spark, bad, parts):
    rows = [(i, [float(i), 0.0], 1.0) for i in range(4)] + [(9, [1.0, 1.0], bad)]
    p = spark.createDataFrame(rows, "id BIGINT, v ARRAY<DOUBLE>, w DOUBLE").repartition(parts)
    for run in (lambda: kmedian(p, 2, 2, weight_col="w"), lambda: lloyd_step(p, ctr(spark), "w"), lambda: cluster_weights(p, ctr(spark), "w").collect()):
        with pytest.raises(Exception, match="weight is NULL, negative or not finite"):
            run()


def test_null_part_is_an_error(spark):
    p = pts(spark).withColumn("part", F.when(F.col("id") > 0, 0))
    for run in (lambda: kmedian(p, 2, 1), lambda: seed_centers(p, 1), lambda: kmedian_cost(p, ctr(spark).withColumn("part", F.lit(0))).collect()):
        with pytest.raises(Exception, match="a part is NULL"):
            run()


def test_no_points_cost_null(spark):
    assert kmedian_cost(pts(spark, []), ctr(spark)).collect()[0].cost is None


def test_large_models_go_by_blocks_of_parts(spark):
    emb = _emb(spark)
    whole = [tuple(r) for r in coreset(emb, 3, 4, 1, seed=5).orderBy("part", "label").collect()]
    parted, centers = assign_parts(emb, 4, seed=5), coreset(emb, 3, 4, 1, seed=5)
    sizes = sorted(map(tuple, cluster_sizes(parted, centers).collect()))
    near = sorted(map(tuple, assign_nearest(parted, centers).collect()))
    spark.conf.set("tessera.maxBroadcastBytes", str(8 * 3 * 64))
    try:
        assert [tuple(r) for r in coreset(emb, 3, 4, 1, seed=5).orderBy("part", "label").collect()] == whole
        assert sorted(map(tuple, cluster_sizes(parted, centers).collect())) == sizes
        assert sorted(map(tuple, assign_nearest(parted, centers).collect())) == near
        with pytest.raises(ValueError, match="maxBroadcastBytes"):
            seed_centers(emb, 4, seed=5)
    finally:
        spark.conf.unset("tessera.maxBroadcastBytes")


def test_many_parts_shuffle_a_row_each(spark, monkeypatch):
    """Many parts: a pass returns about k·L rows in all, not k·L for each task or batch."""
    from tessera.functions import kernels

    points = spark.range(20000).select("id", F.array((F.col("id") % 97).cast("float"), F.rand(3).cast("float")).alias("v"))
    partial = []

    def counted(df, model, **more):
        partial.append(kernels.cluster_sums(df, model, **more))
        return partial[-1]

    monkeypatch.setattr(C, "cluster_sums", counted)
    core = coreset(points, 2, 500, 1, seed=1)
    assert core.count() == 1000
    pts_, _ = C._points(assign_parts(points, 500, seed=1))
    dealt = C._clustered(pts_, 500)
    rows = dealt.select("part", F.spark_partition_id().alias("task")).distinct().count()
    assert rows < 1.2 * 500


@pytest.mark.parametrize("bad", [[1.0, None], [1.0, float("nan")], [float("inf"), 0.0]])
def test_bad_coordinates_are_refused(spark, bad):
    p = pts(spark, [(0, [0.0, 0.0]), (1, bad)])
    with pytest.raises(Exception, match="NULL coordinate|non-finite"):
        assign_nearest(p, ctr(spark)).collect()


def test_points_can_be_reread_instead_of_cached(spark):
    emb = _emb(spark)
    cached = [(r.label, r.center) for r in kmedian(emb, 3, 2, seed=8).orderBy("label").collect()]
    spark.conf.set("tessera.pointsStorageLevel", "NONE")
    try:
        reread = [(r.label, r.center) for r in kmedian(emb, 3, 2, seed=8).orderBy("label").collect()]
    finally:
        spark.conf.unset("tessera.pointsStorageLevel")
    assert cached == reread


def test_mr_reports_round_times(spark):
    t = {}
    kmedian_mr(pts(spark), 2, 2, 1, seed=3, timings=t)
    assert set(t) == {"round1", "round2", "round3"} and all(v >= 0 for v in t.values())


def _clustered_points(spark, n, groups, dim=4, seed=1, partitions=None):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dim)) * 10
    rows = [(int(i), [float(x) for x in centers[rng.integers(groups)] + rng.normal(size=dim)]) for i in range(n)]
    df = spark.createDataFrame(rows, "id BIGINT, v ARRAY<DOUBLE>")
    return (df.repartition(partitions, "id") if partitions else df), rows


def _plain_race(rows, k, seed, weights=None):
    """k-means++ round by round over all points, as defined."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    w = np.ones(len(rows)) if weights is None else np.asarray(weights, float)

    def u(rnd):
        draws = [int(hashlib.md5(f"{seed}:{rnd}:{i}".encode()).hexdigest()[:13], 16) for i in ids]
        return (np.array(draws) + 1.0) / float(2**52 + 1)

    chosen = [int(np.lexsort((ids, u(0)))[0])]
    for rnd in range(1, min(k, len(rows))):
        d = kernels.distances(x, x[chosen]).min(axis=1)
        key = np.full(len(rows), np.inf)
        np.divide(-np.log(u(rnd)), w * d, out=key, where=w * d > 0)
        key[chosen] = np.nan
        order = np.lexsort((ids, key))
        chosen.append(int(next(i for i in order if i not in chosen)))
    return ids[chosen].tolist()


@pytest.mark.parametrize("n, groups, k", [(600, 60, 40), (300, 3, 30), (50, 50, 60), (400, 400, 200)])
def test_scans_of_many_rounds_pick_what_single_rounds_do(spark, n, groups, k):
    df, rows = _clustered_points(spark, n, groups, seed=n)
    if k <= n:
        s = seed_centers(df, k, seed=5).orderBy("label").collect()
        assert [r.id for r in s] == _plain_race(rows, k, 5)
    got = seed_centers(df.withColumn("part", F.lit(0)), k, seed=6).orderBy("label").collect()
    assert [r.id for r in got] == _plain_race(rows, k, 6)


def test_scans_with_weights_zeros_and_repeated_points(spark):
    rows = [(i, [float(i % 7), 0.0]) for i in range(60)]
    weights = [0.0 if i % 3 == 0 else float(i % 5 + 1) for i in range(60)]
    df = spark.createDataFrame([(i, v, w) for (i, v), w in zip(rows, weights)], "id BIGINT, v ARRAY<DOUBLE>, w DOUBLE")
    s = seed_centers(df, 45, seed=2, weight_col="w").orderBy("label").collect()
    assert [r.id for r in s] == _plain_race(rows, 45, 2, weights)


def test_seeding_measures_about_k_distances_a_point(spark):
    df, _ = _clustered_points(spark, 4000, 400, seed=3, partitions=5)
    taken = {}
    for k in (10, 100, 300):
        scans: list = []
        began = time.perf_counter()
        seed_centers(df, k, seed=1, scans=scans)
        taken[k] = (time.perf_counter() - began) / k
        # Rounds that a scan could not settle cost another one; the whole stays linear in k.
        assert sum(n for n, _ in scans) <= 4 * k and len(scans) <= 4 * math.log2(k), (k, scans)
        assert sum(done for _, done in scans) == k - 1
    assert taken[100] <= 3 * taken[10]


def test_bit_equal_however_the_points_are_dealt_out(spark):
    df, _ = _clustered_points(spark, 3000, 9, dim=5, seed=8)
    df = df.withColumn("w", F.lit(0.1) + F.col("id") % 7 / 3)
    seen = {"kmedian": set(), "mr": set(), "cost": set(), "weights": set()}
    for parts in (1, 4, 13):
        pts = df.repartition(parts, "id")
        got = kmedian(pts, 6, 9, seed=3, weight_col="w")
        centers = sorted((r.label, *r.center) for r in got.collect())
        seen["kmedian"].add(tuple(centers))
        seen["cost"].add(kmedian_cost(pts, got, weight_col="w").first().cost)
        seen["weights"].add(tuple(sorted((r.label, r.weight) for r in cluster_weights(pts, got, weight_col="w").collect())))
        seen["mr"].add(tuple(sorted((r.label, *r.center, r.cost) for r in kmedian_mr(pts, 4, 3, 4, seed=3).collect())))
    assert {k: len(v) for k, v in seen.items()} == dict.fromkeys(seen, 1)


def test_exact_sums():
    rng = np.random.default_rng(2)
    terms = rng.normal(size=(500, 3)) * 10.0 ** rng.integers(-30, 30, size=(500, 3))
    terms[0], terms[1] = 5e-324, -1e300
    terms[2] = 1e300
    labels = rng.integers(0, 4, 500)
    out = set()
    for order in (np.arange(500), rng.permutation(500), np.arange(500)[::-1]):
        one, parts = kernels._Exact(), []
        for rows in np.array_split(order, 7):
            e = kernels._Exact()
            e.add(0, labels[rows], terms[rows])
            parts.append(e)
        for e in parts:
            for key, n in e.counts.items():
                one.counts[key] = one.counts.get(key, 0) + n
            for key, total in e.limbs.items():
                one.put(*key, total)
        got = {r["label"]: (r["cnt"], r["sw"], r["sd"], *r["sx"]) for r in one.totals(3).to_pylist()}
        out.add(tuple(sorted(got.items())))
        for label, (n, *sums) in got.items():
            assert n == (labels == label).sum()
            for c, s in enumerate(sums):
                assert s == pytest.approx(math.fsum(terms[labels == label, c]), rel=1e-15, abs=1e-320)
    assert len(out) == 1


def test_coreset_in_waves_and_many_parts(spark):
    df, rows = _clustered_points(spark, 1500, 5, dim=3, seed=4)
    whole = sorted((r.part, r.label, *r.center, r.w) for r in coreset(df, 3, 12, 2, seed=1).collect())
    spark.conf.set("tessera.waveBytes", "200")  # two parts a wave
    try:
        waves = sorted((r.part, r.label, *r.center, r.w) for r in coreset(df, 3, 12, 2, seed=1).collect())
    finally:
        spark.conf.unset("tessera.waveBytes")
    assert waves == whole and sum(r[-1] for r in waves) == 1500
    # Far more parts than points: most parts are empty, the others hold a point or two.
    many = coreset(df, 2, 100_000, 1, seed=1).collect()
    assert sum(r.w for r in many) == 1500 and len({r.part for r in many}) > 1400


def _grouped(n, groups, dim, spread, seed=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, dim)) * 10
    return [(i, (middle[i % groups] + rng.normal(size=dim) * spread).tolist()) for i in range(n)]


@pytest.mark.parametrize(("groups", "spread", "parts"), [(40, 1.0, 1), (40, 1.0, 3), (1, 5.0, 1)])
def test_lloyd_with_bounds_gives_the_same_centers(spark, monkeypatch, groups, spread, parts):
    n, k = 3000, 40
    points = pts(spark, _grouped(n, groups, 6, spread)).withColumn("part", F.col("id") % parts)
    seeds = seed_centers(points, k).drop("id").cache()

    def run(least):
        monkeypatch.setattr(C, "BOUNDS_FROM", least)
        measured = []
        out = lloyd(points, seeds, 14, measured=measured).collect()
        return sorted((r.part, r.label, tuple(r.center)) for r in out), measured

    plain, every = run(10**9)
    bounded, measured = run(2)
    assert bounded == plain and len(measured) == len(every)
    assert every[0] == measured[0] == n * k and every[-1] <= n * k
    if groups > 1:
        # The second pass makes the bounds, which are made anew once they save less than half.
        assert measured[2] < 0.5 * every[2] and sum(measured[2:]) < sum(every[2:]), measured
    assert sum(measured) < 1.3 * sum(every)


def test_bounds_with_ties_repeated_points_and_one_center(spark, monkeypatch):
    monkeypatch.setattr(C, "BOUNDS_FROM", 1)
    grid = [(i, [float(i % 4), float(i // 4 % 4)]) for i in range(200)]
    for centers in ([(0, [1.5, 1.5])], [(0, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [3.0, 3.0]), (3, [3.0, 0.0]), (4, [9.0, 9.0])]):
        bounded = sorted(map(tuple, lloyd(pts(spark, grid), ctr(spark, centers), 9).collect()))
        monkeypatch.setattr(C, "BOUNDS_FROM", 10**9)
        assert bounded == sorted(map(tuple, lloyd(pts(spark, grid), ctr(spark, centers), 9).collect()))
        monkeypatch.setattr(C, "BOUNDS_FROM", 1)
