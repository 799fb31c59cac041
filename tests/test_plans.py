"""Physical-plan shape: the properties the operators rely on at scale."""

from tessera import harmonic_mean, normalize_by_max, word_count, word_count_partitioned, word_count_report, word_count_salted
from tessera.functions import kernels
from tessera.operators import clustering as C
from tessera.plans import catalog
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_word_count_reads_only_text_and_combines_per_task(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    p = plan(word_count(docs.select("doc_id", "text")))
    assert "ReadSchema: struct<text:string>" in p or "struct<text:string>" in p
    assert "partial_count" in p and "Join" not in p
    assert p.count("hashpartitioning(word") == 1


def test_salted_word_count_has_two_rounds(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    p = plan(word_count_salted(docs, salts=4))
    assert p.count("hashpartitioning(") == 2 and "xxhash64" in p


def test_numbers_one_scan_no_join(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    p = plan(harmonic_mean(li, "l_quantity"))
    assert "Join" not in p and "struct<l_quantity:double>" in p and p.count("partial_max") == 1
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    p = plan(normalize_by_max(ev, "value", keep=("event_id",)))
    assert "Join" not in p and p.count("partial_max") == 1


def inner_frames(spark, monkeypatch, name) -> list[str]:
    """Plans of the distance steps inside an operator that runs its jobs while it is built."""
    seen = []
    for step in ("race", "cluster_sums", "nearest_rows"):

        def wrapped(*args, _step=getattr(kernels, step), **more):
            seen.append(plan(out := _step(*args, **more)))
            return out

        monkeypatch.setattr(C, step, wrapped)
    seen.append(plan(catalog.QUERIES[name](spark, SF_SMALL)))
    return seen


def test_distance_steps_scan_once_without_join_or_cap(spark, monkeypatch):
    for name in ("seed_centers", "lloyd", "lloyd_step", "kmedian", "coreset", "kmedian_mr", "kmedian_cost", "cluster_sizes", "assign_nearest"):
        frames = inner_frames(spark, monkeypatch, name)
        monkeypatch.undo()
        assert len(frames) > 1, name
        for p in frames:
            for word in ("Join", "Cartesian", "Limit", "Sample", "TakeOrdered"):
                assert word not in p, (name, word)


def test_no_row_caps_or_sampling_in_registered_queries(spark):
    for name, q in catalog.QUERIES.items():
        p = plan(q(spark, SF_SMALL))
        if name == "max_value_sorted":  # the top-1 is the operator itself
            assert "TakeOrderedAndProject" in p or "Limit" in p
            continue
        for word in ("Limit", "Sample", "TakeOrdered"):
            assert word not in p, (name, word)


def test_partitioned_word_count_has_its_own_plan(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert "RoundRobinPartitioning(3)" in plan(word_count_partitioned(docs, parts=3))
    assert "RoundRobin" not in plan(word_count(docs))


def test_report_reads_and_tokenizes_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    p = plan(word_count_report(docs, parts=3))
    assert p.count("Scan parquet") == 1 and p.count("RoundRobinPartitioning(3)") == 1 and p.count("Generate explode") <= 2


def test_building_word_counts_starts_no_job(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").groupBy("doc_id").agg({"text": "max"})
    docs = docs.withColumnRenamed("max(text)", "text")
    sc = spark.sparkContext
    sc.setJobGroup("building", "nothing should run")
    try:
        word_count_report(docs, parts=3)
        word_count(docs)
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
