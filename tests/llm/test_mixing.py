import random
from collections import defaultdict

import pytest

from tessera.llm import mixing
from tests.llm.conftest import CLASHES


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        rest = [s for s in names if s not in capped]
        if not rest:
            break
        level = (share * sum(sizes.values()) - sum(limit * sizes[s] for s in capped)) / sum(weight[s] for s in rest)
        over = {s for s in rest if weight[s] * level > limit * sizes[s]}
        if not over:
            break
        capped |= over
    return {s: limit * sizes[s] if s in capped else weight[s] * level for s in names}


def check(rows, near=None):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    targets, taken = slow_targets(sizes), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    for s, t in targets.items():
        largest = max(r.size for r in rows if r.source == s)
        assert abs(taken[s] - t) <= (near or largest)


def test_documents(documents):
    rows = mixing.mix(documents).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.select("doc_id").collect())
    check(rows)
    again = mixing.mix(documents.repartition(7, "text")).collect()
    assert sorted(again) == sorted(rows)


def test_many_buckets_and_tree_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(0, 60), rng.choice("aaaaabc")) for i in range(2500)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 2500
    check(got)


def test_awkward_rows(awkward):
    got = mixing.mix(awkward).collect()
    assert len(got) == awkward.count()
    check(got)
    copies = mixing.take_copies(awkward)
    assert copies.columns == [*awkward.columns, "copy_"]
    want, have = defaultdict(int), defaultdict(int)
    for r in got:
        want[r.doc_id, r.source] += r.copies
    for r in copies.collect():
        have[r.doc_id, r.source] += 1
    assert have == {k: n for k, n in want.items() if n}


def test_copies_of_the_documents(documents):
    want = {r.doc_id: r.copies for r in mixing.mix(documents).collect() if r.copies}
    rows = mixing.take_copies(documents).collect()
    have = defaultdict(list)
    for r in rows:
        have[r.doc_id].append(r["copy"])
    assert {k: sorted(v) for k, v in have.items()} == {k: list(range(1, n + 1)) for k, n in want.items()}
    assert CLASHES and all(r.text is not None for r in rows)


def test_empty(empty_docs):
    assert mixing.mix(empty_docs).count() == 0
    assert mixing.take_copies(empty_docs).count() == 0


def test_pivot_keeps_words_and_expectations():
    rng = random.Random(1)
    for _ in range(300):
        s, t = rng.randrange(1, 50), rng.randrange(1, 50)
        p, q = rng.uniform(0.01, 0.99), rng.uniform(0.01, 0.99)
        up, down = min(s * (1 - p), t * q), min(s * p, t * (1 - q))
        chance = down / (up + down)
        a, b = mixing.pivot(s, p, t, q, 0.0), mixing.pivot(s, p, t, q, 1 - 1e-12)
        for x, y in (a, b):
            assert s * x + t * y == pytest.approx(s * p + t * q) and (x in (0.0, 1.0) or y in (0.0, 1.0))
        assert chance * a[0] + (1 - chance) * b[0] == pytest.approx(p)
        assert chance * a[1] + (1 - chance) * b[1] == pytest.approx(q)
