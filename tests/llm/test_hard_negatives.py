"""Hard negatives against SQL and a full search."""

import numpy as np
import pytest

from tessera.compare import compare, duck
from tessera.llm import hard_negatives as H
from tessera.llm import queries
from tests.llm.conftest import CLASHES, SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(np.float32(x)) for x in v):
            continue
        q = [int(np.floor(scale * np.float64(np.float32(x)))) for x in v]
        key = (label, np.array(q, float).tobytes())
        if i not in kept or key < kept[i][0]:
            kept[i] = (key, q, label)
    out = []
    for a, (_, qa, la) in kept.items():
        if a % every:
            continue
        score = {b: sum(x * y for x, y in zip(qa, qb, strict=True)) for b, (_, qb, _) in kept.items() if b != a}
        same = sorted((-s, b) for b, s in score.items() if kept[b][2] == la)[:positives]
        for s, p in same:
            ok = sorted((-t, b) for b, t in score.items() if kept[b][2] != la and low * -s <= 100 * t <= high * -s)
            out += [(a, p, k, b, -s, -t) for k, (t, b) in enumerate(ok[:negatives], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def vectors(seed, n, dim=8, labels=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    return [(int(i), [float(x) for x in np.float32(centers[rng.integers(6)] * 0.3 + rng.normal(size=dim) * 0.1)], int(rng.integers(labels))) for i in range(n)]


def test_query_matches_sql(spark):
    res = compare(queries.op12_hard_negatives(spark, SF), duck(SF), queries.SQL["op12_hard_negatives"])
    assert res["values_match"] and res["rows_spark"] == res["rows_sql"] > 200, res


def test_blocks_of_anchors_and_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 32)
    rows = vectors(1, 400)
    rows += [(7, rows[7][1], rows[7][2])] * 2  # repeated rows, and an id with two vectors
    rows += [(9, [0.5] * 8, 0), (10, [9.0] * 8, 3)]
    # Ties, a hot vector, and zero vectors.
    rows += [(1000 + k, [0.25] * 8, k % 2) for k in range(150)] + [(2000 + k, [0.0] * 8, k % 3) for k in range(20)]
    rows += [(None, [0.1] * 8, 1), (3000, None, 1), (3010, [0.1] * 8, None), (3020, [0.1] * 7 + [None], 1), (3030, [float("nan")] * 8, 1), (3040, [float("inf")] + [0.1] * 7, 2)]
    rows += [(4000, [-0.3] * 8, 77), (-50, [0.3] * 8, 1)]  # alone with its label; a negative id
    extra = CLASHES + ["cell", "block", "anchor", "slot", "v"]
    df = spark.createDataFrame([r + tuple("x" for _ in extra) for r in rows], SCHEMA + "".join(f", {c} string" for c in extra))
    got = rows_of(H.hard_negatives(df, anchor_every=10, codewords=5, block_anchors=20))
    assert got == brute(rows, 10) and len(got) > 1000


def test_wide_and_narrow_windows(spark):
    rows = vectors(2, 200)
    df = spark.createDataFrame(rows, SCHEMA)
    for window in ((0, 100), (89, 90), (95, 300)):
        got = rows_of(H.hard_negatives(df, anchor_every=5, positives=3, negatives=4, window=window))
        assert got == brute(rows, 5, 3, 4, *window)


@pytest.mark.parametrize("dim", [1, 2])
def test_narrow_vectors(spark, dim):
    rows = vectors(3, 60, dim)
    assert rows_of(H.hard_negatives(spark.createDataFrame(rows, SCHEMA), 10)) == brute(rows, 10)


def test_empty_tables(spark):
    assert H.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert H.hard_negatives(spark.createDataFrame([(1, [1.0, 2.0], 0)], SCHEMA)).count() == 0
    assert H.hard_negatives(spark.createDataFrame([(100, [1.0, 2.0], 0)], SCHEMA)).count() == 0
    assert H.hard_negatives(spark.createDataFrame([(100, None, 0)], SCHEMA)).count() == 0


def test_bad_vectors_are_errors(spark):
    for v in ([1.0], [1e20, 0.0]):
        with pytest.raises(Exception, match="different length|too long"):
            H.hard_negatives(spark.createDataFrame([(100, [1.0, 2.0], 0), (1, v, 0)], SCHEMA)).collect()


def test_order_of_cells_is_falling_and_bounds_every_row():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(size=(500, 6)) * 0.2)
    books = H.Codebooks(H._fit(x[:, :3], 4), H._fit(x[:, 3:], 4))
    cell, r0, r1 = books.cells(x)
    for c in np.unique(cell):
        at = divmod(int(c), len(books.second))
        books.counts[at], books.radii[0][at], books.radii[1][at] = (cell == c).sum(), r0[cell == c].max(), r1[cell == c].max()
    for a in x[:20]:
        order = list(books.order(a))
        bounds = [b for b, _ in order]
        assert bounds == sorted(bounds, reverse=True) and sorted(c for _, c in order) == sorted(np.unique(cell).tolist())
        assert all((x[cell == c] @ a).max() <= b for b, c in order)
