import pytest

from tessera import read_documents, read_numbers, read_points, seed_centers
from tessera.sources import text as text_source


def test_read_numbers_file(spark, tmp_path):
    p = tmp_path / "numbers.txt"
    p.write_text("\n".join(f"{i}.0" for i in range(1, 11)) + "\n")
    assert sorted(r.x for r in read_numbers(spark, str(p)).collect()) == [float(i) for i in range(1, 11)]


def test_read_documents_lines(spark, tmp_path):
    p = tmp_path / "docs.txt"
    p.write_text("x yy x\nyy zzz\n")
    rows = read_documents(spark, str(p)).collect()
    assert sorted(r.text for r in rows) == ["x yy x", "yy zzz"]
    assert len({r.doc_id for r in rows}) == 2


def test_read_points(spark, tmp_path):
    p = tmp_path / "points.txt"
    p.write_text("0 0\n0 1\n10 0\n10 1\n")
    pts = read_points(spark, str(p), min_partitions=2).collect()
    assert sorted(tuple(r.v) for r in pts) == [(0.0, 0.0), (0.0, 1.0), (10.0, 0.0), (10.0, 1.0)]


@pytest.fixture
def split_bytes(spark):
    """Sets the size of file splits; back to the defaults afterwards."""
    names = [f"spark.sql.files.{n}" for n in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")]
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(names, (str(n), "0", "1"), strict=True)]
    for k in names:
        spark.conf.unset(k)


def test_line_numbers_do_not_depend_on_the_splits(spark, tmp_path, split_bytes):
    """One, three and seven splits of a file, and several files of unlike size with all kinds of line ends."""
    lines = [f"{i % 50} {i % 7}" for i in range(3000)]
    p = tmp_path / "points.txt"
    p.write_text("\n".join(lines) + "\n")
    size = p.stat().st_size
    for splits in (1, 3, 7):
        split_bytes(size // splits + 1)
        assert spark.read.text(str(p)).rdd.getNumPartitions() == splits
        rows = read_documents(spark, str(p)).collect()
        assert sorted((r.doc_id, r.text) for r in rows) == list(enumerate(lines))
    folder = tmp_path / "many"
    folder.mkdir()
    texts = {"b.txt": "x\r\n\r\ny", "a.txt": "same\n" * 900 + "end", "c.txt": "", "d.txt": "\n\n", "e.txt": "ü\n" * 300}
    for name, t in texts.items():
        (folder / name).write_bytes(t.encode())
    want = [line for name in sorted(texts) for line in texts[name].splitlines()]
    for n in (64, 700, 1 << 20):
        split_bytes(n)
        assert sorted((r.doc_id, r.text) for r in read_documents(spark, str(folder)).collect()) == list(enumerate(want))


def test_numbered_points_seed_alike(spark, tmp_path, split_bytes):
    p = tmp_path / "points.txt"
    p.write_text("".join(f"{i % 50} {i % 7}\n" for i in range(3000)))
    seen = set()
    for n in (1, 3, 7):
        split_bytes(p.stat().st_size // n + 1)
        seen.add(tuple(sorted((r.id, *r.center) for r in seed_centers(read_points(spark, str(p), n), 4, seed=3).collect())))
    assert len(seen) == 1


def test_numbering_shuffles_no_text(spark, tmp_path, monkeypatch):
    p = tmp_path / "docs.txt"
    p.write_text("one\ntwo\n")

    def exchanges(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [x for x in plan.splitlines() if "Exchange" in x]

    found = exchanges(read_documents(spark, str(p)))
    assert any("BroadcastExchange" in x for x in found)
    # The counts meet by file and split; the line itself is in none of the exchanges.
    assert all("value" not in x for x in found) and not any("SortMergeJoin" in x for x in found)
    # Beyond the bound the sums are joined without a broadcast.
    monkeypatch.setattr(text_source, "_MAX_BROADCAST_BYTES", 0)
    df = read_documents(spark, str(p))
    assert not any("BroadcastExchange" in x for x in exchanges(df))
    assert sorted(map(tuple, df.collect())) == [(0, "one"), (1, "two")]


def test_lines_of_a_table_are_numbered_in_blocks(spark):
    df = spark.createDataFrame([("same",)] * 9000 + [("other",), (None,)], "value string")
    rows = text_source.with_line_ids(df, "value", "id").collect()
    assert len({r.id for r in rows}) == 9001 and sum(r.value == "same" for r in rows) == 9000
