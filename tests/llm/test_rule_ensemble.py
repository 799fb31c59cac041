import random
import zlib

import pytest

from tessera.llm import rule_ensemble as R
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = R.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    test = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in test) / len(test) > 0.95
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)


def test_score_reads_only_the_statistics(spark):
    """Other columns and held-out labels change nothing."""
    rng = random.Random(1)
    docs = [(i, prose(i, 60) if i % 3 else "@@ %% " * 30 + prose(i, 5), rng.choice("abc")) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    def labels(flip):
        return spark.createDataFrame([(i, int(i % 3 > 0) ^ (flip and zlib.crc32(str(i).encode()) % 4 == 2)) for i in range(200)], "doc_id long, quality int")
    a = {r.doc_id: r.score for r in R.classify(df, labels(False)).collect()}
    b = {r.doc_id: r.score for r in R.classify(df.withColumn("source", df.doc_id.cast("string")), labels(True)).collect()}
    assert a == b
    assert all((a[i] > 0.7) == (i % 3 > 0) for i in range(200))


def test_compiled_rules_match_their_meaning(spark):
    rules = (R.Rule((("n_words", 3.0, True), ("upper", 0.5, False))), 1.5), (R.Rule((("upper", 0.2, True),)), -2.0)
    model = R.Ensemble(0.25, rules)
    rows = [(float(n), u) for n in (0, 3, 4, 9) for u in (0.0, 0.2, 0.3, 0.5, 0.6)]
    df = spark.createDataFrame(rows, "n_words double, upper double")
    import math

    for r in df.withColumn("score", model.score()).collect():
        total = 0.25 + 1.5 * (r.n_words > 3 and r.upper <= 0.5) - 2.0 * (r.upper > 0.2)
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)))


def test_awkward_rows(spark, awkward, empty_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (7, 1), (99, 1)], "doc_id long, quality int")
    rows = R.classify(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(r.score is not None and 0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False, False]
    assert R.classify(empty_docs, labels).count() == 0
    assert {r.score for r in R.classify(awkward, labels.limit(0)).collect()} == {0.5}


def test_statistics_of_blank_texts_are_zero(awkward):
    for r in R.statistics(awkward).collect():
        if not (r.row.text or "").strip(" \t\n\r\x0b\x0c"):
            assert all(r[s] == 0 for s in R.STATS)
