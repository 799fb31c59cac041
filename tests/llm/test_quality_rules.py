import math
import re
from collections import Counter

import pytest

from tessera.llm import quality_rules as Q
from tessera.llm.queries import op8_quality_rules
from tests.llm.conftest import SF


def slow_base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_and_labels(spark, documents):
    text = {r.doc_id: r.text for r in documents.collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op8_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == slow_base(text[r.doc_id])
        assert r.kept == (not r.base_failed and r.llr >= Q.THRESHOLD)
        if not r.base_failed and label.get(r.doc_id) == 1:
            assert r.kept, "a clean document goes"


def test_ratio_is_the_mean_over_ngrams(spark):
    docs = spark.createDataFrame([(1, "a b c a b"), (2, "x y"), (3, "")], "doc_id long, text string")
    target = docs.where("doc_id = 1")
    n = 64

    def bucket(*words):
        h = docs.selectExpr(*[f"xxhash64('{w}')" for w in words]).first()
        return (h[0] if len(words) == 1 else docs.selectExpr(f"xxhash64({h[0]}L, {h[1]}L)").first()[0]) % n

    def counts(texts):
        c = Counter()
        for t in texts:
            w = t.split()
            c.update(bucket(x) for x in w)
            c.update(bucket(a, b) for a, b in zip(w, w[1:], strict=False))
        return c

    t, r = counts(["a b c a b"]), counts(["a b c a b", "x y"])
    assert {x.bucket: x.n for x in Q.bucket_counts(docs, buckets=n).collect()} == dict(r)
    want = [math.log((t[i] + 1) / (sum(t.values()) + n)) - math.log((r[i] + 1) / (sum(r.values()) + n)) for i in range(n)]
    got = Q.bucket_ratios(Q.bucket_counts(target, buckets=n), Q.bucket_counts(docs, buckets=n), n)
    assert got == pytest.approx(want)
    llr = {x.row.doc_id: x.llr for x in Q.judge(docs, got).collect()}
    assert llr[3] == 0 and llr[2] == pytest.approx((want[bucket("x")] + want[bucket("y")] + want[bucket("x", "y")]) / 3)


def test_awkward_rows(awkward):
    rows = Q.judge(awkward, [0.0] * 16).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == slow_base(r.row.text) and r.kept == (not r.base_failed)


@pytest.mark.parametrize("text", ["a b c d e f g h " * 6, "x " * 7, "x " * 8, "x " * 9, "a\n\na\n \n \na \na", "p q " * 40 + " ".join(map(str, range(300)))])
def test_repeats(spark, text):
    r = Q.judge(spark.createDataFrame([(1, text)], "doc_id long, text string"), [0.0] * 4).first()
    assert tuple(r[c] for c in COLUMNS) == slow_base(text)


def test_every_labelled_document_is_trusted(spark):
    n = 20_500
    docs = spark.range(n).selectExpr("id AS doc_id", "'a b' AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "int(id % 100 > 0) AS quality")
    assert Q.trusted(docs, labels).count() == n - n // 100
    # A repeated label counts once, a repeated document twice; NULL ids and labels match nothing.
    few = spark.createDataFrame([(1, "x"), (1, "y z"), (2, "x"), (None, "x"), (3, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, 1), (4, 1), (2, None)], "doc_id long, quality int")
    found = Q.trusted(few, marks)
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "x"), (1, "y z"), (3, None)]
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_empty(spark, empty_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.quality_rules(empty_docs, labels).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op8_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
