"""Phrase collocations against SQL and against plain counting, and the guarantee of the summaries."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.compare import compare, duck
from tessera.llm import collocations as C
from tessera.llm import queries
from tests.llm.conftest import SF, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(rows, most):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    counts[lang or "und", tuple(w[i : i + k])] += 1
    return counts, n


def brute(rows, most=3, least=10, top=2000):
    counts, n = grams(rows, most)
    cand = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    inside = {}
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(inside.get((lang, w[i : i + k]), 0), a)
    out = []
    for lang in n:
        best = []
        for (of, w), a in cand.items():
            if of != lang or 100 * inside.get((of, w), 0) >= 50 * a > 0:
                continue
            cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            best.append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_query_matches_sql(spark):
    res = compare(queries.op11_collocations(spark, SF), duck(SF), queries.SQL["op11_collocations"])
    assert res["values_match"] and res["rows_spark"] == res["rows_sql"] > 50, res


@pytest.mark.parametrize("most", [2, 4])
def test_awkward_rows_and_small_steps(spark, awkward, awkward_rows, monkeypatch, most):
    many = [("of the A.b c\td  e", None)] * 12 + [("x" * 200 + " y " + "x" * 70, "en"), ("y z y z y z", "en")] * 6
    rows = [(r[1], r[2]) for r in awkward_rows] + many
    extra = spark.createDataFrame(many, "text string, lang string")
    docs = awkward.unionByName(extra, allowMissingColumns=True)
    for name, value in (("HASH_BYTES", 512), ("COUNT_TOKENS", 64), ("PHRASE_TOKENS", 64), ("PARTITION_BYTES", 4096)):
        monkeypatch.setattr(C, name, value)
    expected = brute(rows, most, 5)
    assert rows_of(C.collocations(docs, most, 5)) == expected and len(expected) >= 5
    # A filter far too small for the survivors costs work, not results.
    counts = C.ngram_counts(docs, most, 5, filter_bytes=1024)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.a for r in counts.where("n_words > 0").collect()}
    assert got == {k: a for k, a in grams(rows, most)[0].items() if a >= 5}


def test_top_of_a_language_and_ties(spark):
    rows = [(f"a{k} b{k}" if k % 3 else f"a{k} b{k}. a{k} b{k}", "en") for k in range(300)] * 6
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert rows_of(C.collocations(docs, 3, 5, top=40)) == brute(rows, 3, 5, 40)


def test_empty_table_and_texts(spark, empty_docs):
    assert C.collocations(empty_docs).count() == 0
    blank = spark.createDataFrame([(None, "en"), ("", None), (" .\t\n", "en")], "text string, lang string")
    assert C.collocations(blank).count() == 0


def test_counts_past_64_bits():
    a = 10**13  # exact in the decimal arithmetic of the score
    assert len(str(10**6 * a * a)) <= 38


def test_merged_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(5)
    stream = rng.zipf(1.3, 40_000).astype(np.uint32)
    for threshold in (5, 40):
        s = C.Summary(len(stream) // threshold + 1)
        for part in np.array_split(stream, 37):
            s.merge(*(lambda k, n: (k, n.astype(np.int64)))(*np.unique(part, return_counts=True)))
        keys, counts = np.unique(stream, return_counts=True)
        assert set(keys[counts >= threshold]) <= set(s.frequent(threshold).tolist())
        assert s.error < threshold and len(s.keys) <= s.capacity
        kept = dict(zip(s.keys.tolist(), s.counts.tolist(), strict=True))
        assert all(n - s.error <= kept.get(k, 0) <= n for k, n in zip(keys.tolist(), counts.tolist(), strict=True))


def test_word_hashes_tell_words_apart():
    text = " ".join([prose(3, 400), "ab abc abcd abcdefgh abcdefghi", "q" * 64, "q" * 65, "q" * 66, "q" * 64 + "r"]).encode()
    words = C.Words(np.frombuffer(text, np.uint8), np.array([0]))
    expected = text.split()
    assert [words.phrase(k, 1).encode() for k in range(len(words.start))] == expected
    for seed in (0, 1):
        h = words.hashes(seed)
        assert len(set(h.tolist())) == len(set(expected))


def test_hot_language_report_has_no_whole_sort(spark, documents):
    plan = C.collocations(documents.withColumn("lang", F.lit("en")))._jdf.queryExecution().executedPlan().toString()
    assert "salt" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
