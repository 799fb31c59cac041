import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import decontaminate as D
from tests.llm.conftest import prose


def slow_distance(item, text):
    """Least edits between item and any stretch of text: the textbook table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != word), row[i + 1] + 1, new[-1] + 1))
        row = new
        best = min(best, row[-1])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=90), st.lists(st.integers(0, 4), max_size=120))
def test_bit_parallel_distance(item, text):
    assert D.edit_distance_within(item, text) == slow_distance(item, text)


def slow_matches(items, text, share=0.2):
    out = set()
    words = D.tokens(text or "")
    for item_id, t in items:
        w = D.tokens(t or "")
        if w and (d := slow_distance(w, words)) <= int(share * len(w)):
            out.add((item_id, d))
    return out


def edited(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = "zq"
        elif kind == 1:
            out.insert(at, "zq")
        elif len(out) > 1:
            del out[at]
    return out


def test_matches_brute_force():
    rng = random.Random(2)
    items = [(i, prose(i, rng.randrange(1, 60), 300)) for i in range(25)] + [(90, ""), (91, "!!"), (92, "same same same same same")]
    matcher = D.Matcher(items)
    for k in range(250):
        parts = [prose(1000 + k, rng.randrange(0, 80), 300)]
        for _ in range(rng.randrange(0, 3)):
            w = D.tokens(rng.choice(items)[1])
            if w:
                parts.append(" ".join(edited(w, rng.randrange(0, 2 + len(w) // 4), rng)))
        rng.shuffle(parts)
        text = " ".join(parts).title() + "."
        assert {(m.item, m.distance) for m in matcher.find(text)} == slow_matches(items, text)


def test_corpus(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")

    def plain(t):
        return " ".join(re.findall(r"\w+", t.lower()))

    items = [(r.item_id, plain(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in documents.collect() for i, t in items if t in plain(r.text)}
    rows = D.contaminations(documents, bench).collect()
    assert want and {(r.doc_id, r.item_id) for r in rows if r.distance == 0} == want
    left = {r.doc_id for r in D.drop_contaminated(documents, bench).collect()}
    assert left == {r.doc_id for r in documents.collect()} - {r.doc_id for r in rows}


def test_items_in_blocks(spark, documents, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = sorted(map(tuple, D.contaminations(documents, bench).collect()))
    monkeypatch.setattr(D, "BLOCK_WORDS", 200)
    assert len(list(D.item_blocks(bench))) > 3
    assert sorted(map(tuple, D.contaminations(documents, bench).collect())) == want


def test_awkward_rows(spark, awkward, empty_docs):
    text = {r.doc_id: r.text for r in awkward.collect()}
    items = [(1, text[1]), (1, text[1]), (2, None), (3, ""), (None, text[6]), (4, text[6].replace("w1", "w2", 1)), (5, "漢字 einmal")]
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = D.contaminations(awkward, items).collect()
    assert sorted(((r.doc_id, r.item_id) for r in rows), key=repr) == sorted([(1, 1), (None, 1), (6, 4), (6, 4)], key=repr)
    left = D.drop_contaminated(awkward, items)
    assert left.columns == awkward.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([2, 3, 4, 5, 7, 7, None, 8, 9], key=repr)
    assert D.contaminations(empty_docs, items).count() == 0 and D.drop_contaminated(empty_docs, items).count() == 0
    assert D.contaminations(awkward, items.limit(0)).count() == 0
    assert D.drop_contaminated(awkward, items.limit(0)).count() == awkward.count()
