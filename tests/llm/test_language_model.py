import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import language_model as LM


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [" "]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    c = Counter()
    for d, t in rows:
        if not held(d):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for d, t in rows:
        w = tokens(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        want[d, held(d), len(w), sum(c[x] > 0 for x in w), n, round(base, 4)] += 1
    got = LM.score(docs, **options).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    return got


def test_documents(documents):
    got = check(documents)
    base, model = (sum(getattr(r, c) for r in got if r.held_out) for c in ("base_score", "score"))
    assert model > base and all(r.score < 0 for r in got)


def test_rare_words_are_joined(documents):
    """With a small head most words get their counts in the join."""
    check(documents, head_words=50)


def test_awkward_rows(awkward):
    check(awkward)


def test_empty(spark, empty_docs):
    assert LM.score(empty_docs).count() == 0
    only_held = spark.createDataFrame([(next(i for i in range(99) if held(i)), "a b")], "doc_id long, text string")
    r = check(only_held)[0]
    assert r.n_known == 0 and r.score <= 0


def test_filter_reads_back_quantised_counts():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2**63, 20000).astype(np.uint64) << np.uint64(1))
    counts = rng.geometric(0.3, len(hashes)).astype(np.int64) ** 2
    size, bits = LM.build_shard(hashes, counts)
    f = LM.Filter(np.array([size]), bits)
    q = LM.level(counts)
    got = f.levels(hashes)
    assert (got >= q).all() and (got == q).mean() > 0.9  # never under, seldom over
    absent = rng.integers(0, 2**63, 20000).astype(np.uint64) << np.uint64(1) | np.uint64(1)
    assert (f.levels(absent) > 0).mean() < 0.05
    assert [int(x) for x in LM.level(np.array([1, 2, 3, 4, 7, 8]))] == [1, 2, 2, 3, 3, 4]


def test_filter_holds_every_ngram():
    hashes = np.arange(10000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.where(np.arange(10000) % 10 == 0, 50, 1)
    size, bits = LM.build_shard(hashes, counts)
    assert (LM.Filter(np.array([size]), bits).levels(hashes) >= LM.level(counts)).all()


def test_probabilities_after_a_word_sum_to_one(spark):
    """Over the vocabulary and one unknown word, but for quantised counts (powers of two here)."""
    docs = spark.createDataFrame([("a b a c " * 2,), ("a b " * 2,)], "text string").selectExpr("cast(text as binary) as text")
    model, counts = LM.train(docs, prior=4.0)
    vocabulary = np.array([r.word for r in counts.collect()], np.int64).view(np.uint64)
    a = LM.token_hashes(b"a")[:1]
    total = 0.0
    for w in [*vocabulary, np.uint64(12345)]:
        pair = np.array([a[0], w], np.uint64)
        total += 10 ** model.log10_p(pair, np.array([0]))[1]
    assert total == pytest.approx(1.0, abs=0.25)


def test_blocks_of_the_filter_give_what_the_whole_gives(documents, awkward):
    """A broadcast of at most 20 kB, so that the filter needs many passes, and leaves no n-gram out."""
    for docs, options in ((documents, {"head_words": 50}), (awkward, {})):
        whole = sorted(((r.doc_id or -1, r.n_tokens, r.score) for r in LM.score(docs, **options).collect()))
        got = sorted(((r.doc_id or -1, r.n_tokens, r.score) for r in check(docs, max_bytes=20000, **options)))
        assert [x[:2] for x in got] == [x[:2] for x in whole]
        assert [x[2] for x in got] == pytest.approx([x[2] for x in whole])


def test_the_filter_holds_every_word_and_pair(documents):
    text = documents.selectExpr("cast(text as binary) as text")
    trained = LM.fit(text, head_words=0)
    blocks = trained.blocks(20000)
    assert len(blocks) > 3 and all(a[1] == b[0] for a, b in zip(blocks, blocks[1:])) and blocks[-1][1] == len(trained.sizes)
    words = np.array([r.word for r in trained.counts.collect()], np.int64).view(np.uint64)
    models = [trained.load(*b) for b in blocks]
    assert (sum(m.filter.levels(words) for m in models) > 0).all()
    some = LM.token_hashes(text.first()[0])
    pairs = LM.pair_hashes(some[:-1], some[1:])
    assert (sum(m.filter.levels(pairs) for m in models) > 0).all()


@pytest.mark.parametrize("max_bytes", [LM.MAX_BYTES, 20000])
def test_scores_against_exact_counts(documents, max_bytes):
    """The same smoothing by exact, then quantised counts of all pairs: the filter errs upwards only, and seldom."""
    texts = {r.doc_id: tokens(r.text) for r in documents.collect()}
    single, pair = Counter(), Counter()
    for d, w in texts.items():
        if not held(d):
            single.update(w)
            pair.update(zip([" ", *w], w))
    n, v = sum(single.values()), len(single)
    errors = []
    for r in LM.score(documents, max_bytes=max_bytes).collect():
        w = texts[r.doc_id]
        want = 0.0
        for a, b in zip([" ", *w], w):
            c = pair[a, b]
            c = min((2 ** (c.bit_length() - 1) + 2 ** c.bit_length() - 1) / 2 if c else 0, single[a], single[b])
            want += math.log10((c + LM.PRIOR * (single[b] + 1) / (n + v + 1)) / (single[a] + LM.PRIOR))
        errors.append((r.score - want) / len(w))
    assert min(errors) > -1e-9 and sum(errors) / len(errors) < 0.02


def test_more_blocks_ask_no_more(documents):
    """What is written for the blocks of the filter does not grow with their number."""
    rows = documents.selectExpr("doc_id", "false as held_out", "cast(text as binary) as text")
    trained = LM.fit(rows.select("text"), head_words=50)
    asked = []
    for max_bytes in (60_000, 10_000):
        blocks = trained.blocks(max_bytes)
        made = []
        keep = LM.materialize
        LM.materialize = lambda df, *by, made=made: made.append(keep(df, *by)) or made[-1]
        try:
            LM._routed(rows, trained, blocks)
        finally:
            LM.materialize = keep
        asked.append((len(blocks), made[0].selectExpr("sum(length(asked))").first()[0]))
    assert asked[1][0] > 2 * asked[0][0] > 2 and asked[0][1] == asked[1][1]
