import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import lines as L
from tests.llm.conftest import prose


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=40), st.lists(st.integers(0, 12), max_size=40))
def test_patience_pairs_are_common_subsequences(a, b):
    pairs = L.patience_matches(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    if a == b:
        assert len(pairs) == len(a)
    covered = [j for s, e in L.common_blocks(a, b) for j in range(s, e)]
    assert covered == [j for _, j in pairs]


def longest(seq):
    best = [1] * len(seq)
    for i in range(len(seq)):
        for j in range(i):
            if seq[j] < seq[i]:
                best[i] = max(best[i], best[j] + 1)
    return max(best, default=0)


@given(st.permutations(range(12)))
def test_longest_increasing(order):
    out = L._longest_increasing([(x, k) for k, x in enumerate(order)])
    assert len(out) == longest(order) and all(p < q for p, q in zip(out, out[1:], strict=False))


def keys_of(seq):
    """Lines, and two lines in a row."""
    return set(seq) | set(zip(seq, seq[1:], strict=False))


def slow_deletions(texts, rare_docs=16, least_words=8, passage_words=L.PASSAGE_WORDS, every=False):
    """Every document against every earlier one that shares a rare line or two lines in a row, or holds one first, or has
    the same lines; with ``every``, against all earlier ones that share a line."""
    lines = {k: [(i, x.strip()) for i, x in enumerate(t.split("\n")) if x.strip()] for k, t in texts.items()}
    seqs = {k: [x for _, x in own] for k, own in lines.items()}
    holders = {}
    for k in sorted(seqs):
        for x in keys_of(seqs[k]):
            holders.setdefault(x, []).append(k)
    lost = {}
    for k, seq in seqs.items():
        for h in {h for x in seq for h in holders[x] if h < k}:
            common = keys_of(seqs[h]) & keys_of(seq)
            rare = {x for x in common if len(holders[x]) <= rare_docs}
            if not (every or rare or any(holders[x][0] == h for x in common) or seqs[h] == seq):
                continue
            for s, e in L.common_blocks(seqs[h], seq):
                words = sum(len(x.split()) for x in seq[s:e])
                if words >= least_words and (e - s > 1 or words >= passage_words or rare & set(seq[s:e])) or e - s == len(seq):
                    lost.setdefault(k, set()).update(lines[k][i][0] for i in range(s, e))
    return lost


def test_matches_brute_force(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    want = slow_deletions(texts)
    got = {r.doc_id: {i for i, keep in enumerate(r.keep) if not keep} for r in L.deletions(documents).collect()}
    assert want and got == want
    left = {r.row.doc_id: r.text for r in L.dedup_lines(documents).collect()}
    for k, t in texts.items():
        assert left[k] == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want.get(k, ()))


def test_many_copies_and_frequent_lines(spark):
    rng = random.Random(6)
    menu, block = prose(1, 12), [prose(k, 12) for k in range(10, 14)]
    texts = {i: "\n".join([prose(100 + i, 15), menu, prose(500 + i, 15)]) for i in range(80)}  # a lone frequent line
    texts |= {100 + i: "\n".join([*block, prose(900 + i, 15)]) for i in range(60)}  # a frequent block
    near = [prose(k, 12) for k in range(30, 50)]
    for i in range(60):  # near copies
        lines = list(near)
        lines[rng.randrange(20)] = prose(2000 + i, 12)
        texts[200 + i] = "\n".join(lines)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.n_deleted for r in L.deletions(docs).collect()}
    assert not any(i in got for i in range(80)) and all(got[100 + i] == 4 for i in range(1, 60))
    assert got.keys() >= set(range(201, 260)) and min(got[200 + i] for i in range(1, 60)) >= 17
    # The first holder of a line keeps it: every line is left somewhere.
    left = {x for r in L.dedup_lines(docs).collect() for x in r.text.split("\n")}
    assert left >= {x for t in texts.values() for x in t.split("\n")}


def test_awkward_rows(awkward):
    rows = awkward.collect()
    got = L.dedup_lines(awkward).collect()
    assert len(got) == len(rows)
    # Row 1's copy has no doc_id, so it is the later one and loses its only line; all else stays.
    assert sorted((r.row.doc_id is None, r.n_deleted) for r in got if r.n_deleted) == [(True, 1)]
    kept = L.drop_repeated_lines(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len(rows) - 1
    assert sorted((r.n_chars is None) for r in kept.collect()).count(True) == 2


def test_n_chars_follows_the_text(spark):
    shared = prose(1, 20)
    docs = spark.createDataFrame([(1, shared, 5), (2, shared + "\n" + prose(2, 9), 6)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in L.drop_repeated_lines(docs).collect()}
    assert got[1].n_chars == 5 and got[2].text == prose(2, 9) and got[2].n_chars == len(prose(2, 9))


def test_empty(empty_docs):
    assert L.deletions(empty_docs).count() == 0 and L.drop_repeated_lines(empty_docs).count() == 0


def test_a_passage_on_one_line_goes_however_many_hold_it(spark):
    texts = {}
    for at, n in ((0, 17), (5000, 1000)):
        passage = prose(at + 1, 60)
        texts |= {at + i: "\n".join([prose(10**5 + at + i, 15), passage, prose(10**6 + at + i, 15)]) for i in range(n)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: [i for i, keep in enumerate(r.keep) if not keep] for r in L.deletions(docs).collect()}
    assert got == {k: [1] for k in texts if k not in (0, 5000)}


def test_later_partners_are_aligned_too(spark):
    x, y = [prose(k, 10) for k in (1, 2, 3)], [prose(k, 10) for k in (4, 5, 6)]
    short = [f"only {k} words" for k in "abcd"]
    texts = {1: y + x, 2: x + y, 3: x + y}  # two crossing blocks, then a whole copy
    texts |= {10 + i: [prose(50 + i, 9), s] for i, s in enumerate(short)}  # each short line has its own first holder
    texts |= {20: [prose(60, 9), *short], 21: [*short, prose(61, 9)]}
    texts |= {100 + i: x + [prose(200 + i, 9)] + y[:1] for i in range(30)} | {140 + i: x + y for i in range(20)}
    rng = random.Random(3)
    pool = [prose(300 + i, rng.randrange(2, 14)) for i in range(120)]
    texts |= {200 + i: [rng.choice(pool) for _ in range(rng.randrange(1, 12))] for i in range(80)}
    texts = {k: "\n".join(t) for k, t in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: {i for i, keep in enumerate(r.keep) if not keep} for r in L.deletions(docs).collect()}
    assert got[3] == set(range(6)) and got[21] == {0, 1, 2, 3}
    assert got == slow_deletions(texts)
    left = {x for r in L.dedup_lines(docs).collect() for x in r.text.split("\n")}
    assert left >= {x for t in texts.values() for x in t.split("\n")}


def test_recall_against_all_pairs(spark):
    """All pairs of documents that share any line: what the partners named above miss."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {(r.doc_id, i) for r in L.deletions(docs).collect() for i, keep in enumerate(r.keep) if not keep}
    want = {(k, i) for k, lines in slow_deletions(texts, every=True).items() for i in lines}
    assert got <= want and len(got) >= 0.99 * len(want), (len(got), len(want))


def test_no_change_of_rule_with_the_number_of_holders(spark):
    """A lone line of 25 words with unlike neighbours, in 16, 17 and 1,000 documents."""
    texts = {}
    for at, n in ((0, 16), (2000, 17), (5000, 1000)):
        line = prose(at + 7, 25)
        texts |= {at + i: "\n".join([prose(10**5 + at + i, 15), line, prose(10**6 + at + i, 15)]) for i in range(n)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: [i for i, keep in enumerate(r.keep) if not keep] for r in L.deletions(docs).collect()}
    assert got == {k: [1] for k in texts if k not in (0, 2000, 5000)}


def test_many_rows_without_an_id(spark):
    """200,000 texts under one NULL doc_id: none takes another one's place."""
    docs = spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit("text number"), "id", F.lit("a b c d e f g h")).alias("text"))
    left = L.dedup_lines(docs)
    assert left.where("n_deleted > 0").count() == 0 and left.select("text").distinct().count() == 200_000
