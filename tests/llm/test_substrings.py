import numpy as np
import pytest

from tessera.llm import substrings as S
from tests.llm.conftest import prose


def slow_starts(text, words_per_chunk=4):
    """The gear hash rolled byte by byte."""
    gear, h, out, words = S._gear().tolist(), 0, [], []
    space = [b == 0x20 or 9 <= b <= 13 for b in text]
    for i, b in enumerate(text):
        if not space[i] and (i == 0 or space[i - 1]):
            if not out or h < (1 << 32) // words_per_chunk:
                out.append(i)
                words.append(0)
            words[-1] += 1
        h = ((h << 1) + gear[b]) & 0xFFFFFFFF
    return out, words


@pytest.mark.parametrize("text", ["", " \n", "one", " lead ing", prose(1, 400), "漢字 ünï " * 50, "same " * 200, prose(2, 40) + "\n\n\t " + prose(3, 60)])
def test_rolling_hash(text, monkeypatch):
    data = text.encode()
    for step in (1 << 20, 97):  # positions do not depend on how a text is read
        monkeypatch.setattr(S, "_STEP", step)
        at, n = S.chunk_starts(data)
        assert (at.tolist(), n.tolist()) == slow_starts(data)


def test_insertions_move_only_near_cuts():
    text = prose(7, 3000).encode()
    at = set(S.chunk_starts(text)[0].tolist())
    moved = set((S.chunk_starts(b"something new " + text)[0] - 14).tolist())
    assert len(at ^ moved) <= 16


def rows_of(spark, texts, **options):
    docs = spark.createDataFrame([(i, t) for i, t in texts], "doc_id long, text string")
    return docs, {(r.doc_id, r.row_key): r for r in S.repeats(docs, **options).collect()}


def test_planted_passages(spark):
    """Passages of 51 to 120 words at random places, in documents that are otherwise unlike."""
    texts, holders = [(i, prose(1000 + i, 200)) for i in range(300)], []
    rng = np.random.default_rng(4)
    for k in range(60):
        passage = prose(9000 + k, int(rng.integers(51, 121)), 10**6)
        a, b = rng.choice(300, 2, replace=False).tolist()
        for d in (a, b):
            w = texts[d][1].split(" ")
            at = int(rng.integers(0, len(w)))
            texts[d] = (d, " ".join(w[:at] + [passage] + w[at:]))
        holders += [a, b]
    docs, found = rows_of(spark, texts)
    assert {d for d, _ in found} == set(holders)
    later = [r for r in found.values() if r.removed_words]
    assert later and all(r.firsts and max(r.firsts) < r.doc_id for r in later)
    left = {r.doc_id: r.text for r in S.cut_repeats(docs).collect()}
    for d, t in texts:
        assert (left[d] == t) == (not found.get((d, None), None) and d not in {r.doc_id for r in later})
    # What is left holds no passage of 40 words twice.
    seen, twice = set(), 0
    for t in left.values():
        w = t.split()
        for i in range(len(w) - 39):
            g = tuple(w[i : i + 40])
            twice += g in seen
            seen.add(g)
    assert twice < 60 * 12


def test_copies_go_whole_and_first_stays(spark):
    a, b = prose(1, 300), prose(2, 300)
    docs, found = rows_of(spark, [(5, a), (3, a), (9, b), (4, b + " tail"), (7, prose(3, 200))])
    assert {(d, r.removed_words) for (d, _), r in found.items() if r.removed_words > 290} == {(5, 300), (9, found[next(k for k in found if k[0] == 9)].removed_words)}
    left = {r.doc_id: r.text for r in S.cut_repeats(docs).collect()}
    assert left[3] == a and left[5] == "" and left[4] == b + " tail" and left[7] == prose(3, 200)


def test_within_a_document(spark):
    p = prose(4, 80)
    _, found = rows_of(spark, [(1, p + " " + prose(5, 50) + " " + p)])
    r = next(iter(found.values()))
    assert r.removed_words > 50 and r.firsts == [] and len(r.removed) == 1


def test_awkward_rows(awkward):
    found = S.repeats(awkward).collect()
    # Row 1 and the copy without a doc_id share a text; the repeated row is one document.
    assert sorted((r.doc_id is None, r.removed_words > 0) for r in found) == [(False, False), (True, True)]
    left = S.cut_repeats(awkward)
    assert left.columns == awkward.columns and left.count() == awkward.count()
    before = sorted((r.doc_id or -1, r.text or "") for r in awkward.collect() if r.doc_id is not None)
    assert sorted((r.doc_id or -1, r.text or "") for r in left.collect() if r.doc_id is not None) == before


def test_empty(empty_docs):
    assert S.repeats(empty_docs).count() == 0 and S.cut_repeats(empty_docs).count() == 0
