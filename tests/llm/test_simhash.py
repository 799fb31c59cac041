import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import simhash


def slow_fingerprint(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, bits=4):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    out = {}
    for i in range(len(ids)):
        out.setdefault(root(i), []).append(ids[i])
    return [min((x for x in out[root(i)] if x is not None), default=None) for i in range(len(ids))]


def check(docs, rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    want = zip((i for i, _ in rows), (format(f, "016x") for f in fps), slow_components([i for i, _ in rows], fps), strict=True)
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_matches_brute_force(documents):
    check(documents, [(r.doc_id, r.text) for r in documents.collect()])


def test_awkward_rows(awkward):
    check(awkward, [(r.doc_id, r.text) for r in awkward.collect()])


def test_empty(empty_docs):
    assert simhash.near_duplicates(empty_docs).count() == 0
    assert simhash.keep_one(empty_docs).count() == 0


def test_keep_one(awkward):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    found = simhash.near_duplicates(awkward).select("doc_id", "component").distinct().collect()
    got = kept.collect()
    assert len(got) == len({r.component for r in found})
    # NULL, empty and blank texts are one group; the copy without a doc_id goes; the repeated row stays once.
    assert sorted((r.doc_id for r in got), key=repr) == sorted([1, 2, 5, 6, 7, 7, 8, 9, None], key=repr)


def test_spark_hash_is_the_contracts(spark):
    from pyspark.sql import functions as F

    text = "straße 漢字 words and more words than thirty-two bytes"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


def same_groups(values, links, budget):
    label = {v: v for v in values}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        label[root(a)] = root(b)
    got = {v: root(v) for v in values}
    want = slow_components(list(range(len(values))), values, budget)
    pairs = {(got[v], w) for v, w in zip(values, want, strict=True)}
    return len(pairs) == len({g for g, _ in pairs}) == len({w for _, w in pairs})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=8), st.lists(st.tuples(st.integers(0, 7), st.lists(st.integers(0, 63), max_size=6)), max_size=60), st.integers(0, 6))
def test_trie_join_within_a_block(centers, changes, budget):
    values = set(centers)
    for k, flips in changes:
        x = centers[k % len(centers)]
        for f in flips:
            x ^= 1 << f
        values.add(x)
    values = sorted(values)
    u, v = simhash.link_blocks(np.array(values, np.uint64), None, budget)
    links = list(zip(u.tolist(), v.tolist(), strict=True))
    assert all((a ^ b).bit_count() <= 64 for a, b in links) and len(links) < len(values)
    assert same_groups(values, links, budget)


def test_dense_ball_over_blocks(spark, monkeypatch):
    """Thousands of fingerprints within a few bits of each other: split into blocks, linked by a forest."""
    rng = np.random.default_rng(3)
    center = int(rng.integers(1, 2**63))
    values = {center}
    while len(values) < 1500:
        x = center
        for f in rng.integers(0, 64, 3):
            x ^= 1 << int(f)
        values.add(x)
    values |= {int(x) for x in rng.integers(0, 2**63, 500)}
    values = sorted(values)
    from tessera.llm.common import materialize

    fps = materialize(spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long"))
    links = simhash.trie_links(fps, 4, largest_block=100).collect()
    assert len(links) < 40 * len(values)
    assert same_groups(values, [(r.u % 2**64, r.v % 2**64) for r in links], 4)


def test_pairs_of_blocks_against_all(spark):
    """Blocks of several depths: exactly the pairs whose common prefix bits differ within the budget."""
    rng = random.Random(3)
    nodes, todo = [], [(0, 0)]
    while todo:
        p, d = todo.pop()
        if d < 4 or d < 9 and rng.random() < 0.6:
            todo += [(2 * p, d + 1), (2 * p + 1, d + 1)]
        else:
            nodes.append((p, d, 1))
    nodes.sort(key=lambda x: x[0] << (64 - x[1]))
    want = set()
    for i, (p, d, _) in enumerate(nodes):
        for j, (q, e, _) in enumerate(nodes[i:], i):
            m = min(d, e)
            if ((p >> (d - m)) ^ (q >> (e - m))).bit_count() <= 2:
                want.add((i, j))
    got = [tuple(r) for r in simhash._block_pairs(spark, nodes, 2).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) < len(nodes) ** 2 / 4
    assert [tuple(r) for r in simhash._block_pairs(spark, [(0, 0, 5)], 4).collect()] == [(0, 0)]


def test_block_sizes():
    sizes = [simhash.block_size(n) for n in (2, 10**5, 10**7, 10**9, 10**10, 10**12)]
    assert sizes == [64, 3125, 1 << 17, -(-(10**9) // 4096), 1 << 20, 1 << 20]
