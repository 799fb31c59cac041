"""SimHash near-deduplication: fingerprints linked by a self-join of their binary trie.

Fingerprints are 64-bit votes over hashed word shingles. Those within a few
bits of each other are found by descending the trie of all fingerprints
against itself: a pair of nodes carries the bits in which its two prefixes
differ, and is dropped as soon as they exceed the budget.

Spark splits the trie into blocks (nodes of bounded size, split deeper where
the fingerprints are dense), keeps the pairs of blocks whose prefixes are
within the budget and joins each pair in one task. A task returns a forest of
links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import as_bytes, materialize, row_key, ship_by_value
from tessera.llm.graph import connected_components

#: Shingles hashed and voted on at a time, so that a very long text takes bounded memory.
VOTE_CHUNK = 1 << 15
#: Node pairs expanded at a time in a task, and leaf pairs below which a node pair is compared outright.
FRONTIER, LEAF = 1 << 17, 16


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a UTF-8 text: A-Z lower-cased, words by ASCII space, XXH64 of word shingles with seed 42.

    Fewer words than a shingle: the whole sequence is the one shingle; none: 0.
    """
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(tokens))
    total = len(tokens) - k + 1
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, VOTE_CHUNK):
        n = min(VOTE_CHUNK, total - at)
        spans = zip(starts[at : at + n].tolist(), ends[at + k - 1 : at + k - 1 + n].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, n)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * votes > total).tolist())


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, fp``: the fingerprint (as a signed long) of every whole text; NULL counts as empty."""

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "row_key", "fp"])

    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), row_key(text).alias("row_key"), as_bytes(text).alias("text")).mapInArrow(
        votes, "doc_id long, row_key long, fp long"
    )


class _Trie:
    """The binary trie of sorted distinct fingerprints: a node is a range of them, bit by bit from the top."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.zeros: dict[int, np.ndarray] = {}

    def split(self, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
        """Where a node's child with bit 1 begins."""
        if depth not in self.zeros:
            bit = (self.values >> np.uint64(63 - depth)) & np.uint64(1)
            self.zeros[depth] = np.concatenate(([0], np.cumsum(bit == 0))).astype(np.int32)
        z = self.zeros[depth]
        return lo + z[hi] - z[lo]


class _Links:
    """Components of the two blocks' fingerprints; ``settled`` tells node pairs that cannot add a link."""

    def __init__(self, n: int):
        self.label = np.arange(n, dtype=np.int64)
        self._refresh()

    def _refresh(self) -> None:
        self.runs = np.concatenate(([0], np.cumsum(self.label[1:] != self.label[:-1])))

    def settled(self, alo, ahi, blo, bhi) -> np.ndarray:
        one = (self.runs[alo] == self.runs[ahi - 1]) & (self.runs[blo] == self.runs[bhi - 1])
        return one & (self.label[alo] == self.label[blo])

    def merge(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(label, up := label[label]):
                label = up
        self.label = label
        self._refresh()


def link_blocks(a: np.ndarray, b: np.ndarray | None, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as a forest) among fingerprints of ``a`` and ``b`` (None: within ``a``) at ``budget`` or fewer bits."""
    same = b is None
    ta = _Trie(a)
    tb = ta if same else _Trie(b)
    shift = 0 if same else len(a)
    every = a if same else np.concatenate([a, b])
    links = _Links(len(every))
    first = [np.array([x], np.int64) for x in (0, len(a), 0, len(tb.values), 0)]
    stack = [(0, first)]
    while stack:
        depth, (alo, ahi, blo, bhi, err) = stack.pop()
        live = ~links.settled(alo, ahi, blo + shift, bhi + shift)
        small = live & (((ahi - alo) * (bhi - blo) <= LEAF) | (depth == 64))
        if small.any():
            na, nb = (ahi - alo)[small], (bhi - blo)[small]
            count = na * nb
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            width = np.repeat(nb, count)
            i = np.repeat(alo[small], count) + at // width
            j = np.repeat(blo[small], count) + at % width
            near = np.bitwise_count(a[i] ^ tb.values[j]) <= budget
            if same:
                near &= i != j
            if near.any():
                links.merge(i[near], j[near] + shift)
        rest = live & ~small
        if not rest.any():
            continue
        alo, ahi, blo, bhi, err = (x[rest] for x in (alo, ahi, blo, bhi, err))
        am, bm = ta.split(alo, ahi, depth), tb.split(blo, bhi, depth)
        twin = same & (alo == blo) & (ahi == bhi)
        parts = [
            (alo, am, blo, bm, err, None),
            (am, ahi, bm, bhi, err, None),
            (alo, am, bm, bhi, err + 1, None),
            (am, ahi, blo, bm, err + 1, ~twin),
        ]
        grown = []
        for p_alo, p_ahi, p_blo, p_bhi, p_err, extra in parts:
            keep = (p_alo < p_ahi) & (p_blo < p_bhi) & (p_err <= budget)
            if extra is not None:
                keep &= extra
            grown.append([x[keep] for x in (p_alo, p_ahi, p_blo, p_bhi, p_err)])
        grown = [np.concatenate(x) for x in zip(*grown, strict=True)]
        for at in range(0, len(grown[0]), FRONTIER):
            stack.append((depth + 1, [x[at : at + FRONTIER] for x in grown]))
    child = np.flatnonzero(links.label != np.arange(len(every)))
    return every[child], every[links.label[child]]


def _blocks(fps: DataFrame, largest: int) -> list[tuple[int, int, int]]:
    """Trie nodes ``(prefix, depth, size)`` of at most ``largest`` fingerprints each, in order.

    Sizes come from counts by prefix, eight more bits at a time and only under
    nodes that are still too large, so the driver holds a number of counts in
    proportion to the number of blocks.
    """
    done: list[tuple[int, int, int]] = []
    todo = {0: None}
    depth = 0
    while todo:
        deeper = min(depth + 8, 64)
        head = F.shiftrightunsigned("fp", 64 - deeper) if deeper < 64 else F.col("fp")
        frame = fps
        if depth:
            over = fps.sparkSession.createDataFrame([(_signed(p),) for p in todo], "over long")
            frame = fps.withColumn("over", F.shiftrightunsigned("fp", 64 - depth)).join(over, "over", "left_semi")
        counts = {r[0] % (1 << 64): r[1] for r in frame.groupBy(head.alias("head")).count().collect()}
        sums: dict[tuple[int, int], int] = {}
        for p, n in counts.items():
            for d in range(depth, deeper + 1):
                key = (p >> (deeper - d), d)
                sums[key] = sums.get(key, 0) + n
        nodes, todo = [(p, depth) for p in todo if (p, depth) in sums], {}
        while nodes:
            p, d = nodes.pop()
            n = sums[p, d]
            if n <= largest or d == 64:
                done.append((p, d, n))
            elif d == deeper:
                todo[p] = None
            else:
                nodes += [(2 * p + bit, d + 1) for bit in (0, 1) if (2 * p + bit, d + 1) in sums]
        depth = deeper
    return sorted(done, key=lambda x: x[0] << (64 - x[1]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _block_pairs(spark: SparkSession, blocks: list[tuple[int, int, int]], budget: int) -> DataFrame:
    """Pairs ``a <= b`` of blocks whose common prefix bits differ within the budget: the top of the same descent.

    Each task holds the prefixes (16 bytes a block) and finds the partners of its own blocks.
    """
    prefix = np.array([p << (64 - d) if d else 0 for p, d, _ in blocks], np.uint64)
    shared = spark.sparkContext.broadcast((prefix, np.array([d for _, d, _ in blocks], np.int64)))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, depth = shared.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                d = np.minimum(depth[i], depth[i:])
                mask = np.where(d > 0, np.uint64(0xFFFFFFFFFFFFFFFF) << (64 - np.maximum(d, 1)).astype(np.uint64), np.uint64(0))
                b = i + np.flatnonzero(np.bitwise_count((prefix[i] ^ prefix[i:]) & mask) <= budget)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), i, np.int32)), pa.array(b.astype(np.int32))], ["a", "b"])

    return spark.range(0, len(blocks), 1, -(-len(blocks) // 64)).mapInArrow(near, "a int, b int")


def block_size(total: int, least: int = 1 << 17, most: int = 1 << 20, at_most: int = 1 << 12, least_blocks: int = 32) -> int:
    """Fingerprints in a block: ``least`` (1 MB), more where the trie would have more than ``at_most`` full blocks.

    A block is sent to a task for each of the prefixes within the budget of its
    own, 794 of 4096 at 4 bits; so up to ``at_most * most`` fingerprints (4
    billion) the copies of a block do not grow. ``most`` (8 MB) bounds what a
    task holds. Few fingerprints make ``least_blocks``.
    """
    return max(64, min(most, max(least, -(-total // at_most)), -(-total // least_blocks)))


def trie_links(fps: DataFrame, max_bits: int = 4, largest_block: int | None = None) -> DataFrame:
    """Links ``(u, v)`` that connect all distinct ``fp`` at ``max_bits`` or fewer differing bits.

    ``fps`` must be written already (it is read once a trie level). A block
    holds at most ``largest_block`` fingerprints (None: :func:`block_size`).
    """
    spark = fps.sparkSession
    total = fps.count()
    if total < 2:
        return spark.createDataFrame([], "u long, v long")
    blocks = _blocks(fps, largest_block or block_size(total))
    pairs = materialize(_block_pairs(spark, blocks, max_bits))
    starts = np.array([p << (64 - d) if d else 0 for p, d, _ in blocks], np.uint64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy()
            block = np.searchsorted(starts, fp.view(np.uint64), "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), b.column(0)], ["block", "fp"])

    def pack(table: pa.Table) -> pa.Table:
        values = np.sort(table.column("fp").to_numpy().view(np.uint64))
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "fps": pa.array([values.tobytes()], pa.binary())})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for left, right, x, y in zip(*(b.column(c) for c in ("a", "b", "x", "y")), strict=True):
                twin = left.as_py() == right.as_py()
                u, v = link_blocks(
                    np.frombuffer(x.as_py(), np.uint64), None if twin else np.frombuffer(y.as_py(), np.uint64), max_bits
                )
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    packed = materialize(
        fps.select("fp").mapInArrow(place, "block int, fp long").groupBy("block").applyInArrow(pack, "block int, fps binary")
    )
    left = packed.select(F.col("block").alias("a"), F.col("fps").alias("x"))
    right = packed.select(F.col("block").alias("b"), F.col("fps").alias("y"))
    # A fixed number: the blocks are small in bytes, but a pair of them is seconds of work.
    spread = -(-pairs.count() // 4)
    return pairs.join(left, "a").join(right, "b").repartition(spread, "a", "b").mapInArrow(join, "u long, v long")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, row_key, fingerprint, component_id, component``.

    Fingerprints at ``max_bits`` or fewer differing bits are linked;
    ``component_id`` is the smallest doc_id reachable, the row's own included.
    Empty, blank and NULL texts have fingerprint zero and are linked like any
    other. A NULL doc_id takes part but is never a component_id unless all of a
    component's are NULL. Repeated rows keep one result row each;
    ``row_key`` (a text hash) tells rows of one doc_id apart, ``component`` is
    the component's smallest fingerprint. An empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, shingle, id_col, text_col))
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(trie_links(fps, max_bits))
    rooted = materialize(
        fps.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("component"))
    )
    ids = materialize(rooted.groupBy("component").agg(F.min("first_id").alias("component_id")))
    # Written, so that the join below shuffles both sides and the rows of a frequent fingerprint can be split.
    found = materialize(rooted.select("fp", "component").join(ids, "component"))
    return rows.join(found, "fp").select(
        "doc_id", "row_key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component"
    )


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents with one of each near-duplicate group: the row with the smallest doc_id, then text hash.

    Rows that agree in both (repeated rows) count as one; groups without any doc_id keep one row as well.
    """
    found = materialize(near_duplicates(docs, shingle, max_bits))
    chosen = found.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("c"), F.count("*").alias("members")
    )
    chosen = materialize(chosen.select("c.doc_id", "c.row_key", "component"))
    # Equal (doc_id, row_key) have one text, so one fingerprint and one component: the key is unique in chosen.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), row_key(F.col("text")).alias("key"))
    kept = rows.join(
        chosen.select(F.col("doc_id").alias("cid"), F.col("row_key").alias("ckey")).hint("merge"),
        F.col("id").eqNullSafe(F.col("cid")) & (F.col("key") == F.col("ckey")),
        "left_semi",
    )
    repeated = materialize(
        found.join(chosen, [found.doc_id.eqNullSafe(chosen.doc_id), found.row_key == chosen.row_key], "left_semi")
        .groupBy("doc_id", "row_key")
        .count()
        .where("count > 1")
        .select(F.col("doc_id").alias("rid"), F.col("row_key").alias("rkey"))
    )
    if repeated.isEmpty():
        return kept.select("row.*")
    again = F.col("id").eqNullSafe(F.col("rid")) & (F.col("key") == F.col("rkey"))
    single = kept.join(repeated, again, "left_anti")
    # A frequent repeated row combines in each task before the shuffle.
    merged = kept.join(repeated, again, "left_semi").groupBy("id", "key").agg(
        F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")
    )
    return single.select("row.*").unionByName(merged.select("row.*"))


ship_by_value(__name__)
