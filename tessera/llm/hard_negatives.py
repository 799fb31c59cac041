"""Hard-negative mining with an inverted multi-index.

Vectors are cut into two halves, each with a codebook of its own; a pair of
codewords is a cell (Babenko and Lempitsky, 2012). By the Cauchy-Schwarz
inequality a half's score in a cell is at most the anchor's score with the
codeword plus the anchor's length times the cell's radius, so the sum of both
halves bounds every score in the cell. For each anchor a heap visits the pairs
of codewords in order of that sum (the multi-sequence algorithm) and stops
where what is left can no longer change the result: below the last positive
found, then below the windows of the negatives or what already fills them. All
scores are exact, so the result is that of a full search.

The anchors go in blocks of bounded size, which are broadcast; the index is a
table of cells in blocks of rows, read by the tasks that search it.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample, materialize, ship_by_value
from tessera.session import ensure_checkpoint_dir

#: Codewords of each half, rows that the codebooks are fitted on, and passes of the fit.
CODEWORDS, SAMPLE, FIT_PASSES = 16, 8192, 8
#: Rows of a block of the index, and anchors that are searched together.
BLOCK_ROWS, BLOCK_ANCHORS = 2048, 4096
#: The first visit of an anchor covers one in so many rows.
FIRST_SHARE = 16

_SCORED = "anchor long, slot int, score long, id long"


def _fit(x: np.ndarray, k: int) -> np.ndarray:
    """At most k codewords by Lloyd's algorithm, from rows spread over the sample."""
    distinct = np.unique(x, axis=0)
    centers = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(FIT_PASSES):
        near = _nearest(x, centers)
        centers = np.stack([x[near == c].mean(axis=0) if (near == c).any() else centers[c] for c in range(len(centers))])
    return centers


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers * centers).sum(axis=1) - 2 * (x @ centers.T), axis=1)


def prepared(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: float) -> DataFrame:
    """``id, label, v`` (binary doubles, whole numbers) of the rows that take part, one for every id."""
    width = rows.select(F.max(F.size(vec_col))).first()[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels, vectors = [], [], []
            for i, label, v in zip(*(b.column(c) for c in range(3)), strict=True):
                if v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                if len(x) != width:
                    raise ValueError("vectors of different length")
                q = np.floor(scale * x)
                if (q * q).sum() >= 2.0**51:
                    raise ValueError("a vector is too long for exact inner products")
                ids.append(i.as_py())
                labels.append(label.as_py())
                vectors.append(q.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(vectors, pa.binary())], ["id", "label", "v"])

    whole = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull())
    out = whole.select(F.col(id_col).cast("long"), F.col(label_col).cast("long"), vec_col).mapInArrow(read, "id long, label long, v binary")
    out = materialize(out)
    if not out.groupBy("id").count().where("count > 1").isEmpty():
        # Repeated ids: the least label, then the least vector, counts.
        out = materialize(out.groupBy("id").agg(F.min(F.struct("label", "v")).alias("m")).select("id", "m.label", "m.v"))
    return out


class Codebooks:
    """Two codebooks and, for each cell, its rows and the radius of either half."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.half = first.shape[1]
        self.counts = np.zeros((len(first), len(second)), np.int64)
        self.radii = np.zeros((2, len(first), len(second)))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every row's cell, and its distance to the codeword of either half."""
        a, b = x[:, : self.half], x[:, self.half :]
        i, j = _nearest(a, self.first), _nearest(b, self.second)
        return i * len(self.second) + j, np.sqrt(((a - self.first[i]) ** 2).sum(axis=1)), np.sqrt(((b - self.second[j]) ** 2).sum(axis=1))

    def order(self, anchor: np.ndarray) -> Iterator[tuple[float, int]]:
        """The cells that have rows by falling bound, with the bound: a heap over the two sorted lists of half scores.

        The lists hold each codeword's score with the largest radius of its
        cells; a pair's place is the sum of both, which bounds its rows.
        """
        a, b = anchor[: self.half], anchor[self.half :]
        # Rounding errors stay far below these margins; scores are whole numbers.
        u = self.first @ a + np.sqrt(a @ a) * self.radii[0].max(axis=1) * (1 + 1e-9)
        v = self.second @ b + np.sqrt(b @ b) * self.radii[1].max(axis=0) * (1 + 1e-9)
        iu, iv = np.argsort(-u), np.argsort(-v)
        heap = [(-(u[iu[0]] + v[iv[0]]), 0, 0)]
        seen = {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            if self.counts[iu[i], iv[j]]:
                yield 1e-3 - bound, int(iu[i] * len(self.second) + iv[j])
            for p in ((i + 1, j), (i, j + 1)):
                if p[0] < len(u) and p[1] < len(v) and p not in seen:
                    seen.add(p)
                    heapq.heappush(heap, (-(u[iu[p[0]]] + v[iv[p[1]]]), *p))

    def visits(self, anchor: np.ndarray, least: float, rows: float) -> np.ndarray:
        """Cells to visit, as a mask: those with a bound of at least ``least``, or, without it, the first that hold ``rows`` rows."""
        mask, covered, counts = np.zeros(self.counts.size, bool), 0, self.counts.ravel()
        for bound, cell in self.order(anchor):
            if covered >= rows or bound < least:
                break
            mask[cell] = True
            covered += counts[cell]
        return mask


def index(rows: DataFrame, codewords: int = CODEWORDS, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, Codebooks] | None:
    """The index of ``id, label, v``: ``cell, ids, labels, vectors`` in blocks of about ``block_rows`` rows; None without rows.

    The codebooks are fitted on ``sample`` rows, chosen by hash; every row is in the index.
    """
    chosen = hash_sample(rows, sample, "id").select("v").collect()
    if not chosen:
        return None
    x = np.stack([np.frombuffer(r.v) for r in chosen])
    half = x.shape[1] // 2
    books = Codebooks(_fit(x[:, :half], codewords), _fit(x[:, half:], codewords))
    first, second = books.first, books.second

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Codebooks(first, second)
        for b in batches:
            if b.num_rows:
                cell, r0, r1 = mine.cells(np.stack([np.frombuffer(v.as_buffer()) for v in b.column(2)]))
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(3)), pa.array(cell, pa.int32()), pa.array(r0), pa.array(r1)], ["id", "label", "v", "cell", "r0", "r1"])

    dealt = materialize(rows.select("id", "label", "v").mapInArrow(assign, "id long, label long, v binary, cell int, r0 double, r1 double"))
    blocks = np.ones(books.counts.size, np.int64)
    for r in dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("r0").alias("r0"), F.max("r1").alias("r1")).collect():
        at = divmod(r.cell, len(second))
        books.counts[at], books.radii[0][at], books.radii[1][at] = r.n, r.r0, r.r1
        blocks[r.cell] = -(-r.n // block_rows)
    per_cell = F.get(F.array(*(F.lit(int(n)) for n in blocks)), F.col("cell"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        vectors = b"".join(v.as_py() for v in table.column("v"))
        return pa.table({"cell": table.column("cell")[:1], "ids": [ids.tobytes()], "labels": [labels.tobytes()], "vectors": [vectors]}, schema=packed)

    packed = pa.schema([("cell", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())])
    grouped = dealt.select("id", "label", "v", "cell", F.pmod(F.xxhash64("id"), per_cell).alias("block")).groupBy("cell", "block")
    return materialize(grouped.applyInArrow(pack, "cell int, ids binary, labels binary, vectors binary")), books


def _first(slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The rows with the k highest scores of each slot, ties to the smaller id."""
    order = np.lexsort((ids, -scores, slots))
    s = slots[order]
    start = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))[: len(s)]
    rank = np.arange(len(s)) - np.repeat(start, np.diff(np.append(start, len(s))))
    return order[rank < k]


def _search(blocks: DataFrame, anchors: dict[str, np.ndarray], visits: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> DataFrame:
    """``anchor, slot, score, id``: for every anchor and slot the k best rows with a score in ``[low, high]`` (one column
    per slot) in the visited cells, of the anchor's label without itself, or of others. A task answers for its blocks."""
    spark = blocks.sparkSession
    dim = anchors["v"].shape[1]
    shared = spark.sparkContext.broadcast((anchors["id"], anchors["label"], anchors["v"], np.packbits(visits, axis=0), low, high))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, seen, lowest, highest = shared.value
        held: list[np.ndarray] = []
        slots = lowest.shape[1]

        def reduce() -> None:
            at, score, row = (np.concatenate(x) for x in zip(*held, strict=True))
            best = _first(at, score, row, k)
            held[:] = [(at[best], score[best], row[best])]

        for b in batches:
            for cell, their_ids, their_labels, theirs in zip(*(b.column(c) for c in range(4)), strict=True):
                mine = np.flatnonzero(np.unpackbits(seen[:, cell.as_py()], count=len(ids)))
                if not len(mine):
                    continue
                row_ids, row_labels = (np.frombuffer(x.as_buffer(), np.int64) for x in (their_ids, their_labels))
                scores = vectors[mine] @ np.frombuffer(theirs.as_buffer()).reshape(len(row_ids), dim).T
                alike = labels[mine][:, None] == row_labels[None, :]
                right = alike & (ids[mine][:, None] != row_ids[None, :]) if same else ~alike
                for s in range(slots):
                    a, r = np.nonzero(right & (scores >= lowest[mine, s][:, None]) & (scores <= highest[mine, s][:, None]))
                    if len(a):
                        best = _first(a, scores[a, r], row_ids[r], k)
                        a, r = a[best], r[best]
                        held.append((mine[a] * slots + s, scores[a, r], row_ids[r]))
                if sum(len(x[0]) for x in held) > 1 << 20:
                    reduce()
        if held:
            reduce()
            at, score, row = held[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at // slots]), pa.array((at % slots).astype(np.int32)), pa.array(score.astype(np.int64)), pa.array(row)], ["anchor", "slot", "score", "id"]
            )

    # The cells that nobody visits are not read.
    cells = np.flatnonzero(visits.any(axis=0)).tolist()
    return blocks.where(F.col("cell").isin(cells)).mapInArrow(look, _SCORED)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each (anchor, slot), from what the tasks found."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            a, s, score, row = (held.column(c).to_numpy() for c in ("anchor", "slot", "score", "id"))
            _, group = np.unique(np.stack([a, s.astype(np.int64)]), axis=1, return_inverse=True)
            held = held.take(pa.array(_first(group, score, row, k)))
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return materialize(found.repartition("anchor").mapInArrow(merge, _SCORED))


def _thresholds(found: DataFrame, anchors: dict[str, np.ndarray], slots: int, k: int) -> np.ndarray:
    """The k-th best score by anchor and slot; minus infinity for those with fewer."""
    out = np.full((len(anchors["id"]), slots), -np.inf)
    number = {i: n for n, i in enumerate(anchors["id"].tolist())}
    for r in found.groupBy("anchor", "slot").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).collect():
        out[number[r.anchor], r.slot] = r.least
    return out


def _visits(spark, books: Codebooks, anchors: dict[str, np.ndarray], least: np.ndarray, rows: float) -> np.ndarray:
    """The cells that each anchor visits, one row a anchor; the heaps run in tasks."""
    first, second, counts, radii = books.first, books.second, books.counts, books.radii

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Codebooks(first, second)
        mine.counts, mine.radii = counts, radii
        for b in batches:
            masks = [np.packbits(mine.visits(np.frombuffer(v.as_buffer()), t.as_py(), rows)).tobytes() for v, t in zip(b.column(1), b.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(masks, pa.binary())], ["n", "cells"])

    n = len(anchors["id"])
    table = pa.table({"n": pa.array(range(n), pa.int32()), "v": [v.tobytes() for v in anchors["v"]], "least": pa.array(least, pa.float64())})
    tasks = -(-n // 256)
    out = np.zeros((n, counts.size), bool)
    for r in spark.createDataFrame(table).repartition(tasks, "n").mapInArrow(walk, "n int, cells binary").collect():
        out[r.n] = np.unpackbits(np.frombuffer(r.cells, np.uint8), count=counts.size)
    return out


def _of_block(blocks: DataFrame, books: Codebooks, anchors: dict[str, np.ndarray], positives: int, negatives: int, window: tuple[int, int]) -> DataFrame:
    """The result for one block of anchors."""
    spark = blocks.sparkSession
    n = len(anchors["id"])
    some = books.counts.sum() / FIRST_SHARE
    everything, nothing = np.full((n, 1), np.inf), np.full((n, 1), -np.inf)
    # Positives: the first cells give a least score for the last of them; the heap goes on down to it.
    visited = _visits(spark, books, anchors, nothing[:, 0], some)
    found = _best(_search(blocks, anchors, visited, nothing, everything, True, positives), positives)
    last = _thresholds(found, anchors, 1, positives)
    rest = _visits(spark, books, anchors, last[:, 0], np.inf) & ~visited
    found = _best(found.unionAll(_search(blocks, anchors, rest, last, everything, True, positives)), positives)
    # Every positive opens a window of scores, a slot.
    number = {i: k for k, i in enumerate(anchors["id"].tolist())}
    low, high = np.full((n, positives), np.inf), np.full((n, positives), -np.inf)
    ranks = np.zeros(n, np.int64)
    pairs = {c: [] for c in ("anchor", "slot", "positive_id", "positive_score")}
    for r in sorted(found.collect(), key=lambda r: (r.anchor, -r.score, r.id)):
        k = number[r.anchor]
        s, ranks[k] = int(ranks[k]), ranks[k] + 1
        if r.score >= 0:  # of a negative score the window is empty
            low[k, s], high[k, s] = -(-window[0] * r.score // 100), window[1] * r.score // 100
        for c, v in zip(pairs, (r.anchor, s, r.id, r.score), strict=True):
            pairs[c].append(v)
    # Negatives: the same, down to the lowest window that is not yet full.
    visited = _visits(spark, books, anchors, low.min(axis=1), some)
    found = _best(_search(blocks, anchors, visited, low, high, False, negatives), negatives)
    full = np.maximum(_thresholds(found, anchors, positives, negatives), low)
    rest = _visits(spark, books, anchors, full.min(axis=1), np.inf) & ~visited
    found = _best(found.unionAll(_search(blocks, anchors, rest, full, high, False, negatives)), negatives)
    kinds = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
    windows = spark.createDataFrame(pa.table(pairs, schema=kinds))
    order = F.struct((-F.col("score")).alias("s"), F.col("id"))
    listed = found.groupBy("anchor", "slot").agg(F.array_sort(F.collect_list(order)).alias("best"))  # at most `negatives` each
    return windows.join(listed, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "positive_score", F.posexplode("best").alias("at", "m")
    ).select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("m.id").alias("negative_id"), "positive_score", (-F.col("m.s")).alias("negative_score"))


def hard_negatives(
    rows: DataFrame,
    anchor_every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: float = 256.0,
    codewords: int = CODEWORDS,
    block_anchors: int = BLOCK_ANCHORS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of the vectors with ``floor(scale * x)`` for
    each component x; ties go to the smaller id. Anchors are the rows whose id
    is divisible by ``anchor_every``, an anchor's positives its first other
    rows of the same label; each positive gets the first rows of other labels
    that score ``window`` per cent of it (a negative score has none). Rows
    with a NULL id, label, vector or component or a component that is not
    finite take no part; of repeated ids the row with the least label, then
    vector, does. Vectors of different length are an error, and so are ones of
    a length (after scaling) over 2^25, for which doubles are not exact. An
    anchor without positives or negatives has no row; an empty table gives an
    empty result.
    """
    spark = rows.sparkSession
    table = prepared(rows, id_col, vec_col, label_col, scale)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    built = index(table, codewords)
    anchors = table.where(F.col("id") % anchor_every == 0)
    n = anchors.count()
    if built is None or not n:
        return spark.createDataFrame([], schema)
    blocks, books = built
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{uuid.uuid4().hex}"
    parts = -(-n // block_anchors)
    for k in range(parts):
        mine = anchors.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == k).orderBy("id").collect()
        if mine:
            block = {"id": np.array([r.id for r in mine]), "label": np.array([r.label for r in mine]), "v": np.stack([np.frombuffer(r.v) for r in mine])}
            _of_block(blocks, books, block, positives, negatives, window).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


ship_by_value(__name__)
