"""Language-model scoring with a log-frequency Bloom filter.

A bigram model is trained from the corpus itself: every task counts the words
and word pairs of its texts, the counts meet in shards of the hash space, and
each shard becomes a Bloom filter that holds an n-gram once per level of its
logarithmically quantised count (Talbot and Osborne, 2007). A count is read by
probing level after level. The filter holds every n-gram and grows with the
texts; it is broadcast in blocks of shards of bounded size. Where it takes more
than one, the distinct n-grams of each slice of the texts are written by block
once, and each block probes those of its own shards only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import as_bytes, held_out, materialize, ship_by_value

#: Bits per entry and probes of the filter, and the most bytes of it that are broadcast at a time.
BITS, PROBES, MAX_BYTES = 8, 4, 96 << 20
#: Words whose exact counts are broadcast beside the filter (16 bytes each); the others are joined.
HEAD_WORDS = 1 << 19
#: Weight of the word's own probability beside its counts after the word before it.
PRIOR = 200.0
#: Text bytes per shard of the hash space, and tokens that a task counts and scores at a time.
SHARD_BYTES, COUNT_TOKENS, SCORE_TOKENS = 1 << 23, 1 << 20, 1 << 18

#: Stands for the end of a text, before and after it; no word holds a space.
END = xxhash.xxh64_intdigest(b" ")


def token_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text (A-Z lower-cased, split at ASCII space) and of its end."""
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    out = np.fromiter(map(digest, words), np.uint64, len(words))
    return np.append(out, np.uint64(END))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hashes(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


def level(count: np.ndarray) -> np.ndarray:
    """Quantised counts: 1, 2-3, 4-7, ... are levels 1, 2, 3, ..."""
    return np.frexp(count.astype(np.float64))[1]


#: What a level stands for: the middle of its counts.
LEVEL_COUNT = np.array([0.0] + [(2 ** (q - 1) + 2**q - 1) / 2 for q in range(1, 64)])


class Filter:
    """A log-frequency Bloom filter, in shards by the leading bits of the n-gram hash.

    It may be a block of a larger one: its shards from ``first`` on, of ``shards`` in all.
    """

    def __init__(self, sizes: np.ndarray, bits: bytes, first: int = 0, shards: int | None = None):
        # Bytes, not an array: a worker that loads the broadcast holds them once.
        self.sizes, self.packed, self.first = sizes.astype(np.uint64), bits, first
        self.starts = np.concatenate(([0], np.cumsum((sizes + 7) // 8 * 8)))[:-1].astype(np.uint64)
        self.shift = np.uint64(64 - int(np.log2(shards or len(sizes))))

    @staticmethod
    def places(hashes: np.ndarray, q, sizes) -> Iterator[np.ndarray]:
        """The bits of an n-gram at a level, one array for each probe."""
        g = _mix(hashes + np.uint64(0xD1342543DE82EF95) * np.asarray(q).astype(np.uint64))
        a, b = g & np.uint64(0xFFFFFFFF), g >> np.uint64(32)
        for i in range(PROBES):
            yield ((a + np.uint64(i) * b) & np.uint64(0xFFFFFFFF)) * sizes >> np.uint64(32)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The highest level up to which all levels of each n-gram are there; 0 for those of other blocks."""
        out = np.zeros(len(hashes), np.int64)
        bits = np.frombuffer(self.packed, np.uint8)
        shard = (hashes >> self.shift).astype(np.int64) - self.first if self.shift < 64 else np.zeros(len(hashes), np.int64)
        live = np.flatnonzero((shard >= 0) & (shard < len(self.sizes)))
        q = 0
        while len(live) and q < 62:
            q += 1
            there = np.ones(len(live), bool)
            for place in self.places(hashes[live], q, self.sizes[shard[live]]):
                at = self.starts[shard[live]] + place
                there &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            live = live[there]
            out[live] = q
        return out


def build_shard(hashes: np.ndarray, counts: np.ndarray) -> tuple[int, bytes]:
    """A shard's filter of all its n-grams: its size in bits and the bits."""
    q = level(counts)
    size = max(64, int(q.sum()) * BITS)
    bits = np.zeros((size + 7) // 8 * 8, bool)
    for k in range(1, int(q.max(initial=0)) + 1):
        for place in Filter.places(hashes[q >= k], k, np.uint64(size)):
            bits[place.astype(np.int64)] = True
    return size, np.packbits(bits, bitorder="little").tobytes()


class Model(NamedTuple):
    """What a scoring task holds: the filter, the most frequent words' counts, and the totals."""

    filter: Filter | None
    head: np.ndarray
    head_counts: np.ndarray
    tokens: int
    distinct: int
    prior: float

    def plain(self) -> tuple:
        """The model as arrays, bytes and numbers: what a broadcast may hold, as workers need no install of this class."""
        f = self.filter
        return (None if f is None else (f.sizes, f.packed, f.first, 1 << (64 - int(f.shift))), *self[1:])

    @classmethod
    def of(cls, plain: tuple) -> Model:
        return cls(None if plain[0] is None else Filter(*plain[0]), *plain[1:])

    def known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact counts of the head's words (0 for others), and which words are in the head."""
        if not len(self.head):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.head, words), len(self.head) - 1)
        inside = self.head[at] == words
        return np.where(inside, self.head_counts[at], 0), inside

    def counts(self, words: np.ndarray) -> np.ndarray:
        """The head's words by their exact counts, the others by their quantised ones."""
        known, inside = self.known(words)
        out = known.astype(np.float64)
        out[~inside] = LEVEL_COUNT[self.filter.levels(words[~inside])]
        return out

    def log10_p(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Every token's log10 probability after the token before it; at ``starts`` that is the end of a text."""
        pair = LEVEL_COUNT[self.filter.levels(pair_hashes(_before(words, starts), words))]
        return self.log10_p_of(self.counts(words), pair, starts, self.counts(np.array([END], np.uint64))[0])

    def log10_p_of(self, single: np.ndarray, pair: np.ndarray, starts: np.ndarray, end: float) -> np.ndarray:
        """The same from the counts of the words, of the pairs that they end, and of the end of a text."""
        context = np.concatenate(([0.0], single[:-1]))
        context[starts] = end
        # The quantised count of a pair may be over that of its words.
        pair = np.minimum(pair, np.minimum(context, single))
        own = (single + 1) / (self.tokens + self.distinct + 1)
        return np.log10((pair + self.prior * own) / (context + self.prior))


def _before(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    before = np.concatenate(([np.uint64(END)], words[:-1]))
    before[starts] = END
    return before


class Trained(NamedTuple):
    """The totals and the head (a model without a filter), the words' counts, and the table of the filter's shards."""

    model: Model
    counts: DataFrame
    merged: DataFrame
    sizes: np.ndarray

    def blocks(self, max_bytes: float) -> list[tuple[int, int]]:
        """Stretches ``[first, end)`` of shards of at most ``max_bytes`` together, or of one shard."""
        out, room = [], -1.0
        for k, size in enumerate(((self.sizes + 7) // 8).tolist()):
            if not out or size > room:
                out.append((k, k))
                room = max_bytes
            out[-1] = (out[-1][0], k + 1)
            room -= size
        return out

    def load(self, first: int, end: int) -> Model:
        """The model with one block of the filter."""
        sizes, parts = self.sizes[first:end], [bytes(8)] * (end - first)
        rows = self.merged.where("bits IS NOT NULL").where(F.col("shard").between(first, end - 1))
        for r in rows.select("shard", "bits").toLocalIterator(prefetchPartitions=True):
            parts[r.shard - first] = bytes(r.bits)
        packed = b"".join(parts)
        del parts  # as large as the filter
        return self.model._replace(filter=Filter(sizes, packed, first, len(self.sizes)))


def _counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(h, return_counts=True)
    return values, counts.astype(np.int64)


def train(texts: DataFrame, head_words: int = HEAD_WORDS, prior: float = PRIOR) -> tuple[Model, DataFrame]:
    """A model with the whole filter from all rows of ``text`` (binary), and the exact word counts as a table ``word, n``."""
    trained = fit(texts, head_words, prior)
    return trained.load(0, len(trained.sizes)), trained.counts


def fit(texts: DataFrame, head_words: int = HEAD_WORDS, prior: float = PRIOR) -> Trained:
    """Counts all words and pairs of ``text`` (binary) and builds the filter's shards.

    The shards grow in number with the texts, so that each fits a task.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = 6
    while size > SHARD_BYTES << bits:
        bits += 1
    shift, shards = np.uint64(64 - bits), 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            words = np.concatenate(held)
            before = np.concatenate(([np.uint64(END)], words[:-1]))  # a text's first word follows the end of another
            columns = []
            some = np.zeros(shards, bool)
            for h in (words, pair_hashes(before, words)):
                values, counts = _counted(h)
                edges = np.searchsorted(values >> shift, np.arange(shards + 1))
                some |= edges[1:] > edges[:-1]
                columns += [(x, edges) for x in (values, counts)]
            some = np.flatnonzero(some).tolist()  # a shard that has nothing has no row
            cut = [pa.array([x[e[k] : e[k + 1]].tobytes() for k in some], pa.binary()) for x, e in columns]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *cut], ["shard", "w", "wn", "p", "pn"])

        held, tokens = [], 0
        for b in batches:
            for t in b.column(0):
                held.append(token_hashes(t.as_py()))
                tokens += len(held[-1])
                if tokens >= COUNT_TOKENS:
                    yield flush()
                    held, tokens = [], 0
        if held:
            yield flush()

    def merge(table: pa.Table) -> pa.Table:
        out = []
        for name in ("w", "p"):
            values = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table.column(name)])
            counts = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column(name + "n")])
            order = np.argsort(values, kind="stable")
            values, counts = values[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))[: len(values)]
            out.append((values[first], np.add.reduceat(counts, first) if len(first) else counts))
        (words, n), (pairs, m) = out
        filter_size, bits_ = build_shard(np.concatenate([words, pairs]), np.concatenate([n, m]))
        columns = {"word": words.view(np.int64), "n": n, "shard": table.column("shard")[0].as_py(), "size": filter_size, "bits": bits_}
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        rows = [(pa.array(x, t), pa.nulls(1, t)) if k < 2 else (pa.nulls(len(words), t), pa.array([x], t)) for k, (x, t) in enumerate(zip(columns.values(), kinds))]
        return pa.table({name: pa.chunked_array(x) for name, x in zip(columns, rows)})

    counted = texts.select("text").mapInArrow(count, "shard int, w binary, wn binary, p binary, pn binary")
    merged = counted.groupBy("shard").applyInArrow(merge, "word long, n long, shard int, size long, bits binary")
    merged = materialize(merged)
    counts = merged.where("word IS NOT NULL").select("word", "n")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The head: all words above the least step of counts at which they are few enough. No sort of the vocabulary.
    step = F.floor(16 * F.log2("n"))
    least, room = math.inf, head_words
    for s, n in sorted(map(tuple, counts.groupBy(step).count().collect()), reverse=True):
        room -= n
        if room < 0:
            break
        least = s
    top = counts.where(step >= least if least < math.inf else F.lit(False)).toPandas()
    head = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(head)
    sizes = np.full(shards, 64, np.int64)
    for r in merged.where("bits IS NOT NULL").select("shard", "size").collect():
        sizes[r.shard] = r.size
    model = Model(None, head[order], top["n"].to_numpy(np.int64)[order], tokens, distinct, prior)
    return Trained(model, counts, merged, sizes)


def score(
    docs: DataFrame,
    held_out_of: int = 7,
    held_out_remainder: int = 2,
    max_bytes: int = MAX_BYTES,
    head_words: int = HEAD_WORDS,
    prior: float = PRIOR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from the documents that are not held out. ``base_score``
    is the add-one unigram log10 probability from exact counts; ``score`` that
    of the bigram model, whose pair counts come from the filter. NULL and empty
    texts have one token, their end. A NULL doc_id is not held out; repeated
    rows are scored one by one. An empty table gives an empty result; with no
    training text all words are unknown.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col), held_out_of, held_out_remainder).alias("held_out"),
        as_bytes(F.col(text_col)).alias("text"),
    )
    trained = fit(rows.where("NOT held_out").select("text"), head_words, prior)
    model, counts = trained.model, trained.counts
    blocks = trained.blocks(max_bytes)
    judged = _at_once(rows, trained) if len(blocks) == 1 else _routed(rows, trained, blocks)
    judged = materialize(judged.withColumn("row", F.monotonically_increasing_id()))
    # Rarer words: each costs a row, and meets its exact count in a join.
    floor = float(np.log10(model.tokens + model.distinct + 1))
    others = judged.select("row", F.explode("others").alias("word")).join(counts, "word", "left")
    found = others.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1) - F.lit(floor)).alias("more"), F.count("n").alias("more_known")
    )
    return judged.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )


#: A document's scores by the head's counts and the filter, and the hashes of its words outside the head.
JUDGED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, others array<long>"


def _judge(m: Model, ids: pa.Array, held: pa.Array, words: np.ndarray, n: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    """The ``JUDGED`` rows of documents of ``n`` tokens each, whose tokens have the log10 probabilities ``p``."""
    starts = np.cumsum(n) - n
    known, inside = m.known(words)
    base = np.where(inside, np.log10(known + 1) - np.log10(m.tokens + m.distinct + 1), 0.0)
    outside = ~inside
    ends = np.concatenate(([0], np.cumsum(np.add.reduceat(outside.astype(np.int64), starts)))).astype(np.int32)
    arrays = [ids, held, pa.array(n, pa.int64()), pa.array(np.add.reduceat(inside.astype(np.int64), starts), pa.int64())]
    arrays += [pa.array(np.add.reduceat(x, starts), pa.float64()) for x in (base, p)]
    arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(words[outside].view(np.int64))))
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "others"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of ``SCORE_TOKENS`` tokens or so, with the tokens and their number in each text (column 2)."""
    for b in batches:
        start, tokens, hashes = 0, 0, []
        for k, t in enumerate(b.column(2)):
            hashes.append(token_hashes(t.as_py()))
            tokens += len(hashes[-1])
            if tokens >= SCORE_TOKENS or k == b.num_rows - 1:
                yield b.slice(start, k + 1 - start), np.concatenate(hashes), np.array([len(h) for h in hashes])
                start, tokens, hashes = k + 1, 0, []


def _at_once(rows: DataFrame, trained: Trained) -> DataFrame:
    """``JUDGED`` rows where one broadcast holds the whole filter: a single pass over the texts."""
    shared = rows.sparkSession.sparkContext.broadcast(trained.load(0, len(trained.sizes)).plain())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.of(shared.value)
        for b, words, n in _slices(batches):
            yield _judge(m, b.column(0), b.column(1), words, n, m.log10_p(words, np.cumsum(n) - n))

    return rows.mapInArrow(judge, JUDGED)


def _asked(m: Model, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams of a slice whose counts only the filter has, in order of their hashes, so of their shards; and its pairs."""
    outside = ~m.known(words)[1]
    pairs = pair_hashes(_before(words, starts), words)
    return np.unique(np.concatenate([words[outside], pairs])), outside, pairs


def _routed(rows: DataFrame, trained: Trained, blocks: list[tuple[int, int]]) -> DataFrame:
    """``JUDGED`` rows where the filter is broadcast in several blocks.

    One pass over the texts writes their tokens, by slice, and each slice's
    distinct n-grams, by the block that holds their shard. Each block then
    probes its own n-grams only, and the slices meet the levels that the blocks
    answer: the work grows with the texts, whatever the number of blocks.
    """
    spark = rows.sparkSession
    head = spark.sparkContext.broadcast(trained.model.plain())
    firsts = np.array([first for first, _ in blocks])
    shift = np.uint64(64 - int(np.log2(len(trained.sizes))))
    longs, bools = pa.list_(pa.int64()), pa.list_(pa.bool_())
    schema = pa.schema(
        [("slice", pa.int64()), ("block", pa.int32()), ("asked", pa.binary()), ("doc_id", longs), ("held_out", bools),
         ("n", longs), ("vocabulary", pa.binary()), ("words", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.of(head.value)
        for b, words, n in _slices(batches):
            name = b.column(3)[0].as_py()
            vocabulary, at = np.unique(words, return_inverse=True)
            own = [name, -1, None, b.column(0).to_pylist(), b.column(1).to_pylist(), n.tolist(), vocabulary.tobytes(), at.astype(np.int32).tobytes()]
            asked, _, _ = _asked(m, words, np.cumsum(n) - n)
            edges = np.append(np.searchsorted(asked >> shift, firsts.astype(np.uint64)), len(asked))
            some = np.flatnonzero(edges[1:] > edges[:-1]).tolist()
            out = [own] + [[name, k, asked[edges[k] : edges[k + 1]].tobytes(), *[None] * 5] for k in some]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    kinds = "slice long, block int, asked binary, doc_id array<long>, held_out array<boolean>, n array<long>, vocabulary binary, words binary"
    # A slice is named after its first row.
    named = rows.withColumn("row", F.monotonically_increasing_id())
    table = materialize(named.mapInArrow(cut, kinds), "block")
    parts = None
    for k, block in enumerate(blocks):
        shared = spark.sparkContext.broadcast(trained.load(*block).plain())

        def look(batches: Iterator[pa.RecordBatch], shared=shared, k=k) -> Iterator[pa.RecordBatch]:
            m = Model.of(shared.value)
            for b in batches:
                found = [m.filter.levels(np.frombuffer(x.as_py(), np.uint64)).astype(np.uint8).tobytes() for x in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([k] * len(found), pa.int32()), pa.array(found, pa.binary())], ["slice", "block", "levels"])

        part = materialize(table.where(F.col("block") == k).select("slice", "asked").mapInArrow(look, "slice long, block int, levels binary"))
        shared.destroy()
        parts = part if parts is None else parts.unionAll(part)
    # One answer of each block, together a byte for each n-gram of a slice.
    answers = parts.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("block", "levels"))).alias("answers"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.of(head.value)
        for b in batches:
            for ids, held, n, vocabulary, at, answer in zip(*b.columns, strict=True):
                words = np.frombuffer(vocabulary.as_py(), np.uint64)[np.frombuffer(at.as_py(), np.int32)]
                n = n.values.to_numpy()
                starts = np.cumsum(n) - n
                asked, outside, pairs = _asked(m, words, starts)
                count = LEVEL_COUNT[np.frombuffer(b"".join(x["levels"] for x in answer.as_py()), np.uint8)]
                single = m.known(words)[0].astype(np.float64)
                single[outside] = count[np.searchsorted(asked, words[outside])]
                # The last token of every text is its end.
                p = m.log10_p_of(single, count[np.searchsorted(asked, pairs)], starts, single[-1])
                yield _judge(m, ids.values, held.values, words, n, p)

    slices = table.where(F.col("block") == -1).select("slice", "doc_id", "held_out", "n", "vocabulary", "words")
    both = slices.join(answers, "slice").select("doc_id", "held_out", "n", "vocabulary", "words", "answers")
    return both.mapInArrow(finish, JUDGED)


ship_by_value(__name__)
