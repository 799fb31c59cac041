"""Phrase collocations by mergeable Misra-Gries summaries.

Every task hashes the n-grams of its texts and counts them in steps of bounded
size; what it counted is a Misra-Gries summary that has not lost anything yet.
The summaries are dealt out by hash partition and merged there, with more
counters than the partition's mass divided by the threshold (Agarwal et al.,
2012), so that every n-gram that reaches the threshold keeps a counter. The
survivors become a Bloom filter of bounded size, and a second pass over the
texts counts the n-grams that pass it exactly, by their text. The filter only
saves work: what it lets through too much is dropped by the exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import as_bytes, materialize, ship_by_value

#: Tokens that a task counts at a time in the first and the second pass, bytes of text that it hashes at a time, and bytes of text per hash partition.
COUNT_TOKENS, PHRASE_TOKENS, HASH_BYTES, PARTITION_BYTES = 1 << 20, 1 << 18, 1 << 20, 1 << 22
#: Bits per surviving n-gram and probes of the filter, and the most bytes that are broadcast.
FILTER_BITS, PROBES, FILTER_BYTES = 10, 4, 32 << 20
#: Groups that the first step of the top-k report splits a language into.
TOP_SALTS = 64

#: 0 in a word, 1 between words, 2 between pieces (`[.,;:!?\x0A-\x0D]`).
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
#: A mask for the first 0 to 8 bytes of a little-endian word.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Words are hashed eight bytes at a time up to here; the rest of longer ones goes through xxHash.
_LONG = 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of a stretch of texts: where they stand, and in which piece of which text."""

    def __init__(self, data: np.ndarray, text_starts: np.ndarray):
        """``data``: bytes with A-Z lower-cased; ``text_starts``: where its texts start."""
        self.data = data
        kind = _CLASS[data]
        inside = kind == 0
        cut = np.zeros(len(data) + 1, bool)  # a text starts here
        cut[text_starts] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        self.start = np.flatnonzero(begins)
        # A word ends where the next byte is no word's or another text's.
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | cut[1:-1]
        self.length = np.flatnonzero(ends) + 1 - self.start
        breaks = np.cumsum((kind == 2) + cut[:-1].astype(np.int64))
        self.piece = breaks[self.start]

    def hashes(self, seed: int) -> np.ndarray:
        """A 64-bit hash of every word."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data),), "<u8", padded, strides=(1,))
        h = _mix(self.length.astype(np.uint64) + np.uint64(seed))
        live = np.arange(len(h))
        for at in range(0, _LONG, 8):
            if at:
                live = live[self.length[live] > at]
            if not len(live):
                break
            v = eight[self.start[live] + at] & _MASKS[np.minimum(self.length[live] - at, 8)]
            h[live] = _mix(h[live] ^ v)
        for k in np.flatnonzero(self.length > _LONG).tolist():
            rest = self.data[self.start[k] + _LONG : self.start[k] + self.length[k]].tobytes()
            h[k : k + 1] = _mix(h[k : k + 1] ^ np.uint64(xxhash.xxh64_intdigest(rest, seed)))
        return h

    def ngrams(self, words: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to ``most`` words: the numbers of the words at which an n-gram starts, and its hash."""
        at, h = np.arange(len(words)), words
        for n in range(1, most + 1):
            if n > 1:
                fits = at + n - 1 < len(words)
                at, h = at[fits], h[fits]
                same = self.piece[at] == self.piece[at + n - 1]
                at, h = at[same], h[same]
                h = _mix(h * np.uint64(0x9FB21C651E98DF25) + words[at + n - 1])
            yield at, h + np.uint64(n)

    def phrases(self, at: np.ndarray, n: int) -> tuple[np.ndarray, pa.Array]:
        """The phrases of ``n`` words that start at the words ``at``, in some order: that order, and the phrases."""
        start = self.start[at]
        size = self.start[at + n - 1] + self.length[at + n - 1] - start
        inner = np.concatenate(([0], np.cumsum(self.length)))
        plain = size == inner[at + n] - inner[at] + n - 1  # one space or tab between words
        one, more = np.flatnonzero(plain), np.flatnonzero(~plain)
        size = size[one]
        ends = np.cumsum(size)
        data = self.data[np.repeat(start[one] - (ends - size), size) + np.arange(int(size.sum()))]
        data[data == 0x09] = 0x20
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        spans = pa.StringArray.from_buffers(len(one), pa.py_buffer(offsets), pa.py_buffer(data))
        rest = pa.array([self.phrase(k, n) for k in at[more].tolist()], pa.string())
        return np.concatenate([one, more]), pa.concat_arrays([spans, rest])

    def phrase(self, k: int, n: int) -> str:
        return b" ".join(self.data[self.start[i] : self.start[i] + self.length[i]].tobytes() for i in range(k, k + n)).decode()


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _stretches(texts: list[bytes], langs: list[str]) -> Iterator[tuple[Words, np.ndarray, list[str]]]:
    """The texts in stretches of about ``HASH_BYTES``: words, the number of the language of each, the languages.

    A longer text is cut where a piece ends, over which no n-gram reaches.
    """
    held: list[np.ndarray] = []
    of: list[str] = []
    size = 0

    def flush():
        names = sorted(set(of))
        starts = np.cumsum([0, *map(len, held)])[:-1]
        words = Words(np.concatenate(held), starts)
        number = np.array([names.index(x) for x in of])
        return words, number[np.searchsorted(starts, words.start, side="right") - 1], names

    for text, lang in zip(texts, langs, strict=True):
        data = _LOWER[np.frombuffer(text, np.uint8)]
        while len(data):
            part = data
            if len(data) > HASH_BYTES:
                stops = np.flatnonzero(_CLASS[data[:HASH_BYTES]] == 2)
                end = int(stops[-1]) + 1 if len(stops) else 0
                if not end:  # a piece longer than a stretch is taken whole
                    after = np.flatnonzero(_CLASS[data[HASH_BYTES:]] == 2)
                    end = HASH_BYTES + int(after[0]) + 1 if len(after) else len(data)
                part = data[:end]
            data = data[len(part) :]
            held.append(part)
            of.append(lang)
            size += len(part)
            if size >= HASH_BYTES:
                yield flush()
                held, of, size = [], [], 0
    if held:
        yield flush()


def _seeds(names: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x) for x in names], np.uint64)


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, each at most ``error`` under the true count."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add another summary's counters; then every counter loses what the first one too many has."""
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[: len(keys)]
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            nth = len(keys) - self.capacity - 1
            lost = int(np.partition(counts, nth)[nth])
            self.error += lost
            keys, counts = keys[counts > lost], counts[counts > lost] - lost
        self.keys, self.counts = keys, counts

    def frequent(self, threshold: int) -> np.ndarray:
        """The keys whose true count may reach the threshold; all that do are among them."""
        return self.keys[self.counts + self.error >= threshold]


def _bits(part: np.ndarray | int, keys: np.ndarray, sizes) -> Iterator[np.ndarray]:
    """The places of keys in their partition's stretch of the filter, one array for each probe."""
    g = _mix(keys.astype(np.uint64) + (np.asarray(part).astype(np.uint64) << np.uint64(32)))
    a, b = g & np.uint64(0xFFFFFFFF), g >> np.uint64(32) | np.uint64(1)
    for i in range(PROBES):
        yield ((a + np.uint64(i) * b) & np.uint64(0xFFFFFFFF)) * sizes >> np.uint64(32)


class Filter:
    """A Bloom filter in stretches, one for each hash partition."""

    def __init__(self, sizes: np.ndarray, packed: bytes):
        self.sizes, self.packed = sizes.astype(np.uint64), packed
        self.starts = np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.uint64)
        self.shift = np.uint64(64 - int(np.log2(len(sizes))))

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of the hashes that may be survivors."""
        bits = np.frombuffer(self.packed, np.uint8)
        part = (hashes >> self.shift).astype(np.int64)
        live = np.flatnonzero(self.sizes[part] > 0)
        part, keys = part[live], hashes[live].astype(np.uint32)
        for i in range(PROBES):
            place = next(x for k, x in enumerate(_bits(part, keys, self.sizes[part])) if k == i)
            at = self.starts[part] + place
            there = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            live, part, keys = live[there], part[there], keys[there]
        return live


def survivors(texts: DataFrame, most_words: int, threshold: int, filter_bytes: int = FILTER_BYTES) -> Filter | None:
    """A filter of the n-grams of ``text, lang`` that occur ``threshold`` times, of 1 to ``most_words`` words."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if not size:
        return None
    bits = 6
    while size > PARTITION_BYTES << bits:
        bits += 1
    shift, parts = np.uint64(64 - bits), 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            edges = np.searchsorted(values >> shift, np.arange(parts + 1, dtype=np.uint64))
            some = np.flatnonzero(edges[1:] > edges[:-1]).tolist()
            keys, counts = values.astype(np.uint32), n.astype(np.uint32)
            mass = np.add.reduceat(n, edges[:-1][some]).tolist()
            rows = len(some)
            # The masses come first in a partition, and then the summaries.
            part = pa.array([*some, *some], pa.int32())
            seq = pa.array([0] * rows + [1] * rows, pa.int32())
            return pa.RecordBatch.from_arrays(
                [part, seq, pa.array([*mass, *[None] * rows], pa.int64()),
                 *(pa.array([None] * rows + [x[edges[p] : edges[p + 1]].tobytes() for p in some], pa.binary()) for x in (keys, counts))],
                ["part", "seq", "mass", "keys", "counts"],
            )

        held, tokens = [], 0
        for b in batches:
            for words, lang, names in _stretches([t.as_py() for t in b.column(0)], b.column(1).to_pylist()):
                if not len(words.start):
                    continue
                seed = _seeds(names)[lang]
                for at, h in words.ngrams(words.hashes(0), most_words):
                    held.append(_mix(h ^ seed[at]))
                tokens += len(words.start)
                if tokens >= COUNT_TOKENS:
                    yield flush()
                    held, tokens = [], 0
        if held:
            yield flush()

    most_bits = max(64, filter_bytes * 8 // parts // 64 * 64)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}

        def add() -> None:
            if state.get("keys"):
                state["summary"].merge(np.concatenate(state["keys"]), np.concatenate(state["counts"]))
            state.update(keys=[], counts=[], room=0)

        def finish() -> Iterator[pa.RecordBatch]:
            if not state:
                return
            add()
            keys = state["summary"].frequent(threshold)
            n = int(min(most_bits, -(-max(1, len(keys)) * FILTER_BITS // 64) * 64)) if len(keys) else 0
            on = np.zeros(n, bool)
            for place in _bits(state["part"], keys, np.uint64(n)) if n else ():
                on[place.astype(np.int64)] = True
            bits_ = np.packbits(on, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([state["part"]], pa.int32()), pa.array([bits_], pa.binary())], ["part", "bits"])

        for b in batches:
            for p, seq, mass, keys, counts in zip(*(b.column(c) for c in ("part", "seq", "mass", "keys", "counts")), strict=True):
                p = p.as_py()
                if p != state.get("part"):
                    yield from finish()
                    state = {"part": p, "mass": 0, "summary": None, "keys": [], "counts": [], "room": 0}
                if seq.as_py() == 0:
                    state["mass"] += mass.as_py()
                    continue
                if state["summary"] is None:
                    # One counter more than the mass over the threshold: what is lost stays under the threshold.
                    state["summary"] = Summary(state["mass"] // threshold + 1)
                state["keys"].append(np.frombuffer(keys.as_py(), np.uint32))
                state["counts"].append(np.frombuffer(counts.as_py(), np.uint32).astype(np.int64))
                state["room"] += len(state["keys"][-1])
                if state["room"] > 4 * state["summary"].capacity:
                    add()
        yield from finish()

    counted = texts.select("text", "lang").mapInArrow(count, "part int, seq int, mass long, keys binary, counts binary")
    merged = counted.repartition("part").sortWithinPartitions("part", "seq").mapInArrow(merge, "part int, bits binary")
    sizes, pieces = np.zeros(parts, np.int64), [b""] * parts
    for r in merged.toLocalIterator():
        sizes[r.part], pieces[r.part] = 8 * len(r.bits), bytes(r.bits)
    return Filter(sizes, b"".join(pieces))


def ngram_counts(
    docs: DataFrame, most_words: int = 3, threshold: int = 10, lang_col: str = "lang", text_col: str = "text", filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """``lang, n_words, phrase, a``: the exact counts of the n-grams that occur ``threshold`` times in a language.

    A row with ``n_words`` 0 has a language's number of words. A NULL language
    is ``und``. NULL, empty and blank texts have no n-grams; repeated rows
    count one by one.
    """
    rows = docs.select(as_bytes(F.col(text_col)).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    found = survivors(rows, most_words, threshold, filter_bytes)
    schema = pa.schema([("lang", pa.string()), ("n_words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
    kinds = "lang string, n_words int, phrase string, n long"
    if found is None:
        return docs.sparkSession.createDataFrame([], "lang string, n_words int, phrase string, a long")
    shared = docs.sparkSession.sparkContext.broadcast((found.sizes.astype(np.int64), found.packed))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = Filter(*shared.value)
        held: list[list] = [[] for _ in range(most_words)]
        stretches: list[Words] = []
        totals: dict[str, int] = {}
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            n_langs = len(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals)), pa.array([0] * n_langs, pa.int32()), pa.array([""] * n_langs), pa.array(list(totals.values()), pa.int64())], schema=schema
            )
            names = pa.array(list(totals))
            for n, found_ in enumerate(held, 1):
                if not found_:
                    continue
                at, h, other, lang, of = (np.concatenate(x) for x in zip(*found_, strict=True))
                # Equal in both hashes, 128 bits together.
                order = np.lexsort((other, h))
                h, other = h[order], other[order]
                new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (other[1:] != other[:-1]))))[: len(h)]
                counts = np.diff(np.append(new, len(h)))
                first = order[new]
                for k, words in enumerate(stretches):
                    mine = np.flatnonzero(of[first] == k)
                    languages = names.take(pa.array(lang[first[mine]]))
                    where, phrases = words.phrases(at[first[mine]], n)
                    yield pa.RecordBatch.from_arrays(
                        [languages.take(pa.array(where)), pa.array(np.full(len(mine), n, np.int32)), phrases, pa.array(counts[mine][where])], schema=schema
                    )

        for b in batches:
            for words, lang, names in _stretches([t.as_py() for t in b.column(0)], b.column(1).to_pylist()):
                if not len(words.start):
                    continue
                seed = _seeds(names)[lang]
                for name, n in zip(names, np.bincount(lang, minlength=len(names)).tolist(), strict=True):
                    totals[name] = totals.get(name, 0) + n
                number = np.array([list(totals).index(x) for x in names], np.int32)[lang]
                others = words.ngrams(words.hashes(1), most_words)
                for n, (at, h) in enumerate(words.ngrams(words.hashes(0), most_words)):
                    other = next(others)[1]
                    h = _mix(h ^ seed[at])
                    hits = passing.hits(h)
                    at, h, other = at[hits], h[hits], other[hits]
                    held[n].append((at, h, other, number[at], np.full(len(at), len(stretches), np.int32)))
                stretches.append(words)
                tokens += len(words.start)
                if tokens >= PHRASE_TOKENS:
                    yield from flush()
                    held, stretches, totals, tokens = [[] for _ in range(most_words)], [], {}, 0
        if stretches:
            yield from flush()

    counted = rows.mapInArrow(count, kinds).groupBy("lang", "n_words", "phrase").agg(F.sum("n").alias("a"))
    return counted.where((F.col("n_words") == 0) | (F.col("a") >= threshold))


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame,
    most_words: int = 3,
    min_count: int = 10,
    top: int = 2000,
    cover_percent: int = 50,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Candidates are phrases of 2 to ``most_words`` words that occur
    ``min_count`` times within pieces. ``score`` is the least of
    ``floor(10^6 a^2 / (l r))`` over the cuts into two parts (ties: the first
    cut), in exact decimal arithmetic up to 38 digits. Candidates inside a
    longer candidate with ``cover_percent`` of their count go. Ranks go by
    score and count, both descending, then phrase. A NULL language is ``und``;
    NULL, empty and blank texts have no words; repeated rows count one by one;
    an empty table gives an empty result.
    """
    counts = materialize(ngram_counts(docs, most_words, min_count, lang_col, text_col))
    words = F.split("phrase", " ", -1)
    phrases = counts.where("n_words >= 2").select("lang", "n_words", "phrase", "a", words.alias("w"))
    # Shorter candidates that a longer one covers.
    inner = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("n_words") - 1),
        lambda k: F.transform(F.sequence(F.lit(1), F.col("n_words") - k + 1), lambda i: _part(F.col("w"), i, k)),
    )))
    longer = phrases.where("n_words >= 3").select("lang", inner.alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = phrases.join(longer, ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("a")))
    cuts = kept.select(
        "lang", "phrase", "a", "w", "n_words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    ).select("lang", "phrase", "a", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("left"), _part(F.col("w"), F.col("k") + 1, F.col("n_words") - F.col("k")).alias("right"))
    known = counts.where((F.col("n_words") >= 1) & (F.col("n_words") < most_words))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))) div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    best = best.select("lang", "phrase", "a", "m.l", "m.r", "m.score")
    # The first of each group of a language, then the first of these: no task sorts a whole language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("n_words = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ship_by_value(__name__)
