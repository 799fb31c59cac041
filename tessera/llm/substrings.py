"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends at a word end where
the hash falls under a fixed share of its range. The hash forgets all but the
last 32 bytes, so the same passage is cut alike wherever it stands, and an
insertion moves no cut that is further away. Chunks meet by digest, each
together with the chunk after it, since a short one alone is often a few common
words; a run of chunks that all occurred before is cut out of the later text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import as_bytes, materialize, row_key, ship_by_value

#: One in so many words ends a chunk, and the words of repeated chunks in a row that make a passage.
WORDS_PER_CHUNK, LEAST_WORDS = 4, 16


def _gear() -> np.ndarray:
    """A random 32-bit number for every byte."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), 2) for b in range(256)], np.uint32)


_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes hashed at a time, so that a very long text takes bounded memory.
_STEP = 1 << 20


def chunk_starts(text: bytes, words_per_chunk: int = WORDS_PER_CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which the chunks of a text start, and how many words each has."""
    data = np.frombuffer(text, np.uint8)
    gear = _gear()
    space = _IS_SPACE[data]
    first = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(first):
        return first, first
    low = np.empty(len(first), bool)
    limit = (1 << 32) // words_per_chunk
    for at in range(0, len(data), _STEP):
        # h[i] = sum of gear[data[i - j]] << j for j < 32, by doubling the reach five times.
        lead = min(at, 32)
        h = gear[data[at - lead : at + _STEP]]
        for reach in (1, 2, 4, 8, 16):
            h[reach:] += h[:-reach] << np.uint32(reach)
        a, b = np.searchsorted(first, (at, at + _STEP))
        # The hash of the bytes before a word decides whether a chunk starts with it.
        before = first[a:b] - 1 - (at - lead)
        low[a:b] = h[np.maximum(before, 0)] < limit
    low[0] = True
    at = np.flatnonzero(low)
    return first[at], np.diff(np.append(at, len(first)))


def chunks(docs: DataFrame, words_per_chunk: int = WORDS_PER_CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, starts, n_words, digests``: the chunks of every whole text, as arrays in order.

    There is a digest for every two chunks in a row, or one for a lone chunk.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row_key", pa.int64()), ("starts", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("digests", pa.list_(pa.int64()))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, counts, digests = [], [], []
            for t in b.column(2):
                text = t.as_py()
                at, n = chunk_starts(text, words_per_chunk)
                ends = [*at[min(2, len(at)) :].tolist(), len(text)] if len(at) else []
                pairs = [xxhash.xxh64_intdigest(text[x:y].rstrip()) for x, y in zip(at.tolist(), ends, strict=False)]
                starts.append(at)
                counts.append(n)
                digests.append(np.array(pairs, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, pa.list_(pa.int64())) for x in (starts, counts, digests))], schema=schema)

    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), row_key(text).alias("row_key"), as_bytes(text).alias("text")).mapInArrow(
        cut, "doc_id long, row_key long, starts array<long>, n_words array<long>, digests array<long>"
    )


def repeats(
    docs: DataFrame,
    least_words: int = LEAST_WORDS,
    words_per_chunk: int = WORDS_PER_CHUNK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents that hold a repeated passage: ``doc_id, row_key, n_chunks, repeated_words, removed_words,
    firsts, spans, removed``.

    A passage is a run of chunks, each of which occurs elsewhere (in this
    document or another), of ``least_words`` words together. The first
    occurrence, by doc_id, text hash and place, stays; ``removed_words`` counts
    the words of passages whose chunks all stand somewhere before. ``firsts``
    lists the other documents that hold the first occurrence of a chunk of
    those passages (their doc_ids, sorted), ``spans``
    the repeated passages and ``removed`` those to cut, as ``(start, end)``
    byte positions (end -1: the end of the text).

    NULL, empty and blank texts have no chunks and no row. Repeated rows (same
    doc_id and text) count as one document. A NULL doc_id comes after all
    others. An empty table gives an empty result.
    """
    table = chunks(docs, words_per_chunk, id_col, text_col).where("size(digests) > 0")
    table = materialize(table)
    places = table.select("doc_id", "row_key", F.posexplode("digests").alias("i", "digest"))
    # Repeated rows are one document: only their digests' counts could tell them apart, and they are dropped here.
    twins = materialize(table.groupBy("doc_id", "row_key").count().where("count > 1").select(F.col("doc_id").alias("t_id"), F.col("row_key").alias("t_key")))
    often = materialize(places.groupBy("digest").count().where("count > 1").select("digest"))
    found = places.join(often, "digest")
    if not twins.isEmpty():
        found = found.distinct()
    found = materialize(found)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "i")
    first = materialize(
        found.groupBy("digest").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    )
    marked = found.join(first, "digest").select(
        "doc_id", "row_key", "i", (F.col("first") != key).alias("later"), F.col("first.doc_id").alias("of"), F.col("first.row_key").alias("of_key")
    )
    per_doc = marked.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("i", "later", "of", "of_key")).alias("marks"))
    whole = table if twins.isEmpty() else table.dropDuplicates(["doc_id", "row_key"])
    right = per_doc.select(F.col("doc_id").alias("p_id"), F.col("row_key").alias("p_key"), "marks")
    both = whole.join(right, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("row_key") == F.col("p_key")))
    both = both.select("doc_id", "row_key", "starts", "n_words", "marks")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_chunks", pa.int64()), ("repeated_words", pa.int64()), ("removed_words", pa.int64()),
         ("firsts", pa.list_(pa.int64())), ("spans", span), ("removed", span)]
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [x for x in map(_document, b.to_pylist()) if x]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    def _document(row: dict) -> dict | None:
        words, starts = row["n_words"], [*row["starts"], -1]
        marks = sorted(row["marks"], key=lambda m: m["i"])
        spans = _runs([m["i"] for m in marks], words, least_words)
        if not spans:
            return None
        later = _runs([m["i"] for m in marks if m["later"]], words, least_words)
        inside = {i for a, z in later for i in range(a, z)}
        firsts = {m["of"] for m in marks if m["later"] and m["i"] in inside and m["of"] is not None and (m["of"], m["of_key"]) != (row["doc_id"], row["row_key"])}
        return {
            "doc_id": row["doc_id"], "row_key": row["row_key"], "n_chunks": len(words), "firsts": sorted(firsts),
            "repeated_words": sum(sum(words[a:z]) for a, z in spans), "removed_words": sum(sum(words[a:z]) for a, z in later),
            "spans": [{"start": starts[a], "end": starts[z]} for a, z in spans], "removed": [{"start": starts[a], "end": starts[z]} for a, z in later],
        }

    return both.mapInArrow(
        runs,
        "doc_id long, row_key long, n_chunks long, repeated_words long, removed_words long, firsts array<long>,"
        " spans array<struct<start: long, end: long>>, removed array<struct<start: long, end: long>>",
    )


def _runs(digests: list[int], words: list[int], least_words: int) -> list[tuple[int, int]]:
    """Stretches ``[a, z)`` of chunks in a row with enough words, from the numbers of their digests."""
    marked = sorted({j for i in digests for j in (i, i + 1) if j < len(words)})
    out, k = [], 0
    while k < len(marked):
        end = k
        while end + 1 < len(marked) and marked[end + 1] == marked[end] + 1:
            end += 1
        a, z = marked[k], marked[end] + 1
        if sum(words[a:z]) >= least_words:
            out.append((a, z))
        k = end + 1
    return out


def cut_repeats(docs: DataFrame, least_words: int = LEAST_WORDS, words_per_chunk: int = WORDS_PER_CHUNK) -> DataFrame:
    """The documents without their later repeated passages; all rows and columns stay, only ``text`` changes.

    A document that repeats others in full ends with an empty text.
    """
    found = materialize(repeats(docs, least_words, words_per_chunk).where("size(removed) > 0"))
    found = found.select(F.col("doc_id").alias("c_id"), F.col("row_key").alias("c_key"), "removed")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), row_key(F.col("text")).alias("key"))
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("key") == F.col("c_key")), "left")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, removed: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _cut(t, r or []) for t, r in zip(texts.to_pylist(), removed.to_pylist(), strict=True)], pa.string())

    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(cut(F.col("row.text").cast("binary"), F.col("removed")))
    return joined.select(F.col("row").withField("text", text).alias("row")).select("row.*")


def _cut(text: bytes, removed: list[dict]) -> str:
    kept, at = [], 0
    for s in removed:
        kept.append(text[at : s["start"]])
        at = len(text) if s["end"] < 0 else s["end"]
    return b"".join([*kept, text[at:]]).decode()


ship_by_value(__name__)
