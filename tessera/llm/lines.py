"""Line deduplication by pairwise alignment.

Documents that share lines are paired through the lines' hashes, aligned with
patience diff, and common blocks are deleted from the later document.

Documents meet in a line or in two lines in a row: each holder is paired with
the first document that has it, and the holders of a rare one with one another.
A whole copy of an earlier document's lines is paired with the first such
document alone, which has all that it could lose. So a group of copies is
linear in its size and no line is too frequent to be followed. Rarity also
tells short boilerplate: a block goes if it holds a rare line, or if it is more
than a lone short line that many documents have.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import as_bytes, materialize, row_key, ship_by_value

#: A line in at most so many documents is rare.
RARE_DOCS = 16
#: A shorter block stays, unless it is all of a document.
LEAST_WORDS = 8
#: A lone line of so many words is a passage, in however many documents it stands.
PASSAGE_WORDS = 2 * LEAST_WORDS


def patience_matches(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs ``(i, j)``, increasing in both, with ``a[i] == b[j]``: patience diff.

    Equal heads and tails match; in between, the longest increasing sequence
    of the lines that are unique on both sides; then again between those.
    """
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        once_a, once_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        at_a = {x: k for k, x in enumerate(a[i:i_end], i) if once_a[x] == 1}
        pairs = [(at_a[x], k) for k, x in enumerate(b[j:j_end], j) if once_b[x] == 1 and x in at_a]
        anchors = _longest_increasing(pairs)
        out += anchors
        edges = [(i - 1, j - 1), *anchors, (i_end, j_end)]
        if anchors:
            todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (in order of the second) that increases in the first."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (i, _) in enumerate(pairs):
        pile = bisect_left(tops, i)
        back.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(i)
            ends.append(k)
        else:
            tops[pile], ends[pile] = i, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def common_blocks(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Stretches ``[start, end)`` of ``b`` that align with ``a`` without a gap on either side."""
    blocks: list[list[int]] = []
    last = None
    for i, j in patience_matches(a, b):
        if last == (i - 1, j - 1):
            blocks[-1][1] = j + 1
        else:
            blocks.append([j, j + 1])
        last = (i, j)
    return [tuple(x) for x in blocks]


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, n_lines, at, hashes, n_words``: the lines with a word of every whole text, as arrays in order.

    Lines are compared without the space around them. ``at`` is a line's
    number among all ``n_lines`` lines.
    """
    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_lines", pa.int64()), ("at", longs), ("hashes", longs), ("n_words", longs)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, at, hashes, n_words = [], [], [], []
            for t in b.column(2):
                lines = t.as_py().split(b"\n")
                kept = [(k, len(w), x) for k, line in enumerate(lines) if (x := line.strip()) and (w := x.split())]
                n.append(len(lines))
                at.append([k for k, _, _ in kept])
                n_words.append([w for _, w, _ in kept])
                hashes.append(np.fromiter((xxhash.xxh64_intdigest(x) for _, _, x in kept), np.uint64, len(kept)).view(np.int64))
            arrays = [pa.array(n, pa.int64()), *(pa.array(x, longs) for x in (at, hashes, n_words))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *arrays], schema=schema)

    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), row_key(text).alias("row_key"), as_bytes(text).alias("text")).mapInArrow(
        read, "doc_id long, row_key long, n_lines long, at array<long>, hashes array<long>, n_words array<long>"
    )


def deletions(
    docs: DataFrame,
    rare_docs: int = RARE_DOCS,
    least_words: int = LEAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    passage_words: int = PASSAGE_WORDS,
) -> DataFrame:
    """The documents that lose lines: ``doc_id, row_key, n_lines, n_deleted, keep`` (one boolean a line).

    Earlier and later go by doc_id, then text hash; a NULL doc_id is the
    latest. A block common with an earlier document is deleted if it has
    ``least_words`` words and either a line that at most ``rare_docs``
    documents hold, a second line or ``passage_words`` words, or if it is the
    whole later document. A document is aligned with the first holders of its
    lines and of every two in a row, with all earlier ones that share a rare one
    of these, and a copy of all lines of a document with the first copy alone.
    The first holder of a line always keeps it. NULL, empty and blank texts have
    no lines to lose; repeated rows (same doc_id and text) count as one
    document; an empty table gives an empty result.
    """
    table = materialize(line_table(docs, id_col, text_col).where("size(hashes) > 0"))
    if not table.groupBy("doc_id", "row_key").count().where("count > 1").isEmpty():
        table = materialize(table.dropDuplicates(["doc_id", "row_key"]))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    # Two digests of a document's lines in order: 128 bits.
    order = [F.xxhash64("hashes"), F.xxhash64(F.reverse("hashes"), F.size("hashes"))]
    named = table.select("doc_id", "row_key", *(d.alias(f"d{k}") for k, d in enumerate(order)))
    same = named.groupBy("d0", "d1").agg(F.min(key).alias("first"), F.count("*").alias("docs")).where("docs > 1").drop("docs")
    copies = materialize(named.join(same.hint("merge"), ["d0", "d1"]).where(F.col("first") != key).select("doc_id", "row_key", "first"))
    # Lines, and two lines in a row.
    twos = F.when(F.size("hashes") > 1, F.expr("transform(sequence(1, size(hashes) - 1), i -> xxhash64(hashes[i - 1], hashes[i]))"))
    shared = F.explode(F.array_distinct(F.concat("hashes", F.coalesce(twos, F.array().cast("array<bigint>"))))).alias("line")
    held = table.select("doc_id", "row_key", shared)
    lines = materialize(held.groupBy("line").agg(F.min(key).alias("first"), F.count("*").alias("docs")).where("docs > 1"))
    # The copies count for how rare a line is, but need no further partner and are none: the first one has the same lines.
    gone = copies.select(F.col("doc_id").alias("c_id"), F.col("row_key").alias("c_key")).hint("merge")
    single = table.join(gone, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("row_key") == F.col("c_key")), "left_anti")
    held = single.select("doc_id", "row_key", shared)
    pairs = held.join(lines.hint("merge"), "line").where(F.col("first") != key)
    pairs = pairs.select("doc_id", "row_key", "first", F.when(F.col("docs") <= rare_docs, F.col("line")).alias("rare"))
    pairs = pairs.unionAll(copies.select("doc_id", "row_key", "first", F.lit(None).cast("long")))
    # At most rare_docs holders each, so their pairs are linear in the number of lines.
    rare = held.join(lines.where(F.col("docs").between(3, rare_docs)).select("line").hint("merge"), "line")
    rare = rare.groupBy("line").agg(F.array_sort(F.collect_list(key)).alias("holders"))
    rare = rare.select("line", "holders", F.posexplode("holders").alias("i", "of")).where("i >= 2")
    rare = rare.select("line", "of", F.explode(F.slice("holders", F.lit(2), F.col("i") - 1)).alias("first"))
    pairs = pairs.unionAll(rare.select("of.doc_id", "of.row_key", "first", "line"))
    pairs = pairs.select("doc_id", "row_key", F.col("first.doc_id").alias("h_id"), F.col("first.row_key").alias("h_key"), "rare")
    pairs = materialize(pairs.groupBy("doc_id", "row_key", "h_id", "h_key").agg(F.collect_list("rare").alias("rare")))
    earlier = table.select(F.col("doc_id").alias("e_id"), F.col("row_key").alias("e_key"), F.col("hashes").alias("earlier"))
    later = table.select(F.col("doc_id").alias("l_id"), F.col("row_key").alias("l_key"), "n_lines", "at", "hashes", "n_words")
    # Tables on both sides of either join, so that a frequent holder's pairs can be split over tasks.
    both = pairs.join(earlier.hint("merge"), F.col("h_id").eqNullSafe(F.col("e_id")) & (F.col("h_key") == F.col("e_key")))
    both = both.join(later.hint("merge"), F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("row_key") == F.col("l_key")))
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_lines", pa.int64()), ("lost", pa.list_(pa.int64()))])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                rare, words = set(r["rare"]), r["n_words"]
                lost: list[int] = []
                for start, end in common_blocks(r["earlier"], r["hashes"]):
                    total = sum(words[start:end])
                    counts = total >= least_words and (end - start > 1 or total >= passage_words or not rare.isdisjoint(r["hashes"][start:end]))
                    if counts or end - start == len(words):
                        lost += r["at"][start:end]
                if lost:
                    out.append({"doc_id": r["doc_id"], "row_key": r["row_key"], "n_lines": r["n_lines"], "lost": lost})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    both = both.select("doc_id", "row_key", "n_lines", "at", "hashes", "n_words", "earlier", "rare")
    lost = both.mapInArrow(align, "doc_id long, row_key long, n_lines long, lost array<long>")
    merged = lost.groupBy("doc_id", "row_key", "n_lines").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lost")))).alias("lost"))

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for n, gone in zip(b.column("n_lines").to_pylist(), b.column("lost").to_pylist(), strict=True):
                mask = np.ones(n, bool)
                mask[gone] = False
                keep.append(mask)
            count = [len(x) for x in b.column("lost").to_pylist()]
            arrays = [*(b.column(c) for c in ("doc_id", "row_key", "n_lines")), pa.array(count, pa.int64()), pa.array(keep, pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "row_key", "n_lines", "n_deleted", "keep"])

    return merged.mapInArrow(masks, "doc_id long, row_key long, n_lines long, n_deleted long, keep array<boolean>")


def dedup_lines(docs: DataFrame, rare_docs: int = RARE_DOCS, least_words: int = LEAST_WORDS) -> DataFrame:
    """All rows as a struct ``row``, with ``n_deleted`` and the ``text`` that is left (see :func:`deletions`)."""
    found = materialize(deletions(docs, rare_docs, least_words))
    found = found.select(F.col("doc_id").alias("x_id"), F.col("row_key").alias("x_key"), "n_deleted", "keep")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), row_key(F.col("text")).alias("key"))
    # One plan at every size: a small table of findings would be broadcast, a large one not.
    both = rows.join(found.hint("merge"), F.col("id").eqNullSafe(F.col("x_id")) & (F.col("key") == F.col("x_key")), "left")
    left = F.array_join(F.filter(F.split(F.col("row.text"), "\n", -1), lambda line, i: F.get(F.col("keep"), i)), "\n")
    return both.select("row", F.coalesce("n_deleted", F.lit(0)).alias("n_deleted"), F.when(F.col("keep").isNull(), F.col("row.text")).otherwise(left).alias("text"))


def drop_repeated_lines(docs: DataFrame, rare_docs: int = RARE_DOCS, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents with the text that is left and ``n_chars`` (if there) to fit; all columns stay.

    Documents that lost lines and have no word left go; those without a word from the start stay.
    """
    left = dedup_lines(docs, rare_docs, least_words).where(r"n_deleted = 0 OR text RLIKE '[^\\x20\\x09-\\x0D]'")
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        chars = F.when(F.col("n_deleted") > 0, F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))
        row = row.withField("n_chars", chars)
    return left.select(row.alias("row")).select("row.*")


ship_by_value(__name__)
