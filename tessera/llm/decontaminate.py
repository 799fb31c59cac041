"""Benchmark decontamination: exact pieces of test items in whole documents, verified by edit distance.

A test item of m words may be found with up to k word edits. Cut into k + 1
pieces, at least one piece must occur unchanged; every exact hit of a piece is
verified against the words around it with Myers' bit-parallel distance.

The items are a bounded query set: they travel to the documents in blocks of
at most ``BLOCK_WORDS`` words, so texts are never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import as_bytes, materialize, row_key, ship_by_value

#: Share of an item's words that may be edited.
EDIT_SHARE = 0.2
#: Words of test items in one block (tens of MB in a task).
BLOCK_WORDS = 1 << 20

_TOKEN = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    """Lower-case words without punctuation."""
    return _TOKEN.findall(text.lower())


def edit_distance_within(item: list[int], text: list[int]) -> int:
    """The least number of word edits that turn ``item`` into some stretch of ``text`` (Myers, 1999)."""
    where: dict[int, int] = defaultdict(int)
    for i, word in enumerate(item):
        where[word] |= 1 << i
    full = (1 << len(item)) - 1
    last = 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best = score
    for word in text:
        eq = where.get(word, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = (minus | ~(horizontal | plus)) & full
        down = plus & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
            best = min(best, score)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = (down | ~(vertical | up)) & full, up & vertical
    return best


class Match(NamedTuple):
    item: int
    distance: int
    edits: int


class Matcher:
    """Finds the test items of one block in a text."""

    def __init__(self, items: list[tuple[int, str]], edit_share: float = EDIT_SHARE):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, list[int], int]] = []
        self.pieces: dict[int, dict[tuple[int, ...], list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens(text)]
            if not ids:
                continue
            edits = int(edit_share * len(ids))
            n = len(self.items)
            self.items.append((item_id, ids, edits))
            cuts = [len(ids) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                self.pieces[b - a][tuple(ids[a:b])].append((n, a))
        self.pieces = {k: dict(v) for k, v in self.pieces.items()}
        self.ends = {}
        for length, pieces in self.pieces.items():
            self.ends[length] = first, last = np.zeros((2, len(self.vocabulary) + 1), bool)
            first[[p[0] for p in pieces]] = True
            last[[p[-1] for p in pieces]] = True

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """``(item, where its first word would stand)`` for every exact piece."""
        known = ids > 0
        run = np.cumsum(np.concatenate(([0], known)))
        for length, pieces in self.pieces.items():
            if len(ids) < length:
                continue
            starts = np.flatnonzero(run[length:] - run[:-length] == length)
            # Most windows fall out by their first and last word, before they are looked up.
            first, last = self.ends[length]
            for s in starts[first[ids[starts]] & last[ids[starts + length - 1]]].tolist():
                for item, offset in pieces.get(tuple(ids[s : s + length].tolist()), ()):
                    yield item, s - offset

    def find(self, text: str) -> list[Match]:
        """The items that occur in a text within their edits, each with its least distance."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in tokens(text)], np.int32)
        places: dict[int, list[int]] = defaultdict(list)
        for item, at in self.hits(ids):
            places[item].append(at)
        found = []
        for item, starts in places.items():
            item_id, words, edits = self.items[item]
            spans: list[list[int]] = []
            for at in sorted(set(starts)):
                lo, hi = max(0, at - edits), at + len(words) + edits
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = hi
                else:
                    spans.append([lo, hi])
            best = min(edit_distance_within(words, ids[lo:hi].tolist()) for lo, hi in spans)
            if best <= edits:
                found.append(Match(item_id, best, edits))
        return found


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of at most ``BLOCK_WORDS`` words or so, each small enough for every task."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    rows = materialize(rows.distinct())
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // (6 * BLOCK_WORDS)
    for k in range(blocks):
        yield sorted(map(tuple, rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()))


def contaminations(
    docs: DataFrame, items: DataFrame, edit_share: float = EDIT_SHARE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document and test item found in it: ``doc_id, row_key, item_id, distance, edits``.

    ``distance`` is the least number of word edits between the item and a
    stretch of the document, at most ``edits`` = ``edit_share`` of the item's
    words. NULL, empty and word-free texts and items match nothing; repeated
    rows are reported one by one, repeated items once; a NULL doc_id is kept.
    """

    def finder(block):
        matcher = Matcher(block, edit_share)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [
                    (b.column(0)[k].as_py(), b.column(1)[k].as_py(), *m)
                    for k, t in enumerate(b.column(2))
                    for m in matcher.find(t.as_py().decode())
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema
                    )

        return find

    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("edits", pa.int32())])
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(text).alias("row_key"), as_bytes(text).alias("text"))
    out = None
    for block in item_blocks(items):
        found = rows.mapInArrow(finder(block), "doc_id long, row_key long, item_id long, distance int, edits int")
        out = found if out is None else out.unionAll(found)
    return out


def is_contaminated(block: list[tuple[int, str]], text: Column, edit_share: float = EDIT_SHARE) -> Column:
    """Whether a text contains an item of the block."""
    matcher = Matcher(block, edit_share)

    @F.arrow_udf("boolean")
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([bool(matcher.find(t.as_py().decode())) for t in texts], pa.bool_())

    return found(as_bytes(text))


def drop_contaminated(docs: DataFrame, items: DataFrame, edit_share: float = EDIT_SHARE) -> DataFrame:
    """The documents in which no test item is found, all columns as they were."""
    for block in item_blocks(items):
        docs = docs.where(~is_contaminated(block, F.col("text"), edit_share))
    return docs


ship_by_value(__name__)
