"""License scan: a trained paragraph classifier, confirmed against templates.

A logistic regression over word n-grams tells licence families and plain prose
apart. It is trained on variants of template sentences and on paragraphs of
the corpus; a temperature, fitted on paragraphs it was not trained on, makes
its probabilities honest. A prediction is confirmed by a template that is
close to the paragraph and that no mark in the paragraph contradicts: a word or
number such as "lesser", "nc" or the version, by which licences with nearly
the same sentences differ. What looks like a licence but is confirmed for no
family is ``unknown``, a class that is trained on sentences of other licences.

Only n-grams of the templates are features, so the model has a fixed size, and
texts are read where they are.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import as_bytes, hash_sample, row_key, ship_by_value
from tessera.llm.decontaminate import edit_distance_within, tokens

# Characteristic sentences of common licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "lgpl-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "lgpl-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-nd-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "cc-by-nc-sa-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc-nd-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "cc0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Dedicated to the public domain under CC0 1.0.",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright by the author. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ),
}
# Sentences of licences that are no family here, for the unknown class.
OTHERS = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "Licensed under the European Union Public Licence, version 1.2 or later.",
    "This library is free software; you may redistribute it under the same terms as Perl itself, either the Artistic License or any later version.",
    "The contents of this file are subject to the terms of the Common Development and Distribution License, version 1.0.",
    "Distributed under the Boost Software License, Version 1.0.",
    "SPDX-License-Identifier: Zlib",
    "SPDX-License-Identifier: Artistic-2.0",
)
# Words by which licences with like sentences differ; so do all numbers.
MARKS = frozenset(
    "lesser library affero gpl lgpl agpl apache mit bsd isc mozilla mpl eclipse epl unlicense cc cc0 by nc nd sa attribution "
    "noncommercial noderivatives sharealike creative commons boost artistic zlib european sil academic python".split()
)
NONE, UNKNOWN = "none", "unknown"
FAMILIES = (NONE, *TEMPLATES, UNKNOWN)
#: Paragraphs of the corpus used as prose in training at most, and variants of each template sentence.
PROSE, VARIANTS = 4000, 24
#: Words that may differ from a template, and the calibrated probability below which an edited family is in doubt.
EDIT_SHARE, CERTAIN = 0.2, 0.6
#: Share of the licence classes' probability from which on a family's templates are compared, and
#: words of a template below which it must have all its marks.
LIKELY, SHORT = 0.02, 8
ORDER, SEED = 3, 17
#: A longer paragraph is read in windows of so many words, half of them new in each.
WINDOW = 64


def ngrams(ids: list[int]) -> set[tuple[int, ...]]:
    """The word n-grams without an unknown word (0)."""
    out = set()
    for n in range(1, ORDER + 1):
        out.update(g for g in zip(*(ids[i:] for i in range(n)), strict=False) if 0 not in g)
    return out


class Finding(NamedTuple):
    family: str
    probability: float
    similarity: float
    #: The number of its first word in the line.
    word: int = 0


def stretch(template: list[str], words: list[str]) -> tuple[int, int, int]:
    """The least number of edits between a template and a stretch of the words, and where that starts and ends."""
    row = [(i, 0) for i in range(len(template) + 1)]
    best = (len(template), 0, 0)
    for k, w in enumerate(words, 1):
        new = [(0, k)]
        for i, t in enumerate(template, 1):
            new.append(min((row[i - 1][0] + (t != w), row[i - 1][1]), (row[i][0] + 1, row[i][1]), (new[i - 1][0] + 1, new[i - 1][1])))
        row = new
        if row[-1][0] < best[0]:
            best = (row[-1][0], row[-1][1], k)
    return best


def marks(words: list[str]) -> set[str]:
    return {w for w in words if w in MARKS or w.isdigit()}


def confirmed(template: list[str], words: list[str]) -> float:
    """The similarity of a template to its closest stretch of the words: 0 under the bound, or where a mark contradicts.

    The stretch may have no mark that the template lacks. In a long template
    another word may stand for a mark; one that is cut off, or any in a short
    template, must be there.
    """
    edits = edit_distance_within(template, words)
    if edits > EDIT_SHARE * len(template):
        return 0.0
    if edits:
        _, start, end = stretch(template, words)
        # The word at either end may have been left out for being another one.
        start -= start > 0 and words[start] != template[0]
        end += end < len(words) and words[end - 1] != template[-1]
        there, own = marks(words[start:end]), marks(template)
        if there - own or (own - there and (len(template) < SHORT or end - start < len(template))):
            return 0.0
    return 1 - edits / len(template)


class Classifier:
    """The fitted model: n-gram weights by family, the temperature, and the templates."""

    def __init__(self):
        self.words: dict[str, int] = {}
        self.grams: dict[tuple[int, ...], int] = {}
        self.templates = {f: [tokens(t) for t in ts] for f, ts in TEMPLATES.items()}
        for sentences in [*self.templates.values(), [tokens(t) for t in OTHERS]]:
            for s in sentences:
                ids = [self.words.setdefault(w, len(self.words) + 1) for w in s]
                for g in sorted(ngrams(ids)):
                    self.grams.setdefault(g, len(self.grams))
        self.distinct = {tuple(t): (frozenset(t), int(EDIT_SHARE * len(t))) for ts in self.templates.values() for t in ts}
        self.weights = np.zeros((len(self.grams), len(FAMILIES)))
        self.intercept = np.zeros(len(FAMILIES))
        self.temperature = 1.0

    def features(self, words: list[str]) -> list[int]:
        ids = [self.words.get(w, 0) for w in words]
        return sorted(self.grams[g] for g in ngrams(ids) if g in self.grams) if any(ids) else []

    def logits(self, features: list[int]) -> np.ndarray:
        return self.intercept + self.weights[features].sum(axis=0)

    def judge(self, words: list[str]) -> Finding | None:
        """The family of a paragraph's words, ``unknown``, or None for prose."""
        features = self.features(words)
        if not features:
            return None
        p = _softmax(self.logits(features) / self.temperature)
        if p[0] >= 0.5:
            return None
        share = p[1:] / p[1:].sum()
        near, there = [(0.0, 0.0, UNKNOWN)], set(words)
        for family, own in zip(FAMILIES[1:-1], share, strict=False):
            if own < LIKELY:
                continue
            # A template that misses more different words than may be edited is not close.
            close = [t for t in self.templates[family] if len(self.distinct[tuple(t)][0] - there) <= self.distinct[tuple(t)][1]]
            if similarity := max((confirmed(t, words) for t in close), default=0.0):
                near.append((similarity, float(own), family))
        similarity, own, family = max(near)
        # Of several families that an edited text is close to, it must be the model's choice as well.
        sure = similarity == 1 or (similarity > 0 and own >= CERTAIN * sum(n[1] for n in near))
        return Finding(family if sure else UNKNOWN, float(1 - p[0]), similarity)

    def place(self, family: str, words: list[str], s: int) -> tuple[int, int] | None:
        """Where the longest template of the family that is in the window at ``s`` stands, from and to."""
        for t in sorted(self.templates[family], key=len, reverse=True):
            if confirmed(t, words[s : s + WINDOW]):
                lo = max(0, s - WINDOW)
                _, start, end = stretch(t, words[lo : s + 2 * WINDOW])
                return lo + start, lo + end
        return None

    def licences(self, words: list[str], starts: Iterator[int]) -> tuple[list[tuple[int, int, Finding]], list[tuple[int, Finding]]]:
        """All licences in the windows of some words, ``(from, to, finding)``, and the windows of unknown ones.

        The words of a licence that is found are blanked in ``words``, so that
        the next window does not find it again, and another one beside it is seen.
        """
        found, unknown = [], []
        for s in starts:
            while any(words[s : s + WINDOW]) and (f := self.judge(words[s : s + WINDOW])):
                whole, at = f, s
                if f.family == UNKNOWN:
                    # Two families in one window leave both in doubt: read it in smaller ones.
                    parts = [(i, n) for n in (WINDOW // 2, WINDOW // 4) for i in range(s, min(s + WINDOW, len(words)), n // 2)]
                    sure = ((i, g) for i, n in parts if (g := self.judge(words[i : i + n])) and g.family != UNKNOWN)
                    at, f = next(sure, (s, f))
                place = self.place(f.family, words, at) if f.family != UNKNOWN else None
                if place is None:
                    unknown.append((s, whole))
                    break
                found.append((*place, f))
                words[place[0] : place[1]] = [""] * (place[1] - place[0])
        return found, unknown

    def may_hold(self, words: list[str]) -> bool:
        """Whether enough different words of some template are there to be close to it."""
        there = set(words)
        return any(len(t - there) <= edits for t, edits in self.distinct.values())

    def scan(self, text: str) -> Iterator[tuple[int, Finding]]:
        """The licences of a whole text, by line number and place in the line.

        Each line is read by itself, then each paragraph (lines with words in a
        row) for licences wrapped over lines. A window of an unknown one that
        overlaps a licence counts as its rest; unknown ones whose windows
        overlap are one. Unknown ones are looked for in single lines only.
        """
        out: list[tuple[int, Finding]] = []
        paragraph: list[tuple[int, list[str]]] = []
        for k, line in enumerate([*text.split("\n"), ""]):
            # Comment marks are no words.
            words = tokens(line)
            if words:
                out += [(k, f) for f in self.scan_line(words)]
                paragraph.append((k, words))
                continue
            if len(paragraph) > 1:
                for first, last, f in self.wrapped(paragraph):
                    # Unknown lines inside are parts of it.
                    out = [(j, g) for j, g in out if g.family != UNKNOWN or not first <= j <= last]
                    out.append((first, f))
            paragraph = []
        yield from sorted(out, key=lambda x: (x[0], x[1].word))

    def wrapped(self, paragraph: list[tuple[int, list[str]]]) -> Iterator[tuple[int, int, Finding]]:
        """``(first line, last line, finding)`` for the licences of a paragraph that run over a line's end.

        Takes the words that :meth:`scan_line` has left: those of licences on one line are blanked.
        """
        words = [w for _, line in paragraph for w in line]
        where = [(k, i) for k, line in paragraph for i in range(len(line))]
        starts = range(0, max(1, len(words) - WINDOW // 2), WINDOW // 2)
        crossing = (s for s in starts if where[s][0] != where[min(s + WINDOW, len(words)) - 1][0])
        found, _ = self.licences(words, (s for s in crossing if self.may_hold(words[s : s + WINDOW])))
        for a, z, f in found:
            yield where[a][0], where[z - 1][0], f._replace(word=where[a][1])

    def scan_line(self, words: list[str]) -> list[Finding]:
        """The licences of one line, whose words are blanked where one is found."""
        if not any(w in self.words for w in words):
            return []
        starts = range(0, max(1, len(words) - WINDOW // 2), WINDOW // 2) if len(words) > WINDOW else (0,)
        found, unknown = self.licences(words, starts)
        out = [f._replace(word=a) for a, _, f in found]
        last = None
        for s, f in unknown:
            if any(a < s + WINDOW and s < z for a, z, _ in found):
                continue
            if last is not None and s < last + WINDOW:
                out[-1] = max(out[-1], f._replace(word=out[-1].word), key=lambda x: x.probability)
            else:
                out.append(f._replace(word=s))
            last = s
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def variants(sentence: list[str], filler: list[list[str]], rng: random.Random, number: int) -> Iterator[list[str]]:
    """A sentence as it may stand in a text: whole, with a word lost, and beside prose."""
    yield sentence
    for _ in range(number - 1):
        out = list(sentence)
        if len(out) > 5 and rng.random() < 0.6:
            del out[rng.randrange(len(out))]
        if filler and rng.random() < 0.5:
            prose = rng.choice(filler)
            at = rng.randrange(max(1, len(prose) - 20))
            out = out + prose[at : at + 20] if rng.random() < 0.5 else prose[at : at + 20] + out
        yield out


def train(spark: SparkSession, prose: list[str]) -> Classifier:
    """Fit on the templates and on paragraphs of prose; every fifth example is kept for the temperature."""
    model, rng = Classifier(), random.Random(SEED)
    sentences = {f: [tokens(t) for t in ts] for f, ts in TEMPLATES.items()}
    # Prose that is close to a template is no example of prose.
    plain = [w for w in map(tokens, prose) if w and not _licence_like(w, sentences)]
    examples = [(w, 0) for w in plain]
    for label, family in enumerate(TEMPLATES, 1):
        for s in sentences[family]:
            examples += [(v, label) for v in variants(s, plain, rng, VARIANTS)]
    for t in OTHERS:
        examples += [(v, len(FAMILIES) - 1) for v in variants(tokens(t), plain, rng, VARIANTS)]
    # Prose of template words only, so that single common words prove nothing.
    every = sorted(model.words)
    examples += [([rng.choice(every) for _ in range(rng.randrange(1, 6))], 0) for _ in range(len(examples) // 4)]
    rng.shuffle(examples)
    rows = [(model.features(w), y) for w, y in examples]
    fit_on, held = [r for i, r in enumerate(rows) if i % 5], [r for i, r in enumerate(rows) if i % 5 == 0]
    size = len(model.grams)
    table = spark.createDataFrame(
        [(float(y), Vectors.sparse(size, [(i, 1.0) for i in x])) for x, y in fit_on], ["label", "features"]
    ).repartition(4)
    fitted = LogisticRegression(
        family="multinomial", elasticNetParam=0.5, regParam=0.0005, maxIter=60, standardization=False
    ).fit(table)
    coefficients = fitted.coefficientMatrix.toArray().T
    model.weights[:, : coefficients.shape[1]] = coefficients
    model.intercept[: coefficients.shape[1]] = fitted.interceptVector.toArray()
    logits = np.array([model.logits(x) for x, _ in held])
    truth = np.array([y for _, y in held])

    def loss(t: float) -> float:
        return -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    model.temperature = min(np.geomspace(0.25, 8, 41).tolist(), key=loss)
    return model


def _licence_like(words: list[str], sentences: dict[str, list[list[str]]]) -> bool:
    if not {"license", "licence", "licensed", "rights", "copyright", "permission", "redistribution"} & set(words):
        return False
    return any(edit_distance_within(s, words) <= len(s) // 2 for ts in sentences.values() for s in ts)


def prose_sample(docs: DataFrame, at_most: int = PROSE) -> list[str]:
    """Paragraphs for training: those of the first documents in the order of a hash, ``at_most`` in all."""
    some = hash_sample(docs.select("doc_id", "text"), max(1, at_most // 8), "doc_id", "text")
    lines = some.select(F.explode(F.split("text", "\n")).alias("line")).where("length(line) BETWEEN 1 AND 2000")
    return [r.line for r in lines.distinct().orderBy(F.xxhash64("line"), "line").limit(at_most).collect()]


def scan(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence: ``doc_id, row_key, line, family, probability, similarity, word``.

    ``line`` and ``word``, the place of the licence's first word in the line, count from 0. NULL, empty and blank texts have none; repeated
    rows are reported one by one; an empty table gives an empty result.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("line", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("word", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [
                {"doc_id": b.column(0)[k].as_py(), "row_key": b.column(1)[k].as_py(), "line": line, **found._asdict()}
                for k, t in enumerate(b.column(2))
                for line, found in model.scan(t.as_py().decode())
            ]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), row_key(text).alias("row_key"), as_bytes(text).alias("text")).mapInArrow(
        read, "doc_id long, row_key long, line long, family string, probability double, similarity double, word long"
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """:func:`scan` with a model trained on the templates and a bounded sample of the documents' paragraphs."""
    return scan(docs, train(docs.sparkSession, prose_sample(docs)))


ship_by_value(__name__)
