"""Licence scan: a classifier of paragraphs, confirmed by comparison with templates.

A paragraph is a line of text.  A multinomial logistic regression on sparse word
1-grams and 2-grams gives the probability of each licence family and of none of them
(*unknown*); a temperature, set on rows kept from training, calibrates them.  A
paragraph is reported if a family's probability is at least ``min_probability`` and
one of the family's templates confirms it: enough of the template's word pairs are in the
paragraph, or enough of the paragraph's are in the template.

Within a paragraph, windows as long as a template (and a quarter) that hold enough of its
word pairs are classified likewise, so a line of several notices gives each of their
families.  Licences that follow one grant (*licensed under A or B*) are read as a grant each.

The model is trained here, on the templates below with words dropped, replaced and
put around them, and on a bounded sample of the corpus's own paragraphs (and of
sentences that only talk of licences) as unknown ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import least_of, order_key, q

WORD = re.compile(r"\w+")
UNKNOWN = "unknown"
GRANTS = {"licensed", "released", "available", "distributed"}  # before "under"
JOINED = {"or", "and"}
ALTERNATIVE_WORDS = 24  # how far behind a grant a joined licence is looked for

# Notices and key sentences of widespread licences, by family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU GPL version 2 or later.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released into the public domain under CC0 1.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
        "This document is confidential and proprietary; unauthorized copying of this file is strictly prohibited.",
    ],
}

# Sentences that use licence words without granting anything.
NOT_LICENCES = [
    "He lost his driving license after the third version of the story.",
    "The court ruled that the general public has the right to use the path.",
    "She is a licensed electrician and works under the city's terms.",
    "The public library released a copy of the work to the author.",
    "Permission to land was granted to the pilot, free of charge.",
    "You can modify the terms of the agreement at any later time.",
    "All seats are reserved for people of any kind.",
    "The right version of the license plate was found in the file.",
]


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def pairs_of(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


@dataclass
class LicenceModel:
    families: list[str]  # the last is UNKNOWN
    vocabulary: dict  # a word or a pair of words -> its number
    weights: np.ndarray  # one row for each of the vocabulary
    bias: np.ndarray
    temperature: float
    templates: dict[str, list[set]]
    min_probability: float = 0.5
    min_overlap: float = 0.6
    min_pairs: int = 2

    def features(self, words: list[str]) -> list[int]:
        get = self.vocabulary.get
        found = {i for w in set(words) if (i := get(w)) is not None}
        found |= {i for p in pairs_of(words) if (i := get(p)) is not None}
        return sorted(found)

    def probabilities(self, words: list[str]) -> np.ndarray:
        rows = self.features(words)
        z = (self.bias + self.weights[rows].sum(axis=0) / np.sqrt(max(1, len(rows)))) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def confirm(self, family: str, pairs: set) -> float:
        """Overlap with the family's best template: the larger share of word pairs that either side has of the other."""
        best = 0.0
        for template in self.templates[family]:
            shared = len(pairs & template)
            if shared >= self.min_pairs:
                best = max(best, shared / len(template), shared / len(pairs) if shared >= 4 else 0.0)
        return best

    def classify(self, paragraph: str) -> tuple[str, float, float]:
        """(family, probability, overlap with its template); UNKNOWN if no family is likely and confirmed."""
        words = words_of(paragraph)
        get = self.vocabulary.get
        # a family is only reported with word pairs of a template, so other paragraphs need no probability
        if sum(get(p) is not None for p in zip(words, words[1:], strict=False)) < self.min_pairs:
            return UNKNOWN, 0.0, 0.0
        p = self.probabilities(words)
        best = int(p[:-1].argmax())
        family = self.families[best]
        if p[best] < self.min_probability:
            return UNKNOWN, float(p[best]), 0.0
        overlap = self.confirm(family, pairs_of(words))
        return (family if overlap >= self.min_overlap else UNKNOWN), float(p[best]), overlap

    @cached_property
    def _owners(self) -> dict[tuple[str, str], list[int]]:
        """Word pair -> the numbers of the templates that have it."""
        owners: dict[tuple[str, str], list[int]] = {}
        for number, (_, pairs) in enumerate(self._numbered):
            for p in pairs:
                owners.setdefault(p, []).append(number)
        return owners

    @cached_property
    def _numbered(self) -> list[tuple[str, set]]:
        return [(family, pairs) for family in self.families[:-1] for pairs in self.templates[family]]

    def windows(self, words: list[str]) -> list[tuple[str, float, float, int, int]]:
        """(family, probability, overlap, first word, behind the last) of windows that a template confirms.

        No two overlap: of those that do, the one with more of its template's word pairs
        stays, then the likelier.
        """
        places: dict[int, list[tuple[int, tuple]]] = {}
        for at, p in enumerate(zip(words, words[1:], strict=False)):
            for number in self._owners.get(p, ()):
                places.setdefault(number, []).append((at, p))
        likely = []
        for number, held in places.items():
            family, template = self._numbered[number]
            need = max(self.min_pairs, math.ceil(self.min_overlap * len(template)))
            if len({p for _, p in held}) < need:
                continue
            reach, inside, first = len(template) + len(template) // 4 + 1, Counter(), 0
            for at, p in held:
                inside[p] += 1
                # from the left go pairs out of reach, and those that the window holds again
                while held[first][0] <= at - reach or inside[held[first][1]] > 1:
                    inside[held[first][1]] -= 1
                    if not inside[held[first][1]]:
                        del inside[held[first][1]]
                    first += 1
                if len(inside) >= need:
                    likely.append((len(inside), len(template), family, held[first][0], at + 2))
        found = []
        for shared, size, family, start, end in set(likely):
            p = self.probabilities(words[start:end])
            best = int(p[:-1].argmax())
            if self.families[best] == family and p[best] >= self.min_probability:
                found.append((-shared, -float(p[best]), start, end, family, shared / size))
        kept: list[tuple[str, float, float, int, int]] = []
        for _, p, start, end, family, overlap in sorted(found):
            if all(end <= k[3] or k[4] <= start for k in kept):
                kept.append((family, -p, overlap, start, end))
        return sorted(kept, key=lambda k: k[3])

    def alternatives(self, words: list[str]) -> list[tuple[str, float, float, int, int]]:
        """As ``windows``: licences joined by *or* or *and* to the one that a grant names, each read behind that grant."""
        found = []
        for i in range(1, len(words)):
            if words[i] != "under" or words[i - 1] not in GRANTS:
                continue
            for at in range(i + 1, min(len(words), i + ALTERNATIVE_WORDS)):
                if words[at] in JOINED:
                    alone = words[i - 1 : i + 1] + words[at + 1 : at + ALTERNATIVE_WORDS]
                    for family, p, overlap, start, end in self.windows(alone):
                        if start <= 1:  # the grant is part of it
                            found.append((family, p, overlap, at + 1, at - 1 + end))
        return found

    def scan_line(self, line: str) -> list[tuple[str, float, float, int, int]]:
        """(family, probability, overlap, start, end): the line's own family over the whole line, then all others in it."""
        words = words_of(line)
        if sum(p in self._owners for p in zip(words, words[1:], strict=False)) < self.min_pairs:
            return []
        family, probability, overlap = self.classify(line)
        found = [(family, probability, overlap, 0, len(line))] if family != UNKNOWN else []
        places = [(m.start(), m.end()) for m in WORD.finditer(line)]
        words = [line[a:b].lower() for a, b in places]
        inner = [w for w in self.windows(words) if w[0] != family]
        seen = {family} | {w[0] for w in inner}
        for w in self.alternatives(words):
            if w[0] not in seen:
                seen.add(w[0])
                inner.append(w)
        inner.sort(key=lambda w: w[3])
        return found + [(f, p, o, places[a][0], places[b - 1][1]) for f, p, o, a, b in inner]

    def scan(self, text: str | None) -> list[dict]:
        """The licence paragraphs of a whole text and the notices within them, with their places in code points."""
        found, at = [], 0
        for line in (text or "").split("\n"):
            for family, probability, overlap, start, end in self.scan_line(line):
                found.append(
                    {"family": family, "probability": probability, "overlap": overlap, "start": at + start, "end": at + end}
                )
            at += len(line) + 1
        return found


def _variants(rng: np.random.Generator, words: list[str], others: list[str], copies: int) -> Iterator[list[str]]:
    """The template's words; then copies with some dropped or replaced, and foreign words around them."""
    yield words
    for _ in range(copies):
        noise = rng.uniform(0, 0.25)
        out = []
        for w in words:
            luck = rng.random()
            if luck < noise / 2:
                continue
            out.append(others[rng.integers(len(others))] if luck < noise else w)
        before = [others[i] for i in rng.integers(len(others), size=rng.integers(0, 6))]
        after = [others[i] for i in rng.integers(len(others), size=rng.integers(0, 6))]
        yield before + out + after


def training_rows(unknown: list[str], copies: int, seed: int) -> tuple[list[list[str]], list[int]]:
    rng = np.random.default_rng(seed)
    families = [*TEMPLATES, UNKNOWN]
    foreign = [words_of(p) for p in unknown + NOT_LICENCES]
    others = sorted({w for p in foreign for w in p}) or ["the"]
    template_words = sorted({w for ts in TEMPLATES.values() for t in ts for w in words_of(t)})
    rows, labels = [], []
    for label, family in enumerate(families[:-1]):
        for template in TEMPLATES[family]:
            for words in _variants(rng, words_of(template), others, copies):
                rows.append(words)
                labels.append(label)
    for words in foreign:
        rows.append(words)
        labels.append(len(families) - 1)
    for sentence in NOT_LICENCES:
        for words in _variants(rng, words_of(sentence), others, copies):
            rows.append(words)
            labels.append(len(families) - 1)
    for _ in range(copies * 4):  # words of templates in no order grant nothing
        rows.append([template_words[i] for i in rng.integers(len(template_words), size=rng.integers(3, 25))])
        labels.append(len(families) - 1)
    return rows, labels


def train(unknown: list[str], copies: int = 20, epochs: int = 200, rate: float = 0.5, decay: float = 1e-3, seed: int = 11) -> LicenceModel:
    """Softmax regression by full-batch Adagrad; every fifth row is kept out and sets the temperature."""
    families = [*TEMPLATES, UNKNOWN]
    texts = [words_of(t) for ts in TEMPLATES.values() for t in ts]
    terms = sorted({w for t in texts for w in t}) + sorted({p for t in texts for p in pairs_of(t)})
    vocabulary = {t: i for i, t in enumerate(terms)}
    templates = {f: [pairs_of(words_of(t)) for t in ts] for f, ts in TEMPLATES.items()}
    model = LicenceModel(families, vocabulary, np.zeros((len(terms), len(families))), np.zeros(len(families)), 1.0, templates)
    own = [u for u in unknown if max(model.confirm(f, pairs_of(words_of(u))) for f in TEMPLATES) < 0.3]
    rows, labels = training_rows(own, copies, seed)
    x = np.zeros((len(rows), len(terms)), dtype=np.float32)
    for i, words in enumerate(rows):
        at = model.features(words)
        x[i, at] = 1 / np.sqrt(max(1, len(at)))
    y = np.eye(len(families), dtype=np.float32)[labels]
    kept = np.arange(len(rows)) % 5 == 4
    weights = np.zeros((len(terms), len(families)), dtype=np.float32)
    bias = np.zeros(len(families), dtype=np.float32)
    sw, sb = np.full_like(weights, 1e-8), np.full_like(bias, 1e-8)
    xt, yt = x[~kept], y[~kept]
    for _ in range(epochs):
        z = xt @ weights + bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        error = (e / e.sum(axis=1, keepdims=True) - yt) / len(xt)
        gw, gb = xt.T @ error + decay * weights / len(families), error.sum(axis=0)
        sw, sb = sw + gw**2, sb + gb**2
        weights, bias = weights - rate * gw / np.sqrt(sw), bias - rate * gb / np.sqrt(sb)
    z, target = x[kept] @ weights + bias, np.array(labels)[kept]

    def loss(t: float) -> float:
        s = z / t
        return float(np.mean(np.log(np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)) + s.max(axis=1) - s[np.arange(len(s)), target]))

    model.weights, model.bias = weights, bias
    model.temperature = float(min(np.geomspace(0.1, 10, 81), key=loss))
    return model


def sample_paragraphs(docs: DataFrame, id_col: str, text_col: str, rows: int) -> list[str]:
    """At most ``rows`` paragraphs, one from each of the rows of least hash (of id and text)."""
    own = F.xxhash64(F.lit("licence"), q(id_col).cast("string"), q(text_col))
    lines = F.filter(F.split(q(text_col), "\n"), lambda x: F.char_length(x) > 0)
    few = least_of(docs.select(q(id_col), q(text_col)), own, rows)
    one = few.select(order_key(own).alias("h"), lines.alias("l")).where(F.size("l") > 0).select("h", F.element_at("l", (F.pmod("h", F.size("l")) + 1).cast("int")).alias("p"))
    # a paragraph beyond 2,000 code points is no better an example of an unknown one; scanning has no such limit
    return [r["p"] for r in one.select("h", F.left("p", F.lit(2000)).alias("p")).orderBy("h", "p").limit(rows).collect()]


FOUND = "array<struct<family:string,probability:double,overlap:double,start:bigint,end:bigint>>"


def licence_column(text, model: LicenceModel):
    """Column: the licence paragraphs of each text."""

    @F.arrow_udf(FOUND)
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fields = [("family", pa.string()), ("probability", pa.float64()), ("overlap", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]
        for batch in texts:
            yield pa.array([model.scan(t.as_py()) for t in batch], pa.list_(pa.struct(fields)))

    return scan(text)


def licence_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 2000) -> DataFrame:
    """``(doc_id, families, n_licences, found)`` for every row of ``docs``.

    ``families``: those found, sorted, comma-joined; ``found``: family, probability,
    overlap and place of each licence paragraph.  Null, empty and wordless texts have none.
    Repeated rows and null ids get a row each; other columns are ignored.  The unknown
    class is learned from at most ``sample_rows`` paragraphs of ``docs``; an empty table
    gives an empty result.
    """
    ship_package(docs.sparkSession)
    model = train(sample_paragraphs(docs, id_col, text_col, sample_rows))
    rows = docs.select(q(id_col).alias("doc_id"), licence_column(q(text_col), model).alias("found"))
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: f["family"]))), ",")
    return rows.select("doc_id", families.alias("families"), F.size("found").cast("bigint").alias("n_licences"), "found")
