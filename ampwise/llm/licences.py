"""License scans: a trained paragraph classifier. The scan uses DataFrame functions only.

A paragraph is a line of the text; neighbouring lines up to one without a word (blank,
or a comment mark alone) are judged together as well. A paragraph's sparse features are the words and word
pairs that occur in the notices below. A multinomial logistic regression, fitted
on the driver on those notices (with words left out at random), on scraps of them,
and on a bounded sample of lines of the corpus as the class "none", gives each
paragraph the probability of every licence family. The least certainty with which
a family is named is calibrated by leaving each family out in turn: a paragraph
that is a licence but fits no known family is "unknown". A named family is
confirmed by comparing the paragraph's word pairs with those of its notices.

Lines judged together count if they have at least half of the word pairs of a
notice, more than any line by itself: a notice wrapped over them. That find takes
the place of the lines' finds whose features are mostly that notice's.

Vocabulary words are those of the notices that are rare in the sample of lines;
every pair feature holds one. A paragraph without any such word has no feature
and is "none" by the model's bias, so only the others are scored.

Defined cases: null and empty texts have no paragraph with features and so no
find; repeated rows get equal finds; an empty table gives no rows; columns beyond
those named are ignored, one named like the output is replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampwise.llm.common import distinct_sample

#: Usual notices of public licences, by family.
NOTICES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE file in the project root for full license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "BSD": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
    ),
}
FAMILIES = tuple(NOTICES)

#: Bound of the sample of corpus lines for the class "none"; variants of each notice.
SAMPLE_LINES, VARIANTS = 3000, 30
#: A word of the notices is left out of the vocabulary if this share of the sampled lines has it.
COMMON = 0.005
#: Least likeness of word pairs that confirms a family.
CONFIRMED = 0.5

SEPARATOR = "[^a-z0-9]+"
#: The end of a line and a line without a word after it; words that begin a comment.
BLANK, COMMENT = "\n[^a-z0-9\n]*(?=\n|$)", "(^|\n)[^a-z0-9\n]*(dnl|rem)(?=[ \t\n]|$)"


def words(line: str) -> list[str]:
    return [w for w in re.split(SEPARATOR, line.lower()) if w]


def grams(w: list[str], vocabulary: set[str]) -> set[str]:
    """Features: vocabulary words, and pairs of neighbours of which one is in the vocabulary."""
    return {x for x in w if x in vocabulary} | {f"{a} {b}" for a, b in zip(w, w[1:]) if a in vocabulary or b in vocabulary}


class Model:
    """``weights[gram]``: a score for each class; class 0 is "none", then FAMILIES."""

    def __init__(self, vocabulary: list[str], weights: dict[str, list[float]], bias: list[float], certain: float) -> None:
        self.vocabulary, self.weights, self.bias, self.certain = vocabulary, weights, bias, certain

    def probabilities(self, line: str) -> np.ndarray:
        z = np.array(self.bias)
        for g in grams(words(line), set(self.vocabulary)):
            z = z + np.array(self.weights.get(g, [0.0] * len(z)))
        p = np.exp(z - z.max())
        return p / p.sum()


def _solve(rows: list[list[int]], y: np.ndarray, n_features: int, classes: int, weight: np.ndarray, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a multinomial logistic regression with a quadratic penalty (Adam)."""
    x = np.zeros((len(rows), n_features), np.float32)
    for i, r in enumerate(rows):
        x[i, r] = 1
    w, b = np.zeros((n_features, classes), np.float32), np.zeros(classes, np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    target = np.eye(classes, dtype=np.float32)[y]
    scale = (weight / weight.sum()).astype(np.float32)[:, None]
    for step in range(1, rounds + 1):
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        g = (p / p.sum(1, keepdims=True) - target) * scale
        gw, gb = x.T @ g + 2e-4 * w, g.sum(0)
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 * (1 - step / (rounds + 1))
        w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
        b -= rate * (mb / (1 - 0.9 ** step)) / (np.sqrt(vb / (1 - 0.99 ** step)) + 1e-7)
    return w, b


def fit(lines: list[str], seed: int = 5) -> Model:
    """``lines``: a bounded sample of the corpus's lines without the word parts "licen" and
    "copyright" (the class "none")."""
    rng = np.random.default_rng(seed)
    none = [words(x) for x in lines]
    seen: dict[str, int] = {}
    for w in none:
        for x in set(w):
            seen[x] = seen.get(x, 0) + 1
    notices = [(k, words(t)) for k, f in enumerate(FAMILIES, 1) for t in NOTICES[f]]
    little = {"a", "an", "and", "any", "as", "at", "be", "by", "can", "for", "form", "from", "if", "in", "is", "it", "may", "not", "of", "on",
              "one", "or", "that", "the", "this", "to", "under", "use", "was", "with", "work", "you", "are", "all", "either", "file", "code", "see"}
    vocabulary = sorted({x for _, w in notices for x in w if x not in little and len(x) > 1 and seen.get(x, 0) <= COMMON * max(1, len(none))})
    known = set(vocabulary)
    features = sorted({g for _, w in notices for g in grams(w, known)})
    at = {g: i for i, g in enumerate(features)}
    examples: list[tuple[int, set[str], int]] = []  # class, features, notice
    for n, (k, w) in enumerate(notices):
        for v in range(VARIANTS):
            keep = rng.random(len(w)) >= (0 if v == 0 else 0.25 * rng.random())
            g = grams([x for x, ok in zip(w, keep) if ok], known)
            examples.append((k, g, n))
            # a scrap: one or two of its words by themselves are no notice
            own = [x for x in w if x in known]
            examples.append((0, set(rng.choice(own, min(len(own), 1 + v % 2), replace=False).tolist()) if own else set(), -1))
    examples += [(0, grams(w, known), -1) for w in none]
    rows = [[at[g] for g in e[1] if g in at] for e in examples]
    y = np.array([e[0] for e in examples])
    size = np.bincount(y, minlength=len(FAMILIES) + 1).astype(float)
    weight = (1 / np.maximum(size, 1))[y]
    weight[y == 0] *= len(FAMILIES) / 2
    classes = len(FAMILIES) + 1
    w, b = _solve(rows, y, len(features), classes, weight)

    # calibration: how sure is a model of a family it never saw, against families that it knows
    strange, usual = [], []
    for left in range(1, classes):
        own = y == left
        train = np.flatnonzero(~own)
        w2, b2 = _solve([rows[i] for i in train], y[train], len(features), classes, weight[train], 60)
        for i in np.flatnonzero(own):
            strange.append(_certainty(rows[i], w2, b2))
    for i in np.flatnonzero(y > 0):
        usual.append(_certainty(rows[i], w, b))
    strange_a, usual_a = np.sort(strange), np.sort(usual)
    grid = np.linspace(0.5, 0.99, 50)
    wrong = [np.mean(strange_a >= t) + 2 * np.mean(usual_a < t) for t in grid]
    certain = float(grid[int(np.argmin(wrong))])
    return Model(vocabulary, {g: w[i].astype(float).tolist() for g, i in at.items()}, b.astype(float).tolist(), certain)


def _certainty(row: list[int], w: np.ndarray, b: np.ndarray) -> float:
    """Probability of the likeliest family among the families."""
    z = w[row].sum(0) + b
    p = np.exp(z[1:] - z[1:].max())
    return float(p.max() / p.sum())


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Fit on the notices and on at most SAMPLE_LINES distinct lines of the corpus, in the order of a
    hash of the line (a line that is repeated everywhere is one of them)."""
    lines = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("line")).where(
        (F.length("line") >= 20) & (F.length("line") <= 2000) & ~F.lower("line").rlike("licen|copyright|public domain"))
    return fit([r[0] for r in distinct_sample(lines, SAMPLE_LINES, "line").collect()])


def scan(docs: DataFrame, model: Model, text_col: str = "text", out: str = "licences") -> DataFrame:
    """Append ``out``: array of structs (paragraph, family, probability, certainty, likeness,
    confirmed), one for each paragraph that is likelier a licence than not; ``paragraph`` counts
    from 0, ``family`` may be "unknown"."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    vocabulary = F.lit(model.vocabulary)
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("paragraph"), F.filter(F.split(F.lower(x), SEPARATOR), lambda w: w != "").alias("w")))
    held = F.filter(numbered, lambda p: F.arrays_overlap(p["w"], vocabulary))
    found = F.filter(F.transform(held, lambda p: _judge(p, model)), lambda r: r["licence"] > 0.5)
    both = F.struct(found.alias("lines"), F.when(F.size(held) > 1, _wrapped(F.lower(text_col), model)).otherwise(F.array().cast(_JUDGED)).alias("joined"))
    merged = F.element_at(F.transform(F.array(both), lambda x: _merged(x["lines"], x["joined"], model)), 1)
    result = F.transform(merged, lambda r: F.struct(
        r["paragraph"].alias("paragraph"), F.when(r["certainty"] >= model.certain, r["family"]).otherwise("unknown").alias("family"),
        r["licence"].alias("probability"), r["certainty"].alias("certainty"), r["likeness"].alias("likeness"),
        ((r["certainty"] >= model.certain) & (r["likeness"] >= CONFIRMED)).alias("confirmed")))
    return docs.drop(out).withColumn(out, result)


_JUDGED = "array<struct<paragraph:int,family:string,licence:double,certainty:double,likeness:double,hits:array<string>,upto:int>>"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SEPARATOR), lambda w: w != "")


def _wrapped(text: Column, model: Model) -> Column:
    """Judged runs of lines between blank ones, if wrapped notices; ``paragraph`` is the first
    line with a word of the vocabulary and ``upto`` the line after the run."""
    vocabulary = F.lit(model.vocabulary)
    pieces = F.transform(F.split(text, BLANK), lambda t, k: F.struct(k.alias("k"), F.split(t, "\n").alias("lines")))

    def runs(all_: Column) -> Column:
        # the lines before each piece: those of the pieces before, added up once
        sizes = F.transform(all_, lambda q: F.size(q["lines"]))
        upto = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.element_at(F.transform(F.array(upto), lambda starts: found(all_, starts)), 1)

    def found(all_: Column, starts: Column) -> Column:
        marked = F.transform(all_, lambda q: F.struct(q["k"].alias("k"), q["lines"].alias("lines"), F.transform(q["lines"], lambda x: F.arrays_overlap(_words(x), vocabulary)).alias("held")))
        several = F.filter(marked, lambda q: F.size(F.filter(q["held"], lambda h: h)) > 1)
        placed = F.transform(several, lambda q: F.struct(
            F.element_at(starts, q["k"] + 1).alias("start"), q["held"].alias("held"), F.size(q["lines"]).alias("n"),
            _words(F.regexp_replace(F.array_join(q["lines"], "\n"), COMMENT, "\n")).alias("w")))
        judged = F.transform(placed, lambda q: _judge(F.struct((q["start"] + F.array_position(q["held"], F.lit(True)).cast("int") - 1).alias("paragraph"), q["w"].alias("w"),
                                                               (q["start"] + q["n"]).alias("upto")), model, joined=True))
        return F.filter(judged, lambda r: (r["licence"] > 0.5) & (r["pairs"] >= CONFIRMED))

    kept = F.element_at(F.transform(F.array(pieces), runs), 1)
    return F.transform(kept, lambda r: F.struct(*(r[c].alias(c) for c in ("paragraph", "family", "licence", "certainty", "likeness", "hits", "upto"))))


def _merged(lines: Column, joined: Column, model: Model) -> Column:
    """Finds of lines and of runs of lines that say more than their lines, by paragraph."""
    shown = ("paragraph", "family", "licence", "certainty", "likeness")

    def plain(finds: Column) -> Column:
        return F.transform(finds, lambda x: F.struct(*(x[c].alias(c) for c in shown)))

    families = F.map_from_arrays(F.lit(list(FAMILIES)), F.lit(_notices(model)))

    def share(hits: Column, n: Column) -> Column:
        pairs = F.filter(n, lambda g: F.instr(g, " ") > 0)
        return F.size(F.array_intersect(hits, pairs)) / F.greatest(F.size(pairs), F.lit(1))

    def within(x: Column, r: Column) -> Column:
        return (x["paragraph"] >= r["paragraph"]) & (x["paragraph"] < r["upto"])

    # the features of the notices that a run has and none of its lines has as well
    told = F.transform(joined, lambda r: F.struct(*(r[c].alias(c) for c in (*shown, "upto")), F.flatten(F.filter(
        F.element_at(families, r["family"]),
        lambda n: (share(r["hits"], n) >= CONFIRMED) & ~F.exists(lines, lambda x: within(x, r) & (share(x["hits"], n) >= share(r["hits"], n))))).alias("wrapped")))
    more = F.filter(told, lambda r: F.size(r["wrapped"]) > 0)

    def together(new: Column) -> Column:
        kept = F.filter(lines, lambda x: ~F.exists(new, lambda r: within(x, r) & (2 * F.size(F.array_intersect(x["hits"], r["wrapped"])) >= F.size(x["hits"]))))
        return F.array_sort(F.concat(plain(kept), plain(new)))

    return F.when(F.size(joined) == 0, plain(lines)).otherwise(F.element_at(F.transform(F.array(more), together), 1))


def _judge(p: Column, model: Model, joined: bool = False) -> Column:
    """``joined``: of lines judged together; the family is then that of the notice with most of its
    word pairs there, as words from far apart add up."""
    w = p["w"]
    pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    keys = list(model.weights)
    hits = F.array_intersect(F.concat(w, pairs), F.lit(keys))
    table = F.map_from_arrays(F.lit(keys), F.lit([model.weights[k] for k in keys]))
    z = F.aggregate(hits, F.lit(model.bias), lambda acc, g: F.zip_with(acc, F.element_at(table, g), lambda a, b: a + b))

    def with_z(scores: Column) -> Column:
        top = F.array_max(scores)
        e = F.transform(scores, lambda s: F.exp(s - top))
        total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
        families = F.slice(scores, 2, len(FAMILIES))
        best = F.array_max(families)
        pairs_of = _pair_likeness(hits, model) if joined else None
        place = (F.array_position(pairs_of, F.array_max(pairs_of)) if joined else F.array_position(families, best)).cast("int")
        sure = (F.exp(F.element_at(families, place) - best) if joined else F.lit(1.0)) / F.aggregate(F.transform(families, lambda s: F.exp(s - best)), F.lit(0.0), lambda a, x: a + x)
        return F.struct(p["paragraph"].alias("paragraph"), F.element_at(F.lit(list(FAMILIES)), place).alias("family"),
                        (1 - F.element_at(e, 1) / total).alias("licence"), sure.alias("certainty"), _likeness(hits, place, model).alias("likeness"), hits.alias("hits"), *((F.array_max(pairs_of).alias("pairs"), p["upto"].alias("upto")) if joined else ()))

    return F.element_at(F.transform(F.array(z), with_z), 1)


def _likeness(hits: Column, place: Column, model: Model) -> Column:
    """Largest share of a notice's features that the paragraph has, over the family's notices."""
    notices = _notices(model)
    most = max(map(len, notices))
    table = F.lit([n + [["\x00"]] * (most - len(n)) for n in notices])
    own = F.element_at(table, place)
    return F.array_max(F.transform(own, lambda n: F.size(F.array_intersect(hits, n)) / F.greatest(F.size(n), F.lit(1))))


def _notices(model: Model) -> list[list[list[str]]]:
    """Features of each family's notices."""
    known = set(model.vocabulary)
    return [[sorted(grams(words(t), known) & set(model.weights)) for t in NOTICES[f]] for f in FAMILIES]


def _pair_likeness(hits: Column, model: Model) -> Column:
    """For each family, the largest share of a notice's word pairs among ``hits``."""
    table = F.lit([[[g for g in n if " " in g] or ["\x00"] for n in f] + [["\x00"]] * (max(map(len, NOTICES.values())) - len(f)) for f in _notices(model)])
    return F.transform(table, lambda own: F.array_max(F.transform(own, lambda n: F.size(F.array_intersect(hits, n)) / F.size(n))))
