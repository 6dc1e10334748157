"""Licence notices in documents: a trained paragraph classifier whose predictions templates confirm."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketseries.llm.neardup import _BYTE, _P, _P_INVERSE, _SPACE, _mixed, _powers
from marketseries.llm.words import slices

#: Usual wordings of the notices of each licence family.
TEMPLATES = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache 2.0 license.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "This project is available under the terms of the MIT License.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPL version 2 or later.",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "Licensed under the LGPL version 2.1 or later.",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "Licensed under the AGPL version 3 or later.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "Released under the ISC license.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "Released under the Unlicense.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Content is available under CC BY 4.0 unless otherwise noted.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NoDerivs 3.0 License.",
    ],
    "CC-BY-NC-SA": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-ND": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "Licensed under CC BY-SA 4.0.",
    ],
}
#: Words that tell families of like wordings apart. Where a template fits, the notice must have just those
#: of them that the template has.
MARKS = ["lesser", "lgpl", "affero", "agpl", "nc", "noncommercial", "nd", "noderivatives", "noderivs", "sa", "sharealike"]
#: Words that deny what follows. A notice may have no other than the template.
DENIALS = ["not", "never", "neither", "nor", "isn", "without"]
#: Beginnings of the SPDX identifiers of each family, longer ones first.
SPDX = {
    "Apache-": "Apache", "MIT": "MIT", "BSD-": "BSD", "0BSD": "BSD", "LGPL-": "LGPL", "AGPL-": "AGPL", "GPL-": "GPL", "MPL-": "MPL", "ISC": "ISC",
    "Unlicense": "Unlicense", "CC-BY-NC-SA-": "CC-BY-NC-SA", "CC-BY-NC-ND-": "CC-BY-NC-ND", "CC-BY-NC-": "CC-BY-NC", "CC-BY-ND-": "CC-BY-ND",
    "CC-BY-SA-": "CC-BY-SA", "CC-BY-": "CC-BY",
}
_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+)")
#: Notices of no known family, which train the class "unknown".
OTHER_NOTICES = [
    "All rights reserved.", "This software is licensed under a proprietary license agreement.",
    "Licensed under the terms of the accompanying license file.", "Use of this material requires written permission of the owner.",
    "This document may not be reproduced without permission of the copyright holder.",
    "Distributed under the terms of the vendor license, version 1.",
]
NONE, UNKNOWN = "none", "unknown"
#: Longest word n-gram; words of a window, which begin every half window.
GRAMS, WINDOW = 3, 48
#: Rows of the corpus that the class "none" is trained on (those with the least hashes), and paragraphs of each.
BACKGROUND_ROWS, BACKGROUND_PARAGRAPHS = 300, 5
#: Share of a template's 2-grams that a paragraph must have, and the least probability of being a notice.
CONFIRM, NOTICE = 0.7, 0.5
#: Share of any wording's 2-grams that an unknown notice must have.
WORDING = 0.25


@dataclass
class Classifier:
    """Weights by class of the word n-grams (sorted hashes) that the notices have; other n-grams weigh nothing."""

    classes: list[str]
    grams: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of some lines, and the first word of each line and the end."""
    data = np.frombuffer(b" ".join([b"", *(t.translate(_SPACE) for t in texts), b""]), np.uint8)
    first = np.cumsum([1, *(len(t) + 1 for t in texts)])
    letter = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    inside = np.concatenate([[False], letter, [False]])
    begin, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_P, len(data)), dtype=np.uint64)])
    words = _mixed((sums[end] - sums[begin]) * _powers(_P_INVERSE, len(data) + 1)[begin])
    return words, np.searchsorted(begin, first)


def _cut(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of some stretches of words (from first to before last) its stretch, first word and end."""
    half = WINDOW // 2
    count = last - first
    many = np.where(count > 0, np.maximum(1, -(-(count - half) // half)), 0)
    owner = np.repeat(np.arange(len(first)), many)
    start = first[owner] + half * (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many))
    return owner, start, np.minimum(start + WINDOW, last[owner])


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of some paragraphs, and for each window its paragraph, first word and end."""
    words, at = _words(texts)
    return words, *_cut(at[:-1], at[1:])


def _grams(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 1- to 3-grams of the windows, and the window of each."""
    parts, owners = [], []
    joint = np.zeros(len(words), np.uint64)
    for n in range(1, GRAMS + 1):
        joint = joint[: len(words) - n + 1] * _P + words[n - 1 :] if len(words) >= n else joint[:0]
        size = np.maximum(0, end - start - n + 1)
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        parts.append(_mixed(joint + np.uint64(n))[at])
        owners.append(np.repeat(np.arange(len(start)), size))
    return np.concatenate(parts), np.concatenate(owners)


def _matrix(grams: np.ndarray, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window, feature and value of what the windows have of the sorted ``grams``: presence, weighted down in long windows."""
    found, owner = _grams(words, start, end)
    size = np.bincount(owner, minlength=len(start))
    at = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
    hit = grams[at] == found
    pair = np.unique(owner[hit].astype(np.int64) * len(grams) + at[hit])
    owner = pair // len(grams)
    return owner, pair % len(grams), 1 / np.sqrt(size[owner])


def _scores(model: Classifier, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Class probabilities of windows."""
    owner, feature, value = _matrix(model.grams, words, start, end)
    total = [np.bincount(owner, w[feature] * value, len(start)) for w in model.weights]
    logits = (np.stack(total, 1) + model.bias) / model.temperature
    p = np.exp(logits - logits.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def train(background: list[str], seed: int = 3, variants: int = 16, steps: int = 500) -> Classifier:
    """Multinomial logistic regression on changed wordings of the templates and on the background paragraphs.

    Two thirds of the examples fit the weights; the temperature is the one that makes the rest likeliest, so that the
    probabilities, those of ``unknown`` and ``none`` among them, are calibrated.
    """
    rng = np.random.default_rng(seed)
    classes = sorted(TEMPLATES) + [UNKNOWN, NONE]
    filler = [w for b in background for w in b.split()] or ["the", "of"]
    texts, labels = [], []
    for label, wordings in {**TEMPLATES, UNKNOWN: OTHER_NOTICES}.items():
        for wording in wordings:
            for v in range(variants):
                own = wording.split()
                if v:
                    own = [w for w in own if rng.random() > 0.05 * (v % 3)] or own
                    around = [list(rng.choice(filler, int(rng.integers(0, 22)))) for _ in range(2)]
                    own = around[0] + own + around[1]
                texts.append(" ".join(own))
                labels.append(classes.index(label))
    plain = [" ".join(b.split()[:WINDOW]) for b in background]
    wordings = [w for x in (*TEMPLATES.values(), OTHER_NOTICES) for t in x for w in t.split()]
    for _ in range(400):  # single words of notices, repeated words and mixtures are no notices
        own = list(rng.choice(filler, int(rng.integers(1, 30)))) + list(rng.choice(wordings, int(rng.integers(0, 4))))
        plain.append(" ".join(rng.permutation(own * int(rng.choice([1, 1, 8])))))
    texts += plain
    labels += [len(classes) - 1] * len(plain)
    words, owner, start, end = _windows([t.encode() for t in texts])
    notices, _, first, last = _windows([w.encode() for x in (*TEMPLATES.values(), OTHER_NOTICES) for w in x])
    grams = np.unique(_grams(notices, first, last)[0])
    row, feature, value = _matrix(grams, words, start, end)
    z = np.zeros((len(start), len(grams)))
    np.add.at(z, (row, feature), value)
    y = np.eye(len(classes))[np.array(labels)[owner]]
    fit = rng.random(len(z)) < 2 / 3
    w, b = np.zeros((len(grams), len(classes))), np.zeros(len(classes))
    share = (1 / np.maximum(1, y[fit].sum(0)))[y[fit].argmax(1)][:, None] / len(classes)  # classes weigh alike
    own, goal = z[fit], y[fit]
    for _ in range(steps):
        logits = own @ w + b
        p = np.exp(logits - logits.max(1, keepdims=True))
        gap = (p / p.sum(1, keepdims=True) - goal) * share
        w -= 20 * (own.T @ gap + 1e-5 * w)
        b -= 2 * gap.sum(0)
    held = z[~fit] @ w + b
    true = y[~fit].argmax(1)

    def loss(t: float) -> float:
        own = held / t
        own = own - own.max(1, keepdims=True)
        return float((np.log(np.exp(own).sum(1)) - own[np.arange(len(own)), true]).mean())

    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=loss) if len(true) else 1.0
    return Classifier(classes, grams, w.T.copy(), b, temperature)


def _pairs(words: np.ndarray) -> set[int]:
    return set((words[:-1] * _P + words[1:]).tolist()) if len(words) > 1 else set(words.tolist())


def _blocks(at: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and end of the stretches of two or more lines of one document without a line that has no words."""
    full = np.diff(at) > 0
    joined = full[1:] & full[:-1] & (document[1:] == document[:-1])
    edge = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
    return edge[0::2], edge[1::2] + 1


def _place(words: np.ndarray, template: set[int]) -> tuple[int, int]:
    """First and last word of the stretch of a window that has most of a template's word pairs."""
    pairs = (words[:-1] * _P + words[1:]).tolist()
    hit = [i for i, p in enumerate(pairs) if p in template]
    reach = len(template) + len(template) // 4
    inside = [[j for j in hit if i <= j <= i + reach] for i in hit]
    best = max(inside, key=lambda own: (len({pairs[j] for j in own}), own[0]))
    return best[0], best[-1] + 1


@dataclass
class Template:
    """Word pairs of a wording, and which telling words it has."""

    pairs: set[int]
    marks: set[int]
    denials: set[int]


def _hashes(words: list[str]) -> set[int]:
    return set(_words([" ".join(words).encode()])[0].tolist())


def _templates() -> dict[str, list[Template]]:
    marks, denials = _hashes(MARKS), _hashes(DENIALS)
    out = {}
    for family, wordings in {**TEMPLATES, UNKNOWN: OTHER_NOTICES}.items():
        words, at = _words([t.encode() for t in wordings])
        parts = [words[a:b] for a, b in zip(at, at[1:])]
        out[family] = [Template(_pairs(w), marks & set(w.tolist()), denials & set(w.tolist())) for w in parts]
    return out


def _fits(words: np.ndarray, own: set[int], template: Template, marks: set[int], denials: set[int]) -> float:
    """Share of a template's word pairs that a window has; 0 if too few, or if a telling word says otherwise."""
    near = len(own & template.pairs) / len(template.pairs)
    if near < CONFIRM:
        return 0.0
    a, b = _place(words, template.pairs)
    there = set(words[a : b + 1].tolist())
    before = set(words[max(0, a - 2) : b + 1].tolist())
    return near if there & marks == template.marks and before & denials <= template.denials else 0.0


def spdx_family(line: str) -> str | None:
    """Family of a line's SPDX tag; None without one."""
    tag = _TAG.search(line)
    return tag and next((f for start, f in SPDX.items() if tag[1].startswith(start)), UNKNOWN)


def background(docs: DataFrame, rows: int = BACKGROUND_ROWS) -> list[str]:
    """Paragraphs of the bounded sample for ``none``: the ``rows`` rows with the least key hashes, without notices."""
    some = docs.filter("doc_id is not null and text is not null")
    ids = [r["doc_id"] for r in some.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()]
    sample = some.filter(F.col("doc_id").isin(ids)).select("doc_id", F.substring(F.col("text").cast("string"), 1, 20000).alias("text"))
    sample = sorted(sample.collect(), key=lambda r: (r["doc_id"], r["text"]))
    found = [p for r in sample for p in [x for x in r["text"].split("\n") if x.strip()][:BACKGROUND_PARAGRAPHS]]
    return [p for p in found if not any(w in p.lower() for w in ("licen", "copyright", "all rights", "redistribut"))]


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, paragraph, family, probability and similarity of every paragraph that is a licence notice.

    Paragraphs are lines, read in overlapping windows of :data:`WINDOW` words, of which the likeliest notice counts. A
    family is reported if the share of one of its templates' word pairs that the window has reaches :data:`CONFIRM`;
    else the notice is ``unknown``, if it has some of any wording's word pairs. A notice that is wrapped over lines, none
    of them without words, is read in windows that cross them: it counts if a template confirms it, under its first line,
    and its lines are no unknown notices of their own. A template only confirms a notice that has the same telling words
    (:data:`MARKS`) and is not denied. A line with an SPDX tag has the family of its identifier. Null and empty texts have none; repeated rows repeat theirs.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates, marks, denials = _templates(), _hashes(MARKS), _hashes(DENIALS)
        none = len(model.classes) - 1
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: list[tuple] = []
            for a, b in slices([len(t or "") for t in texts], 500_000):
                paragraphs = [(i, n, p) for i in range(a, b) for n, p in enumerate((texts[i] or "").split("\n"))]
                words, at = _words([p.encode("utf-8", "surrogatepass") for _, _, p in paragraphs])
                owner, start, end = _cut(at[:-1], at[1:])
                if not len(start):
                    continue
                chance = _scores(model, words, start, end)
                notice = 1 - chance[:, none]
                best: dict[int, tuple] = {}
                for k in np.flatnonzero(notice >= NOTICE).tolist():
                    own = _pairs(words[start[k] : end[k]])
                    inside = words[start[k] : end[k]]
                    family, near = UNKNOWN, 0.0
                    for c in np.argsort(-chance[k, :none], kind="stable").tolist():  # the likeliest family that is confirmed
                        if model.classes[c] in TEMPLATES:
                            near = max(_fits(inside, own, t, marks, denials) for t in templates[model.classes[c]])
                            if near:
                                family = model.classes[c]
                                break
                    if family == UNKNOWN:
                        near = max(len(own & t.pairs) / len(t.pairs) for x in templates.values() for t in x)
                    if near < WORDING:
                        continue
                    found = (family != UNKNOWN, float(notice[k]), family, near)
                    best[owner[k]] = max(best.get(owner[k], found), found)
                first, last = _blocks(at, np.array([i for i, _, _ in paragraphs]))
                _, start, end = _cut(at[first], at[last])
                chance = _scores(model, words, start, end) if len(start) else np.zeros((0, none + 1))
                wrapped: dict[int, tuple] = {}
                for k in np.flatnonzero(1 - chance[:, none] >= NOTICE).tolist():
                    inside = words[start[k] : end[k]]
                    own = _pairs(inside)
                    for family in TEMPLATES:
                        for t in templates[family]:
                            near = _fits(inside, own, t, marks, denials)
                            if not near:
                                continue
                            a, b = (int(np.searchsorted(at, start[k] + w, "right")) - 1 for w in _place(inside, t.pairs))
                            if a < b:
                                found = (True, near, float(1 - chance[k, none]), family, b)
                                wrapped[a] = max(wrapped.get(a, found), found)
                for a, (_, near, probability, family, b) in wrapped.items():
                    for line in range(a, b + 1):
                        if line in best and not best[line][0]:
                            del best[line]
                    best.setdefault(a, (True, probability, family, near))
                for o, (i, _, line) in enumerate(paragraphs):
                    if "SPDX-License-Identifier" in line and (family := spdx_family(line)):
                        best[o] = (True, 1.0, family, 1.0)
                rows += [(keys[paragraphs[o][0]], paragraphs[o][1], f, p, n) for o, (_, p, f, n) in sorted(best.items())]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "paragraph", "family", "probability", "similarity"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        find, "doc_id long, paragraph int, family string, probability double, similarity double")
