"""Licence scan: a trained paragraph classifier with a calibrated unknown class, confirmed by template comparison.

Paragraphs are the lines of a text.  A sparse multinomial logistic regression over hashed word n-grams (1 to 3 words,
lower case, without ASCII punctuation) gives each paragraph a licence family or ``unknown``.  It is trained on the driver
on the notices of :data:`TEMPLATES` (cut, joined and mixed with other words by a fixed seed) against a bounded, documented sample
of the corpus' own paragraphs, which make the unknown class; sampled paragraphs that match a template are
left out of it.  The unknown class is calibrated on held-out sampled paragraphs: the acceptance limit
is the lowest probability that at most ``false_rate`` of them exceed.  It holds for predictions that no template confirms, as it rests on a
bounded sample.  A family is *proposed* for a stretch of words if these speak for it more than for unknown (:meth:`Model.judge`); without
the classifier's proposal nothing is reported, whatever template is there.  A proposal is confirmed if at least ``coverage`` of
some template of the family is in the paragraph (its words in order, by word n-grams), or the paragraph
is a part of at least ``part_words`` words of a template.

A notice may stand inside a long paragraph, or several may: a paragraph of more than :data:`WINDOW` words is also classified in
overlapping windows, of which the best one counts for each family, and every place is compared with the templates
on its own (:func:`notices`), over line ends too: a notice wrapped over several lines is reported at its first one.  Of notices on the same words the one with more of its template is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.llm.common import bounded_sample, text_slices
from peerlens.llm.wordhash import shingle_hashes, word_hashes

#: Short notices by licence family (fixed values).
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
        "This work is dedicated to the public domain.",
    ],
    "Proprietary": [
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "All rights reserved.",
    ],
}

BITS = 18
NGRAMS = (1, 2, 3)
SAMPLE = 1500
FALSE_RATE = 0.001
COVERAGE = 0.8
PART_WORDS = 12
#: Words of a window in a long paragraph (the longest template and some words around it), and the step between windows.
WINDOW = 52
STRIDE = 20


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of the word 1- to 3-grams of texts, with repeats."""
    return _ngrams(*word_hashes(texts, letters_only=True)[:2])


def _ngrams(owner: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    owners, grams = [], []
    for n in NGRAMS:
        if len(words) < n:
            continue
        same = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1])
        _, g = shingle_hashes(np.zeros(len(words), dtype=np.int64), words, n)
        owners.append(owner[same]), grams.append(g[same])
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(grams)


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BITS)).astype(np.int64)


@lru_cache(maxsize=1)
def _template_grams() -> list[tuple[int, np.ndarray, int]]:
    """(family, different 2-grams or the single word, number of words) of every template."""
    out = []
    for k, notices in enumerate(TEMPLATES.values()):
        for notice in notices:
            words = word_hashes([notice], letters_only=True)[1]
            out.append((k, np.unique(shingle_hashes(np.zeros(len(words), dtype=np.int64), words, 2)[1]), len(words)))
    return out


@dataclass
class Model:
    """Weights (used n-gram slots x classes; the last class is unknown) and the acceptance limit."""

    row: np.ndarray  # slot -> row of weights, 0 for unused
    weights: np.ndarray
    bias: np.ndarray
    limit: float

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return self.of_words(*word_hashes(texts, letters_only=True)[:2], len(texts))

    def of_words(self, owner: np.ndarray, words: np.ndarray, texts: int) -> np.ndarray:
        """The probabilities of so many texts, of which the hashed words are given."""
        return self.judge(owner, words, texts)[0]

    def judge(self, owner: np.ndarray, words: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities, and the families that the words of a text speak for more than for unknown: those it proposes.

        The words must speak: without known n-grams, or with weights of zero, no family is proposed, whatever the bias.
        """
        owner, grams = _ngrams(owner, words)
        row = self.row[_slots(grams)]
        hit = row > 0
        owner, row = owner[hit], row[hit]
        length = np.maximum(1.0, np.bincount(owner, minlength=texts))
        said = np.zeros((texts, self.weights.shape[1]))
        for c in range(self.weights.shape[1]):
            said[:, c] = np.bincount(owner, weights=self.weights[row, c], minlength=texts) / np.sqrt(length)
        logits = said + self.bias
        proposed = (said > said[:, -1:]) & (logits > logits[:, -1:])
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), proposed


@lru_cache(maxsize=1)
def _known() -> np.ndarray:
    return np.unique(np.concatenate([g for _, g, _ in _template_grams()]))


def suspects(texts: list[str]) -> np.ndarray:
    """Paragraphs with a 2-gram that some template has (a template of one word: that word); no other can be confirmed."""
    if not texts:
        return np.zeros(0, dtype=bool)
    owner, words, _ = word_hashes(texts, letters_only=True)
    owner, grams = shingle_hashes(owner, words, 2)
    return np.bincount(owner[np.isin(grams, _known())], minlength=len(texts)) > 0


def confirm(paragraph: str, family: int, coverage: float = COVERAGE, part_words: int = PART_WORDS) -> tuple[bool, float]:
    """Whether some template of the family is (nearly) in the paragraph or the paragraph is part of one; the best share."""
    return _compared(word_hashes([paragraph], letters_only=True)[1], family, coverage, part_words)


def _compared(words: np.ndarray, family: int, coverage: float = COVERAGE, part_words: int = PART_WORDS) -> tuple[bool, float]:
    if not len(words):
        return False, 0.0
    own = np.unique(shingle_hashes(np.zeros(len(words), dtype=np.int64), words, 2)[1])
    best, part = 0.0, False
    for k, grams, _ in _template_grams():
        if k == family:
            both = len(np.intersect1d(own, grams, assume_unique=True))
            best = max(best, both / len(grams))
            part = part or (len(words) >= part_words and both >= coverage * len(own))
    return best >= coverage or part, best


@lru_cache(maxsize=1)
def _template_table() -> tuple[np.ndarray, np.ndarray]:
    """2-grams of all templates in order, and the template of each."""
    grams = [g for _, g, _ in _template_grams()]
    flat, template = np.concatenate(grams), np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    order = np.argsort(flat, kind="stable")
    return flat[order], template[order]


def _spans(at: list[int], gram: list[int], least: int, reach: int, grow: bool) -> list[tuple[int, int, int, int]]:
    """(different 2-grams, minus length, first, last) of places with at least ``least`` of them at most ``reach`` apart.

    Of places that overlap the best one is taken, or (``grow``) their union.
    """
    out: list[tuple[int, int, int, int]] = []
    held: dict[int, int] = {}
    left = 0
    for right, g in enumerate(gram):
        held[g] = held.get(g, 0) + 1
        while at[right] - at[left] > reach or held[gram[left]] > 1:
            held[gram[left]] -= 1
            if not held[gram[left]]:
                del held[gram[left]]
            left += 1
        if len(held) < least:
            continue
        span = (len(held), at[left] - at[right], at[left], at[right])
        if not out or span[2] > out[-1][3]:
            out.append(span)
        elif grow:
            first = out[-1][2]
            inside = {x for p, x in zip(at, gram) if first <= p <= span[3]}
            out[-1] = (len(inside), first - span[3], first, span[3])
        else:
            out[-1] = max(out[-1], span)
    return out


def notices(
    unit: np.ndarray, words: np.ndarray, coverage: float = COVERAGE, part_words: int = PART_WORDS
) -> list[tuple[int, float, int, int, int]]:
    """(2-grams found, their share of the template, family, first word, last word) of every place that holds a template.

    ``unit`` is the text of each word; places run over line ends (comment marks are no words).  A place holds a template if ``coverage`` of its 2-grams are within half more words than it has, or
    a part of it if that share of the 2-grams of ``part_words`` words in a row are the template's.
    """
    if len(words) < 2:
        return []
    same = np.flatnonzero(unit[1:] == unit[:-1])
    grams = shingle_hashes(np.zeros(len(words), dtype=np.int64), words, 2)[1][same]
    keys, owner = _template_table()
    low, high = (np.searchsorted(keys, grams, side=x) for x in ("left", "right"))
    n = high - low
    at = np.repeat(same, n)
    entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    templates = _template_grams()
    whole = np.array([int(np.ceil(coverage * len(g))) for _, g, _ in templates])
    part = int(np.ceil(coverage * (part_words - 1)))
    pair = unit[at] * len(templates) + owner[entry]
    different = np.unique(pair * len(keys) + entry) // len(keys)
    promising, count = np.unique(different, return_counts=True)
    promising = promising[count >= np.minimum(whole, part)[promising % len(templates)]]
    some = np.flatnonzero(np.isin(pair, promising))
    some = some[np.argsort(pair[some], kind="stable")]
    out = []
    for rows in np.split(some, np.flatnonzero(np.diff(pair[some])) + 1) if len(some) else []:
        t = int(pair[rows[0]]) % len(templates)
        family, own, size = templates[t]
        place, gram = at[rows].tolist(), entry[rows].tolist()
        found = _spans(place, gram, int(whole[t]), size + size // 2, False) + _spans(place, gram, part, part_words - 2, True)
        out += [(k, k / len(own), family, first, last + 1) for k, _, first, last in found]
    return out


def _settled(found: list[tuple], score: list[float]) -> list[int]:
    """Indices of the notices to report: of those of one family on common words, and of several families on mostly the same words, the best."""
    kept: list[int] = []
    for k in sorted(range(len(found)), key=lambda k: (-found[k][0], -score[k], found[k][3])):
        _, _, family, first, last = found[k]
        for other in kept:
            common = min(last, found[other][4]) - max(first, found[other][3]) + 1
            shorter = min(last - first, found[other][4] - found[other][3]) + 1
            if common > 0 and (family == found[other][2] or 2 * common > shorter):
                break
        else:
            kept.append(k)
    return kept


def _windows(first: np.ndarray, stop: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, first word, word behind the last) of the lines that hold a known 2-gram, and of the windows of long ones that do."""
    total = np.r_[0, np.cumsum(known)]
    line, begin, end = [np.arange(len(first))], [first], [stop]
    for k in np.flatnonzero((stop - first > WINDOW) & (total[stop] > total[first])).tolist():
        start = np.arange(first[k], stop[k] - WINDOW + STRIDE, STRIDE)
        line.append(np.full(len(start), k)), begin.append(start), end.append(np.minimum(start + WINDOW, stop[k]))
    line, begin, end = (np.concatenate(x) for x in (line, begin, end))
    some = total[end] > total[begin]
    return line[some], begin[some], end[some]


def _scan(model: Model, texts: list[str], coverage: float) -> list[tuple[int, int, int, float, float, bool]]:
    """(text, line, family, probability, share, confirmed) of some texts."""
    lines = [t.split("\n") for t in texts]
    text_of = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    number = np.concatenate([np.arange(len(x)) for x in lines])
    owner, words, _ = word_hashes([x for own in lines for x in own], letters_only=True)
    if not len(words):
        return []
    known = np.zeros(len(words), dtype=bool)
    grams = shingle_hashes(np.zeros(len(words), dtype=np.int64), words, 2)[1][: len(words) - 1]
    known[:-1] = np.isin(grams, _known()) & (owner[1:] == owner[:-1])
    filled = np.unique(owner)
    first, stop = (np.searchsorted(owner, filled, side=x) for x in ("left", "right"))
    line, begin, end = _windows(first, stop, known)
    best: dict[tuple[int, int], tuple[float, float, bool]] = {}

    def add(where: int, family: int, probability: float, share: float, confirmed: bool) -> None:
        old = best.get((where, family), (0.0, 0.0, False))
        best[where, family] = max(probability, old[0]), max(share, old[1]), confirmed or old[2]

    def judged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = end - begin
        which = np.repeat(np.arange(len(size)), size)
        return model.judge(which, words[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())], len(size))

    found = notices(text_of[owner], words, coverage)
    spans = np.array([m[3:] for m in found], dtype=np.int64).reshape(-1, 2)
    p, proposed = judged(spans[:, 0], spans[:, 1] + 1)
    # the classifier proposes a family on the words of the place, the template confirms it
    agreed = [k for k, m in enumerate(found) if proposed[k, m[2]]]
    found, p = [found[k] for k in agreed], p[agreed]
    settled = _settled(found, [p[k, m[2]] for k, m in enumerate(found)])
    taken = np.zeros(len(words) + 1, dtype=np.int64)
    for k in settled:
        _, share, family, a, b = found[k]
        add(int(owner[a]), family, float(p[k, family]), share, True)
        taken[a : b + 1] = 1
    taken = np.r_[0, np.cumsum(taken)]
    p, proposed = judged(begin, end)
    family = p[:, :-1].argmax(axis=1)
    at = np.arange(len(p))
    score = p[at, family]
    for k in np.flatnonzero((score >= model.limit) & proposed[at, family]).tolist():
        confirmed, share = _compared(words[begin[k] : end[k]], int(family[k]), coverage)
        place = line[k]
        confirmed = confirmed and taken[stop[place]] == taken[first[place]]
        add(int(filled[place]), int(family[k]), float(score[k]), share, bool(confirmed))
    return [(int(text_of[w]), int(number[w]), f, *best[w, f]) for w, f in sorted(best)]


def train(paragraphs: list[str], false_rate: float = FALSE_RATE, rounds: int = 80, seed: int = 7) -> Model:
    """Fit on the templates and sampled corpus paragraphs (every fourth is kept back for calibration)."""
    rng = np.random.default_rng(seed)
    near = suspects(paragraphs)
    clean = [p for p, s in zip(paragraphs, near) if not (s and any(confirm(p, k)[0] for k in range(len(TEMPLATES))))]
    fitted, kept_back = [p for i, p in enumerate(clean) if i % 4], clean[::4]
    filler = [w for p in fitted[:500] for w in p.split()][:5000] or ["text"]
    texts, y = list(fitted), [len(TEMPLATES)] * len(fitted)
    for k, notices in enumerate(TEMPLATES.values()):
        for notice in notices:
            for i in range(24):
                words = notice.split()
                if i % 4 == 1 and len(words) > 8:  # a part
                    cut = int(rng.integers(0, len(words) // 4 + 1))
                    words = words[cut : len(words) - int(rng.integers(0, len(words) // 4 + 1))]
                around = [filler[j] for j in rng.integers(0, len(filler), int(rng.integers(0, 12)) if i % 4 > 1 else 0)]
                at = int(rng.integers(0, len(around) + 1))
                texts.append(" ".join([*around[:at], *words, *around[at:]]))
                y.append(k)
    label, classes = np.array(y), len(TEMPLATES) + 1
    owner, grams = ngrams(texts)
    slots, column = np.unique(_slots(grams), return_inverse=True)
    row = np.zeros(1 << BITS, dtype=np.int32)
    row[slots] = np.arange(1, len(slots) + 1)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(texts))))
    target = np.zeros((len(texts), classes))
    target[np.arange(len(texts)), label] = 1
    mass = (1 / np.bincount(label, minlength=classes).clip(1))[label][:, None] / classes
    w, bias, speed = np.zeros((len(slots), classes)), np.zeros(classes), np.zeros((len(slots), classes))
    for _ in range(rounds):
        logits = np.stack([np.bincount(owner, weights=w[column, c], minlength=len(texts)) for c in range(classes)], axis=1)
        logits = logits * scale[:, None] + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        g = (p / p.sum(axis=1, keepdims=True) - target) * mass
        step = np.stack([np.bincount(column, weights=(g[:, c] * scale)[owner], minlength=len(slots)) for c in range(classes)], axis=1)
        speed = 0.9 * speed + step + 1e-5 * w
        w, bias = w - 3.0 * speed, bias - 3.0 * g.sum(axis=0)
    # sparse: only slots that speak for some class
    strong = np.abs(w).max(axis=1) > 0.01
    row[slots] = 0
    row[slots[strong]] = np.arange(1, strong.sum() + 1)
    model = Model(row, np.vstack([np.zeros(classes), w[strong]]), bias, 0.0)
    if kept_back:
        p = np.sort(model.probabilities(kept_back)[:, :-1].max(axis=1))
        model.limit = float(max(0.5, p[min(len(p) - 1, int(np.ceil(len(p) * (1 - false_rate))) - 1)]))
    else:
        model.limit = 0.5
    return model


def sampled_paragraphs(docs: DataFrame, id_col: str, text_col: str, most: int) -> list[str]:
    """One line of each of at most ``most`` documents, the first by a hash of the id."""
    lines = F.split(F.coalesce(text_col, F.lit("")), "\n")
    line = F.get(lines, F.pmod(F.xxhash64(id_col, F.lit(1)), F.size(lines)).cast("int"))
    chosen = bounded_sample(docs.select(id_col, F.substring(line, 1, 600).alias("_line")), id_col, most)
    return [r["_line"] for r in chosen.orderBy(F.xxhash64(id_col), "_line").collect() if r["_line"]]


def licence_paragraphs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, coverage: float = COVERAGE
) -> DataFrame:
    """One row per paragraph and licence family in it: ``id_col``, ``paragraph`` (number of its first line, from 0), ``family``, ``probability``, ``share``, ``confirmed``.

    Rows are the predictions above the calibrated limit and all notices that a template confirms; ``confirmed`` says that the template comparison
    agrees, ``share`` how much of the best template was found.  Null and empty texts give no rows, repeated
    rows of ``docs`` repeated ones.  The training sample (at most ``sample`` lines of up to 600 characters) is the only text that goes
    to the driver; every line of every text is classified whole.  Other columns are not read.
    """
    model = train(sampled_paragraphs(docs, id_col, text_col, sample))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = list(TEMPLATES)
    schema = T.StructType(
        [docs.schema[id_col]]
        + [T.StructField(n, t) for n, t in (("paragraph", T.LongType()), ("family", T.StringType()), ("probability", T.DoubleType()), ("share", T.DoubleType()), ("confirmed", T.BooleanType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = shared.value
        for part, texts in text_slices(batches, text_col):
            found = _scan(scan, texts, coverage)
            rows = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(id_col)).take(rows), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([names[f[2]] for f in found], pa.string()), pa.array([f[3] for f in found], pa.float64()),
                 pa.array([f[4] for f in found], pa.float64()), pa.array([f[5] for f in found], pa.bool_())],
                names=schema.names,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
