"""License scans: a trained paragraph classifier, confirmed by templates.

Features are hashed word uni- and bigrams of a paragraph (a line), each counted
once and scaled by the root of their number.  Softmax regression knows the
families and an unknown class; a temperature fitted on a held-out part calibrates
it.  A family is reported if it is likelier than ``MIN_PROBABILITY`` and one of its
templates confirms it by containment of word bigrams.

Notices wrapped over several lines are found as windows: wherever so many bigrams
of a template stand within ``SPAN`` of its length, the words from the first to the
last of them are judged as one paragraph, whatever lines they lie on.  Of confirmed
notices that overlap, on one line or on several, the one that holds most of its
template counts, then the shortest, then the likeliest.  ``n_paragraphs`` counts
lines; ``n_predicted`` counts lines and confirmed windows.

Training rows: templates cut, merged and damaged by rule, against a bounded sample
of whole lines of the corpus itself as the unknown class.

Defined cases: null and empty texts have no paragraphs; a paragraph without words
is none; a very long text is one row, scanned whole; of confirmed notices that share a
place the first of the order above counts; repeated rows are treated alike, each by
itself; an empty table gives an empty result (and trains against nothing but damaged
templates); extra columns of any name and type are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import hash_sample

BUCKETS = 1 << 15
#: About so many documents and so many of their lines (those of small hash) form the unknown class; longer lines are left out.
UNKNOWN_DOCS = 800
UNKNOWN_LINES = 8_000
UNKNOWN_CHARS = 2_000
MIN_PROBABILITY = 0.6
MIN_CONTAINED = 0.6
#: Words that a wrapped notice may be spread over, as a multiple of its template's (and ten more).
SPAN = 2
#: Words without a new bigram of the template that end a notice.
GAP = 10
SEED = 11

# Wording of common licence notices, by family.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "SPDX-License-Identifier: Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License.", "SPDX-License-Identifier: GPL-2.0-only", "Licensed under the GNU General Public License, version 2."],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Released under the 3-Clause BSD License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "Proprietary": ["Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher.", "All rights reserved."],
}
FAMILIES = tuple(TEMPLATES)
SCHEMA = "doc_id long, n_paragraphs long, n_predicted long, n_confirmed long, families string, probability double"


def _words(text: str) -> list[str]:
    raw = text.encode().translate(bytes(tv.LOWER))
    s, e, _ = tv.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), tv.ALNUM)
    return [raw[a:b].decode() for a, b in zip(s.tolist(), e.tolist(), strict=True)]


def _bigrams(ws: list[str]) -> set:
    return set(zip(ws, ws[1:], strict=False)) or set(ws)


def containment(words: list[str], family: str) -> float:
    """The largest share of a template's bigrams that the paragraph has."""
    have = _bigrams(words)
    return max(len(have & t) / len(t) for t in (_bigrams(_words(x)) for x in TEMPLATES[family]))


def line_features(data: np.ndarray, offs: np.ndarray):
    """Paragraphs of the rows (start, end, row) and their distinct hashed n-grams (paragraph, bucket), with the number of each."""
    low = tv.LOWER[data]
    is_line = np.full(256, True)
    is_line[[0x0A, 0x0D]] = False
    ls, le, lrow = tv.words(low, offs, is_line)
    ws, we, _ = tv.words(low, offs, tv.ALNUM)
    if not len(ws):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z, z
    line = np.searchsorted(ls, ws, side="right") - 1
    filled, line = np.unique(line, return_inverse=True)
    ls, le, lrow = ls[filled], le[filled], lrow[filled]
    h = tv.MAIN.ranges(tv.MAIN.prefix(low), ws, we)
    two, at = tv.windows(h, line, 2)
    bucket = (np.concatenate([h, two]) % tv.U(BUCKETS)).astype(np.int64)
    para = np.concatenate([line, line[at]])
    size = np.bincount(para, minlength=len(ls))
    return ls, le, lrow, para, bucket, size


def _hashed(low: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (start, end) of rows, and their bigrams (hash, index of the first word), with the row of each word."""
    ws, we, row = tv.words(low, offs, tv.ALNUM)
    two, at = tv.windows(tv.MAIN.ranges(tv.MAIN.prefix(low), ws, we), row, 2)
    return ws, we, row, two, at


@functools.cache
def _grams() -> tuple[np.ndarray, list[tuple[np.ndarray, int, int]]]:
    """Hashes of all templates' bigrams, sorted; per template which of them it has, how many confirm it, and its span."""
    of = []
    for texts in TEMPLATES.values():
        for text in texts:
            raw = np.frombuffer(" ".join(_words(text)).encode(), np.uint8)
            ws, _, _, two, _ = _hashed(raw, np.array([0, len(raw)]))
            of.append((np.unique(two), len(ws)))
    known = np.unique(np.concatenate([t for t, _ in of]))
    return known, [(np.isin(known, t), math.ceil(MIN_CONTAINED * len(t) - 1e-9), SPAN * n + 10) for t, n in of]


def _whole(gram: np.ndarray, place: np.ndarray, first: int, last: int) -> int:
    """The last hit in first..last that adds a new bigram and lies at most ``GAP`` words after the one before."""
    seen, end = {gram[first]}, first
    for i in range(first + 1, last + 1):
        if place[i] - place[end] > GAP:
            break
        if gram[i] not in seen:
            seen.add(gram[i])
            end = i
    return end


def windows(data: np.ndarray, offs: np.ndarray, ls: np.ndarray) -> np.ndarray:
    """Passages over two lines or more (start, end, first line, last line) that hold as many bigrams of a template as confirm it.

    ``ls`` are the starts of all lines with words.  From each hit on, the least such passage and the ``_whole`` one.
    """
    known, templates = _grams()
    ws, we, row, two, at = _hashed(tv.LOWER[data], offs)
    if not len(two):
        return np.zeros((0, 4), np.int64)
    gram = np.searchsorted(known, two).clip(max=len(known) - 1)
    hit = known[gram] == two
    gram, at = gram[hit], at[hit]
    line = np.searchsorted(ls, ws, side="right") - 1
    out = [np.zeros((0, 4), np.int64)]
    for has, least, span in templates:
        p, g = at[has[gram]], gram[has[gram]]
        if len(p) < least:
            continue
        # a span ends with its row; gaps of span words between rows keep them apart
        place = p + row[p] * span
        k = np.flatnonzero(place[least - 1 :] - place[: len(place) - least + 1] < span)
        last = np.searchsorted(place, place[k] + span, side="left") - 1
        whole = np.array([_whole(g, place, a, z) for a, z in zip(k.tolist(), last.tolist(), strict=True)], np.int64)
        for end in (k + least - 1, whole):
            out.append(np.stack([ws[p[k]], we[p[end] + 1], line[p[k]], line[p[end] + 1]], axis=1))
    found = np.unique(np.concatenate(out), axis=0)
    return found[found[:, 3] > found[:, 2]]


@dataclass
class Model:
    weights: np.ndarray  # active bucket -> class; class 0 is unknown
    active: np.ndarray  # bucket -> row of weights, 0 if never seen in a template
    bias: np.ndarray
    temperature: float

    def probabilities(self, para: np.ndarray, bucket: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paragraphs with at least two active n-grams, and their class probabilities; the others are unknown."""
        row = self.active[bucket]
        on = row > 0
        para, row = para[on], row[on]
        rich = np.bincount(para, minlength=len(size)) >= 2
        on = rich[para]
        key = np.unique(para[on] * np.int64(len(self.weights)) + row[on])
        para, row = key // len(self.weights), key % len(self.weights)
        ids, inv = np.unique(para, return_inverse=True)
        z = np.tile(self.bias, (len(ids), 1))
        np.add.at(z, inv, self.weights[row] / np.sqrt(size[para])[:, None])
        return ids, softmax(z / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
    return e / e.sum(axis=1, keepdims=True) if len(z) else z


def damaged(seed: int = SEED, copies: int = 24) -> list[tuple[str, int]]:
    """(paragraph, class) made from the templates: cut at either end, words lost, a few strange words added."""
    rng = np.random.default_rng(seed)
    noise = ["foo", "bar", "copyright", "2021", "the", "project", "see", "file", "author", "by"]
    out = []
    for k, texts in enumerate(TEMPLATES.values(), 1):
        for text in texts:
            ws = _words(text)
            for c in range(copies):
                keep = [w for w in ws if c == 0 or rng.random() > 0.08]
                extra = [noise[i] for i in rng.integers(0, len(noise), rng.integers(0, 4))] if c % 3 else []
                out.append((" ".join(keep + extra if c % 2 else extra + keep), k))
    # fragments without the words that name a licence are unknown
    for texts in TEMPLATES.values():
        for text in texts:
            ws = _words(text)
            out += [(" ".join(ws[i : i + 2]), 0) for i in range(0, max(1, len(ws) - 2), 4)]
    return out


def train(samples: list[tuple[str, int]], steps: int = 300, rate: float = 2.0, ridge: float = 1e-4) -> Model:
    """Full-batch softmax regression over n-grams of the templates; every fifth sample calibrates."""
    texts = [t.replace("\n", " ") for t, _ in samples]
    y = np.array([k for _, k in samples])
    raw = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    _, _, row, para, bucket, size = line_features(np.frombuffer(b"".join(raw), np.uint8), offs)
    y = y[row]
    known = np.unique(bucket[y[para] > 0])
    active = np.zeros(BUCKETS, np.int64)
    active[known] = np.arange(1, len(known) + 1)
    x = np.zeros((len(size), len(known) + 1), np.float32)
    x[para, active[bucket]] = (1 / np.sqrt(size))[para]
    x[:, 0] = 0
    classes = len(FAMILIES) + 1
    target = np.eye(classes, dtype=np.float32)[y]
    weigh = (1 / np.bincount(y, minlength=classes).clip(1))[y].astype(np.float32)
    weigh[y == 0] *= 3
    fit = np.arange(len(y)) % 5 > 0
    w, b = np.zeros((x.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    xf, tf, wf = x[fit], target[fit], weigh[fit] / weigh[fit].sum()
    for _ in range(steps):
        g = (softmax(xf @ w + b) - tf) * wf[:, None]
        w -= rate * 8 * (xf.T @ g + ridge * w)
        b -= rate * g.sum(axis=0)
    z, t, c = x[~fit] @ w + b, y[~fit], weigh[~fit]
    loss = lambda temp: -float((c * np.log(softmax(z / temp)[np.arange(len(t)), t] + 1e-12)).sum())
    return Model(w.astype(np.float64), active, b.astype(np.float64), min((0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0, 1.5, 2.0), key=loss))


def fit(docs: DataFrame, unknown_docs: int = UNKNOWN_DOCS) -> Model:
    """Trained against lines of a bounded sample of the corpus; lines that a template confirms are left out."""
    sample = hash_sample(docs.select("doc_id", "text", F.length("text").alias("len")).where("text is not null"), unknown_docs, "doc_id", "len")
    lines = sample.select(F.explode(F.split("text", "[\\n\\r]+")).alias("line")).where((F.length("line") <= UNKNOWN_CHARS) & (F.length(F.trim("line")) > 0))
    other = []
    for r in hash_sample(lines.distinct(), UNKNOWN_LINES, "line").collect():
        ws = _words(r["line"])
        if ws and all(containment(ws, f) < MIN_CONTAINED for f in FAMILIES):
            other.append((" ".join(ws), 0))
    return train(damaged() + sorted(set(other)))


def held(data: np.ndarray, start: int, end: int, family: str) -> tuple[float, int, int]:
    """The largest share of a template of the family that the passage holds, and where its bigrams begin and end."""
    raw = tv.LOWER[data[start:end]]
    ws, we, _ = tv.words(raw, np.array([0, len(raw)]), tv.ALNUM)
    words = [raw[a:z].tobytes().decode() for a, z in zip(ws.tolist(), we.tolist(), strict=True)]
    have, best = _bigrams(words), (0.0, start, end)
    for t in (_bigrams(_words(x)) for x in TEMPLATES[family]):
        if (share := len(have & t) / len(t)) > best[0]:
            at = [i for i, two in enumerate(zip(words, words[1:], strict=False)) if two in t] or [0]
            best = (share, start + int(ws[at[0]]), start + int(we[min(at[-1] + 1, len(we) - 1)]))
    return best


def wrapped(model: Model, data: np.ndarray, offs: np.ndarray, ls: np.ndarray) -> list[tuple]:
    """Confirmed notices on several lines, as (-share, size, -probability, start, line, family)."""
    runs = windows(data, offs, ls)
    if not len(runs):
        return []
    raw = [data[a:z].tobytes().replace(b"\n", b" ").replace(b"\r", b" ") for a, z, _, _ in runs.tolist()]
    _, _, at, para, bucket, size = line_features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))
    ids, p = model.probabilities(para, bucket, size)
    out = []
    for i, of in zip(ids.tolist(), p, strict=True):
        if (k := int(of.argmax())) and of[k] >= MIN_PROBABILITY:
            start, end, line, _ = runs[at[i]].tolist()
            if (share := held(data, start, end, FAMILIES[k - 1])[0]) >= MIN_CONTAINED:
                out.append((-share, end - start, -float(of[k]), start, line, FAMILIES[k - 1]))
    return out


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: paragraphs, predicted and confirmed licence paragraphs, families."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in tv.text_slices(b.column("text")):
                n = hi - lo
                ls, le, lrow, para, bucket, size = line_features(data, offs)
                predicted, confirmed = np.zeros(n, np.int64), np.zeros(n, np.int64)
                best, families = np.zeros(n), [set() for _ in range(n)]
                ids, p = shared.value.probabilities(para, bucket, size)
                top = p.argmax(axis=1) if len(ids) else ids
                found = []
                for i in np.flatnonzero((top > 0) & (p.max(axis=1, initial=0) >= MIN_PROBABILITY)) if len(ids) else ():
                    k, r = int(ids[i]), int(lrow[ids[i]])
                    family = FAMILIES[top[i] - 1]
                    predicted[r] += 1
                    share, start, end = held(data, int(ls[k]), int(le[k]), family)
                    if share >= MIN_CONTAINED:
                        found.append((-share, end - start, -float(p[i, top[i]]), start, k, family, True))
                found += [(*f, False) for f in wrapped(shared.value, data, offs, ls)]
                taken = np.zeros(len(data), bool)
                for _, length, neg, start, k, family, alone in sorted(found):
                    if not taken[start : start + length].any():
                        taken[start : start + length] = True
                        r = int(lrow[k])
                        predicted[r] += not alone
                        confirmed[r] += 1
                        families[r].add(family)
                        best[r] = max(best[r], -neg)
                cols = [b.column("doc_id").slice(lo, n), pa.array(np.bincount(lrow, minlength=n)), pa.array(predicted), pa.array(confirmed), pa.array([",".join(sorted(f)) for f in families], pa.string()), pa.array(np.round(best, 6))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_paragraphs", "n_predicted", "n_confirmed", "families", "probability"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
