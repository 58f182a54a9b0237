"""Licence notices by a trained paragraph classifier.

A paragraph is a line; one of more than ``WINDOW`` words is read in windows of so many,
each half a window on, so that a notice inside a long text without line breaks is seen by
itself. Its features are hashed word 1- to 3-grams. One sparse logistic
regression per licence family (FTRL with L1, as in ``toxicity``) learns from variants of
the family's templates, made by rule, against the other families and lines of the
corpus. Scores are calibrated on a fifth of the examples that the fit did not see
(Platt), and the unknown class takes the probability that no family claims. Every family
whose own probability reaches ``CLAIM`` is compared with its templates, so a line may hold
several notices. It is confirmed if five-word shingles agree with one of them:
``SIMILARITY`` of the template's are in the paragraph, or of the paragraph's in the
template, for notices broken into lines. Of families whose templates are much alike, as
those of one publisher, the closest is confirmed alone.

The fit is bounded: ``VARIANTS`` per template and at most ``NEGATIVES`` lines of
``NEGATIVE_DOCS`` documents, chosen by hash of the key, of ``NEGATIVE_WORDS`` words at
most. Every line of every text is scored, whole.

Null and empty texts have no paragraph and no family. Repeated rows are scored one by
one. Without documents the fit has the templates alone. Further columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spoorlens.llm.common import text_of
from spoorlens.llm.hashing import WordIds, buckets, combine, tokens
from spoorlens.llm.toxicity import Ftrl

BITS = 18
VARIANTS = 40
NEGATIVES = 3_000
NEGATIVE_DOCS = 500
NEGATIVE_WORDS = 300
PASSES = 3
SHINGLE = 5
SIMILARITY = 0.8
WINDOW = 120  # twice the words of the longest template, and more
CLAIM = 0.05
RIVAL = 0.5

# Notices as their licences word them.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "bsd-3-clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "lgpl-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ],
}
FAMILIES = list(TEMPLATES)
# Lines with words of notices that are none.
PLAIN = [
    "The driver had to show a license at the border.", "This version of the story is free of charge.",
    "The general public was under the impression that the work is done.", "Copyright law is taught in the second year.",
    "Permission to enter was granted to any person with a ticket.", "Version 3 of the plan was released under pressure.",
    "A copy of the document is kept at the foundation.", "The terms of the contract were modified in writing.",
]


@dataclass(frozen=True)
class Model:
    """Places of weights that are not zero, a row of weights per place, intercepts, and
    slope and shift of the calibration per family."""

    places: np.ndarray
    values: np.ndarray
    intercepts: np.ndarray
    slopes: np.ndarray
    shifts: np.ndarray


def line_features(lines: list[list[bytes]], ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the lines, and the line it is in."""
    count = sum(map(len, lines))
    numbers = np.fromiter((ids[w] for line in lines for w in line), np.uint64, count)
    owner = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
    found, owners = [], []
    for n in range(1, 4):
        if count < n:
            break
        inside = owner[n - 1:] == owner[:count - n + 1]
        made = combine([numbers[i:count - n + 1 + i] for i in range(n)], n)
        found.append(made[inside])
        owners.append(owner[:count - n + 1][inside])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return buckets(np.concatenate(found), BITS), np.concatenate(owners)


def _variants(rng: random.Random, filler: list[str]) -> list[tuple[str, int]]:
    """Templates with words left out, doubled or of other case, and words around them."""
    out = []
    for label, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            out.append((template, label))
            for _ in range(VARIANTS):
                words = [w.upper() if rng.random() < 0.1 else w for w in template.split() if rng.random() > 0.08]
                around = [" ".join(rng.choice(filler) for _ in range(rng.choice([0, 0, 0, 2, 5]))) for _ in range(2)]
                out.append((f"{around[0]} {' '.join(words)} {around[1]}", label))
    return out


def negative_lines(docs: DataFrame) -> list[str]:
    """Bounded sample of lines: of the documents with the lowest hash of their key."""
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(NEGATIVE_DOCS)
    lines = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", F.posexplode(F.split(text_of(), "\n")).alias("at", "line"))
    short = lines.filter((F.size(F.split("line", " ")) <= NEGATIVE_WORDS) & (F.length(F.trim("line")) > 0))
    return [r["line"] for r in short.orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at", "line").limit(NEGATIVES).collect()]


def fit(negatives: list[str], seed: int = 11, ftrl: Ftrl = Ftrl(alpha=1.0, l1=0.5)) -> Model:
    """Fit on template variants and the given lines, of which those that agree with a
    template are left out."""
    rng = random.Random(seed)
    clean = [x for x in [*PLAIN, *negatives] if not any(_alike(tokens(x), family) >= SIMILARITY for family in FAMILIES)]
    filler = sorted({w for x in clean[:500] for w in x.split()}) or ["and"]
    examples = _variants(rng, filler) + [(x, -1) for x in clean] + [(x, -1) for x in PLAIN] * 5
    rng.shuffle(examples)
    ids = WordIds()
    size = (1 << BITS) + 1
    features = [np.append(np.unique(line_features([tokens(x)], ids)[0]), size - 1) for x, _ in examples]
    labels = np.array([y for _, y in examples])
    held = np.arange(len(examples)) % 5 == 0
    weights, intercepts, slopes, shifts = [], [], [], []
    for family in range(len(FAMILIES)):
        z, n = np.zeros(size), np.zeros(size)
        for _ in range(PASSES):
            for i in np.flatnonzero(~held).tolist():
                ftrl.learn(z, n, features[i], float(labels[i] == family))
        w = ftrl.weights(z, n)
        w[-1] = -z[-1] / ((ftrl.beta + np.sqrt(n[-1])) / ftrl.alpha + ftrl.l2)
        scores = np.array([w[features[i]].sum() for i in np.flatnonzero(held)])
        slope, shift = platt(scores, labels[held] == family)
        weights.append(w[:-1])
        intercepts.append(w[-1])
        slopes.append(slope)
        shifts.append(shift)
    table = np.stack(weights, axis=1)
    places = np.flatnonzero(np.abs(table).sum(axis=1))
    return Model(places, table[places].astype(np.float32), np.array(intercepts), np.array(slopes), np.array(shifts))


def platt(scores: np.ndarray, hits: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve of hits over scores, by Newton's method, with
    Platt's smoothed targets."""
    good, bad = hits.sum(), (~hits).sum()
    target = np.where(hits, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack((scores, np.ones(len(scores))), axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (beta - [1.0, 0.0]))
        beta = beta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(SHINGLE, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


_TEMPLATE_SHINGLES = {family: [_shingles(tokens(t)) for t in texts] for family, texts in TEMPLATES.items()}


def _alike(words: list[bytes], family: str) -> float:
    """Share of a template's shingles in the paragraph, or of the paragraph's in it."""
    own = _shingles(words)
    best = 0.0
    for template in _TEMPLATE_SHINGLES[family]:
        shared = len(own & template)
        if shared:
            best = max(best, shared / len(template), shared / len(own) if len(words) >= SHINGLE else 0.0)
    return best


def _rivals() -> dict[str, set[str]]:
    """Families with templates of which more than ``RIVAL`` of the shingles agree."""
    return {
        a: {
            b for b in FAMILIES if a != b and any(
                len(x & y) > RIVAL * min(len(x), len(y)) for x in _TEMPLATE_SHINGLES[a] for y in _TEMPLATE_SHINGLES[b]
            )
        } for a in FAMILIES
    }


RIVALS = _rivals()


def confirmed(words: list[bytes], claims: list[str]) -> dict[str, float]:
    """The families among ``claims`` that a paragraph is confirmed for, with its similarity."""
    found = {family: _alike(words, family) for family in claims}
    found = {family: alike for family, alike in found.items() if alike >= SIMILARITY}
    return {
        family: alike for family, alike in found.items()
        if alike >= max((_alike(words, other) for other in RIVALS[family]), default=0.0)
    }


def paragraphs(text: str) -> tuple[list[list[bytes]], list[int]]:
    """Words of each line, long ones in windows, and the line of each."""
    parts, lines = [], []
    for at, line in enumerate(text.split("\n")):
        words = tokens(line)
        starts = range(0, max(len(words) - WINDOW // 2, 1), WINDOW // 2)
        parts += [words[a:a + WINDOW] for a in starts]
        lines += [at] * len(starts)
    return parts, lines


def own_probabilities(scores: np.ndarray, m: Model) -> np.ndarray:
    """Calibrated probability of each family by itself."""
    return 1 / (1 + np.exp(-np.clip(scores * m.slopes + m.shifts, -35, 35)))


def probabilities(scores: np.ndarray, m: Model) -> np.ndarray:
    """Rows of family probabilities and, last, that of no family."""
    odds = np.exp(np.clip(scores * m.slopes + m.shifts, -35, 35))
    total = 1 + odds.sum(axis=1, keepdims=True)
    return np.concatenate((odds / total, 1 / total), axis=1)


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, number of paragraphs, the confirmed families, and the
    best paragraph with its family, probability and template similarity. Family is null
    where no paragraph is confirmed."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_of(text).alias("text"))
    schema = "key long, n_paragraphs int, families array<string>, family string, paragraph int, probability double, similarity double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        row_of = np.full(1 << BITS, -1, np.int32)
        row_of[m.places] = np.arange(len(m.places))
        ids = WordIds()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for text in batch.column("text").to_pylist():
                lines, line_of = paragraphs(text)
                found, owner = line_features(lines, ids)
                rows_ = row_of[found]
                hit = rows_ >= 0
                best = (None, None, None, None)
                families = set()
                if hit.any():
                    # Each n-gram counts once per line.
                    pairs = np.unique(owner[hit] * len(m.places) + rows_[hit])
                    places, which = np.unique(pairs // len(m.places), return_inverse=True)
                    scores = np.tile(m.intercepts, (len(places), 1))
                    np.add.at(scores, which, m.values[pairs % len(m.places)])
                    chance = own_probabilities(scores, m)
                    for i in np.flatnonzero((chance >= CLAIM).any(axis=1)).tolist():
                        claims = [FAMILIES[f] for f in np.flatnonzero(chance[i] >= CLAIM).tolist()]
                        for family, alike in confirmed(lines[places[i]], claims).items():
                            families.add(family)
                            now = (family, line_of[places[i]], float(chance[i, FAMILIES.index(family)]), alike)
                            if best[0] is None or now[2] > best[2]:
                                best = now
                filled = len({line for line, words in zip(line_of, lines) if words})
                row = (filled, sorted(families), *best)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int32(), pa.list_(pa.string()), pa.string(), pa.int32(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array(c, t) for c, t in zip(out, kinds)]],
                ["key", "n_paragraphs", "families", "family", "paragraph", "probability", "similarity"],
            )

    return rows.mapInArrow(work, schema).withColumnRenamed("key", key)
