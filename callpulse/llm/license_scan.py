"""Licence scans: a trained classifier of paragraphs, confirmed by templates.

Every line of a text is a paragraph. Logistic regression over its hashed word
1- to 3-grams, a sparse vector, gives each licence family and "none of them" a
probability. It is trained on variants of the templates (cut, framed by other words,
with words lost) and on paragraphs of a bounded sample of the corpus that no
template confirms; held-out ones calibrate the probability of being a licence at
all.

A paragraph is read in sliding windows. Neighbouring windows in which a family is likely
are one run, and a run counts if a template of the family confirms one of its windows,
by that window's own word pairs. A paragraph may have several licences: of runs that rest
on the same words, as those of kindred licences do, the likeliest stays, and ties go to
the better match.

Null and empty texts have no paragraphs. Every input row gives one row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.common import Words, bytes_where, gram_hashes, map_arrow, text_blocks
from callpulse.llm.learning import Platt, sample_of

#: Documents whose paragraphs are trained on, and pieces of such paragraphs, at most (about).
SAMPLE_DOCUMENTS, SAMPLE_PARAGRAPHS = 2_000, 3_000
#: Characters of the pieces in which they are drawn, each as likely as any other.
PIECE = 2_000
VARIANTS = 60
ENTRIES_BITS = 15
SIZES = (1, 2, 3)
LIKELY = 0.5
#: Words of a window and from one window's start to the next.
WINDOW, STEP = 32, 16
#: Share of a template's word pairs, or of the paragraph's, that confirms; a template of
#: fewer pairs than ``SHORT`` must be there whole, as its rest is common speech.
CONFIRMED_TEMPLATE, CONFIRMED_PARAGRAPH, SHORT = 0.6, 0.85, 4

# How texts state the licence they are under.
TEMPLATES = {
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain worldwide.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ],
}

# Sentences that sound alike and state no licence.
OTHERS = """The driver renewed a license at the office of the town.
Permission to enter the building was granted by the owner.
Version 2.0 of the program was released to the public in May.
All rights of the members are listed in the general terms of the foundation.
The licence of the restaurant is under review by the public authority.
Copies of this work are sold under the name of the author.
The software comes with a manual and a general warranty of two years.
This file is free of errors and was published by the university.
The conditions of the contract were met with some modification.
Attribution of the painting to a school of the time is open.""".splitlines()

NONE = "none"
LICENSES = "array<struct<family:string,paragraph:int,start:int,end:int,score:double,match:double>>"

_WORD = bytes_where(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def paragraph_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines of a block's texts start, with the end; and each line's text."""
    starts = np.union1d(offsets[:-1], np.flatnonzero(data == 10) + 1)
    starts = starts[starts < len(data)] if len(data) else starts[:0]
    owner = np.searchsorted(offsets, starts, "right") - 1
    return np.append(starts, len(data)), owner


def _entry(grams: np.ndarray, size: int) -> np.ndarray:
    return ((grams + np.uint64(size)) >> np.uint64(64 - ENTRIES_BITS)).astype(np.int64)


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Table entries of all n-grams and the paragraph of each, by paragraph."""
    entries, owners = [], []
    for size in SIZES:
        grams, whole = words.grams(size)
        entries.append(_entry(grams[whole], size))
        owners.append(words.text[: len(grams)][whole])
    entries, owners = np.concatenate(entries), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return entries[order], owners[order]


def _paragraphs_of(texts: list[str]) -> Words:
    raw = [t.replace("\n", " ").encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    return Words(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64), _WORD)


class Templates:
    """The word pairs of each family's templates."""

    def __init__(self):
        self.pairs = {
            family: [np.unique(_paragraphs_of([t]).grams(2)[0]) for t in texts]
            for family, texts in TEMPLATES.items()
        }

    def found(self, family: str, pairs: np.ndarray) -> tuple[float, np.ndarray]:
        """How well a template confirms a window: 1 is all that is needed, below 1 is not
        confirmed. And which of the window's pairs it shares; of equal ones, the closest
        together."""
        best = (0.0, 0, np.empty(0, np.int64))
        size = len(np.unique(pairs))
        for template in self.pairs[family]:
            at = np.flatnonzero(np.isin(pairs, template))
            common = len(np.unique(pairs[at]))
            needed = CONFIRMED_TEMPLATE if len(template) >= SHORT else 1
            match = common / len(template) / needed
            if common >= 4:
                match = max(match, common / max(size, 1) / CONFIRMED_PARAGRAPH)
            if len(at):
                best = max(best, (match, int(at[0] - at[-1]), at), key=lambda b: b[:2])
        return best[0], best[2]

    def match(self, family: str, pairs: np.ndarray) -> float:
        return self.found(family, pairs)[0]

    def confirms_any(self, pairs: np.ndarray) -> bool:
        return any(self.match(family, pairs) >= 1 for family in self.pairs)


class SparseRegression:
    """Softmax regression on sparse rows of ones over the root of their number;
    trained with Adagrad."""

    def __init__(self, classes: int):
        self.w = np.zeros((1 << ENTRIES_BITS, classes), np.float32)
        self.b = np.zeros(classes, np.float32)

    def decide(self, entries: np.ndarray, owners: np.ndarray, count: int) -> np.ndarray:
        out = np.tile(self.b, (count, 1))
        if len(entries):
            rows, begin, sizes = np.unique(owners, return_index=True, return_counts=True)
            out[rows] += np.add.reduceat(self.w[entries], begin, 0) / np.sqrt(sizes)[:, None].astype(np.float32)
        return out

    def fit(self, entries, owners, y, epochs=12, batch=32, rate=0.5):
        begin = np.searchsorted(owners, np.arange(len(y) + 1))
        seen_w, seen_b = np.full_like(self.w, 1e-6), np.full_like(self.b, 1e-6)
        r = np.random.default_rng(6)
        for _ in range(epochs):
            for rows in np.array_split(r.permutation(len(y)), max(1, len(y) // batch)):
                parts = [entries[begin[k] : begin[k + 1]] for k in rows]
                own = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
                flat = np.concatenate(parts)
                share = probabilities(self.decide(flat, own, len(rows)))
                share[np.arange(len(rows)), y[rows]] -= 1
                share /= len(rows)
                sizes = np.maximum(np.bincount(own, minlength=len(rows)), 1)
                touched, place = np.unique(flat, return_inverse=True)
                g = np.zeros((len(touched), share.shape[1]), np.float32)
                np.add.at(g, place, (share / np.sqrt(sizes)[:, None]).astype(np.float32)[own])
                seen_w[touched] += g * g
                self.w[touched] -= rate * g / np.sqrt(seen_w[touched]) * 0.2
                gb = share.sum(0)
                seen_b += gb * gb
                self.b -= (rate * 0.2 * gb / np.sqrt(seen_b)).astype(np.float32)
        return self


def probabilities(decided: np.ndarray) -> np.ndarray:
    e = np.exp(decided - decided.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class LicenseModel:
    families: list[str]  # the first is "none of them"
    regression: SparseRegression
    calibrate: Platt
    templates: Templates


@dataclass
class Windows:
    """The windows of a block's paragraphs, in order: whose they are, their words, and the
    log odds of each family against none."""

    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    odds: np.ndarray


def _windows(words: Words, regression: SparseRegression) -> Windows:
    value = np.zeros((len(words.hash) + 1, regression.w.shape[1]), np.float32)
    for size in SIZES:
        grams, whole = words.grams(size)
        at = np.flatnonzero(whole)
        value[at] += regression.w[_entry(grams[at], size)]
    sums = np.zeros((len(value) + 1, value.shape[1]))
    np.cumsum(value, axis=0, out=sums[1:])
    sizes = np.diff(words.first)
    room = np.maximum(sizes - WINDOW, 0)  # from the first window's start to the last one's
    number = (-(-room // STEP) + 1) * (sizes > 0)
    owner = np.repeat(np.arange(len(sizes)), number)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    start = words.first[owner] + np.minimum(nth * STEP, room[owner])
    end = np.minimum(start + WINDOW, words.first[owner + 1])
    decided = (sums[end] - sums[start]) / np.sqrt(np.maximum(3 * (end - start) - 3, 1))[:, None]
    decided += regression.b
    return Windows(owner, start, end, decided[:, 1:] - decided[:, :1])


def _best_odds(words: Words, regression: SparseRegression) -> np.ndarray:
    """Per paragraph the log odds of a licence in its best window."""
    windows = _windows(words, regression)
    best = np.full(len(words.first) - 1, -np.inf)
    np.maximum.at(best, windows.owner, windows.odds.max(1))
    return best


@dataclass
class Run:
    """Windows ``first`` to ``last`` of a paragraph in which a family is likely. ``on`` are
    the places of the words that its template shares with the window it confirms."""

    owner: int
    family: int
    first: int
    last: int
    score: float
    match: float
    on: np.ndarray


def _runs(words: Words, windows: Windows, model: LicenseModel) -> list[Run]:
    """The confirmed runs, by paragraph and place, with none that rests on the words of
    a likelier one."""
    score = model.calibrate(windows.odds.ravel()).reshape(windows.odds.shape)
    found: dict[int, list[tuple[tuple[float, float], Run]]] = {}
    for family in range(score.shape[1]):
        likely = np.flatnonzero(score[:, family] >= LIKELY)
        apart = (np.diff(likely) > 1) | (np.diff(windows.owner[likely]) > 0)
        for run in np.split(likely, np.flatnonzero(apart) + 1):
            best = None
            for k in run:
                pairs = _pairs(words.hash[windows.start[k] : windows.end[k]])
                match, on = model.templates.found(model.families[family + 1], pairs)
                if match >= 1 and (best is None or match > best.match):
                    on = np.unique([windows.start[k] + on, windows.start[k] + on + 1])
                    best = Run(windows.owner[k], family + 1, run[0], run[-1], score[k, family], match, on)
            if best:
                rank = (windows.odds[run, family].max(), best.match)
                found.setdefault(best.owner, []).append((rank, best))
    kept = []
    for _, runs in sorted(found.items()):
        own: list[Run] = []
        for _, run in sorted(runs, key=lambda r: r[0], reverse=True):
            if all(2 * len(np.intersect1d(run.on, o.on)) < min(len(run.on), len(o.on)) for o in own):
                own.append(run)
        kept += sorted(own, key=lambda r: r.on[0])
    return kept


def _variants(fillers: list[str]) -> tuple[list[str], list[int]]:
    """Templates cut, framed and with words lost; the class of each."""
    r = np.random.default_rng(8)
    texts, classes = [], []
    filler = [w for f in fillers for w in f.split()][:20_000] or ["and"]
    for number, (_, templates) in enumerate(sorted(TEMPLATES.items()), 1):
        for template in templates:
            words = template.split()
            for k in range(VARIANTS):
                own = words
                if k and len(words) > 12 and r.random() < 0.5:
                    size = int(len(words) * r.uniform(0.6, 1))
                    at = r.integers(0, len(words) - size + 1)
                    own = words[at : at + size]
                if k and r.random() < 0.3:
                    own = [w for w in own if r.random() > 0.08]
                if k and r.random() < 0.4:
                    n, m = r.integers(0, 25, 2)
                    own = [*r.choice(filler, n), *own, *r.choice(filler, m)]
                texts.append(" ".join(own))
                classes.append(number)
    return texts, classes


def fit(
    documents: DataFrame, limit: int = SAMPLE_DOCUMENTS, pieces: int = SAMPLE_PARAGRAPHS
) -> LicenseModel:
    """Trains on variants of the templates and on ``pieces`` of the paragraphs of about
    ``limit`` texts, drawn from all their pieces."""
    templates = Templates()
    drawn = sample_of(documents.where("doc_id is not null").select("doc_id", "text"), "doc_id", limit)
    paragraph = F.explode(F.split("text", "\n")).alias("paragraph")
    rows = (
        drawn.select(paragraph)
        .select("paragraph", F.explode(F.expr(f"sequence(1, greatest(length(paragraph), 1), {PIECE})")).alias("at"))
        .select(F.expr(f"substring(paragraph, at, {PIECE})").alias("paragraph"))
        .where("trim(paragraph) <> ''")
        .distinct()
        .orderBy(F.xxhash64("paragraph"))
        .limit(pieces)
        .collect()
    )
    corpus = [r[0] for r in rows] + OTHERS * 20
    words = _paragraphs_of(corpus)
    pairs, whole = words.grams(2)
    owner = words.text[: len(pairs)][whole]
    bounds = np.searchsorted(owner, np.arange(len(corpus) + 1))
    pairs = pairs[whole]
    known = [templates.confirms_any(pairs[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    plain = [t for t, k in zip(corpus, known, strict=True) if not k]
    texts, classes = _variants(plain)
    y = np.array(classes + [0] * len(plain))
    texts = texts + plain
    order = np.random.default_rng(9).permutation(len(y))
    cut = len(y) * 3 // 4
    families = [NONE, *sorted(TEMPLATES)]

    def part(chosen):
        entries, owners = _grams(_paragraphs_of([texts[k] for k in chosen]))
        return entries, owners, y[chosen]

    regression = SparseRegression(len(families)).fit(*part(order[:cut]))
    held = order[cut:]
    odds = _best_odds(_paragraphs_of([texts[k] for k in held]), regression)
    read = np.isfinite(odds)
    calibrate = Platt().fit(odds[read], (y[held][read] > 0).astype(float))
    return LicenseModel(families, regression, calibrate, templates)


def scan(documents: DataFrame, model: LicenseModel) -> DataFrame:
    """The documents, all their columns, with ``paragraphs`` (their number) and
    ``licenses``: family, paragraph (from 0), start and end in code points, score and
    match of every confirmed run of windows. A run ends where the next word begins, or
    with its line. Input columns of these names are replaced."""
    documents = documents.drop("paragraphs", "licenses")
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.select(
        "*", F.lit(0).cast("long").alias("paragraphs"), F.array().cast(LICENSES).alias("licenses")
    ).schema
    kind = pa.list_(
        pa.struct(
            [
                ("family", pa.string()), ("paragraph", pa.int32()), ("start", pa.int32()),
                ("end", pa.int32()), ("score", pa.float64()), ("match", pa.float64()),
            ]
        )
    )

    def run(batches):
        own = sent.value
        for rows, data, offsets in text_blocks(batches, "text"):
            starts, owner = paragraph_starts(data, offsets)
            found = [[] for _ in range(rows.num_rows)]
            if len(owner):
                words = Words(data, starts, _WORD)
                windows = _windows(words, own.regression)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                first = np.searchsorted(owner, owner)
                for run in _runs(words, windows, own) if len(windows.owner) else ():
                    k = run.owner
                    line_end = starts[k + 1] - (starts[k + 1] > starts[k] and data[starts[k + 1] - 1] == 10)
                    begin, end = windows.start[run.first], windows.end[run.last]
                    begin = starts[k] if begin == words.first[k] else words.start[begin]
                    end = line_end if end == words.first[k + 1] else words.start[end]
                    base = points[offsets[owner[k]]]
                    found[owner[k]].append(
                        {
                            "family": own.families[run.family], "paragraph": int(k - first[k]),
                            "start": int(points[begin] - base), "end": int(points[end] - base),
                            "score": float(run.score), "match": float(min(run.match, 1.0)),
                        }
                    )
            number = np.bincount(owner, minlength=rows.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(number, pa.int64()), pa.array(found, kind)],
                names=[*rows.schema.names, "paragraphs", "licenses"],
            )

    return map_arrow(documents, run, schema)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return gram_hashes(hashes, 2)
