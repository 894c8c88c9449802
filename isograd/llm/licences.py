"""Licence scans with a trained paragraph classifier.

A multinomial logistic regression over sparse word n-grams tells licence
families and an unknown class apart.  It is trained from notices of each
family with rule-made variations, and from paragraphs of the documents as
unknown text, at most ``background`` of them.  A temperature fitted on notices
held out from training calibrates its probabilities.  A prediction counts only
if a template of the predicted family confirms it: enough of the template's
word pairs occur in the paragraph, at least two of them, and one of these is
in no other family's templates.  Other licences that are confirmed in the same
paragraph are listed too.  Paragraphs that
reserve all rights or forbid copying are notices too; as they grant no licence,
they are listed as ``restrictions``, not among ``families``.  A line that only
names an owner and a year is none.

A paragraph is a line of a text, or a run of up to ``WRAP`` lines without a
blank one between them, for notices broken into lines: shorter runs go first,
then earlier ones, and a line that a judged run holds is in no other.  The
templates are compared first, by hashes of word pairs with numpy on megabytes
at a time, and the classifier judges what one of them confirms.
``n_paragraphs`` counts lines with a word.
Judging is one pass without a shuffle; the model's size depends on its
templates and on ``background`` alone.

Null and empty texts have no paragraphs.  Very long texts and paragraphs are
scanned whole.  Equal rows get equal results; other columns pass through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.llm.decontaminate import _TABLE
from isograd.llm.text import Spans, annotate, ngrams, words

NGRAMS = (1, 2, 3)
BACKGROUND = 600
EXCERPT = 400
CONFIRM = 0.5
WRAP = 4
UNKNOWN = "unknown"

# Common notices of licence families.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "This project is released under the Apache 2.0 license",
        "Distributed under the terms of the Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License",
        "This software is licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Distributed under the MIT license, see the file LICENSE",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Licensed under the GNU GPL version 2 or later",
        "Released under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "This library is free software under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the simplified BSD license",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Available under CC BY-NC-SA 4.0 for noncommercial use",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Text is available under the Creative Commons Attribution-ShareAlike License CC BY-SA 4.0",
    ],
    "CC0": [
        "Dedicated to the public domain under CC0 1.0 Universal",
        "The author has waived all copyright and related rights under the CC0 public domain dedication",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Licensed under the ISC License",
        "SPDX-License-Identifier: ISC",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain",
        "SPDX-License-Identifier: Unlicense",
    ],
    "Proprietary": [
        "All rights reserved",
        "Copyright (c) 2020 the company. All rights reserved",
        "Proprietary and confidential",
        "This document is proprietary and confidential and may not be disclosed",
        "Unauthorized copying of this file, via any medium, is strictly prohibited",
        "No part of this publication may be reproduced or distributed in any form without prior written permission",
    ],
}
#: Families that grant nothing; they are listed apart from the licences, and a licence in the same paragraph goes first.
RESTRICTIONS = {"Proprietary"}
#: Text that shares words with notices but is none.
NEAR_MISSES = [
    "The driver lost the license after the second offence", "Students at MIT released the results of the public survey",
    "The Apache helicopter is under repair", "General conditions of public transport are under review", "He is a licensed plumber in the city",
    "The version 2.0 of the plan was released", "This work is under way in the public library", "The terms of the peace were published by the foundation",
    "CC the manager by email", "A copy of the file is free of charge", "The license plate was stolen", "Software and documentation files are stored in the archive",
    "Copyright 2020 the authors", "The rights of all citizens were restored", "All rights of way lead to the river", "All seats were reserved",
    "The report on the talks is confidential", "No part of the town was without water", "A proprietary blend of herbs and spices",
]
_BEFORE = ("", "This file is ", "Copyright 2020 the authors. ", "Note: ")
_AFTER = ("", ". All rights reserved.", ". See the file for details.")

FIELDS = T.StructType(
    [
        T.StructField("n_paragraphs", T.LongType()),
        T.StructField("n_notices", T.LongType()),
        T.StructField("families", T.ArrayType(T.StringType())),
        T.StructField("restrictions", T.ArrayType(T.StringType())),
        T.StructField(
            "notices",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                        T.StructField("family", T.StringType()),
                        T.StructField("probability", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)

_FOLDED = np.frombuffer(_TABLE, dtype=np.uint8)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[32] = True


def paragraph_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Start of every paragraph with a word, its document, and for each length n-gram hashes with their paragraph."""
    folded = _FOLDED[data]
    starts, ends, _ = words(folded, offsets, _BLANK)
    begins = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
    line = np.searchsorted(begins, starts, side="right") - 1
    used, paragraph = np.unique(line, return_inverse=True)
    hashes = Spans(folded).hash(starts, ends)
    found = []
    for n in NGRAMS:
        value, at = ngrams(hashes, paragraph, n)
        found.append((value + np.uint64(n), paragraph[at]))
    begin = begins[used]
    return begin, np.searchsorted(offsets, begin, side="right") - 1, found


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts of one line each, as bytes and offsets."""
    held = [t.replace("\n", " ").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in held])]).astype(np.int64)
    return np.frombuffer(b"".join(held), dtype=np.uint8), offsets


def _grams_of(texts: list[str]) -> list[np.ndarray]:
    """Distinct n-grams of each text, read as one paragraph."""
    _, doc, found = paragraph_grams(*_joined(texts))
    value, at = np.concatenate([v for v, _ in found]), np.concatenate([doc[p] for _, p in found])
    return [np.unique(value[at == i]) for i in range(len(texts))]


def variations(notice: str) -> list[str]:
    """A notice in usual surroundings, and without each of its words."""
    held = notice.split()
    framed = [f"{a}{notice}{b}" for a in _BEFORE for b in _AFTER]
    return framed + [" ".join(held[:i] + held[i + 1 :]) for i in range(len(held)) if len(held) > 4]


class Classifier:
    """Weights of n-grams for every family, in ascending order of their hash, and the templates."""

    def __init__(self, background: list[str], steps: int = 120, rate: float = 0.5, decay: float = 1e-4):
        self.families = [*TEMPLATES, UNKNOWN]
        train, check = [], []
        for label, notices in enumerate(TEMPLATES.values()):
            for notice in notices:
                for i, text in enumerate(variations(notice)):
                    (check if i % 5 == 4 else train).append((text, label))
        unknown = NEAR_MISSES + background
        for i, text in enumerate(unknown):
            (check if i % 5 == 4 else train).append((text, len(self.families) - 1))
        grams = _grams_of([t for t, _ in train])
        seen, times = np.unique(np.concatenate(grams), return_counts=True)
        self.keys = seen[times > 1]  # n-grams of one text only tell nothing about others
        x, y = self._matrix(grams), np.array([label for _, label in train])
        # Every family counts as much as the unknown text does.
        share = 1 / np.bincount(y, minlength=len(self.families))[y]
        share /= share.sum()
        self.weights = np.zeros((len(self.keys) + 1, len(self.families)))
        scale = np.full_like(self.weights, 1e-8)
        want = np.eye(len(self.families))[y]
        for _ in range(steps):  # gradient descent with a rate of its own for each weight
            slope = x.T @ ((self._softmax(x @ self.weights) - want) * share[:, None]) + decay * self.weights
            scale += slope**2
            self.weights -= rate * slope / np.sqrt(scale)
        self.temperature = self._calibrated(check)
        self._compare_with([(label, notice) for label, notices in enumerate(TEMPLATES.values()) for notice in notices])

    def _compare_with(self, notices: list[tuple[int, str]]) -> None:
        """Word pairs of all templates, ascending, with the templates that hold each and whether it tells a family."""
        held = [(label, np.unique(paragraph_grams(*_joined([notice]))[2][1][0])) for label, notice in notices]
        self.label_of = np.array([label for label, _ in held])
        self.size_of = np.array([len(pairs) for _, pairs in held])
        pair, template = np.concatenate([pairs for _, pairs in held]), np.repeat(np.arange(len(held)), self.size_of)
        order = np.argsort(pair, kind="stable")
        self.pairs, first = np.unique(pair[order], return_index=True)
        self.templates, self.first = template[order], np.append(first, len(pair))
        families = np.unique(np.stack([np.searchsorted(self.pairs, pair), self.label_of[template]], axis=1), axis=0)[:, 0]
        self.telling = np.bincount(families, minlength=len(self.pairs)) == 1
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(self.pairs & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def _matrix(self, grams: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(grams), len(self.keys) + 1), dtype=np.float32)
        x[:, -1] = 1
        for row, found in zip(x, grams, strict=True):
            row[np.flatnonzero(np.isin(self.keys, found))] = 1
        return x

    def _calibrated(self, check: list[tuple[str, int]]) -> float:
        """The temperature under which held-out text is most likely."""
        z = self._matrix(_grams_of([t for t, _ in check])) @ self.weights
        y = np.array([label for _, label in check])
        tried = np.geomspace(0.05, 8, 61)
        loss = [-np.log(self._softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in tried]
        return float(tried[int(np.argmin(loss))])

    def chances(self, texts: list[bytes]) -> np.ndarray:
        """Probability of every family for texts that are one paragraph each."""
        _, paragraph, found = paragraph_grams(*_joined([t.decode("utf-8", "replace") for t in texts]))
        key, of = np.concatenate([v for v, _ in found]), np.concatenate([paragraph[p] for _, p in found])
        place = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        right = self.keys[place] == key
        seen = np.unique(np.stack([of[right], place[right]], axis=1), axis=0)  # an n-gram counts once
        z = [np.bincount(seen[:, 0], weights=self.weights[seen[:, 1], c], minlength=len(texts)) for c in range(len(self.families))]
        return self._softmax((np.stack(z, axis=1) + self.weights[-1]) / self.temperature)

    def scan(self, data: np.ndarray, offsets: np.ndarray, confirm: float = CONFIRM, wrap: int = WRAP) -> dict[str, list]:
        docs = len(offsets) - 1
        folded = _FOLDED[data]
        starts, ends, _ = words(folded, offsets, _BLANK)
        begins = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
        used, line = np.unique(np.searchsorted(begins, starts, side="right") - 1, return_inverse=True)
        doc = np.searchsorted(offsets, begins[used], side="right") - 1
        stops = np.append(begins[1:], len(data))[used]
        stops -= (stops > begins[used]) & (data[stops - 1] == 10) if len(used) else 0
        new = np.append(True, (np.diff(used) > 1) | (np.diff(doc) > 0))[: len(used)]
        block = np.cumsum(new) - 1
        out = {"n_paragraphs": np.bincount(doc, minlength=docs), "notices": [[] for _ in range(docs)]}
        value, at = ngrams(Spans(folded).hash(starts, ends), block[line], 2)
        value += np.uint64(2)
        hit = np.flatnonzero(self.sieve[(value & np.uint64((1 << 20) - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.pairs, value[hit]), len(self.pairs) - 1)
        right = self.pairs[place] == value[hit]
        pair, first, last = place[right], line[at[hit[right]]], line[at[hit[right]] + 1]
        closed = np.zeros(len(used), dtype=bool)
        for size in range(1, wrap + 1):
            windows, families = self._confirmed(pair, first, last, block, closed, size, confirm)
            if not len(windows):
                continue
            held = [data[begins[used[w]] : stops[w + size - 1]].tobytes() for w in windows.tolist()]
            for w, confirmed, chance in zip(windows.tolist(), families, self.chances(held), strict=True):
                if closed[w : w + size].any():
                    continue
                closed[w : w + size] = True
                label = int(chance.argmax())
                if label not in confirmed:
                    continue
                also = [f for f in sorted(confirmed) if f != label and self.families[f] not in RESTRICTIONS]
                d = int(doc[w])
                for f in [label] + (also if self.families[label] not in RESTRICTIONS else []):
                    span = {"start": int(begins[used[w]] - offsets[d]), "end": int(stops[w + size - 1] - offsets[d])}
                    out["notices"][d].append({**span, "family": self.families[f], "probability": float(chance[f])})
        for notices in out["notices"]:
            notices.sort(key=lambda n: n["start"])
        out["n_notices"] = [len(x) for x in out["notices"]]
        named = [sorted({n["family"] for n in x}) for x in out["notices"]]
        out["families"] = [[f for f in x if f not in RESTRICTIONS] for x in named]
        out["restrictions"] = [[f for f in x if f in RESTRICTIONS] for x in named]
        return out

    def _confirmed(self, pair, first, last, block, closed, size: int, confirm: float) -> tuple[np.ndarray, list[set[int]]]:
        """Runs of ``size`` open lines in which templates are found, by first line, and the families of these templates."""
        back = size - 1 - (last - first)  # how much earlier than its first line a run with the pair may begin
        fits = back >= 0
        number = back[fits] + 1
        step = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        window, key = np.repeat(first[fits], number) - step, np.repeat(pair[fits], number)
        inside = (window >= 0) & (window + size <= len(block))
        window, key = window[inside], key[inside]
        inside = block[window] == block[window + size - 1]
        before = np.concatenate([[0], np.cumsum(closed)])
        inside &= before[window] == before[window + size]
        seen = np.unique(window[inside] * len(self.pairs) + key[inside])  # a pair counts once in a run
        window, key = seen // len(self.pairs), seen % len(self.pairs)
        many = self.first[key + 1] - self.first[key]
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        template = self.templates[np.repeat(self.first[key], many) + step]
        met, of, times = np.unique(np.repeat(window, many) * len(self.size_of) + template, return_inverse=True, return_counts=True)
        telling = np.bincount(of, weights=np.repeat(self.telling[key], many), minlength=len(met)) > 0
        template = met % len(self.size_of)
        # One pair of a short template is not enough.
        enough = telling & (times >= np.maximum(confirm * self.size_of[template], np.minimum(2, self.size_of[template])))
        families: dict[int, set[int]] = {}
        for w, label in zip((met[enough] // len(self.size_of)).tolist(), self.label_of[template[enough]].tolist(), strict=True):
            families.setdefault(w, set()).add(label)
        return np.array(list(families), dtype=np.int64), list(families.values())


def background(docs: DataFrame, key: str = "doc_id", text: str = "text", count: int = BACKGROUND, excerpt: int = EXCERPT) -> list[str]:
    """At most ``count`` excerpts of texts, chosen by a hash of the key, that do not speak of licences."""
    rows = docs.where(F.length(text) > 0)
    total = rows.count()
    if not total:
        return []
    draw = F.pmod(F.xxhash64(key, F.lit("background")), F.lit(1 << 40)).cast("double") / float(1 << 40)
    speaks = F.lower(F.substring(text, 1, excerpt)).rlike("licen[cs]e|copyright|public domain|rights reserved|proprietary|confidential|unauthori[sz]ed|written permission")
    drawn = rows.where(draw < min(1.0, 1.5 * count / total + 20 / total)).where(~speaks)
    found = drawn.select(draw.alias("draw"), F.substring(text, 1, excerpt).alias("part")).collect()
    return [r["part"] for r in sorted(found)[:count]]



def scan_licences(docs: DataFrame, unknown: list[str], text: str = "text", into: str = "licences", confirm: float = CONFIRM) -> DataFrame:
    """``docs`` with a struct: paragraphs, confirmed notices with their spans in bytes, and their families: licences and restrictions."""
    model = docs.sparkSession.sparkContext.broadcast(Classifier(unknown))

    def measure():
        return lambda data, offsets: model.value.scan(data, offsets, confirm)

    return annotate(docs, text, into, FIELDS, measure)
