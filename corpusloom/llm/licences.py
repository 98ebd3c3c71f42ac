"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a run of non-blank lines, or a line where a text has only one such run. Notices are searched in the whole
run, across its line breaks. Words, in lower case with digits as ``#``, give hashed 1- to 3-word features to a
multinomial logistic regression over the licence families and a class for everything else. It is trained here on variations
of the templates (cut, embedded, with words lost or foreign words around them) and, for the class "none", on foreign words and on
shuffled template words. A temperature fitted on held-back variations calibrates its probabilities. A template is
confirmed where enough of its words, in its order, stand in a line, or within a window of ``SPREAD`` times its length
anywhere in the run. Its family counts if it is the likeliest for that line, or for the words from the template's first to its
last, with a probability of at least ``SURE``. So a paragraph can hold several families; where two claim the same
words, the one whose template fits with fewer words lost or added has them.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from collections import Counter
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import add_column, free_name

#: Fixed texts: the usual short notices and the opening or telling sentences of common licences.
TEMPLATES = {
    "agpl": ["This program is licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0"],
    "apache": ["Licensed under the Apache License, Version 2.0", "You may not use this file except in compliance with the License", "SPDX-License-Identifier: Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS basis"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Released under the BSD License", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Released under the ISC License", "SPDX-License-Identifier: ISC"],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: LGPL-2.1"],
    "mit": ["Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "SPDX-License-Identifier: MIT"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, version 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "proprietary": ["All rights reserved", "Copyright 2020 all rights reserved", "No part of this work may be reproduced without the prior written permission of the publisher"],
    "public-domain": ["This work has been released into the public domain", "This is free and unencumbered software released into the public domain", "SPDX-License-Identifier: CC0-1.0", "Licensed under CC0 1.0 Universal"],
}
NONE = "none"
WIDTH = 1 << 16
SURE = 0.6
#: Share of a template's words, in order, that confirm it.
MATCH = 0.7
#: A template's words stand within so many times its length, if not in one line.
SPREAD = 2

_CUT = bytes(b + 32 if 65 <= b <= 90 else 35 if 48 <= b <= 57 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_SQUEEZE = re.compile(rb"#+")


def words_of(line: bytes) -> list[bytes]:
    return _SQUEEZE.sub(b"#", line.translate(_CUT)).split()


def features(words: list[bytes]) -> list[int]:
    grams = set(words) | {b" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)}
    return sorted({zlib.crc32(g) % WIDTH for g in grams})


def best_span(template: list[bytes], words: list[tuple[int, bytes]]) -> tuple[int, int, int]:
    """How long the longest common subsequence with (place, word) is, and the places of its first and last word."""
    row = [(0, -1)] * (len(template) + 1)
    best = (0, -1, -1)
    for at, w in words:
        left = row[0]
        for i, t in enumerate(template):
            up = row[i + 1]
            row[i + 1] = (left[0] + 1, left[1] if left[0] else at) if w == t else max(up, row[i])
            left = up
        if row[-1][0] > best[0]:
            best = (*row[-1], at)
    return best


def in_order(template: list[bytes], words: list[bytes]) -> float:
    """Share of the template's words in the longest common subsequence with the paragraph's words."""
    return best_span(template, list(enumerate(words)))[0] / len(template)


def spans(template: list[bytes], words: list[bytes]) -> list[tuple[int, int, int]]:
    """Every ``best_span`` that confirms the template within its window, one after the other."""
    need, width, own = MATCH * len(template), SPREAD * len(template), Counter(template)
    seq = [(i, w) for i, w in enumerate(words) if w in own]
    out: list[tuple[int, int, int]] = []
    held: Counter[bytes] = Counter()
    a = cover = 0
    for e, (at, w) in enumerate(seq):
        held[w] += 1
        cover += held[w] <= own[w]
        while seq[a][0] <= at - width or (out and seq[a][0] <= out[-1][2] and a < e):
            cover -= held[seq[a][1]] <= own[seq[a][1]]
            held[seq[a][1]] -= 1
            a += 1
        if cover < need or (out and at <= out[-1][2]):
            continue
        got = best_span(template, seq[a : e + 1])
        if got[0] >= need:
            b = a
            while seq[b][0] < got[1]:
                b += 1
            c = e + 1
            while c < len(seq) and seq[c][0] < got[1] + width:
                c += 1
            out.append(best_span(template, seq[b:c]))
    return out


class LicenceModel:
    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, seed: int = 0):
        self.names = [NONE, *sorted(templates)]
        self.templates = {f: [words_of(t.encode()) for t in ts] for f, ts in templates.items()}
        #: a paragraph without two of these words holds no template
        self.known = {w for ts in self.templates.values() for t in ts for w in t}
        self.rare = self.known - set(b"a of the in to and or is be with without this for that are by not on any it as you all no may must work use law file form list met part free fee # v source person following above associated".split())
        rng = random.Random(seed)
        rows = [self._variation(rng) for _ in range(3000)]
        self.weights = self._fit(rows[:2400])
        self.heat = min((1.0, 0.5, 0.7, 1.4, 2.0), key=lambda h: self._loss(rows[2400:], h))

    def _variation(self, rng: random.Random) -> tuple[list[int], int]:
        foreign = lambda n: ["".join(rng.choice("abdeilmnorstuvz") for _ in range(rng.randint(2, 9))).encode() for _ in range(n)]
        if rng.random() < 0.4:
            words = foreign(rng.randint(0, 30))
            for _ in range(rng.randint(0, 6)):
                words.insert(rng.randint(0, len(words)), rng.choice(sorted(self.known)))
            if rng.random() < 0.3:
                mixed = list(rng.choice(self.templates[rng.choice(self.names[1:])]))
                rng.shuffle(mixed)
                words += mixed[: max(1, len(mixed) // 2)]
            return features(words), 0
        family = rng.randrange(1, len(self.names))
        words = [w for w in rng.choice(self.templates[self.names[family]])]
        if len(words) > 6 and rng.random() < 0.4:
            del words[rng.randrange(len(words))]
        return features(foreign(rng.choice([0, 0, 2, 8])) + words + foreign(rng.choice([0, 0, 2, 12]))), family

    def _fit(self, rows: list[tuple[list[int], int]], rounds: int = 120) -> np.ndarray:
        classes = len(self.names)
        col = np.concatenate([np.array(f, dtype=np.int64) for f, _ in rows])
        row = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
        used, col = np.unique(col, return_inverse=True)
        goal = np.eye(classes)[[y for _, y in rows]]
        w, m, v = (np.zeros((len(used) + 1, classes)) for _ in range(3))
        for t in range(1, rounds + 1):
            z = np.zeros((len(rows), classes)) + w[-1]
            for c in range(classes):
                z[:, c] += np.bincount(row, weights=w[col, c], minlength=len(rows))
            p = np.exp(z - z.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - goal) / len(rows)
            grad = np.stack([np.r_[np.bincount(col, weights=error[row, c], minlength=len(used)), error[:, c].sum()] for c in range(classes)], axis=1)
            grad[:-1] += 1e-5 * w[:-1]
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-12)
        self.bias = w[-1]
        self.place = {int(u): i for i, u in enumerate(used)}
        return w[:-1]

    def probabilities(self, found: list[int], heat: float | None = None) -> np.ndarray:
        z = self.bias + self.weights[[self.place[f] for f in found if f in self.place]].sum(axis=0)
        z = (z - z.max()) / (heat or self.heat)
        p = np.exp(z)
        return p / p.sum()

    def _loss(self, rows: list[tuple[list[int], int]], heat: float) -> float:
        return -sum(float(np.log(self.probabilities(f, heat)[y] + 1e-12)) for f, y in rows)

    def classify(self, line: bytes) -> tuple[str, float]:
        """(family or "none", its probability) of a paragraph."""
        words = words_of(line)
        if len(self.rare.intersection(words)) < 2 or len(self.known.intersection(words)) < 2:
            return NONE, 1.0
        p = self.probabilities(features(words))
        best = int(p.argmax())
        name = self.names[best]
        if name != NONE and p[best] >= SURE and any(in_order(t, words) >= MATCH for t in self.templates[name]):
            return name, float(p[best])
        return NONE, float(p[0])

    def possible(self, words: set[bytes]) -> list[tuple[str, list[bytes]]]:
        """The templates with enough of their words among these, in whatever order."""
        if len(self.rare.intersection(words)) < 2:
            return []
        return [(f, t) for f, ts in self.templates.items() for t in ts if sum(w in words for w in t) >= MATCH * len(t)]

    def notices(self, lines: list[bytes]) -> list[tuple[int, str, float]]:
        """(line where it begins, family, probability) of each notice in neighbouring lines."""
        cut = [words_of(x) for x in lines]
        words = [w for x in cut for w in x]
        starts = [0, *accumulate(map(len, cut))]
        claims = []

        def claim(family, p, template, found):
            n, first, last = found
            claims.append(((len(template) - n + last - first + 1 - n) / len(template), -n, first, last, family, p))

        every = self.possible(set(words))
        for line, own, start in zip(lines, cut, starts, strict=False):
            if every and self.possible(set(own)):
                family, p = self.classify(line)
                for t in self.templates.get(family, ()):
                    got = best_span(t, list(enumerate(own, start)))
                    if got[0] >= MATCH * len(t):
                        claim(family, p, t, got)
        for family, t in every:
            for got in spans(t, words):
                inside = words[got[1] : got[2] + 1]
                if len(self.rare.intersection(inside)) >= 2:
                    p = self.probabilities(features(inside))
                    if self.names[int(p.argmax())] == family and p.max() >= SURE:
                        claim(family, float(p.max()), t, got)
        held: list[tuple] = []
        for c in sorted(claims):
            if not any(c[2] <= h[3] and h[2] <= c[3] for h in held):
                held.append(c)
        return sorted((bisect_right(starts, c[2]) - 1, c[4], c[5]) for c in held)

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, str, float]]]:
        """How many paragraphs, and (first line, family, probability) of each family in each that holds one."""
        lines = text.split(b"\n")
        runs = [[i for i, _ in g] for blank, g in groupby(enumerate(lines), lambda x: not x[1] or x[1].isspace()) if not blank]
        n = len(runs) if len(runs) > 1 else sum(map(len, runs))
        found: dict[tuple[int, str], float] = {}
        if self.possible(set(words_of(text))):
            for run in runs:
                for line, family, p in self.notices([lines[i] for i in run]):
                    place = (run[0] if len(runs) > 1 else run[line], family)
                    found[place] = max(p, found.get(place, 0.0))
        return n, [(i, family, p) for (i, family), p in sorted(found.items())]


SCAN = "struct<n_paragraphs:long,found:array<struct<paragraph:long,family:string,probability:double>>>"


def scan_licences(docs: DataFrame, text_col: str = "text", model: LicenceModel | None = None, name: str = "licences") -> tuple[DataFrame, str]:
    """The documents with a struct column added, and its name: paragraphs, and those that hold a licence.

    Null and empty texts have no paragraphs; blank lines are none. A paragraph's number is that of its first line, from 0,
    and of a notice over several lines that are paragraphs, that of the first. A paragraph has an entry for each family in it. Repeated rows
    are scanned alike; a clashing column name gets underscores.
    """
    name = free_name(docs, name)
    shipped = docs.sparkSession.sparkContext.broadcast(model or LicenceModel())  # templates and their features only
    kind = pa.struct([("n_paragraphs", pa.int64()), ("found", pa.list_(pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64())])))])

    def make():
        own = shipped.value

        def scan(text: bytes) -> dict:
            n, found = own.scan(text)
            return {"n_paragraphs": n, "found": [{"paragraph": i, "family": f, "probability": p} for i, f, p in found]}

        return lambda texts: pa.array([scan(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts], type=kind)

    return add_column(docs, name, SCAN, text_col, make), name
