"""License scan: a trained paragraph classifier, confirmed against templates.

A paragraph is a line. Overlapping windows of WINDOW words run over each line
and over the whole text's words, so no text is cut and a notice may be wrapped
over any lines. A window's hashed word uni- and bigrams go through a
multinomial logistic regression over licence families (one a version and
variant), ``unknown`` (licence wording of no known family) and ``none``.

The regression names the families of a window that is not ``none``: the likely
ones (CANDIDATE or more), likeliest first, are compared with their templates in
and around the window. A template is met if enough of its word trigrams are
there, among them all that hold a decisive word (numbers, ``gnu``, ``by`` ...), so
no version is taken for its neighbour. The words of confirmed notices are set
aside and the rest of the window is classified again, until it is ``none`` or no
family is confirmed. A confirmed family is reported once for the line on which
its notice begins; a window without a confirmed notice is ``unknown``.

Probabilities are calibrated by a temperature and shifts of ``none`` and ``unknown``, fitted
on examples of models that never saw their family (these count as unknown) or
their wording: FOLDS times, a part of the families, of the wordings and of the
plain paragraphs is left out of training.

Training is on the driver and bounded: variations of the templates, and at most
``MAX_NEGATIVES`` paragraphs of the corpus (chosen by hash) as ``none``; it goes on
until the loss settles. Only grams of the notices themselves carry weight. The
scan itself is one pass without shuffle; its model is a table of some hundred
grams by class.

Defined cases: null and empty texts have no paragraph; repeated rows and ties
are scanned alike; an empty table gives an empty result; other columns pass
through and clashing result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlab.llm.byte_bpe import _chunks
from basketlab.llm.common import bounded_sample, table
from basketlab.llm.near_dedup import mix, word_hashes

_GNU = "under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License"
_CC = {"cc-by": "Attribution", "cc-by-sa": "Attribution-ShareAlike", "cc-by-nc": "Attribution-NonCommercial", "cc-by-nd": "Attribution-NoDerivatives", "cc-by-nc-sa": "Attribution-NonCommercial-ShareAlike", "cc-by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}


def _gnu(code: str, name: str, version: str, day: str) -> list[str]:
    spdx = f"SPDX-License-Identifier: {code}-{version if '.' in version else version + '.0'}"
    return [
        f"This work is licensed under the GNU {name}, version {version}",
        f"This program is free software: you can redistribute it and/or modify it {_GNU.format(name, version)}",
        _GNU.format(name, version),
        f"GNU {name} Version {version}, {day}",
        f"Licensed under the GNU {code} v{version}",
        f"Licensed under the {code}v{version} license",
        spdx,
        f"{spdx}-only",
        f"{spdx}-or-later",
    ]


# fixed values: public licence notices, by family
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT license",
        "The MIT License",
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-2.0": _gnu("GPL", "General Public License", "2", "June 1991"),
    "gpl-3.0": _gnu("GPL", "General Public License", "3", "29 June 2007"),
    "lgpl-2.1": _gnu("LGPL", "Lesser General Public License", "2.1", "February 1999"),
    "lgpl-3.0": _gnu("LGPL", "Lesser General Public License", "3", "29 June 2007"),
    "agpl-3.0": _gnu("AGPL", "Affero General Public License", "3", "19 November 2007"),
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
        "Licensed under the BSD 3-Clause License",
        "Licensed under the BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "mpl-1.1": [
        "The contents of this file are subject to the Mozilla Public License Version 1.1",
        "subject to the Mozilla Public License Version 1.1",
        "Licensed under the Mozilla Public License, version 1.1",
        "SPDX-License-Identifier: MPL-1.1",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
        "SPDX-License-Identifier: Unlicense",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Licensed under the ISC License",
        "SPDX-License-Identifier: ISC",
    ],
    **{
        f"{code}-4.0": [
            f"This work is licensed under a Creative Commons {name} 4.0 International License",
            f"Creative Commons {name} 4.0 International",
            f"Licensed under {code.upper().replace('-', ' ', 1)} 4.0",
            f"SPDX-License-Identifier: {code.upper()}-4.0",
        ]
        for code, name in _CC.items()
    },
    "cc0-1.0": [
        "This work is dedicated to the public domain under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "SPDX-License-Identifier: CC0-1.0",
    ],
}
# fixed values: licence wording of no known family, and plain uses of the words
UNKNOWN = [
    "Licensed under the Example Public License, version 7",
    "Released under the Sample Community License",
    "This software is licensed under proprietary terms",
    "Use of this file is governed by the vendor license agreement",
    "SPDX-License-Identifier: LicenseRef-Custom",
    "All rights reserved. Redistribution without written permission is prohibited",
    "This work is licensed under its own license terms",
    "Licensed under the terms of the agreement between the parties",
    "You may not use this software without a commercial license from the vendor",
    "Released under the terms of a license of its own",
]
PLAIN = [
    "he lost his driver license and paid a fine",
    "the license plate of the car was dirty",
    "poetic license allows the author some freedom",
    "the general public came to see the version of the play",
    "the restaurant renewed its license to serve wine",
    "she did her degree at mit and moved west",
    "the apache people of the south west",
    "free software is a matter of liberty",
    "released in may the film was a success under the new management",
    "work on the source of the river was permitted",
    "the terms of the contract were published in the general report",
    "version 2 0 of the plan came in 4 0 weeks",
]
CLASSES = ("none", "unknown", *TEMPLATES)
#: words that tell families apart, beside those with a digit: trigrams that hold one must all be there
DECISIVE = {"gnu", "attribution", "by"}
#: families whose notices differ in a word or two
KIN = ({f for f in TEMPLATES if "gpl" in f}, {f for f in TEMPLATES if f.startswith("cc-")}, {f for f in TEMPLATES if f.startswith("mpl")})
WINDOW, STRIDE = 48, 24
CONFIRMED = 0.8
CANDIDATE = 0.01
VARIANTS, FOLDS, MAX_NEGATIVES = 30, 4, 5000
ODDS = 1.2  # plain paragraphs weigh this many times the notices, however many were sampled
SETTLED = 1e-4  # training ends when ten steps lower the loss an example by less
EXPRESSION = 12  # words from one "or" / "and" of an SPDX expression to the next at most
_U = np.uint64
#: letters, digits and all bytes of other scripts are words; a line break stays, the rest is a space
_WORDS = bytes(b if (48 <= b <= 57 or 97 <= b <= 122 or b >= 128 or b == 10) else 32 for b in range(256))


def _raw(texts: list[str | None]) -> list[bytes]:
    return [(t or "").lower().encode().translate(_WORDS) for t in texts]


def _paragraph_words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, line number in the text, hash) of every word."""
    doc, word, start, buf = word_hashes(raw)
    breaks = np.cumsum(buf == 10)
    before = np.cumsum([0] + [r.count(b"\n") for r in raw])[:-1]
    return doc, breaks[start] - before[doc] if len(doc) else doc, word


def _grams(group: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and of each word with the next one of its group (0: there is none)."""
    two = np.zeros(len(word), _U)
    if len(word) > 1:
        two[:-1] = np.where(group[:-1] == group[1:], mix(word[:-1] * _U(3) + word[1:]), _U(0))
    return word, two


def _blocks(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Start of the block of STRIDE words that each word lies in, counted from its group's first word."""
    at = np.repeat(first, size)
    return at + (np.arange(len(at)) - at) // STRIDE * STRIDE


class Vocabulary:
    """Number of each known gram (from 1; 0 is any other), looked up by whole arrays."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.concatenate([[_U(0)], np.unique(hashes[hashes != 0])]).astype(_U)
        bits = 18
        while True:  # a part of the hash that tells all grams apart
            found = next((s for s in range(0, 64 - bits) if len(np.unique(self._part(self.hashes[1:], s, bits))) == len(self.hashes) - 1), None)
            if found is not None:
                break
            bits += 1
        self.shift, self.bits = found, bits
        self.number = np.zeros(1 << bits, np.int32)
        self.number[self._part(self.hashes[1:], found, bits)] = np.arange(1, len(self.hashes))

    @staticmethod
    def _part(h: np.ndarray, shift: int, bits: int) -> np.ndarray:
        return ((h >> _U(shift)) & _U((1 << bits) - 1)).astype(np.int64)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        n = self.number[self._part(h, self.shift, self.bits)]
        return np.where(self.hashes[n] == h, n, 0)

    def once(self, h: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Numbers of the grams, each counted once a block, so that a word over and over is no notice."""
        n = self(h)
        at = np.flatnonzero(n)
        at = at[np.unique(block[at] * len(self.hashes) + n[at], return_index=True)[1]]
        out = np.zeros_like(n)
        out[at] = n[at]
        return out


def _three(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return mix(a * _U(5) + mix(b * _U(11) + c))


def _trigrams(words: np.ndarray) -> list[int]:
    """Hashes of the word trigrams in order; of a title of two words: of a line that holds just these."""
    if len(words) == 2:
        return _three(np.zeros(1, _U), words[:1], words[1:]).tolist()
    return _three(words[:-2], words[1:-1], words[2:]).tolist()


@dataclass
class Template:
    family: int
    grams: set[int]
    must: set[int]


def _templates() -> list[Template]:
    out = []
    for family, texts in TEMPLATES.items():
        for t in texts:
            raw = _raw([t])
            grams = _trigrams(_paragraph_words(raw)[2])
            decisive = [w in DECISIVE or any(c.isdigit() for c in w) for w in raw[0].decode().split()]
            must = {g for k, g in enumerate(grams) if any(decisive[k : k + 3])}
            out.append(Template(CLASSES.index(family), set(grams), must))
    return out


def _expression_words(word: np.ndarray, doc: np.ndarray, line: np.ndarray) -> list[int]:
    """Places of "or" / "and" in SPDX expressions: what follows reads as if the tag stood there."""
    if len(word) < 5:
        return []
    spdx, licence, identifier, *joins = _paragraph_words(_raw(["spdx license identifier or and"]))[2]
    tags = np.flatnonzero((word[:-2] == spdx) & (word[1:-1] == licence) & (word[2:] == identifier))
    if not len(tags):
        return []
    places = np.flatnonzero(np.isin(word[:-1], joins) & (doc[:-1] == doc[1:]) & (line[:-1] == line[1:]))
    out, owner = [], np.searchsorted(tags, places) - 1
    last, tag = 0, -1
    for j, k in zip(places.tolist(), owner.tolist(), strict=True):
        if k < 0:
            continue
        i = int(tags[k])
        if k != tag:
            tag, last = k, i + 3
        if doc[j] == doc[i] and line[j] == line[i] and j > i + 3 and j - last <= EXPRESSION:
            out.append(j)
            last = j
    return out


@dataclass
class Classifier:
    vocabulary: Vocabulary
    weights: np.ndarray  # grams by classes
    bias: np.ndarray
    temperature: float
    templates: list[Template]

    def probabilities(self, margin: np.ndarray) -> np.ndarray:
        z = (margin + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def scan(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, str, float, bool]]]]:
        """Of each text the number of paragraphs with words, and its licence paragraphs, one entry a family."""
        out: list[tuple[int, list]] = []
        for part in _chunks([t or "" for t in texts]):
            doc, line, word = _paragraph_words(_raw(part))
            edge = np.ones(len(word), bool)
            edge[1:] = doc[1:] != doc[:-1]
            new = edge.copy()
            new[1:] |= line[1:] != line[:-1]
            first, begin = np.flatnonzero(new), np.flatnonzero(edge)
            count = np.bincount(doc[first], minlength=len(part)) if len(first) else np.zeros(len(part), int)
            joins = _expression_words(word, doc, line)
            lines, whole = self._flagged(word, first, joins), self._flagged(word, begin, [])
            rows: list[list] = [[] for _ in part]
            if lines or whole:
                ends = np.append(begin, len(word))
                windows: dict[int, tuple[list, list]] = {}
                for k, found in enumerate((lines, whole)):
                    for w in found:
                        windows.setdefault(int(doc[w[0]]), ([], []))[k].append(w)
                notices = _Notices(self, word, doc, line, joins)
                at = {int(doc[x]): k for k, x in enumerate(begin)}
                for d, (of_lines, of_text) in windows.items():
                    rows[d] = notices.hits(of_lines, of_text, int(ends[at[d]]), int(ends[at[d] + 1]))
            out += list(zip(count.tolist(), rows, strict=True))
        return out

    def _flagged(self, word: np.ndarray, first: np.ndarray, joins: list[int]) -> list[tuple[int, int, float, np.ndarray]]:
        """(start, end, probability, words by classes) of the windows with licence wording, within groups that start at ``first``."""
        size = np.diff(np.append(first, len(word)))
        block = _blocks(first, size)
        one, two = (self.vocabulary.once(h, block) for h in _grams(np.repeat(first, size), word))
        share = self.weights[one] + self.weights[two]
        sums = np.zeros((len(word) + 1, len(CLASSES)))
        np.cumsum(share, axis=0, out=sums[1:])
        n = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
        owner = np.repeat(np.arange(len(first)), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        start = first[owner] + step * STRIDE
        end = np.minimum(start + WINDOW, first[owner] + size[owner])
        p = self.probabilities(sums[end] - sums[start])[:, 0]
        out = [(int(start[w]), int(end[w]), float(1 - p[w]), share[start[w] : end[w]].copy()) for w in np.flatnonzero(p < 0.5)]
        if not joins:
            return out
        # an operand of an SPDX expression is a window of its own, read with the tag in front
        tag = _paragraph_words(_raw(["spdx license identifier"]))[2]
        before = self.weights[self.vocabulary(np.concatenate(_grams(np.zeros(3, int), tag)))].sum(axis=0)
        group = np.searchsorted(first, joins, side="right") - 1
        for k, j in enumerate(joins):
            stop = min(int(first[group[k]] + size[group[k]]), j + 1 + EXPRESSION, *joins[k + 1 : k + 2])
            rows = share[j:stop].copy()
            rows[0] += before + self.weights[self.vocabulary(mix(tag[2:] * _U(3) + word[j + 1 : j + 2]))][0]
            none = float(self.probabilities(rows.sum(axis=0)[None])[0, 0])
            if none < 0.5:
                out.append((j, stop, 1 - none, rows))
        return out


class _Notices:
    """Where templates occur in a sequence of words, by their trigrams."""

    def __init__(self, model: Classifier, word: np.ndarray, doc: np.ndarray, line: np.ndarray, joins: list[int]):
        self.line, self.model = line, model
        known = np.array(sorted(set().union(*(t.grams for t in model.templates))), _U)

        def numbers(h: np.ndarray) -> np.ndarray:
            n = np.minimum(np.searchsorted(known, h), len(known) - 1)
            return np.where(known[n] == h, n, -1)

        as_set = lambda grams: set(numbers(np.array(sorted(grams), _U)).tolist())
        self.of: dict[int, list[tuple[set[int], set[int]]]] = {}
        for t in model.templates:
            self.of.setdefault(t.family, []).append((as_set(t.grams), as_set(t.must)))
        places, found = [np.zeros(0, int)], [np.zeros(0, int)]
        if len(word) > 2:
            tri = numbers(_three(word[:-2], word[1:-1], word[2:]))
            tri[doc[:-2] != doc[2:]] = -1
            places.append(np.flatnonzero(tri >= 0))
            found.append(tri[places[-1]])
        if len(word) > 1:  # lines of two words
            edge = np.ones(len(word) + 1, bool)
            edge[1:-1] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
            at = np.flatnonzero(edge[:-2] & ~edge[1:-1] & edge[2:])
            places.append(at)
            found.append(numbers(_three(np.zeros(len(at), _U), word[at], word[at + 1])))
        if joins:
            at = np.array(joins)
            spdx, licence, identifier = (np.full(len(at), w, _U) for w in _paragraph_words(_raw(["spdx license identifier"]))[2])
            after = np.minimum(at + 2, len(word) - 1)
            pair = np.where((at + 2 < len(word)) & (doc[after] == doc[at]), _three(identifier, word[at + 1], word[after]), _U(0))
            places += [at] * 3
            found += [numbers(_three(spdx, licence, identifier)), numbers(_three(licence, identifier, word[at + 1])), numbers(pair)]
        place, number = np.concatenate(places), np.concatenate(found)
        place, number = place[number >= 0], number[number >= 0]
        order = np.argsort(place, kind="stable")
        self.place, self.number = place[order], number[order]

    def _confirmed(self, family: int, start: int, end: int) -> list[tuple[int, float, int, int, int]]:
        """(family, share, trigrams, start, end) of the family's templates that occur in the words [start, end)."""
        a, b = np.searchsorted(self.place, [start, end - 1])
        place, number = self.place[a:b].tolist(), self.number[a:b].tolist()
        here, found = set(number), []
        for grams, must in self.of[family]:
            if len(grams & here) < CONFIRMED * len(grams) or not must <= here:
                continue
            mine = [(x, n) for x, n in zip(place, number, strict=True) if n in grams]
            open_ = [(0, len(mine))]
            while open_:  # the tightest stretch with most of the template, then what lies on either side of it
                lo, hi = open_.pop()
                best = (0, 0, 0)
                for i in range(lo, hi):
                    seen: set[int] = set()
                    from_ = last = mine[i][0]
                    for y, n in mine[i:hi]:
                        if y > from_ + WINDOW - 3:
                            break
                        if n not in seen:
                            seen.add(n)
                            last = y
                    if must <= seen:
                        best = max(best, (len(seen), from_, last + 3))
                if best[0] >= CONFIRMED * len(grams):
                    found.append((family, best[0] / len(grams), *best))
                    left = [k for k in range(lo, hi) if mine[k][0] < best[1]]
                    right = [k for k in range(lo, hi) if mine[k][0] >= best[2]]
                    open_ += [(x[0], x[-1] + 1) for x in (left, right) if x]
        return found

    def named(self, a: int, b: int, share: np.ndarray, begin: int, end: int) -> dict[tuple, float]:
        """Confirmed notices of the families that the regression names in the window [a, b), with its probabilities."""
        free, found, tried = np.ones(b - a, bool), {}, {0, 1}
        while True:
            p = self.model.probabilities(share[free].sum(axis=0)[None])[0]
            if p[0] >= 0.5:
                return found
            likely = [c for c in np.argsort(-p, kind="stable").tolist() if c not in tried and p[c] >= CANDIDATE]
            tried.update(likely)
            notices = {x: float(p[c]) for c in likely for x in self._confirmed(c, max(begin, a - STRIDE), min(end, b + STRIDE))}
            if not notices:
                return found
            found |= notices
            for x in notices:
                free[max(0, x[3] - a) : max(0, x[4] - a)] = False

    def hits(self, of_lines: list, of_text: list, begin: int, end: int) -> list[tuple[int, str, float, bool]]:
        """Licence paragraphs of the text [begin, end) with these flagged windows of its lines and of all its words."""
        seen: dict[tuple, float] = {}
        for a, b, _, share in of_lines + of_text:
            for x, p in self.named(a, b, share, begin, end).items():
                seen[x] = max(p, seen.get(x, 0.0))
        kept: list[tuple[int, float, int, int, int]] = []
        overlap = lambda x, a, b: x[3] < b and a < x[4]
        near: dict[int, list] = {}  # kept notices by stretch of WINDOW words, so that only neighbours are compared
        around = lambda a, b: [x for k in range(a // WINDOW - 2, b // WINDOW + 1) for x in near.get(k, [])]
        for x in sorted(seen, key=lambda x: (-x[1], -x[2], -seen[x], x)):
            kin = next((g for g in KIN if CLASSES[x[0]] in g), set())
            for k in around(x[3], x[4]):
                if overlap(k, x[3], x[4]) and (k[0] == x[0] or (CLASSES[k[0]] in kin and x[1] < 1)):
                    break
            else:
                kept.append(x)
                near.setdefault(x[3] // WINDOW, []).append(x)
        out: dict[tuple[int, str], float] = {}
        for x in kept:
            key = (int(self.line[x[3]]), CLASSES[x[0]])
            out[key] = max(seen[x], out.get(key, 0.0))
        sure = set(out)
        for a, b, p, _ in of_lines:
            if not any(overlap(x, a, b) for x in around(a, b)):
                key = (int(self.line[a]), "unknown")
                out[key] = max(p, out.get(key, 0.0))
        told, last = sorted({k for k, _ in out}), begin
        for a, b, p, _ in of_text:  # wording that no line shows by itself
            k = np.searchsorted(told, self.line[a])
            if a >= last and not (k < len(told) and told[k] <= self.line[b - 1]) and not any(overlap(x, a, b) for x in around(a, b)):
                out[(int(self.line[a]), "unknown")] = p
                last = b
        return [(*key, p, key in sure) for key, p in sorted(out.items())]


def _variants(rng: np.random.Generator, text: str, fillers: list[list[str]]) -> str:
    """A notice with a few words lost and up to a dozen plain words on either side."""
    kept = [w for w in text.split() if rng.random() > 0.06]
    pick = lambda: fillers[rng.integers(len(fillers))][: rng.integers(12)] if fillers and rng.random() < 0.5 else []
    return " ".join([*pick(), *kept, *pick()])


def _weights(y: np.ndarray) -> np.ndarray:
    plain = y == 0
    return np.where(plain, ODDS * (~plain).sum() / max(1, plain.sum()), 1.0)


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias for counts of grams ``x`` and classes ``y``, by adaptive gradient steps until the loss settles."""
    # equal examples are one row that weighs as many times as much
    _, one, times = np.unique(np.c_[x, y].astype(np.int32), axis=0, return_index=True, return_counts=True)
    weight = (_weights(y)[one] * times)[:, None]
    x, y = x[one], y[one]
    goal, xt = np.eye(len(CLASSES))[y], np.ascontiguousarray(x.T)
    w, b = np.zeros((x.shape[1], len(CLASSES))), np.zeros(len(CLASSES))
    seen_w, seen_b = np.full(w.shape, 1e-3), np.full(len(CLASSES), 1e-3)
    step, before = 0, np.inf
    while True:
        z = x @ w + b
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        total = p.sum(axis=1, keepdims=True)
        if step % 10 == 0:
            loss = float((weight * (np.log(total) - (z * goal).sum(axis=1, keepdims=True))).sum() + 0.01 * (w**2).sum()) / weight.sum()
            if loss > before - SETTLED:
                return w, b
            before = loss
        step += 1
        miss = (goal - p / total) * weight
        g = xt @ miss - 0.02 * w
        seen_w += g * g
        w += 0.3 * g / np.sqrt(seen_w)
        gb = miss.sum(axis=0)
        seen_b += gb * gb
        b += 0.3 * gb / np.sqrt(seen_b)


def examples(negatives: list[str], seed: int = 7) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Training texts, their classes and the number of the wording each is made of."""
    rng = np.random.default_rng(seed)
    every = [t.grams for t in _templates()]
    near = lambda n: any(2 * len(t & h) >= len(t) for h in [set(_trigrams(_paragraph_words(_raw([n.replace("\n", " ")]))[2]))] for t in every)
    clean = [n for n in negatives if not near(n)]
    fillers = [n.split() for n in clean[:500]]
    texts, y, wording = [], [], []
    for c, sources in [(0, PLAIN), (1, UNKNOWN), *[(CLASSES.index(f), ts) for f, ts in TEMPLATES.items()]]:
        for k, t in enumerate(sources):
            texts += [t] + [_variants(rng, t, fillers) for _ in range(VARIANTS)]
            y += [c] * (VARIANTS + 1)
            wording += [k] * (VARIANTS + 1)
    for k, n in enumerate(clean):
        texts.append(" ".join(n.split()[:WINDOW]))
        y.append(0)
        wording.append(k)
    return texts, np.array(y), np.array(wording)


def left_out(y: np.ndarray, wording: np.ndarray, fold: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that a fold's model never sees, and their true classes for it: families left out whole are unknown."""
    family = (y > 1) & (y % FOLDS == fold)
    return family | (wording % FOLDS == fold), np.where(family, 1, y)


def train(negatives: list[str], seed: int = 7) -> Classifier:
    """Fits the regression on template variations and plain paragraphs, and calibrates it on what folds leave out."""
    texts, y, wording = examples(negatives, seed)
    doc, _, word = _paragraph_words(_raw([t.replace("\n", " ") for t in texts]))
    source_doc, _, source = _paragraph_words(_raw([*UNKNOWN, *(t for ts in TEMPLATES.values() for t in ts)]))
    vocabulary = Vocabulary(np.concatenate(_grams(source_doc, source)))
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    block = _blocks(first, np.diff(np.append(first, len(doc))))
    row, col = np.concatenate([doc, doc]), np.concatenate([vocabulary.once(h, block) for h in _grams(doc, word)])
    x = np.zeros((len(texts), len(vocabulary.hashes)))
    np.add.at(x, (row[col > 0], col[col > 0]), 1.0)
    margins, truth = [], []
    for fold in range(FOLDS):
        out, true = left_out(y, wording, fold)
        w, b = _fit(x[~out], y[~out])
        margins.append(x[out] @ w + b)
        truth.append(true[out])
    model = Classifier(vocabulary, *_fit(x, y), 1.0, _templates())
    model.temperature, shift = _calibrated(np.concatenate(margins), np.concatenate(truth))
    model.bias[:2] += shift
    return model


def _calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """The temperature and the shifts of ``none`` and ``unknown`` of the least log loss, searched in turns."""

    weight = _weights(y)

    def loss(temperature: float, none: float, unknown: float) -> float:
        m = z.copy()
        m[:, :2] += none, unknown
        m /= temperature
        m -= m.max(axis=1, keepdims=True)
        return float(np.average(np.log(np.exp(m).sum(axis=1)) - m[np.arange(len(y)), y], weights=weight))

    best, before = [1.0, 0.0, 0.0], np.inf
    grids = [np.exp(np.linspace(-1.5, 1.5, 31)), np.linspace(-6, 6, 25), np.linspace(-6, 6, 25)]
    while (now := loss(*best)) < before - 1e-6:
        before = now
        for k, grid in enumerate(grids):
            best[k] = min([best[k], *grid.tolist()], key=lambda v: loss(*best[:k], v, *best[k + 1 :]))  # noqa: B023
    return best[0], np.array(best[1:])


def sample_paragraphs(docs: DataFrame, text_col: str = "text", most: int = MAX_NEGATIVES) -> list[str]:
    """At most ``most`` distinct paragraphs of the corpus, by hash (their first WINDOW words, for training only)."""
    lines = docs.select(F.explode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("p")).where(F.length(F.trim("p")) > 0)
    lines = lines.select(F.xxhash64("p").alias("h"), F.substring_index("p", " ", WINDOW).alias("p"))
    return [r.p for r in bounded_sample(lines, most, "h", "p", distinct=True).collect()]


def scan(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """``docs`` with n_paragraphs and found: array of (paragraph, family, probability, confirmed)."""
    kind = "struct<n_paragraphs:bigint,found:array<struct<paragraph:int,family:string,probability:double,confirmed:boolean>>>"

    @F.pandas_udf(kind)
    def read(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            rows = model.scan(s.tolist())
            names = ("paragraph", "family", "probability", "confirmed")
            yield pd.DataFrame({"n_paragraphs": [n for n, _ in rows], "found": [[dict(zip(names, h, strict=True)) for h in hits] for _, hits in rows]})

    base = docs.drop("n_paragraphs", "found")
    return base.withColumn("_scan", read(F.col(text_col))).select(*base.columns, "_scan.*")


# -- registered query -------------------------------------------------------
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(sample_paragraphs(docs)))
    known = F.filter("found", lambda x: x["confirmed"])
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("found").cast("long").alias("n_license"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(known, lambda x: x["family"])))).alias("families"),
        F.concat_ws(",", F.transform("found", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"]))).alias("paragraphs"),
    )
