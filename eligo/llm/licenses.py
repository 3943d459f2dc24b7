"""License scan: winnowed fingerprints pick candidates, banded alignment confirms them.

Texts and templates are words (runs without ASCII white space, lower case, without punctuation at their ends). Every
``k`` successive words have a hash; of each ``window`` successive hashes the least is a fingerprint, so any run of
``k + window - 1`` words that a text shares with a template shares a fingerprint with it. The templates' fingerprints
are an inverted index, small and fixed, that each task holds. A fingerprint found in a text gives a template and a
diagonal (place in the text minus place in the template); diagonals within ``band`` of each other are one candidate.
A notice of at most ``short`` words need not share such a run. Its fingerprint is its first deciding word or, without
one, as many single words as may be missing and one more, so a text that matches enough of it holds one of them in place.
A text is searched for a template window by window, from one hit to the next: a match has at most ``2 n + 2 band``
words for a template of ``n``, and each window holds all matches with a hit in its first part. Its candidates are
aligned, unless too few of the template's words occur in the window at all: the longest chain of equal words within the
band around their diagonals. The best match is taken, what is before it searched again, and the search goes on after
it, so any number of adjacent notices gives as many matches, in time that follows the text's length. Reported are
those that match at least ``least`` of the template's words; of overlapping ones the one with most words matched. Two
damaged notices side by side can join to one match, where one has the words that the other lacks.

Licenses differ in few words. A match of a template counts only if its span holds all of the template's deciding words
and no qualifier (Lesser, NonCommercial, another license's name) more often than the template itself.

Each text is scanned whole, in its task; nothing is gathered.

Defined results: null and empty texts have no matches; repeated rows give their matches once each; rows with a null
key are scanned like any other; only the key and text are read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import WORD, table, text_of

#: Short public license notices (fixed values): license, template, text.
NOTICES = (
    ("MIT", "line", "Released under the MIT License."),
    ("MIT", "grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "line", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "line", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "line", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("All-rights-reserved", "line", "All rights reserved."),
    ("Apache", "line", "Released under the Apache License."),
    ("BSD", "line", "Released under the BSD License."),
    ("MPL-2.0", "line", "Licensed under the Mozilla Public License, Version 2.0."),
    ("GPL-2.0", "line", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "line", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "line", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "line", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL-2.0", "header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "header", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-4.0", "short", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "short", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "short", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "short", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "short", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-4.0", "long", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "long", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "long", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "long", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
)
#: Words that decide between licenses (fixed values): a match of the template holds all of them.
DECIDING = {
    ("MIT", "line"): "mit",
    ("Apache", "line"): "apache",
    ("Apache-2.0", "line"): "apache 2.0",
    ("Apache-2.0", "header"): "apache 2.0",
    ("BSD", "line"): "bsd",
    ("MPL-2.0", "line"): "mozilla 2.0",
    ("MPL-2.0", "header"): "mozilla 2.0",
    ("GPL-2.0", "line"): "gnu general 2",
    ("GPL-3.0", "line"): "gnu general 3",
    ("LGPL-2.1", "line"): "lesser gnu 2.1",
    ("LGPL-3.0", "line"): "lesser gnu 3",
    ("AGPL-3.0", "line"): "affero gnu 3",
    ("GPL-2.0", "header"): "gnu general 2",
    ("GPL-3.0", "header"): "gnu general 3",
    ("LGPL-2.1", "header"): "lesser gnu 2.1",
    ("LGPL-3.0", "header"): "lesser gnu 3",
    ("AGPL-3.0", "header"): "affero gnu 3",
    ("CC-BY-4.0", "short"): "cc by 4.0",
    ("CC-BY-SA-4.0", "short"): "by-sa cc 4.0",
    ("CC-BY-ND-4.0", "short"): "by-nd cc 4.0",
    ("CC-BY-NC-4.0", "line"): "by-nc cc 4.0",
    ("CC-BY-NC-SA-4.0", "short"): "by-nc-sa cc 4.0",
    ("CC-BY-NC-ND-4.0", "short"): "by-nc-nd cc 4.0",
    ("CC-BY-4.0", "line"): "attribution creative 4.0",
    ("CC-BY-SA-4.0", "line"): "attribution-sharealike creative 4.0",
    ("CC-BY-ND-4.0", "long"): "attribution-noderivatives creative 4.0",
    ("CC-BY-NC-4.0", "long"): "attribution-noncommercial creative 4.0",
    ("CC-BY-NC-SA-4.0", "long"): "attribution-noncommercial-sharealike creative 4.0",
    ("CC-BY-NC-ND-4.0", "long"): "attribution-noncommercial-noderivatives creative 4.0",
    ("All-rights-reserved", "line"): "reserved rights",
}
#: Words that make a notice that of another license (fixed values): a match has none more often than its template.
QUALIFIERS = (
    "affero", "apache", "bsd", "gnu", "lesser", "library", "mit", "mozilla", "noderivatives", "noderivs", "noncommercial", "sharealike",
    "by-nc", "by-nd", "by-sa", "by-nc-nd", "by-nc-sa", "attribution-noderivatives", "attribution-noncommercial", "attribution-sharealike",
    "attribution-noncommercial-noderivatives", "attribution-noncommercial-sharealike",
)
#: Public licenses whose whole texts are templates.
BODIES = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "CC-BY-SA-4.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0")
TEMPLATES = NOTICES + tuple((n, "body", (Path(__file__).parent / "license_texts" / f"{n}.txt").read_text("utf-8")) for n in BODIES)
#: Function words, the last to stand for a short notice.
COMMON = ("a", "all", "is", "of", "the", "this", "under", "work")
MIX = np.uint64(0x9E3779B97F4A7C15)
ENDS = re.compile(r"^\W+|\W+$")
CACHE_WORDS = 400_000


class WordHashes(dict):
    """Hashes of normalised words; a bounded memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(ENDS.sub("", word.decode().lower()))
        return h


WORDS = WordHashes()


def word_hashes(text: str) -> np.ndarray:
    words = text.encode().split()
    return np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))


def winnowed(h: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, places) of a word hash sequence."""
    if len(h) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    grams = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        grams = (grams + h[j : len(h) - k + 1 + j]) * MIX
        grams ^= grams >> np.uint64(31)
    if len(grams) <= window:
        places = np.asarray([int(grams.argmin())])
    else:
        views = np.lib.stride_tricks.sliding_window_view(grams, window)
        places = np.unique(views.argmin(1) + np.arange(len(views)))
    return grams[places], places


def needed(n: int, least: float) -> int:
    """The least number of matched words that is a share ``least`` of ``n``."""
    m = math.ceil(least * n)
    return m if m - 1 < least * n else m - 1


def anchors(text: str, least: float, deciding: list[str]) -> list[int]:
    """Places of a short notice's words of which at least one is in every match: a deciding word, or else the longest,
    function words last."""
    words = [ENDS.sub("", w.decode().lower()) for w in text.encode().split()]
    if deciding:
        return [p for p, w in enumerate(words) if w == deciding[0]]
    missing = len(words) - needed(len(words), least)
    return sorted(range(len(words)), key=lambda p: (words[p] in COMMON, -len(words[p]), p))[: missing + 1]


class Prints:
    """An inverted index: (print, template, place) in order."""

    def __init__(self, found: list[tuple[int, int, int]]):
        found.sort()
        self.prints = np.asarray([f for f, _, _ in found], np.uint64)
        self.template = np.asarray([t for _, t, _ in found], np.int64)
        self.place = np.asarray([p for _, _, p in found], np.int64)

    def hits(self, prints: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, place in the text, diagonal) of every common fingerprint."""
        lo, hi = np.searchsorted(self.prints, prints, "left"), np.searchsorted(self.prints, prints, "right")
        return [(int(self.template[j]), int(places[i]), int(places[i]) - int(self.place[j])) for i in np.flatnonzero(hi > lo) for j in range(lo[i], hi[i])]


class Index:
    """The templates' words, fingerprints of the long ones and anchors of the short ones."""

    def __init__(self, templates, k: int, window: int, least: float, short: int):
        self.k, self.window, self.least = k, window, least
        self.words = [word_hashes(text) for _, _, text in templates]
        self.needed = [needed(len(w), least) for w in self.words]
        brief = [t for t, w in enumerate(self.words) if len(w) <= short]
        self.long = Prints([(f, t, p) for t, h in enumerate(self.words) if t not in brief for f, p in zip(*winnowed(h, k, window))])
        deciding = [DECIDING.get((license_, kind), "").split() for license_, kind, _ in templates]
        self.short = Prints([(self.words[t][p], t, p) for t in brief for p in anchors(templates[t][2], least, deciding[t])])
        self.deciding = [word_hashes(" ".join(d)) for d in deciding]
        self.qualifiers = word_hashes(" ".join(QUALIFIERS))
        self.own = [self.qualified(w) for w in self.words]

    def qualified(self, words: np.ndarray) -> np.ndarray:
        """How often each qualifier occurs."""
        return (words[:, None] == self.qualifiers).sum(0) if len(words) < 1_000 else np.array([np.count_nonzero(words == q) for q in self.qualifiers])

    def decided(self, t: int, span: np.ndarray) -> bool:
        """Whether a matched span's words leave no other license than the template's."""
        return bool(np.isin(self.deciding[t], span).all() and (self.qualified(span) <= self.own[t]).all())

    def hits(self, h: np.ndarray) -> list[tuple[int, int, int]]:
        return self.long.hits(*winnowed(h, self.k, self.window)) + self.short.hits(h, np.arange(len(h)))


def aligned_wide(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """:func:`aligned` by whole rows, for wide bands; (matched, start, end) are the digits of one number."""
    width, base, bits = high - low + 1, max(low, 0), 21
    most, one = (1 << bits) - 1, 1 << 2 * bits
    at = np.arange(low, high + len(template))
    inside = (at >= 0) & (at < len(text))
    row, at = np.zeros(width + 1, np.int64), at - base
    for i, w in enumerate(template):
        c = np.flatnonzero(inside[i : i + width])
        c = c[text[c + (i + low)] == w]
        j, now = at[c + i], row[1:].copy()
        grown = np.where(row[c] > 0, (row[c] & ~most) + one, one + (j << bits)) + (most - j - 1)
        now[c] = np.maximum(now[c], grown)
        np.maximum.accumulate(now, out=row[:-1])
    found = {(int(x) >> 2 * bits, base + (int(x) >> bits & most), base + most - (int(x) & most)) for x in np.unique(row[row > 0])}
    return min(found, key=tightest, default=(0, 0, 0))


def tightest(match: tuple[int, int, int]) -> tuple[int, int, int]:
    """Orders (matched, start, end): most words, then the shorter, then the earlier span."""
    return -match[0], match[2] - match[1], match[1]


def aligned(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(matched words, first word, word after the last) of the longest chain of equal words, of template word i with
    text words i + low to i + high. Ties go to the shorter, then the earlier span."""
    width = high - low + 1
    if width > 64 and width + len(template) < 1 << 21:
        return aligned_wide(template, text, low, high)
    none = (0, 0, 0)  # matched, start, minus end: larger is better
    row = [none] * width
    for i, w in enumerate(template.tolist()):
        now, left = [none] * width, none
        for c in range(width):
            j = i + low + c
            best = max(row[c + 1] if c + 1 < width else none, left)
            if 0 <= j < len(text) and int(text[j]) == w:
                m, start, _ = row[c]
                best = max(best, (m + 1, start if m else j, -(j + 1)))
            now[c] = left = best
        row = now
    return min(((m, start, -end) for m, start, end in row), key=tightest)


def equal_words(words: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the template, diagonal) of every pair of equal words, in the order of diagonals."""
    order = np.argsort(window, kind="stable")
    lo, hi = (np.searchsorted(window[order], words, side) for side in ("left", "right"))
    count = hi - lo
    place = np.repeat(np.arange(len(words)), count)
    within = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
    diagonal = order[np.repeat(lo, count) + within] - place
    by = np.argsort(diagonal, kind="stable")
    return place[by], diagonal[by]


def best_in(window: np.ndarray, diagonals: list[int], words: np.ndarray, need: int, band: int) -> tuple[int, int, int] | None:
    """(matched, start, end) of the best match in a window, diagonals counted from its first word; None if none has
    ``need`` words. Diagonals within ``band`` of each other are aligned together, if their band holds equals of enough
    of the template's words at all."""
    if len(window) < need or np.count_nonzero(np.isin(words, window)) < need:
        return None
    place, at = equal_words(words, window)
    found, low = [], diagonals[0]
    for high, after in zip(diagonals, [*diagonals[1:], None]):
        if after is None or after - high > band:
            inside = place[np.searchsorted(at, low - band, "left") : np.searchsorted(at, high + band, "right")]
            if len(inside) >= need and len(np.unique(inside)) >= need:
                found.append(aligned(words, window, low - band, high + band))
            low = after
    best = min(found, key=tightest, default=(0, 0, 0))
    return best if best[0] >= need else None


def occurrences(h: np.ndarray, hits: list[tuple[int, int]], words: np.ndarray, need: int, band: int, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """(matched, start, end) of a template's matches in ``h[lo:hi]``, none overlapping; ``hits``: sorted (place, diagonal)."""
    span, out = 2 * len(words) + 2 * band, []
    k = bisect_left(hits, (lo,))
    while k < len(hits) and hits[k][0] < hi:
        place = hits[k][0]
        start, stop = max(lo, place - span), min(hi, place + 2 * span)
        near = sorted({d - start for p, d in hits[bisect_left(hits, (start,)) : bisect_left(hits, (stop,))]})
        best = best_in(h[start:stop], near, words, need, band)
        if best is None:
            k = bisect_left(hits, (place + span,))
            continue
        m, a, b = best[0], best[1] + start, best[2] + start
        out += occurrences(h, hits, words, need, band, start, a)
        if a < place + span:
            out.append((m, a, b))
            lo = b
        else:  # it may be cut off at the window's end: its own window comes later
            lo = min(a, place + span)
        k = bisect_left(hits, (lo,))
    return out


def candidates(h: np.ndarray, index: Index, band: int) -> list[tuple]:
    """(matched, coverage, first word, word after the last, template) of all candidates that match enough."""
    by: dict[int, set] = {}
    for t, place, d in index.hits(h):
        by.setdefault(t, set()).add((place, d))
    found = []
    for t, hits in by.items():
        words = index.words[t]
        found += [(m, m / len(words), a, b, t) for m, a, b in occurrences(h, sorted(hits), words, index.needed[t], band, 0, len(h)) if index.decided(t, h[a:b])]
    return found


def matches(text: str, index: Index, names, band: int) -> list[tuple]:
    """(license, template, matched, coverage, start, end) of a text, in order; start and end in code points."""
    found = candidates(word_hashes(text), index, band)
    if not found:
        return []
    spans = [x.span() for x in re.finditer(WORD, text)]
    out, taken = [], []
    for m, share, start, end, t in sorted(found, key=lambda c: (-c[0], -c[1], c[2], c[4])):
        k = bisect_left(taken, (end,))  # the last span that begins before the end
        if not k or taken[k - 1][1] <= start:
            taken.insert(k, (start, end))
            out.append((names[t][0], names[t][1], m, share, spans[start][0], spans[end - 1][1]))
    return sorted(out, key=lambda x: x[4])


def scan(docs: DataFrame, templates=TEMPLATES, k: int = 3, window: int = 2, band: int = 8, least: float = 0.8, short: int = 15, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per match: key, license, template, matched_words, coverage, start, end."""

    def run(batches):
        index = Index(templates, k, window, least, short)
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 256):
                for i, t in enumerate(batch.column(1).slice(at, 256).to_pylist(), at):
                    rows += [(i, *m) for m in matches(t, index, templates, band)]
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.string(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, t) for c, t in zip(columns[1:], types))], names=[key, "license", "template", "matched_words", "coverage", "start", "end"])

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, license string, template string, matched_words long, coverage double, start long, end long"
    return docs.select(docs[key], text_of(docs, text).alias("text")).mapInArrow(run, schema)


def op9_license_scan(spark, sf_dir) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
