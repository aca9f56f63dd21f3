"""License scans by patience alignment.

A template and a stretch of text are anchored on the words that stand once in either.  The
longest increasing run of these anchors is kept, and the gaps between two anchors are aligned
the same way; where a gap has no such word, its longest common subsequence counts.  Coverage
is the share of the template's words that are matched.

A text is cut into stretches that overlap by more than a template can stretch, so every
notice stands whole in one of them.  Only stretches that hold enough of the template's words to
reach the coverage are aligned.  All texts are read in full; nothing is shuffled.

Words are lower-cased and split at blanks and ASCII punctuation.

Defined cases: null and empty texts have no words and match nothing, nor do templates without
words; equal templates are reported each; of two stretches with the same coverage the first
counts; repeated rows are reported each; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.decontaminate import words_of

#: Share of a template's words that a notice must match, and the most words between its first
#: and last match, as a multiple of the template's.
COVERAGE, STRETCH = 0.8, 1.25

# Public short notices and the telling parts of public license texts.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "BSD-3-Clause line": "Use of this source code is governed by a BSD-style license.",
    "rights reserved": "All rights reserved.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "BSD conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
}
COLUMNS = {
    "license": "string",
    "coverage": "double",
    "matched": "long",
    "n_words": "long",
    "first_word": "long",
    "last_word": "long",
}


def _longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of ``pairs`` in order of their first number, the longest run whose second numbers rise."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(tails, b)
        tails[at : at + 1], ends[at : at + 1] = [b], [k]
        back.append(ends[at - 1] if at else -1)
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence as pairs of places; both sides are short."""
    rows = [[0] * (len(b) + 1)]
    for x in a:
        last, row = rows[-1], [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1] and rows[i][j] == rows[i - 1][j - 1] + 1:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rows[i - 1][j] >= rows[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def align(template: list, text: list) -> list[tuple[int, int]]:
    """Matched places of template and text, both rising."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(text))]
    while todo:
        i, j, k, m = todo.pop()
        if i >= j or k >= m:
            continue
        here, there = Counter(template[i:j]), Counter(text[k:m])
        places = {w: n for n, w in enumerate(text[k:m], k) if there[w] == 1}
        anchors = _longest_rising([(n, places[w]) for n, w in enumerate(template[i:j], i) if here[w] == 1 and w in places])
        if not anchors:
            out += [(i + a, k + b) for a, b in _common(template[i:j], text[k:m])]
            continue
        out += anchors
        for (a, b), (c, d) in zip([(i - 1, k - 1), *anchors], [*anchors, (j, m)], strict=True):
            todo.append((a + 1, c, b + 1, d))
    return sorted(out)


def _dense(pairs: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """The longest part of ``pairs`` that spans at most ``most`` words of the text."""
    best, start = (0, 0), 0
    for end in range(len(pairs)):
        while pairs[end][1] - pairs[start][1] >= most:
            start += 1
        if end + 1 - start > best[1] - best[0]:
            best = start, end + 1
    return pairs[best[0] : best[1]]


class Templates:
    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.items = [(name, w, Counter(w)) for name, t in templates.items() if (w := words_of(t))]

    def scan(self, text: str | None) -> Iterator[tuple[str, float, int, int, int, int]]:
        """license, coverage, matched words, template words, first and last (exclusive) word of the best notice."""
        words = words_of(text)
        held = set(words)
        for name, template, counts in self.items:
            need = self.coverage * len(template)
            if sum(c for w, c in counts.items() if w in held) < need:
                continue
            n, best = int(STRETCH * len(template)) + 1, None
            places = [k for k, w in enumerate(words) if w in counts]
            for start in self._stretches(words, places, counts, n, need):
                pairs = _dense(align(template, words[start : start + 2 * n]), n)
                if len(pairs) >= need and (best is None or len(pairs) > best[0]):
                    best = len(pairs), start + pairs[0][1], start + pairs[-1][1] + 1
            if best:
                yield name, best[0] / len(template), best[0], len(template), best[1], best[2]

    def _stretches(self, words: list, places: list[int], counts: Counter, n: int, need: float) -> Iterator[int]:
        """Starts of stretches of 2n words, n apart, that hold enough of the template's words."""
        for block in sorted({max(0, p // n - d) for p in places for d in (0, 1)}):
            seen = Counter(words[block * n : (block + 2) * n])
            if sum(min(c, seen[w]) for w, c in counts.items()) >= need:
                yield block * n


def scan_licenses(docs: DataFrame, key: list[str], templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """``key`` columns of ``docs``, license, coverage, matched, n_words (of the template), first_word, last_word (exclusive).

    One row, the best notice, for each row of ``docs`` and template that reaches ``coverage``.
    """
    scanner = Templates(templates, coverage)

    @F.pandas_udf(f"array<struct<{', '.join(f'{c}: {t}' for c, t in COLUMNS.items())}>>")
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(COLUMNS, f, strict=True)) for f in scanner.scan(t)] for t in texts])

    return docs.select(*key, F.inline(scan("text")))
