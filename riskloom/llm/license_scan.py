"""License scans by patience alignment of license templates with texts.

A template and a stretch of text are aligned on the words that occur exactly
once in both: of these anchors the longest increasing subsequence is kept,
and the gaps between kept anchors are aligned the same way, where other
words are now unique. Coverage is the share of template words aligned; a
template is found where coverage reaches ``min_coverage``.

A text may hold a license more than once, which leaves no unique word in the
whole of it. So a template is aligned within stretches of ``n`` and of
``2 n + 8`` words that begin at a template word, left to right. The first
stretch that reaches the coverage may begin in the prose before a license and
end within it, so stretches from later starts that keep most of its alignment
are tried, too, and the one with most words aligned, then the shortest, is the
find. The scan goes on behind it. Texts and stretches that cannot reach the coverage, because too
few template words occur in them at all, are passed over; that bound loses
nothing.

Defined cases: null and empty texts, and texts without a find, give one row
with a null license and coverage 0; a tie between templates goes to the one
with more words, then by name; repeated rows are scanned alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame

from riskloom.llm.common import map_text, read_table
from riskloom.llm.decontaminate import words_of

MIN_COVERAGE = 0.8

#: fixed values: public license notices and texts, as users paste them
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-line": "Released under the MIT License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."),
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."),
}

FIELDS = ("n_words bigint, license string, coverage double, n_finds bigint, "
          "finds array<struct<license:string,coverage:double,start_word:int,end_word:int>>")


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
        back.append(at[k - 1] if k else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned (text, template) positions, increasing in both."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        in_b = Counter(template[b0:b1])
        in_a = Counter(w for w in text[a0:a1] if w in in_b)
        where = {template[j]: j for j in range(b0, b1)}
        pairs = [(i, where[text[i]]) for i in range(a0, a1) if in_a[text[i]] == 1 and in_b[text[i]] == 1]
        kept = [pairs[k] for k in increasing([j for _, j in pairs])]
        if not kept:
            continue
        found += kept
        pa, pb = a0 - 1, b0 - 1
        for i, j in [*kept, (a1, b1)]:
            todo.append((pa + 1, i, pb + 1, j))
            pa, pb = i, j
    return sorted(found)


def align(words: list, start: int, template: list, need: int) -> list[tuple[int, int]]:
    """Aligned (word, template) positions of the stretch from ``start``, the longer one if the first has under ``need``."""
    # a stretch of the template's own length first: a copy right behind would leave no unique word
    pairs = patience(words[start:start + len(template)], template)
    if len(pairs) < need:
        pairs = patience(words[start:start + 2 * len(template) + 8], template)
    return [(start + i, j) for i, j in pairs]


class LicenseScanner:
    def __init__(self, templates: dict[str, str], min_coverage: float = MIN_COVERAGE) -> None:
        self.items = [(name, words_of(t.encode())) for name, t in templates.items()]
        self.items = sorted(((n, w) for n, w in self.items if w), key=lambda x: (-len(x[1]), x[0]))
        self.counts = [Counter(w) for _, w in self.items]
        self.vocab = frozenset(w for _, t in self.items for w in t)
        self.needs = [math.ceil(min_coverage * len(w) - 1e-9) for _, w in self.items]

    @staticmethod
    def widest(words: list, start: int, at: list[int], k: int, template: list, counts: Counter,
               pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The best alignment of the license that ``pairs``, found from ``start`` = ``at[k]``, lie in.

        Alignments that share at most half of ``pairs`` are of another copy and
        left to the scan; no start behind the middle pair can share more.
        """
        n, size, found = len(template), 2 * len(template) + 8, set(pairs)

        def rank(p):
            return len(p), p[0][0] - p[-1][0]

        best = pairs
        # where the license begins if no word was added or lost before the middle pair: mostly right at once
        i, j = pairs[len(pairs) // 2]
        for s in [max(start, i - j), *at[k:bisect_left(at, i + 1)]]:
            if len(best) == n and rank(best)[1] == 1 - n:
                break
            here = Counter(words[x] for x in at[bisect_left(at, s):bisect_left(at, s + size)])
            if sum(min(c, counts[w]) for w, c in here.items()) < len(best):
                continue
            for length in (n, size):
                p = [(s + x, y) for x, y in patience(words[s:s + length], template)]
                if p and rank(p) > rank(best) and 2 * len(found.intersection(p)) > len(found):
                    best = p
        return best

    def scan(self, text: bytes | None):
        words = words_of(text)
        present = self.vocab.intersection(words)
        finds = []
        for (name, template), counts, need in zip(self.items, self.counts, self.needs):
            if sum(counts[w] for w in present if w in counts) < need:
                continue
            size = 2 * len(template) + 8
            at = [i for i, w in enumerate(words) if w in counts]
            k = 0
            while k < len(at):
                start = at[k]
                k1 = bisect_left(at, start + size)
                # at most min(count here, count in template) of each word can align
                here = Counter(words[i] for i in at[k:k1]) if k1 - k >= need else None
                if here is None or sum(min(c, counts[w]) for w, c in here.items()) < need:
                    k += 1
                    continue
                pairs = align(words, start, template, need)
                if len(pairs) < need:
                    k += 1
                    continue
                pairs = self.widest(words, start, at, k, template, counts, pairs)
                first, last = pairs[0][0], pairs[-1][0]
                finds.append((name, len(pairs) / len(template), first, last + 1))
                k = bisect_left(at, last + 1)
        best = max(finds, key=lambda f: f[1], default=None)  # templates are ordered: ties go to the first
        return len(words), best and best[0], best[1] if best else 0.0, len(finds), [
            {"license": f[0], "coverage": f[1], "start_word": f[2], "end_word": f[3]} for f in finds]


def license_scan(docs: DataFrame, keep: list[str], templates: dict[str, str] | None = None,
                 min_coverage: float = MIN_COVERAGE, text: str = "text") -> DataFrame:
    """``keep`` columns, the best license with its coverage, and every find with its words."""
    chosen = dict(TEMPLATES if templates is None else templates)

    def make():
        scanner = LicenseScanner(chosen, min_coverage)

        def f(texts):
            rows = [scanner.scan(t) for t in texts]
            return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(5)]
        return f
    return map_text(docs, keep, make, FIELDS, text=text)


def op6_license_scan(spark, sf_dir):
    """License notices and texts in all documents."""
    return license_scan(read_table(spark, sf_dir, "documents"), ["doc_id"])
