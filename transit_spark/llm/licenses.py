"""License texts in documents, by patience alignment with templates."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import in_batches, table

# Notices as their licenses word them.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0.",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 2.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "CC-BY-NC-4.0": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."),
}
COVERAGE = 0.85
#: A window that is aligned is longer than the template by this share, for words that were put in.
SPARE = 0.25
WORD = r"[\p{L}\p{N}]+"


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, ascending on both sides.

    Words that are unique in both are anchors; the longest ascending sequence of them is kept
    (patience sorting), and the gaps between its members are aligned in the same way. Equal words at the
    borders of a gap pair off first; a gap without an anchor pairs nothing more.
    """
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        ours, theirs = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {w: i for i, w in enumerate(b[b0:b1], b0) if theirs[w] == 1}
        anchors = [(i, at[w]) for i, w in enumerate(a[a0:a1], a0) if ours[w] == 1 and w in at]
        kept = _longest_ascending(anchors)
        if not kept:
            continue
        out += kept
        borders = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(borders, borders[1:])]
    return sorted(out)


def _longest_ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence whose second places ascend; the first ones do already."""
    tops: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, place) in enumerate(pairs):
        pile = bisect_left(tops, place)
        before[n] = last[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(place)
            last.append(n)
        else:
            tops[pile], last[pile] = place, n
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


class Scanner:
    """Finds templates in texts."""

    def __init__(self, templates: dict[str, tuple[str, ...]], coverage: float):
        import regex

        self.pattern, self.coverage = regex.compile(WORD), coverage
        self.templates = [(name, [w.lower() for w in self.pattern.findall(t)]) for name, texts in templates.items() for t in texts]
        spread = Counter(w for _, words in self.templates for w in set(words))
        #: A template can reach the coverage only if one of so many of its words is there: its rarest ones.
        self.hints: dict[str, list[tuple[int, int]]] = {}
        for number, (_, words) in enumerate(self.templates):
            ranked = sorted(set(words), key=lambda w: (spread[w], words.count(w), -len(w), w))
            need, missed = coverage * len(words), 0
            for word in ranked:
                self.hints.setdefault(word, []).extend((number, at) for at, w in enumerate(words) if w == word)
                missed += words.count(word)
                if len(words) - missed < need:
                    break
        self.any_hint = regex.compile(r"(?i)\b(?:" + "|".join(sorted(map(regex.escape, self.hints), key=len, reverse=True)) + r")\b")

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(license, first character, end, coverage) of each place found, best first where places overlap."""
        if not text or not self.any_hint.search(text):
            return []
        spans = [(m.start(), m.end()) for m in self.pattern.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        places: dict[int, list[tuple[int, int]]] = {}
        for at, word in enumerate(words):
            for number, place in self.hints.get(word, ()):
                places.setdefault(number, []).append((at, place))
        found = []
        for number, hints in places.items():
            name, template = self.templates[number]
            n = len(template)
            spare, done = max(2, int(SPARE * n)), 0
            for hint, place in hints:
                if hint < done:
                    continue
                # Where the template would have to stand, with room for words put in or left out on both sides.
                first, end = max(0, hint - place - spare, done), min(len(words), hint - place + n + spare)
                pairs = self._best_stretch(align(words[first:end], template), n + spare)
                if len(pairs) >= self.coverage * n:
                    a, b = first + pairs[0][0], first + pairs[-1][0]
                    found.append((len(pairs) / n, n, name, spans[a][0], spans[b][1]))
                    done = b + 1
        out = []
        for share, _, name, start, end in sorted(found, key=lambda f: (-f[0] * f[1], f[3], f[2])):
            if all(end <= s or start >= e for _, s, e, _ in out):
                out.append((name, start, end, round(share, 6)))
        return sorted(out, key=lambda f: f[1])

    @staticmethod
    def _best_stretch(pairs: list[tuple[int, int]], reach: int) -> list[tuple[int, int]]:
        """The most pairs within ``reach`` words of the text."""
        best, low = (0, 0), 0
        for high in range(len(pairs)):
            while pairs[high][0] - pairs[low][0] >= reach:
                low += 1
            if high + 1 - low > best[1] - best[0]:
                best = (low, high + 1)
        return pairs[best[0] : best[1]]


_SCANNERS: dict = {}


def scan_licenses(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, coverage: float = COVERAGE, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the licenses found in its whole text and their places.

    ``matches`` lists license, first character, end (from 0, end excluded) and coverage: the share of
    the template's words that the alignment finds in their order; at least ``coverage`` counts. Case
    and signs are ignored. Overlapping finds yield to the one with more words. A null, empty or
    wordless text has none; ids may be null or repeat; other columns are not read; no rows in, none
    out.
    """
    templates = TEMPLATES if templates is None else templates
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def find(batch: pd.DataFrame) -> pd.DataFrame:
        key = (str(templates), coverage)
        scanner = _SCANNERS.get(key) or _SCANNERS.setdefault(key, Scanner(templates, coverage))
        found = [[{"license": m[0], "first": m[1], "end": m[2], "coverage": m[3]} for m in scanner.scan(t)] for t in batch["text"]]
        return pd.DataFrame({"doc_id": batch["doc_id"], "matches": pd.Series(found, dtype=object, index=batch.index)})

    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, matches array<struct<license: string, first: int, end: int, coverage: double>>"
    return rows.mapInPandas(in_batches(find), schema)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses named or quoted in each document."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    names = F.array_join(F.array_distinct(F.transform("matches", lambda m: m["license"])), ",")
    return found.select("doc_id", F.size("matches").alias("n_matches"), names.alias("licenses"), F.to_json("matches").alias("matches"))


QUERIES = {"op2_license_scan": op2_license_scan}
ORACLES: dict[str, str] = {}
