"""License notices in documents: winnowed fingerprints, then banded alignment.

Templates are word sequences. The hashes of their ``GRAM``-word sequences are winnowed
(the smallest of every ``WINDOW`` in a row) into an inverted index of bounded size that
goes to the workers. Documents are winnowed alike; by the guarantee of winnowing, any
``GRAM + WINDOW - 1`` words in a row that a document shares with a template give a hit. A notice without such a
run may be missed: four of the five words of a one-line statement are no sure hit.
Hits of one template on near diagonals form a candidate, which a local alignment inside
a band around the diagonal turns into matched words, coverage and span. Of overlapping
matches the one with more matched words stays; of equal ones that of the shorter
template, then the template's name and the place in the text decide.

A document is read once in its task and nothing is shuffled.

Edge cases: null and empty texts have no match. Words are runs of letters and digits in
lower case. Repeated notices in a text, and repeated rows, are reported each. An empty
table gives no rows; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.llm.common import text_of

GRAM = 3
WINDOW = 3
MIN_COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+")

# Notices as projects publish them, without names and years.
TEMPLATES: dict[str, str] = {
    "Apache-2.0 statement": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0 statement": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 statement": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 statement": "Licensed under CC BY-NC 4.0.",
    "GPL statement": "This work is licensed under the GNU General Public License, version 3.",
    "MIT statement": "Released under the MIT License.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
        "the distribution."
    ),
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}

FIELDS = "template string, template_words long, matched_words long, coverage double, start long, end long"


def winnowed(ids: np.ndarray, words: int) -> dict[int, int]:
    """``position: fingerprint`` of a sequence of word numbers; -1 is a word of no template.

    Sequences with such a word cannot match and never win a window.
    """
    n = len(ids) - GRAM + 1
    if n < 1:
        return {}
    code, valid = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(GRAM):
        part = ids[k : k + n]
        code = code * (words + 1) + part + 1
        valid &= part >= 0
    if not valid.any():
        return {}
    mixed = (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)
    order = np.where(valid, mixed.astype(np.int64), np.iinfo(np.int64).max)
    width = min(WINDOW, n)
    windows = np.lib.stride_tricks.sliding_window_view(order, width)
    # The rightmost smallest of each window.
    at = np.arange(len(windows)) + width - 1 - np.argmin(windows[:, ::-1], axis=1)
    at = np.unique(at[valid[at]])
    return dict(zip(at.tolist(), code[at].tolist(), strict=True))


def align(t: list[int], d: list[int], diagonal: int, band: int) -> list[tuple[int, int]]:
    """Matched positions of the best local alignment with ``|j - i - diagonal| <= band``.

    A match counts 2, a gap or a replaced word -1.
    """
    width = 2 * band + 1
    previous = [0] * (width + 2)
    back, best, end = [], 0, None
    for i, word in enumerate(t):
        row, step = [0] * (width + 2), bytearray(width)
        for k in range(width):
            j = i + diagonal - band + k
            if not 0 <= j < len(d):
                continue
            through = previous[k + 1] + (2 if d[j] == word else -1)
            up, left = previous[k + 2] - 1, row[k] - 1
            score = max(0, through, up, left)
            row[k + 1] = score
            step[k] = 0 if not score else 1 if score == through else 2 if score == up else 3
            if score > best:
                best, end = score, (i, k)
        back.append(step)
        previous = row
    found = []
    while end is not None:
        i, k = end
        if i < 0 or not 0 <= k < width or not back[i][k]:
            break
        j = i + diagonal - band + k
        if back[i][k] == 1:
            if t[i] == d[j]:
                found.append((i, j))
            end = (i - 1, k)
        else:
            end = (i - 1, k + 1) if back[i][k] == 2 else (i, k - 1)
    return found[::-1]


class LicenseIndex:
    """Inverted index of the fingerprints of templates."""

    def __init__(self, templates: Mapping[str, str]):
        words = {n: [w.lower() for w in WORD.findall(t)] for n, t in templates.items()}
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for t in words.values() for w in t}))}
        self.templates = {n: [self.vocabulary[w] for w in t] for n, t in words.items()}
        self.index: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, ids in self.templates.items():
            for at, code in winnowed(np.array(ids, np.int64), len(self.vocabulary)).items():
                self.index[code].append((name, at))

    def candidates(self, ids: np.ndarray) -> list[tuple[str, int, int]]:
        """(template, first diagonal, last diagonal) of hits that lie near each other."""
        hits = defaultdict(set)
        for at, code in winnowed(ids, len(self.vocabulary)).items():
            for name, where in self.index.get(code, ()):
                hits[name].add(at - where)
        found = []
        for name, diagonals in hits.items():
            near = self.band(name)
            run: list[int] = []
            for x in sorted(diagonals):
                if run and x - run[0] > near:
                    found.append((name, run[0], run[-1]))
                    run = []
                run.append(x)
            found.append((name, run[0], run[-1]))
        return found

    def band(self, name: str) -> int:
        return max(4, len(self.templates[name]) // 8)

    def scan(self, text: str | None, least: float = MIN_COVERAGE) -> list[tuple]:
        """Matches of a text in order: template, its words, matched words, coverage, span."""
        if not text:
            return []
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in WORD.findall(text.lower())], np.int64)
        found = self.candidates(ids) if (ids >= 0).sum() >= GRAM else []
        if not found:
            return []
        d, matches = ids.tolist(), []
        for name, first, last in found:
            t = self.templates[name]
            pairs = align(t, d, (first + last) // 2, self.band(name) + (last - first + 1) // 2)
            if pairs and len(pairs) >= least * len(t):
                matches.append((len(pairs), name, pairs[0][1], pairs[-1][1]))
        matches.sort(key=lambda m: (-m[0], len(self.templates[m[1]]), m[1], m[2]))
        # Spans kept so far do not overlap, so the neighbours in order decide.
        kept: list[tuple] = []
        for m in matches:
            at = bisect_left(kept, m[2], key=lambda k: k[2])
            if (at == 0 or kept[at - 1][3] < m[2]) and (at == len(kept) or kept[at][2] > m[3]):
                kept.insert(at, m)
        if not kept:
            return []
        # Lower case may change lengths, so places come from the text as it is.
        spans = [x.span() for x in WORD.finditer(text)]
        if len(spans) != len(d):
            spans = [x.span() for x in WORD.finditer(text.lower())]
        return [
            (name, len(self.templates[name]), n, n / len(self.templates[name]), spans[a][0], spans[b][1])
            for n, name, a, b in kept
        ]


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = MIN_COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: id, template, matched words, coverage, and the span in characters."""
    index = LicenseIndex(templates)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))
    fields = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(FIELDS)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in fields]
        types = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        for batch in batches:
            at, matches = [], []
            for k, text in enumerate(batch.column("text")):
                found = index.scan(text.as_py(), least)
                at += [k] * len(found)
                matches += found
            ids = batch.column("doc_id").take(pa.array(at, pa.int64()))
            columns = list(zip(*matches, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns, types)], names=names)

    return rows.mapInArrow(find, fields)
