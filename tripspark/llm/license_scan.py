"""Operator 1: license scan.

Templates are cut into words; their winnowed gram fingerprints form an inverted
index, in which every gram of a document is looked up. A template's coverage
limit allows a number of changed, dropped or added words, and these leave a run
of unchanged words somewhere: grams are no longer than this run (three words at
most), and a template of up to ``LONG`` words is winnowed only as far as the run
still holds a fingerprint, so no such match is missed whatever lies around it.
Longer templates keep one fingerprint in every ``WINDOW`` grams.

Each hit says where in the text the template would begin. A banded local
alignment compares text and template there word by word, and a span that covers
at least ``min_coverage`` of the template's words is reported. Alignments of the
same template do not enter spans already reported, so copies side by side are a
row each.

The templates are a parameter and their size is checked (``MAX_TEMPLATE_BYTES``)
before they travel to the tasks. The documents are read once, without a
shuffle.

Defined cases: a null or empty text matches nothing; templates without words
are ignored; null ids, repeated rows and extra columns do no harm; an empty
table gives no rows. Overlapping matches of different templates are all
reported; spans of one template do not overlap. Matches with more edits than the
coverage limit allows as changed words (through many added words) may be missed.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripspark.llm import runtime, words

GRAM, WINDOW, BAND = 3, 3, 8
LONG = 32  # words of templates that are always winnowed
MIN_COVERAGE = 0.75
MAX_TEMPLATE_BYTES = 16 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
SCHEMA = ("doc_id long, template string, matched_words int, template_words int, coverage double, "
          "char_start long, char_end long, byte_start long, byte_end long")

# Notices, headers and short licenses as published.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit-line": "Released under the MIT License.",
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-3-clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-disclaimer": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "agpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "bsl-1.0-header": "Distributed under the Boost Software License, Version 1.0.",
    "cc0-1.0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "spdx-identifier-mit": "SPDX-License-Identifier: MIT",
    "spdx-identifier-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-4.0-line": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

_LETTERS = np.zeros(256, np.uint8)  # A-Z lower-cased, other ASCII than letters and digits to space
_LETTERS[:] = ord(" ")
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _LETTERS[_b] = _b
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)


def _words(data: np.ndarray, offs: np.ndarray):
    plain = _LETTERS[data]
    starts, ends, rows = words.word_spans(plain, offs)
    return words.span_hashes(plain, starts, ends), starts, ends, rows


def winnow(grams: np.ndarray, row: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Indices of the fingerprints kept: the smallest of each ``window``
    consecutive grams of a row (the last of equals); all of a row with fewer."""
    n = len(grams)
    keep = np.zeros(n, bool)
    if n >= window:
        views = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
        pick = np.arange(len(views)) + window - 1 - views.argmin(1)
        whole = row[:len(views)] == row[window - 1:]
        keep[pick[whole]] = True
    count = np.bincount(row, minlength=1) if n else np.zeros(1, int)
    if n:
        keep |= (count < window)[row]
    return np.flatnonzero(keep)


def sure_run(n: int, need: int) -> int:
    """Words of the longest run that ``n - need`` edits leave in ``n`` words."""
    edits = n - need
    return -(-need // (edits + 1))


class Index:
    """Templates as word hashes, and the inverted index of their fingerprints,
    for each gram length in use."""

    def __init__(self, templates: dict[str, str], min_coverage: float = MIN_COVERAGE):
        if sum(len(t.encode()) for t in templates.values()) > MAX_TEMPLATE_BYTES:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_BYTES} bytes")
        column = pa.array(list(templates.values()), pa.string())
        hashes, _, _, rows = _words(*words.text_bytes(column))
        self.names = list(templates)
        self.words = [hashes[a:b] for a, b in zip(rows[:-1], rows[1:])]
        self.need = [math.ceil(min_coverage * len(w) - 1e-9) for w in self.words]
        entries: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for t, (w, need) in enumerate(zip(self.words, self.need)):
            if not len(w):
                continue
            run = sure_run(len(w), max(need, 1))
            gram = min(GRAM, run)
            grams, at, _ = words.shingles(w, np.array([0, len(w)]), gram)
            kept = winnow(grams, np.zeros(len(grams), np.int64), WINDOW if len(w) > LONG else min(WINDOW, run - gram + 1))
            entries.setdefault(gram, []).append((grams[kept], np.full(len(kept), t), at[kept]))
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for gram, parts in entries.items():
            g, t, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(g, kind="stable")
            self.grams[gram] = g[order], t[order], at[order]

    def hits(self, gram: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each occurrence of a gram in the index: which gram of the
        input, template, position."""
        known, template, at = self.grams[gram]
        low, high = np.searchsorted(known, grams, "left"), np.searchsorted(known, grams, "right")
        count = high - low
        which = np.repeat(np.arange(len(grams)), count)
        entry = np.repeat(low, count) + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        return which, template[entry], at[entry]


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """Best local alignment within ``band`` of text position = template
    position + ``diagonal``: matched words, first and last + 1 text word."""
    m, width = len(template), 2 * band + 1
    score = np.zeros((m + 1, width), np.int32)
    slide = GAP * np.arange(width)
    for i in range(1, m + 1):
        j = i - 1 + diagonal + np.arange(-band, band + 1)  # text word compared
        ok = (j >= 0) & (j < len(text))
        same = np.zeros(width, bool)
        same[ok] = text[j[ok]] == template[i - 1]
        here = score[i - 1] + np.where(same, MATCH, MISMATCH)
        here[:-1] = np.maximum(here[:-1], score[i - 1][1:] + GAP)  # template word left out
        here = np.maximum(np.where(ok, here, 0), 0)
        score[i] = np.maximum.accumulate(here - slide) + slide  # text words left out
    i, d = np.unravel_index(int(score.argmax()), score.shape)
    matched, last, first = 0, None, None
    while i > 0 and score[i, d] > 0:
        j = i - 1 + diagonal + d - band
        same = 0 <= j < len(text) and text[j] == template[i - 1]
        if score[i, d] == score[i - 1, d] + (MATCH if same else MISMATCH):
            if same:
                matched += 1
                first, last = j, last if last is not None else j + 1
            i -= 1
        elif d + 1 < width and score[i, d] == score[i - 1, d + 1] + GAP:
            i, d = i - 1, d + 1
        elif d > 0 and score[i, d] == score[i, d - 1] + GAP:
            d -= 1
        else:
            break
    return matched, first if first is not None else 0, last if last is not None else 0


class _Spans:
    """Accepted spans of one template in one document, in order."""

    def __init__(self):
        self.starts: list[int] = []
        self.rows: list[tuple[int, int, int]] = []  # first, last + 1, matched

    def room(self, at: int) -> tuple[int, int] | None:
        """The free stretch around ``at``; None inside a span."""
        i = bisect.bisect_right(self.starts, at)
        low = self.rows[i - 1][1] if i else 0
        return None if at < low else (low, self.starts[i] if i < len(self.rows) else 1 << 62)

    def add(self, first: int, last: int, matched: int) -> None:
        i = bisect.bisect_right(self.starts, first)
        self.starts.insert(i, first)
        self.rows.insert(i, (first, last, matched))


def find(template: np.ndarray, need: int, text: np.ndarray, diagonals: np.ndarray, memo: dict) -> list[tuple[int, int, int]]:
    """Spans of a template in a document's words; ``diagonals`` are where hits
    let it begin, ascending."""
    spans, failed = _Spans(), None
    n = len(template)

    def look(at: int, low: int, high: int) -> bool:
        part = text[low:high]
        key = (at - low, part.tobytes())
        if key not in memo:
            memo[key] = align(template, part, at - low)
        matched, first, last = memo[key]
        if matched < need:
            return False
        spans.add(low + first, low + last, matched)
        if first >= need:  # room for a copy in front, which may be the one that was hit
            look(at, low, low + first)
        return True

    for at in diagonals.tolist():
        if failed is not None and at - failed <= BAND // 2:  # that alignment has seen this place
            continue
        room = spans.room(max(at, 0))
        if room is None:
            continue
        low, high = max(at - BAND, room[0], 0), min(at + n + BAND, room[1], len(text))
        failed = None if high > low and look(at, low, high) else at
    return spans.rows


def scan(docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document, template and span that covers at least
    ``min_coverage`` of the template's words."""
    runtime.prepare(docs.sparkSession)
    index = Index(TEMPLATES if templates is None else templates, min_coverage)

    def run(batches):
        for batch in batches:
            data, offs = words.text_bytes(batch.column(1))
            hashes, starts, ends, rows = _words(data, offs)
            parts = []
            for gram in index.grams:
                grams, at, row = words.shingles(hashes, rows, gram)
                which, tpl, place = index.hits(gram, grams)
                parts.append((row[which], tpl, at[which] - rows[row[which]] - place))
            row, tpl, diagonal = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 3
            hits = np.unique(np.stack([row, tpl, diagonal], 1), axis=0)
            found: list[tuple[int, int, int, int, int]] = []
            memos: dict[int, dict] = {}
            edges = np.flatnonzero(np.any(hits[1:, :2] != hits[:-1, :2], axis=1)) + 1 if len(hits) else []
            for group in np.split(hits, edges) if len(hits) else []:
                doc, t = int(group[0, 0]), int(group[0, 1])
                base = int(rows[doc])
                text = hashes[base:int(rows[doc + 1])]
                for first, last, matched in find(index.words[t], index.need[t], text, group[:, 2], memos.setdefault(t, {})):
                    found.append((doc, t, matched, int(starts[base + first]), int(ends[base + last - 1])))
            if not found:
                continue
            doc, t, matched, s, e = map(np.array, zip(*found))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            size = np.array([len(w) for w in index.words])[t]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).take(pa.array(doc)), "template": pa.array([index.names[i] for i in t]),
                "matched_words": pa.array(matched.astype(np.int32)), "template_words": pa.array(size.astype(np.int32)),
                "coverage": pa.array(matched / size),
                "char_start": pa.array(chars[s] - chars[offs[doc]]), "char_end": pa.array(chars[e] - chars[offs[doc]]),
                "byte_start": pa.array(s - offs[doc]), "byte_end": pa.array(e - offs[doc]),
            })

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, SCHEMA)
