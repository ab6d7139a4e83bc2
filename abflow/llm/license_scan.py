"""License scan by winnowed fingerprints and banded alignment (operator 5).

Templates are cut into words; their hashed 3-word runs are winnowed (the smallest of every
window of four is kept, all of a short template) and filed in an inverted index. A text's 3-word
runs are looked up there; hits of one template whose diagonals follow each other in steps of
at most a band make a chain. A chain is aligned word by word within a band around its
diagonals, a chain wider than ``SPAN`` templates in windows that overlap by half, so
every hit is aligned; the text before and after an alignment is aligned again while it has hits.
Reported are the template's matched words, their share (coverage) and the byte span
in the text. Of overlapping finds the best stays.

Narrow: templates are a fixed argument of checked size (``MAX_TEMPLATE_WORDS``) and go to every task.

Defined cases: null or empty text has no finds; a template without three words is
refused; equal finds go to the earlier template; repeated rows and null ids
are scanned like others; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLAIN, Words, read_table, text_buffers

RUN, WINDOW = 3, 4
COVERAGE = 0.8
SPAN = 4  # diagonals aligned at once, in lengths of the template
NARROW = 64  # diagonals up to which cells are cheaper one by one
MAX_TEMPLATE_WORDS = 1_000_000
_OUT = pa.schema([("doc_id", pa.int64()), ("license_id", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                  ("n_matched", pa.int64()), ("n_words", pa.int64()), ("coverage", pa.float64())])
_OUT_DDL = "doc_id long, license_id string, start long, end long, n_matched long, n_words long, coverage double"

# Notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                         "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
                      "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
                      "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                  "as published by the Free Software Foundation",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
}


def winnow(h: np.ndarray, window: int = WINDOW) -> list[int]:
    """Places of the kept hashes: the last smallest of each window."""
    if len(h) <= window:
        return list(range(len(h)))
    kept = set()
    for i in range(len(h) - window + 1):
        part = h[i:i + window]
        kept.add(i + window - 1 - int(np.argmin(part[::-1])))
    return sorted(kept)


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names, self.words = list(templates), []
        self.at: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, text in enumerate(templates.values()):
            raw = np.frombuffer(text.encode(), np.uint8)
            w = Words(raw, np.array([0, len(raw)]), PLAIN)
            if len(w.hash) < RUN:
                raise ValueError(f"{self.names[k]}: fewer than {RUN} words")
            self.words.append(w.hash.tolist())
            _, h = w.windows(RUN)
            for i in winnow(h):
                self.at[int(h[i])].append((k, i))
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError("templates are too large to be sent to every task")
        self.bits = np.zeros(1 << 16, bool)
        self.bits[np.fromiter(self.at, np.uint64, len(self.at)) >> np.uint64(48)] = True


def align(text: list[int], template: list[int], diagonal: int, band: int) -> tuple[int, int, int]:
    """Local alignment within ``band`` of a diagonal (text place minus template place):
    matched words, first and last text word plus one, of the best score (match 2, else -1)."""
    m, best = len(template), (0, 0, 0, 0)
    lo = diagonal - band
    width = 2 * band + 1
    before: list[tuple[int, int, int] | None] = [None] * (width + 1)  # (score, matches, first) by text place i = j + lo + b
    for j in range(m):
        now: list[tuple[int, int, int] | None] = [None] * (width + 1)
        left = None
        for b in range(width):
            i = j + lo + b
            if not 0 <= i < len(text):
                left = None
                continue
            same = text[i] == template[j]
            diag, up = before[b], before[b + 1]
            cell = (diag[0] + 2, diag[1] + 1, diag[2]) if same and diag else (2, 1, i) if same else (diag[0] - 1, diag[1], diag[2]) if diag else None
            for other in (up, left):
                if other and (cell is None or other[0] - 1 > cell[0]):
                    cell = (other[0] - 1, other[1], other[2])
            if cell and cell[0] <= 0:
                cell = None
            now[b] = left = cell
            if cell and cell[0] > best[0]:
                best = (cell[0], cell[1], cell[2], i + 1)
        before = now
    return best[1], best[2], best[3]


def align_wide(text: np.ndarray, template: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """``align`` a template word at a time over all diagonals: a cell is score, matches and first
    text word in 21 bits each. Of equal scores the one with more matches wins."""
    n, m, lo, width = len(text), len(template), diagonal - band, 2 * band + 1
    one, pair = 1 << 42, (2 << 42) + (1 << 21)
    slope = np.arange(width, dtype=np.int64) * one
    before, now = np.zeros(width + 1, np.int64), np.zeros(width + 1, np.int64)
    best = (0, 0, 0)
    for j in range(m):
        p, q = max(0, -lo - j), min(width, n - lo - j)
        now[:] = 0
        if p < q:
            diag, row = before[p:q], now[p:q]
            same = text[j + lo + p:j + lo + q] == template[j]
            np.subtract(diag, one, out=row)
            at = np.flatnonzero(same)
            row[at] = np.where(diag[at] > 0, diag[at], at + (j + lo + p)) + pair
            np.maximum(row, before[p + 1:q + 1] - one, out=row)
            row[row < one] = 0
            row += slope[:q - p]
            np.maximum.accumulate(row, out=row)
            row -= slope[:q - p]
            row[row < one] = 0
            b = int(row.argmax())
            top = int(row[b])
            if top >> 21 > best[0] >> 21:
                best = (top, top & (1 << 21) - 1, j + lo + p + b + 1)
        before, now = now, before
    return best[0] >> 21 & (1 << 21) - 1, best[1], best[2]


def _aligned(text: list[int], template: list[int], diagonal: int, band: int) -> tuple[int, int, int]:
    if 2 * band + 1 <= NARROW or 2 * (len(template) + band) + len(text) >= 1 << 21:  # the latter doesn't fit the packed cells
        return align(text, template, diagonal, band)
    return align_wide(np.array(text, np.uint64), np.array(template, np.uint64), diagonal, band)


def windows(places: list[tuple[int, int]], band: int, span: int) -> list[list[tuple[int, int]]]:
    """Hits (diagonal, text place), sorted, in chains of steps up to ``band``; a chain wider than
    ``span`` in windows of that width that overlap by half."""
    out = []
    cuts = [0, *(x for x in range(1, len(places)) if places[x][0] - places[x - 1][0] > band), len(places)]
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        while True:
            e = bisect_right(places, places[a][0] + span, a, z, key=lambda x: x[0])
            out.append(places[a:e])
            if e == z:
                break
            a = bisect_right(places, places[a][0] + span // 2, a, z, key=lambda x: x[0])
    return out


def finds(hashes: list[int], hits: list[tuple[int, int, int]], index: Index, coverage: float) -> list[tuple[int, int, int, int]]:
    """(template, matched, first word, last word plus one) of a text. hits: (template, text place, template place)."""
    found = []
    by: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for k, i, j in hits:
        by[k].append((i - j, i))
    for k, places in by.items():
        words = index.words[k]
        m = len(words)
        band = 2 + m // 8
        places.sort()
        for group in windows(places, band, max(2 * band, SPAN * m)):
            first, last = group[0][0], group[-1][0]
            d, wide = (first + last) // 2, min(band + last - first, 2 * band + (last - first + 1) // 2)
            at = sorted(i for _, i in group)
            parts = [(max(0, first - band), min(len(hashes), last + m + band))]
            while parts:
                a, z = parts.pop()
                h = bisect_left(at, a)
                if h == len(at) or at[h] + RUN > z:
                    continue  # no hit
                part = hashes[a:z]
                some = set(part)
                if sum(w in some for w in words) < coverage * m:
                    continue  # can't reach the coverage
                n, i, e = _aligned(part, words, d - a, wide)
                if not n:
                    continue
                if n >= coverage * m:
                    found.append((k, n, a + i, a + e))
                parts += [(a, a + i), (a + e, z)]
    found.sort(key=lambda f: (-f[1], -f[1] / len(index.words[f[0]]), f[3] - f[2], f[0], f[2]))
    kept: list[tuple[int, int, int, int]] = []
    for f in found:
        if all(f[3] <= g[2] or f[2] >= g[3] for g in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: f[2])


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per find: license, byte span, matched words of the template's, coverage."""
    shared = docs.sparkSession.sparkContext.broadcast(Index(templates or TEMPLATES))

    def run(batches):
        index = shared.value
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for data, off, first in text_buffers(batch.column("text")):
                w = Words(data, off, PLAIN)
                at, h = w.windows(RUN)
                hits = defaultdict(list)
                for i in np.flatnonzero(index.bits[h >> np.uint64(48)]).tolist():
                    for k, j in index.at.get(int(h[i]), ()):
                        d = int(w.doc[at[i]])
                        hits[d].append((k, int(at[i] - w.first[d]), j))
                for d, got in hits.items():
                    a, z = int(w.first[d]), int(w.first[d + 1])
                    for k, n, i, e in finds(w.hash[a:z].tolist(), got, index, coverage):
                        m = len(index.words[k])
                        rows.append((ids[first + d], index.names[k], int(w.start[a + i] - off[d]), int(w.end[a + e - 1] - off[d]), n, m, n / m))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_OUT)], schema=_OUT)

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, _OUT_DDL)


def op5(spark, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return license_scan(read_table(spark, sf_dir, "documents"))
