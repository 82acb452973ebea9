"""License scans: winnowed fingerprints and banded alignment.

Templates are cut into word k-grams; of every window of neighbouring k-grams the
smallest hash is a fingerprint (winnowing: Schleimer, Wilkerson and Aiken,
2003), so that any run of ``GRAM + WINDOW - 1`` words that a text shares with a
template has a fingerprint in common.  An inverted index of the templates'
fingerprints picks candidates and the diagonals on which they lie; around each
diagonal a banded alignment of the words counts those that match in order.  A
template is reported where its coverage reaches ``COVERAGE``; of overlapping
reports the best stays.

The index is a small table of fixed texts that goes along with the tasks;
documents are read once and not shuffled.

Defined cases: null and empty texts match nothing; case, punctuation and white
space do not count; templates without words are left out; equal templates are
reported under the first name; a template that stands several times in a text is
reported each time; rows are independent, other columns pass through."""

from __future__ import annotations

import re
from bisect import bisect
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chainwatch.llm._common import with_text_columns

#: Words of a k-gram, k-grams of a window, least coverage that is reported.
GRAM, WINDOW, COVERAGE = 3, 2, 0.8
#: Words that an alignment may stray from its diagonal, as a share of the template, and at least.
BAND, LEAST_BAND = 0.2, 4
FOUND = "array<struct<license:string,coverage:double,matched_words:bigint,start:bigint,end:bigint>>"
WORD = re.compile("[A-Za-z0-9\u0080-\U0010ffff]+")

#: The usual notices of common public licenses.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def _byte_map() -> bytes:
    return bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def winnow(grams: np.ndarray) -> np.ndarray:
    """Positions of the smallest k-gram hash of each window, the last of equals."""
    if len(grams) <= WINDOW:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))]) if len(grams) else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    return np.unique(np.arange(len(view)) + WINDOW - 1 - np.argmin(view[:, ::-1], axis=1))


class TemplateIndex:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.map = _byte_map()
        words = [(name, t.encode().translate(self.map).split()) for name, t in templates]
        self.names = [n for n, w in words if w]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({x for _, ws in words for x in ws}))}
        self.ids = [np.array([self.vocabulary[x] for x in ws]) for _, ws in words if ws]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, ids in enumerate(self.ids):
            grams = self.grams(ids)
            for p in winnow(grams).tolist():
                self.places.setdefault(int(grams[p]), []).append((t, p))
        self.prints = np.array(sorted(self.places), np.uint64)

    def grams(self, ids: np.ndarray) -> np.ndarray:
        """Hash of the k-gram at each word (a text shorter than k words is one);
        the largest number where a word is in no template."""
        n = min(GRAM, len(ids))
        if n == 0:
            return np.zeros(0, np.uint64)
        code = np.zeros(len(ids) - n + 1, np.uint64)
        known = np.ones(len(code), bool)
        for j in range(n):
            part = ids[j : len(code) + j]
            code = (code * np.uint64(1_000_003) + part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            known &= part > 0
        code ^= code >> np.uint64(32)
        return np.where(known, code, np.uint64((1 << 64) - 1))

    def scan(self, text: str | None) -> list[tuple]:
        """(license, coverage, matched words, start, end) in code points, by start."""
        get = self.vocabulary.get
        words = (text or "").encode().translate(self.map).split()
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        if len(ids) == 0 or not ids.any() or not len(self.prints):
            return []
        grams = self.grams(ids)
        # runs outside the templates' words need no window: their hashes match nothing
        at = winnow(grams)
        hit = at[np.isin(grams[at], self.prints)]
        if not len(hit):
            return []
        diagonals: dict[int, list[int]] = {}
        for p in hit.tolist():
            for t, q in self.places[int(grams[p])]:
                diagonals.setdefault(t, []).append(p - q)
        found = []
        for t, places in diagonals.items():
            band = max(LEAST_BAND, int(BAND * len(self.ids[t])))
            last = None
            for d in sorted(set(places)):
                if last is None or d - last > band:
                    found += self._align(t, ids, d, band)
                    last = d
        return self._best(found, text)

    def _align(self, t: int, ids: np.ndarray, diagonal: int, band: int) -> list[tuple]:
        """Longest common subsequence of the template and the text around a
        diagonal, within the band; one row if its coverage suffices."""
        template = self.ids[t].tolist()
        # best[j]: (matches, -span, first, last) of the template so far, ending before text word low + j
        low = diagonal - band
        best = [(0, 0, -1, -1)] * (2 * band + 2)
        for i, word in enumerate(template):
            row = [(0, 0, -1, -1)] * (2 * band + 2)
            for j in range(2 * band + 1):
                p = low + i + j
                # in the row before, the same text word stands one place further on
                top = max(best[j + 1], row[j - 1] if j else (0, 0, -1, -1))
                if 0 <= p < len(ids) and ids[p] == word:
                    m, _, a, _ = best[j]
                    a = p if m == 0 else a
                    top = max(top, (m + 1, a - p, a, p))
                row[j] = top
            best = row
        matched, _, first, last = max(best)
        coverage = matched / len(template)
        return [(t, coverage, matched, first, last)] if coverage >= COVERAGE else []

    def _best(self, found: list[tuple], text: str) -> list[tuple]:
        kept: list[tuple] = []  # by place; they do not overlap, so only both neighbours can meet a new one
        for f in sorted(set(found), key=lambda f: (-f[1], -f[2], f[3], f[0])):
            at = bisect(kept, f[3], key=itemgetter(3))
            if (at == 0 or kept[at - 1][4] < f[3]) and (at == len(kept) or f[4] < kept[at][3]):
                kept.insert(at, f)
        if not kept:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        return [(self.names[t], c, m, spans[a][0], spans[b][1]) for t, c, m, a, b in kept]


def find_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, text: str = "text", out: str = "licenses") -> DataFrame:
    """Append the reports of every document, an array of license, coverage,
    matched_words, start and end (code points, end exclusive)."""
    kind = T._parse_datatype_string(FOUND)
    names = [f.name for f in kind.elementType.fields]
    index = TemplateIndex(templates)

    def make():
        return lambda texts: [[[dict(zip(names, r)) for r in index.scan(t)] for t in texts]]

    return with_text_columns(docs, text, make, [T.StructField(out, kind, False)])
