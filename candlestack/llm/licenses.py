"""License scan: units of a text against license templates by Dice coefficient.

A text is cut into units: every sentence, every line, every paragraph and
the whole text.  A unit is normalised (ASCII lower case, punctuation at word
edges dropped) to its set of word bigrams and compared with the templates by
Dice: 2 |A and B| / (|A| + |B|).  A unit of n bigrams can only reach the
threshold t with templates of n t / (2 - t) to n (2 - t) / t bigrams, so the
templates, sorted by size, are pruned to that range first; units that are too
small or too large for any template are not even counted.

One pass over the documents, no shuffle: the templates travel with the code.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

from candlestack.llm.common import on_workers, slices

THRESHOLD = 0.8

#: Templates by SPDX name: the notices by which a text states its license.
#: Several wordings of one license are several templates.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not"
                   " use this file except in compliance with the License. You may obtain a copy"
                   " of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of"
            " this software and associated documentation files (the \"Software\"), to deal in"
            " the Software without restriction, including without limitation the rights to use,"
            " copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
            " Software, and to permit persons to whom the Software is furnished to do so,"
            " subject to the following conditions:"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without"
                     " modification, are permitted provided that the following conditions are"
                     " met:"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be"
                     " found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose"
            " with or without fee is hereby granted, provided that the above copyright notice"
            " and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under"
                " the terms of the GNU General Public License as published by the Free Software"
                " Foundation, either version 3 of the License, or (at your option) any later"
                " version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under"
                " the terms of the GNU General Public License as published by the Free Software"
                " Foundation; either version 2 of the License, or (at your option) any later"
                " version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License,"
                " v. 2.0. If a copy of the MPL was not distributed with this file, You can"
                " obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International"
                  " License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and"
                " related and neighboring rights to this work to the public domain worldwide."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no"
             " event will the authors be held liable for any damages arising from the use of"
             " this software."),
)

SENTENCE = re.compile(r"(?<=[.!?])[ \t]+")
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
EDGE = b".,;:!?\"'()[]{}<>*"


def bigrams(text: str) -> set:
    words = [w for w in (x.strip(EDGE) for x in text.encode().lower().split()) if w]
    return set(zip(words, words[1:]))


class Matcher:
    """Templates sorted by size, with the sizes a unit may have at all."""

    def __init__(self, templates, threshold: float):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be in (0, 1]")
        rows = sorted(((len(b), name, b) for name, text in templates
                       if (b := bigrams(text))), key=lambda r: (r[0], r[1], sorted(r[2])))
        self.threshold, self.rows, self.sizes = threshold, rows, [r[0] for r in rows]
        self.known = set().union(*(r[2] for r in rows)) if rows else set()
        self.ratio = (2 - threshold) / threshold
        self.least = self.sizes[0] / self.ratio if rows else float("inf")
        self.most = self.sizes[-1] * self.ratio if rows else 0

    def best(self, unit: str):
        """(score, name) of the best template at or above the threshold, or None."""
        spaces = unit.count(" ")
        if spaces + unit.count("\n") + unit.count("\t") < self.least:
            return None  # fewer words than any template allows
        grams = bigrams(unit)
        n = len(grams)
        if not self.least <= n <= self.most or self.known.isdisjoint(grams):
            return None
        eps = 1e-9
        lo = bisect_left(self.sizes, n / self.ratio - eps)
        hi = bisect_right(self.sizes, n * self.ratio + eps)
        best = None
        for size, name, gram in self.rows[lo:hi]:
            score = 2 * len(gram & grams) / (size + n)
            if score >= self.threshold and (best is None or (-score, name) < (-best[0], best[1])):
                best = (score, name)
        return best


def units(text: str):
    """(begin, end) of sentences, lines, paragraphs and the whole text, each
    range once."""
    seen = set()

    def pieces(begin, end, rule):
        at = begin
        for m in rule.finditer(text, begin, end):
            yield at, m.start()
            at = m.end()
        yield at, end

    if text:
        seen.add((0, len(text)))
    for a, b in pieces(0, len(text), PARAGRAPH):
        seen.add((a, b))
    at = 0
    for line in text.split("\n"):
        end = at + len(line)
        seen.add((at, end))
        seen.update(pieces(at, end, SENTENCE))
        at = end + 1
    return sorted(u for u in seen if u[0] < u[1])


def scan(text: str, matcher: Matcher) -> list:
    """[(begin, end, license, score)]: units that match, without those that
    overlap one of higher score (ties: the shorter unit, then the earlier)."""
    hits = [(b[0], a, e, b[1]) for a, e in units(text) if (b := matcher.best(text[a:e]))]
    taken: list = []
    for score, a, e, name in sorted(hits, key=lambda h: (-h[0], h[2] - h[1], h[1])):
        if all(e <= x or a >= y for x, y, _, _ in taken):
            taken.append((a, e, name, score))
    return sorted(taken)


def scan_batches(batches: Iterator, templates, threshold: float) -> Iterator:
    import pyarrow as pa

    matcher = Matcher(templates, threshold)
    hit = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("license", pa.string()),
                     ("score", pa.float64())])
    for batch in slices(batches):
        found = [[{"begin": a, "end": e, "license": n, "score": s}
                  for a, e, n, s in scan(t or "", matcher)] for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.list_(hit))],
                                         ["doc_id", "matches"])


def scan_licenses(docs: DataFrame, templates: tuple | Mapping = TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and ``matches``, an
    array of struct(begin, end, license, score), code points, end exclusive,
    ascending, never overlapping.

    Null and empty texts have no matches; a null doc_id stays null; repeated
    rows are scanned each; very long texts are scanned whole.  Of equally good
    templates the first by name is reported.  An empty table gives an empty
    table; other columns of ``docs`` are ignored."""
    pairs = tuple(templates.items()) if isinstance(templates, Mapping) else tuple(templates)
    return docs.select("doc_id", "text").mapInArrow(
        on_workers("licenses", "scan_batches", pairs, threshold),
        "doc_id long, matches array<struct<begin:bigint,end:bigint,license:string,score:double>>")
