"""License notices in run documents by patience alignment with templates."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import shared

# Notices and the head of license texts, by SPDX name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                   "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                   "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                         "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                         "option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
                     "of conditions and the following disclaimer."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
]
WORD = re.compile(r"[^\W_]+")
_PARTED = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by patience piles."""
    tops, at_top, before = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect.bisect_left(tops, v)
        before[i] = at_top[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            at_top.append(i)
        else:
            tops[pile], at_top[pile] = v, i
    out, i = [], at_top[-1] if at_top else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, increasing in both: words that are unique on both sides anchor, the longest
    increasing run of anchors is kept, and the gaps between anchors are aligned in the same way; equal words at the
    ends of a gap are matched as they stand."""
    pairs, open_gaps = [], [(0, len(a), 0, len(b))]
    while open_gaps:
        i, k, j, m = open_gaps.pop()
        while i < k and j < m and a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            pairs.append((k, m))
        if i == k or j == m:
            continue
        in_a, in_b = Counter(a[i:k]), Counter(b[j:m])
        once = {w: p for p, w in enumerate(b[j:m], j) if in_b[w] == 1}
        anchors = [(p, once[w]) for p, w in enumerate(a[i:k], i) if in_a[w] == 1 and w in once]
        if not anchors:
            continue
        chain = [anchors[x] for x in longest_increasing([q for _, q in anchors])]
        pairs += chain
        edges = [(i - 1, j - 1), *chain, (k, m)]
        open_gaps += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:])]
    return sorted(pairs)


class Template:
    def __init__(self, name: str, text: str, least: float):
        self.name, self.words = name, WORD.findall(text.lower())
        self.distinct = set(self.words)
        self.places: dict[str, list[int]] = {}
        for i, w in enumerate(self.words):
            self.places.setdefault(w, []).append(i)
        n = len(self.words)
        # a text that covers the template lacks at most this many places, so one of these words is in it
        missing = n - max(1, math.ceil(least * n))
        counts = Counter(self.words)
        self.keys, places = set(), 0
        for w in sorted(self.distinct, key=lambda w: (-len(w), w)):
            if places > missing:
                break
            self.keys.add(w)
            places += counts[w]


def windows(words: list[str], template: Template) -> list[tuple[int, int]]:
    """Stretches of the text where the template could stand: for each key word, as if the notice stood there without
    gaps, and a quarter of its length more on both sides. Stretches are short, so a notice that is repeated
    close by is still mostly unique in one of them."""
    n = len(template.words)
    extra = n // 4 + 2
    starts = {i - p for i, w in enumerate(words) if w in template.keys for p in template.places[w]}
    found = []
    for s in sorted(starts):
        start, end = max(0, s - extra), min(len(words), s + n + extra)
        if end > start and (start, end) not in found[-1:]:
            found.append((start, end))
    return found


def notices(text: str, templates: list[Template], least: float, dense: float) -> list[tuple[int, int, str, int, float]]:
    """(start, end, license, matched words, coverage) of the notices of a text; of overlapping ones the one with
    more matched words stays, then the better covered, the shorter, the earlier."""
    found = []
    seen = set(text.encode("utf-8", "surrogatepass").translate(_PARTED).split())
    near = [t for t in templates if any(k.encode() in seen for k in t.keys)]
    if not near:
        return []
    spots = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
    words = [w for w, _, _ in spots]
    present = set(words)
    for t in near:
        size = len(t.words)
        if sum(w in present for w in t.words) < least * size:
            continue
        for start, end in windows(words, t):
            if sum(w in t.distinct for w in words[start:end]) < least * size:
                continue
            pairs = align(words[start:end], t.words)
            # the densest run: drop far matches on the edges of the stretch
            while pairs and (pairs[-1][0] - pairs[0][0] + 1) * dense > len(pairs):
                left = pairs[1][0] - pairs[0][0] if len(pairs) > 1 else 1
                right = pairs[-1][0] - pairs[-2][0] if len(pairs) > 1 else 1
                if max(left, right) <= 1:
                    break
                pairs = pairs[1:] if left >= right else pairs[:-1]
            if pairs and len(pairs) >= least * size:
                found.append((spots[start + pairs[0][0]][1], spots[start + pairs[-1][0]][2], t.name, len(pairs), len(pairs) / size))
    kept: list[tuple[int, int, str, int, float]] = []
    for f in sorted(set(found), key=lambda f: (-f[3], -f[4], f[1] - f[0], f[0], f[2])):
        at = bisect.bisect(kept, f)
        if (at == 0 or kept[at - 1][1] <= f[0]) and (at == len(kept) or f[1] <= kept[at][0]):
            kept.insert(at, f)
    return kept


def scan_licenses(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, path: str = "path", doc: str = "doc",
                  least: float = 0.75, dense: float = 0.6) -> DataFrame:
    """One row per notice in the run documents: ``path``, start, length (characters), license, matched, coverage.

    A stretch of a document is aligned with a template by :func:`align`; it is a notice when ``least`` of the template's
    words are matched and at least ``dense`` of the words it spans. Stretches are found by words of the template of
    which a notice must hold one, so no document is left out. Templates are a short list given by the caller.
    NULL and empty documents have none; repeated rows report each; a NULL path is kept. An empty table or list of
    templates gives no rows. Other columns are ignored.
    """
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    ready = [t for t in (Template(name, text, least) for name, text in templates) if t.words]
    fields = "start long, length long, license string, matched long, coverage double"
    schema = T.StructType([source.schema["path"], *T._parse_datatype_string(fields).fields])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(schema)
        for batch in shared.chunks(batches):
            rows = [(key, s, e - s, name, n, c) for key, text in zip(batch.column(0).to_pylist(), shared.texts(batch.column(1)))
                    for s, e, name, n, c in notices(text, ready, least, dense)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return source.mapInArrow(each, schema).withColumnRenamed("path", path)
