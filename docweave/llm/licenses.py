"""License scans by patience alignment.

Texts and templates are sequences of lower-cased words (letters and digits).
A template can only match where its words are, so a text is first held against
a template's words as a bag, which bounds the coverage that any alignment can
reach; what is left is aligned.  Patience alignment anchors on words that are
unique in both sequences, takes the longest increasing subsequence of their
places, and aligns the gaps between anchors in the same way; gaps without
anchors grow the matches at their ends.  Coverage is the share of the
template's words that are aligned.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_ISC = 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD_2 = 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.'
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'

#: Short forms, opening passages and whole texts of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-short": "Released under the BSD License",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "MIT-text": _MIT,
    "ISC-text": _ISC,
    "BSD-2-Clause-text": f"{_BSD_2} {_BSD_END}",
    "BSD-3-Clause-text": f"{_BSD_2} {_BSD_3} {_BSD_END}",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}

words = re.compile(r"[^\W_]+").findall


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        below[i] = piles[k - 1] if k else -1
        tops[k : k + 1], piles[k : k + 1] = [v], [i]
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places (in a, in b) of equal words, increasing in both.

    Gaps wait on a stack of their own, so depth of nesting is no concern.
    """
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        common = [(i, at_b[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at_b]
        chain = [common[i] for i in longest_increasing([j for _, j in common])]
        for i, j in chain:
            pairs.append((i, j))
            gaps.append((a0, i, b0, j))
            a0, b0 = i + 1, j + 1
        if chain:
            gaps.append((a0, a1, b0, b1))
    return sorted(pairs)


class Scanner:
    """Finds templates in word sequences.

    A text is cut into regions where enough of a template's words lie close
    together: windows a template's length apart, one template's length longer
    than the longest span that ``stretch`` allows (rounded up), whose bag of
    words covers ``least`` of it.  So each such span lies whole in a window.
    Regions that touch are one.  Each region is aligned; a find is the span from its first to its
    last aligned word, if its coverage is at least ``least`` and at most
    ``stretch`` words of text lie in it for each of the template.
    """

    def __init__(self, templates: dict[str, str], least: float, stretch: float):
        self.least, self.stretch = least, stretch
        self.templates = {name: words(text.lower()) for name, text in sorted(templates.items())}
        self.bags = {name: Counter(t) for name, t in self.templates.items()}
        self.known = set().union(*self.templates.values()) if templates else set()

    def span(self, m: int) -> int:
        """Words of text that a find of a template of m words takes at most."""
        return int(self.stretch * m) + 1

    def regions(self, at: dict[str, list[int]], name: str) -> Iterator[tuple[int, int]]:
        template, bag = self.templates[name], self.bags[name]
        m = len(template)
        if sum(min(n, len(at.get(w, ()))) for w, n in bag.items()) < self.least * m:
            return
        # Occurrences fall in cells of m words; each cell begins a window, which holds every span that starts in the cell.
        width = math.ceil((m - 1 + self.span(m)) / m)
        cells: dict[int, Counter] = {}
        for w in bag:
            for i in at.get(w, ()):
                cells.setdefault(i // m, Counter())[w] += 1
        start = end = None
        for c in sorted({x for i in cells for x in range(i - width + 1, i + 1)}):
            near = sum((cells[x] for x in range(c, c + width) if x in cells), Counter())
            if sum(min(n, near[w]) for w, n in bag.items()) >= self.least * m:
                lo, hi = max(0, c * m), (c + width) * m
                if end is not None and lo <= end:
                    end = hi
                else:
                    if end is not None:
                        yield start, end
                    start, end = lo, hi
        if end is not None:
            yield start, end

    def finds(self, text: str) -> list[tuple[int, int, str, float]]:
        """(first word, end word, template, coverage), the best at each place, in order."""
        tokens = words(text.lower())
        at: dict[str, list[int]] = {}
        for i, w in enumerate(tokens):
            if w in self.known:
                at.setdefault(w, []).append(i)
        found = []
        for name, template in self.templates.items():
            for lo, hi in self.regions(at, name):
                while lo < hi:  # a region may hold the template more than once
                    pairs = self.best(tokens, lo, min(hi, len(tokens)), template)
                    if not pairs:
                        break
                    first, last = pairs[0][0], pairs[-1][0] + 1
                    found.append((first, last, name, len(pairs) / len(template), len(pairs)))
                    lo = last
        kept: list[tuple] = []  # in order of place, so only neighbours can overlap
        for f in sorted(found, key=lambda f: (-f[4], -f[3], f[0], f[2])):  # more words, then more of the template
            k = bisect_left(kept, f)
            if (k == len(kept) or f[1] <= kept[k][0]) and (k == 0 or kept[k - 1][1] <= f[0]):
                kept.insert(k, f)
        return [f[:4] for f in kept]

    def best(self, tokens: list[str], lo: int, hi: int, template: list[str]) -> list[tuple[int, int]]:
        """The alignment at the first place in [lo, hi) where the template is found.

        Windows start at the template's own words.  From the first one that
        passes, those of one span are compared: more words aligned, then fewer
        words of text, then the earlier one.
        """
        m, span = len(template), self.span(len(template))
        bag, best, until = Counter(template), (), hi
        for start in range(lo, hi):
            if start >= until:
                break
            if tokens[start] not in bag:
                continue
            part = tokens[start : min(hi, start + span)]
            if sum((Counter(part) & bag).values()) < max(self.least * m, best[0] if best else 0):
                continue
            pairs = align(part, template)
            if len(pairs) >= self.least * m:
                until = min(until, start + span)
                found = (len(pairs), pairs[0][0] - pairs[-1][0], -start, [(start + i, j) for i, j in pairs])
                best = max(best, found)
        return best[3] if best else []


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, least: float = 0.8, stretch: float = 1.5) -> DataFrame:
    """One row per row of docs: (id, n_licenses, best_license, best_coverage, finds).

    finds is an array of (license, first_word, end_word, coverage) in order of
    place.  A null or empty text has none; best_license is the find with the
    highest coverage, then the first by name, null without finds.  Repeated
    rows stay repeated and null ids are carried.  An empty table gives an empty
    one.  Other columns are ignored, whatever their names.  A long text costs
    time in proportion to its words and to those of the notices in it.
    """
    chosen = TEMPLATES if templates is None else templates
    schema = "id long, n_licenses long, best_license string, best_coverage double, finds array<struct<license:string,first_word:int,end_word:int,coverage:double>>"
    find = pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int32()), ("end_word", pa.int32()), ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, least, stretch)
        for batch in batches:
            out = [scanner.finds(t.as_py() or "") for t in batch.column(1)]
            best = [min(((-c, n) for _, _, n, c in f), default=None) for f in out]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(f) for f in out], pa.int64()), pa.array([b and b[1] for b in best], pa.string()), pa.array([b and -b[0] for b in best], pa.float64()),
                pa.array([[{"license": n, "first_word": a, "end_word": z, "coverage": c} for a, z, n, c in f] for f in out], find),
            ], names=["id", "n_licenses", "best_license", "best_coverage", "finds"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digests(docs: DataFrame, **options) -> DataFrame:
    """scan() with the finds as one string, license:first:end joined by commas."""
    x = scan(docs, **options)
    return x.withColumn("finds", F.array_join(F.transform("finds", lambda f: F.concat_ws(":", f["license"], f["first_word"], f["end_word"])), ","))
