"""License scans (operator 8): patience alignment of texts with license templates.

Near each telling word of a template, the text is aligned with it: words that are
unique in both are anchors, the longest increasing subsequence of their places is
kept, and the gaps between are aligned in the same way. The share of the template's
words that are aligned is its coverage. A place is aligned only if enough words of
the template are near it, counted by a running sum, so a long text costs as much as
it has such places.

Defined results: a null or empty text, and one in which no template reaches
``LEAST_COVERAGE``, get a null license, coverage 0 and no matches; a text of any length
is scanned whole; repeated rows give equal rows; ties go to the
longer template, then to its name; equal texts get equal results; a null doc_id is
passed on; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import text_or_empty
from .words import text_slices

LEAST_COVERAGE = 0.8
#: Words of a template with this many letters or more are telling.
TELLING_LETTERS = 7
_WORD = re.compile(r"[^\W_]+")

# Notices and short texts of public licenses.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE."
    ),
    "MIT permission": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD '
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "ISC permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "BSD-2-Clause conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors "
        "may be used to endorse or promote products derived from this software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "LGPL-2.1 header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser "
        "General Public License for more details."
    ),
    "AGPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero "
        "General Public License for more details."
    ),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
        "obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "BSL-1.0 notice": "Distributed under the Boost Software License, Version 1.0.",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
        "required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may "
        "not be removed or altered from any source distribution."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "CC0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def longest_increasing(values: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        at = bisect_left(tops, v)
        if at == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[at], piles[at] = v, i
        before.append(piles[at - 1] if at else -1)
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places of equal words, ascending in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        i, j, k, m = gaps.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        place = {w: p for p, w in enumerate(b[k:m], k) if in_b[w] == 1}
        anchors = [(p, place[w]) for p, w in enumerate(a[i:j], i) if in_a[w] == 1 and w in place]
        if not anchors:
            continue
        chain = [anchors[n] for n in longest_increasing([q for _, q in anchors])]
        out += chain
        edges = [(i - 1, k - 1), *chain, (j, m)]
        gaps += [(p + 1, p2, q + 1, q2) for (p, q), (p2, q2) in zip(edges, edges[1:])]
    return sorted(out)


class Match(NamedTuple):
    license: str
    coverage: float
    matched: int
    first: int  # words of the text, from the first aligned one
    last: int  # to the last


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES):
        self.templates = {name: words_of(text) for name, text in templates.items()}
        self.telling = {name: {w for w in words if len(w) >= TELLING_LETTERS} or set(words) for name, words in self.templates.items()}
        self.any_telling = set().union(*self.telling.values())

    def scan(self, text: str) -> list[Match]:
        """Places that a template covers well enough, per template without overlaps."""
        words = words_of(text)
        held = self.any_telling.intersection(words)
        if not held:
            return []
        found = []
        for name, template in self.templates.items():
            telling = self.telling[name] & held
            if not telling:
                continue
            own, size = set(template), len(template)
            near = np.cumsum([0, *(w in own for w in words)])
            free = 0
            for at in [i for i, w in enumerate(words) if w in telling]:
                low, high = max(free, at - size), min(len(words), at + size)
                if at < free or near[high] - near[low] < LEAST_COVERAGE * size:
                    continue
                pairs = patience(words[low:high], template)
                if len(pairs) >= LEAST_COVERAGE * size:
                    found.append(Match(name, len(pairs) / size, len(pairs), low + pairs[0][0], low + pairs[-1][0]))
                    free = low + pairs[-1][0] + 1
        return found


_SCANNED = "doc_id long, license string, coverage double, matched_words long, first_word long, last_word long, n_matches long"


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """The best match of every row, and the number of all its matches."""
    templates = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            for part in text_slices(batch):
                rows = []
                for text in part["text"].to_pylist():
                    found = scanner.scan(text)
                    best = min(found, key=lambda m: (-m.coverage, -m.matched, m.license, m.first), default=Match(None, 0.0, 0, None, None))
                    rows.append((*best, len(found)))
                columns = list(zip(*rows)) or [()] * 6
                kinds = (pa.string(), pa.float64(), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds))], [f.split()[0] for f in _SCANNED.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, _SCANNED)
