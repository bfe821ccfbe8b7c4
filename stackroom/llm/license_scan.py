"""License scans by patience alignment of texts with templates.

Words that stand exactly once in a text region and exactly once in a template are anchors. The longest run of anchors
that rises in both is kept, and the gaps between them are aligned in the same way, down to gaps without common words.
A gap whose common words are all repeated is aligned by the longest common subsequence where it is small, else by
its first common word. Coverage is the share of the template's words that are aligned; a hit is a region with coverage
of ``coverage`` or more.

Regions are found by the template's words alone: places in the text whose word the template has, chained over gaps of
at most ``gap`` other words. Where the alignment of a region reaches no hit, as when anchors of several copies mix, the
longest chain of aligned words at most ``gap`` words apart is sought exactly. Words that tell licences apart (versions,
clause counts, nc, nd, sa, lesser, affero) must all be among the aligned ones, and others of them must not stand between;
in templates of more than ``short`` words other numbers may. Templates of several clauses, a line each, need
``clause_coverage`` of each clause, so that a licence with a clause more or less is not taken for its sibling. A text that lacks too many of a template's words for the coverage asked for is not
aligned with it; both steps lose no hit, but that clauses are judged
on the patience alignment of the chain found.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_by_row

#: Short notices and opening passages of public licences.
TEMPLATES: dict[str, str] = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0-line": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-nd-4.0-line": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-nc-sa-4.0-line": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-3.0-line": "Licensed under CC BY 3.0.",
    "cc-by-sa-3.0-line": "Licensed under CC BY-SA 3.0.",
    "bsd-3-line": "Released under the BSD 3-Clause License.",
    "bsd-2-line": "Released under the BSD 2-Clause License.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-2.1-line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-2.0-line": "Licensed under the Mozilla Public License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "lgpl-2.1-notice": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
    "License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3.0-notice": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
}

#: Whole texts, without the copyright line, numbers of clauses and names; a line for each clause.
TEXTS: dict[str, str] = {
    "mit-text": """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-text": """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-text": """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-text": """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "zlib-text": """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
This notice may not be removed or altered from any source distribution.""",
}
TEMPLATES |= TEXTS

WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
NUMBER = re.compile(r"v?([0-9]+(?:\.[0-9]+)*?)(?:\.0)?")
KINDS = frozenset(("nc", "nd", "sa", "lesser", "affero", "noncommercial", "noderivatives", "noderivs", "sharealike"))


@dataclass(frozen=True)
class LicenseSpec:
    coverage: float = 0.8
    clause_coverage: float = 0.5
    gap: int = 12
    small: int = 4096
    short: int = 16


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def clauses_of(text: str) -> list[tuple[int, int]]:
    """First and last word, end exclusive, of each line of a template."""
    ends = [0]
    for line in text.split("\n"):
        ends.append(ends[-1] + len(words_of(line)))
    return [(a, b) for a, b in zip(ends, ends[1:]) if a < b]


def covers(aligned: set[int], clauses: list[tuple[int, int]], spec: LicenseSpec) -> bool:
    """Whether enough of every clause is among the aligned places of a template."""
    return all(len(aligned.intersection(range(a, b))) >= spec.clause_coverage * (b - a) for a, b in clauses)


def alike(words: list[str]) -> list[str]:
    """The words with version numbers written in one way: v3 and 3.0 are 3."""
    return [m[1] if (m := NUMBER.fullmatch(w)) else w for w in words]


def tells_apart(word: str, template: list[str], spec: LicenseSpec) -> bool:
    """Whether the word between aligned words says that the text is another licence than the template."""
    return word in KINDS or (len(template) <= spec.short and NUMBER.fullmatch(word) is not None)


def required(template: list[str]) -> frozenset[int]:
    """Places of the words that a hit must align: the first of each number and kind."""
    return frozenset(template.index(w) for w in set(template) if w in KINDS or NUMBER.fullmatch(w))


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of ``pairs``, sorted by the first place, that rises in the second, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    below: list[int] = []
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tops, y)
        below.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(y)
            piles.append(i)
        else:
            tops[k], piles[k] = y, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = below[i]
    return out[::-1]


def common_subsequence(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            length[i][j] = length[i + 1][j + 1] + 1 if a[i] == b[j] else max(length[i + 1][j], length[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif length[i + 1][j] >= length[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(text: list[str], template: list[str], spec: LicenseSpec = LicenseSpec()) -> list[tuple[int, int]]:
    """Aligned places (text, template), rising in both."""
    out, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d:
            continue
        mine, theirs = Counter(text[a:b]), Counter(template[c:d])
        place = {w: j for j, w in enumerate(template[c:d], c) if theirs[w] == 1 and mine[w] == 1}
        anchors = rising([(i, place[w]) for i, w in enumerate(text[a:b], a) if w in place])
        if not anchors and not mine.keys() & theirs.keys():
            continue
        if not anchors and (b - a) * (d - c) <= spec.small:
            out += [(a + i, c + j) for i, j in common_subsequence(text[a:b], template[c:d])]
            continue
        if not anchors:
            j = next(j for j in range(c, d) if template[j] in mine)
            anchors = [(text.index(template[j], a, b), j)]
        out += anchors
        ends = [(a - 1, c - 1), *anchors, (b, d)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(out)


def regions(places: list[int], gap: int) -> list[tuple[int, int]]:
    """First and last place of each chain of places at most ``gap`` words apart."""
    out = []
    for p in places:
        if out and p - out[-1][1] <= gap + 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return [tuple(x) for x in out]


def longest_chain(words: list[str], a: int, b: int, template: list[str], spec: LicenseSpec) -> tuple[int, int, int] | None:
    """(count, first, last) of the first chain in words[a:b + 1] that reaches the coverage; None if there is none.

    A chain is words aligned with rising places of the template, at most ``gap`` other words apart. Of equal chains the
    one that begins last counts, so that no word of a copy before is taken along.
    """
    must = required(template)
    # A word that must be there counts for more than all others together.
    more = len(template) + 1
    n, needed = len(template), spec.coverage * len(template) + more * len(must)
    spots: dict[str, list[int]] = {}
    for j, w in enumerate(template):
        spots.setdefault(w, []).append(j)
    recent: list[tuple[int, list[tuple[int, int, int]]]] = []
    top = None
    for i in range(a, b + 1):
        if top and i - top[2] > spec.gap + 1:
            break
        apart = tells_apart(words[i], template, spec)
        if words[i] not in spots:
            recent = [] if apart else recent
            continue
        recent = [x for x in recent if i - x[0] <= spec.gap + 1]
        before = [(0, i)] * (n + 1)  # the longest chain that ends before each place of the template
        for _, chains in recent:
            for j, count, began in chains:
                before[j + 1] = max(before[j + 1], (count, began))
        for j in range(n):
            before[j + 1] = max(before[j + 1], before[j])
        chains = [(j, before[j][0] + 1 + more * (j in must), before[j][1]) for j in spots[words[i]]]
        recent = [*([] if apart else recent), (i, chains)]
        for _, count, began in chains:
            if count >= needed and (top is None or count > top[0]):
                top = (count, began, i)
    return top and (top[0] - more * len(must), *top[1:])


def find_licenses(
    text: str | None,
    templates: dict[str, list[str]],
    spec: LicenseSpec = LicenseSpec(),
    clauses: dict[str, list[tuple[int, int]]] | None = None,
) -> list[tuple[str, int, int, float]]:
    """(name, start, end, coverage) of all hits, in words, end exclusive; a region is tried again after each hit.

    Where hits of several templates overlap, the one with most aligned words stands, then the one with most coverage.
    """
    words = alike(words_of(text or ""))
    present, found = set(words), []
    for name, template in templates.items():
        template = alike(template)
        must = required(template)
        needed = spec.coverage * len(template)
        if sum(w in present for w in template) < needed or not all(template[j] in present for j in must):
            continue
        own, parts = set(template), (clauses or {}).get(name, [])
        todo = regions([i for i, w in enumerate(words) if w in own], spec.gap)
        while todo:
            a, b = todo.pop()
            if b - a + 1 < needed:
                continue
            places = align(words[a : b + 1], template, spec)
            # The aligned words that lie close together; far ones belong to other text.
            close = [(sum(x <= i <= y for i, _ in places), a + x, a + y) for x, y in regions([i for i, _ in places], spec.gap)]
            to = {a + i: j for i, j in places}
            good = [
                (count, x, y)
                for count, x, y in close
                if count >= needed
                and must <= {to[i] for i in range(x, y + 1) if i in to}
                and not any(tells_apart(words[i], template, spec) for i in range(x, y + 1) if i not in to)
                and covers({to[i] for i in range(x, y + 1) if i in to}, parts, spec)
            ]
            if not good and (chain := longest_chain(words, a, b, template, spec)):
                places = align(words[chain[1] : chain[2] + 1], template, spec)
                good = [chain] if covers({j for _, j in places}, parts, spec) else []
            found += [(count, name, first, last + 1, round(count / len(template), 6)) for count, first, last in good]
            if good:  # what lies before, between and after them
                ends = [a - 1, *(x for _, first, last in good for x in (first, last)), b + 1]
                todo += [(x + 1, y - 1) for x, y in zip(ends[::2], ends[1::2])]
    hits: list[tuple[str, int, int, float]] = []
    for _, *hit in sorted(found, key=lambda x: (-x[0], -x[4], x[2], x[1])):
        if all(hit[2] <= h[1] or h[2] <= hit[1] for h in hits):
            hits.append(tuple(hit))
    return sorted(hits, key=lambda x: (x[1], x[0]))


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, spec: LicenseSpec = LicenseSpec()) -> DataFrame:
    """doc_id, n_hits, licenses (sorted names) and hits (name:start:end:coverage) of every document, whole texts.

    Null and empty texts have no hits; repeated rows are each scanned.
    """
    cut = {name: words_of(text) for name, text in templates.items()}
    clauses = {name: clauses_of(text) for name, text in templates.items()}
    schema = pa.schema([("doc_id", pa.int64()), ("n_hits", pa.int64()), ("licenses", pa.list_(pa.string())), ("hits", pa.list_(pa.string()))])

    def scan(doc_id, text):
        hits = find_licenses(text, cut, spec, clauses)
        return doc_id, len(hits), sorted({h[0] for h in hits}), [":".join(map(str, h)) for h in hits]

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(row_by_row(scan, schema), "doc_id long, n_hits long, licenses array<string>, hits array<string>")
