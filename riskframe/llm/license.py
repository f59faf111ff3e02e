"""Operator 3, license scans: patience alignment of texts against license templates.

Both sides are word sequences (lower case, letters and digits). Words that occur once in the template and once in the
part of the text under test are anchors; the longest increasing run of them fixes the alignment, and the gaps between
anchors are aligned the same way; a gap without anchors gets its longest common subsequence, whatever its size. The
coverage is the share of template words that found their place.

A place of a license is a run of words, at most ``SPREAD`` template lengths long, that holds the coverage's share of the
template in order. What has that share holds, of the template's less common words (each as often as the template has it), all
but as many as the template may lose; texts with fewer cost one count of their words and are done, and in the others only the
stretches around enough of them are cut into one part per copy and aligned. So no place is passed over, however its words are chosen.
The templates (a parameter; the fixed ones are notices and, as package data, whole license texts) go to every task; nothing is shuffled.

Cases: null and empty texts hold no license; a license that occurs several times is reported with every place; of
licenses with the same coverage the first by name is the text's license; repeated rows are scanned one by one; texts of
any length are scanned whole; an empty table gives an empty result; other columns, whatever their names, are not carried.
"""

from __future__ import annotations

import math
import re
import sys
from bisect import bisect_left
from collections import Counter
from pathlib import Path

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = re.compile(r"[^\W_]+")
#: Least coverage of a reported license, and the longest place in template lengths.
COVERAGE, SPREAD = 0.8, 3
#: Larger gaps without an anchor (template words times text words) are aligned by bits, not by a table.
SMALL_GAP = 4096

# Notices and license texts as published.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "AGPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS
        SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
        LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
        NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the
        name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
        software without specific prior written permission. THIS
        SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
        LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
        NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
        THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
        IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
        RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
        OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "LGPL-3.0-header": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "MIT": "Released under the MIT License.",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
        use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
        ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}


def whole_texts() -> dict[str, str]:
    """The license texts that are package data, by file name (read on the driver)."""
    return {f"{f.stem}-text": f.read_text() for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}


TEMPLATES = NOTICES | whole_texts()
# English words too common to point at a license.
COMMON = frozenset("a all an and any as at be but by do for in is it may no not of on or so that the this to under use with you".split())


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(values)
    for k, v in enumerate(values):
        p = bisect_left(tops, v)
        if p == len(tops):
            tops.append(v)
            piles.append(k)
        else:
            tops[p], piles[p] = v, k
        before[k] = piles[p - 1] if p else -1
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def _word_by_word(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Longest common subsequence of two short sequences."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _masks(a: list[str]) -> dict[str, int]:
    """Per word, its positions in a sequence as bits."""
    out: dict[str, int] = {}
    for i, w in enumerate(a):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _lcs_rows(masks: dict[str, int], size: int, b):
    """After every word of b, the bit-parallel row of the longest common subsequence: its zero bits count the matches."""
    full = row = (1 << size) - 1
    for w in b:
        u = row & masks.get(w, 0)
        row = ((row + u) | (row - u)) & full
        yield row


def _by_bits(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Longest common subsequence of two sequences of any size (one bit per pair of words)."""
    rows = [(1 << len(a)) - 1, *_lcs_rows(_masks(a), len(a), b)]
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[j] >> (i - 1) & 1:
            i -= 1
            continue
        j -= 1
        if rows[j] >> (i - 1) & 1:
            i -= 1
            out.append((i, j))
    return out[::-1]


def _reach(masks: dict[str, int], size: int, b, need: int) -> int | None:
    """Fewest first words of b that have ``need`` words in common, in order, with the masked sequence."""
    return next((k for k, row in enumerate(_lcs_rows(masks, size, b), 1) if size - row.bit_count() >= need), None)


def align(template: list[str], text: list[str]) -> list[tuple[int, int]]:
    """Matched positions (template, text), increasing in both: anchors, then the gaps between them."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(text))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == text[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        left, right = Counter(template[a:b]), Counter(text[c:d])
        place = {w: j for j, w in enumerate(text[c:d], c) if right[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(template[a:b], a) if left[w] == 1 and w in place]
        anchors = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        if anchors:
            out += anchors
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
        else:
            exact = _word_by_word if (b - a) * (d - c) <= SMALL_GAP else _by_bits
            out += [(a + i, c + j) for i, j in exact(template[a:b], text[c:d])]
    return sorted(out)


class Scanner:
    """Templates ready for scanning."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.words = {k: WORD.findall(t.lower()) for k, t in sorted(templates.items())}
        self.masks = {k: (_masks(w), _masks(w[::-1])) for k, w in self.words.items()}
        self.rare = {k: Counter(x for x in w if x not in COMMON) for k, w in self.words.items()}
        #: less common words that a place has at least
        self.need = {k: self.rare[k].total() - (len(w) - self.least(k)) for k, w in self.words.items()}
        self.by_word: dict[str, list[tuple[str, int]]] = {}
        for k, ws in self.rare.items():
            for w, n in ws.items():
                self.by_word.setdefault(w, []).append((k, n))

    def least(self, name: str) -> int:
        """Template words that a place holds at least."""
        return max(1, math.ceil(self.coverage * len(self.words[name]) - 1e-9))

    def _stretches(self, name: str, words: list[str]) -> list[list[int]]:
        """Ranges of word positions that hold every place of a license: those around enough of its less common words."""
        size, caps, need = (SPREAD + 1) * len(self.words[name]), self.rare[name], self.need[name]
        if need <= 0:
            return [[0, len(words)]]
        hits, inside, first, total = [k for k, w in enumerate(words) if w in caps], Counter(), 0, 0
        out: list[list[int]] = []
        for at in hits:
            inside[words[at]] += 1
            total += inside[words[at]] <= caps[words[at]]
            while hits[first] <= at - size:
                w = words[hits[first]]
                total -= inside[w] <= caps[w]
                inside[w] -= 1
                first += 1
            if total >= need:
                lo, hi = max(0, at - size), min(len(words), at + size)
                if out and lo <= out[-1][1]:
                    out[-1][1] = hi
                else:
                    out.append([lo, hi])
        return out

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(license, coverage, start, end) of every place, by license and start; offsets in code points."""
        low = text.lower()
        if len(low) != len(text):  # keep offsets: lower-case letter by letter where the whole changes its length
            low = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
        words = WORD.findall(low)
        counts, held = Counter(words), Counter()
        for w in counts.keys() & self.by_word.keys():
            for name, cap in self.by_word[w]:
                held[name] += min(cap, counts[w])
        out, spans = [], None
        for name in self.words:
            if held[name] >= self.need[name]:
                for lo, hi in self._stretches(name, words):
                    spans = spans or [m.span() for m in WORD.finditer(low)]
                    out += self._places(name, words, spans, lo, hi)
        return out

    def _tight(self, name: str, words, lo: int, hi: int, need: int) -> tuple[int, int] | None:
        """The range of the earliest end, and of these the latest start, with ``need`` template words in order."""
        size, (ahead, back) = len(self.words[name]), self.masks[name]
        n = _reach(ahead, size, words[lo:hi], need)
        return n and (lo + n - _reach(back, size, words[lo:lo + n][::-1], need), lo + n)

    def _cores(self, name: str, words, lo: int, hi: int) -> list[tuple[int, int]]:
        """Most disjoint ranges that reach the coverage, all within SPREAD template lengths: one per copy."""
        size, out = len(self.words[name]), []
        need = self.least(name)
        while hi - lo >= need:
            end = min(hi, lo + (SPREAD + 1) * size)  # with steps of one length, all places of SPREAD lengths lie in one
            core = self._tight(name, words, lo, end, need)
            if core:
                out.append(core)
                lo = core[1]
            elif end < hi:
                lo += size
            else:
                break
        return out

    def _places(self, name: str, words, spans, lo: int, hi: int):
        """Alignments in a window: of each core with the words around it, up to the place before and the core behind."""
        template, out, cores = self.words[name], [], self._cores(name, words, lo, hi)
        size, (masks, _) = len(template), self.masks[name]
        for k, (s, e) in enumerate(cores):
            a, b = max(lo, e - (SPREAD + 1) * size), min(cores[k + 1][0] if k + 1 < len(cores) else hi, s + (SPREAD + 1) * size)
            *_, row = _lcs_rows(masks, size, words[a:b])
            a, b = self._tight(name, words, a, b, size - row.bit_count())
            pairs = align(template, words[a:b])
            if len(pairs) < self.coverage * size:  # anchors out of order
                pairs = _by_bits(template, words[a:b])
            first, lo = a + pairs[0][1], a + pairs[-1][1] + 1
            out.append((name, round(len(pairs) / size, 6), spans[first][0], spans[lo - 1][1]))
        return out


def scan(df: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, n_places, places), one row per row of ``df`` (columns doc_id, text).

    ``license`` is the one of the highest coverage (null without any); ``places`` lists all as name:start:end.
    """
    small_batches(df)
    scanner = Scanner(TEMPLATES if templates is None else templates, coverage)

    def run(batches):
        for b in batches:
            best, share, n, places = [], [], [], []
            texts = b["text"].to_pylist()
            for t in texts:
                found = scanner.scan(t) if t else []
                top = min(found, key=lambda x: (-x[1], x[0]), default=None)
                best.append(top and top[0])
                share.append(top[1] if top else 0.0)
                n.append(len(found))
                places.append(",".join(f"{k}:{s}:{e}" for k, _, s, e in found))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(best, pa.string()), pa.array(share, pa.float64()),
                                              pa.array(n, pa.int64()), pa.array(places, pa.string())],
                                             names=["doc_id", "license", "coverage", "n_places", "places"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, license string, coverage double, n_places long, places string")


def op3(documents: DataFrame) -> DataFrame:
    """The result for every document."""
    return scan(documents)
