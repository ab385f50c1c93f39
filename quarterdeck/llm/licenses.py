"""Licence scan: normalised text against licence templates by the Dice coefficient over word bigrams.

Templates are notices, paragraphs and whole headers of licences. A document is compared line by line, paragraph by
paragraph and whole; a coefficient of t needs sizes within a factor of t / (2 - t) of each other, so a piece meets only the
templates in that range of sizes. Notices inside longer pieces are found in word windows of a template's size: one that
reaches t lacks at most a share of 1 - t of the template's bigrams, so it holds one of any larger set of them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_DICE = 0.8

#: (licence, paragraph or notice). Fixed values, from the public texts of the licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "MIT",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS"
        " OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
        " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with"
        " the License. You may obtain a copy of the License at",
    ),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later"
        " version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:",
    ),
    (
        "BSD-3-Clause",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
        " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
        " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
        " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
        " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
        " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE"
        " OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work has been dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    (
        "MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software.",
    ),
    (
        "BSD-3-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer.",
    ),
    (
        "BSD-3-Clause",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
        " disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
        " derived from this software without specific prior written permission.",
    ),
    (
        "ISC",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL"
        " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
        " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN"
        " AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
        " PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "GPL-3.0",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied"
        " warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    # Titles and first paragraphs of whole texts, which are too long to be held against a document piece by piece.
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    (
        "LGPL-3.0",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU"
        " General Public License, supplemented by the additional permissions listed below.",
    ),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)"
        " any later version.",
    ),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)

#: Templates that stand in several licences, by their text's place above. Fixed values.
SHARED = {
    16: ("BSD-2-Clause", "BSD-3-Clause"), 17: ("BSD-2-Clause", "BSD-3-Clause"), 30: ("BSD-2-Clause", "BSD-3-Clause"),
    31: ("BSD-2-Clause", "BSD-3-Clause"), 34: ("GPL-2.0", "GPL-3.0"),
}
#: Characters between a reservation of rights and the licence that it goes with.
NEAR = 200


def _whole(name: str, *numbers: int) -> tuple[str, str]:
    return name, "\n\n".join(TEMPLATES[k][1] for k in numbers)


#: Whole headers, made of the paragraphs above.
TEMPLATES += (
    _whole("MIT", 4, 29, 5),
    ("Apache-2.0", f"{TEMPLATES[8][1]} http://www.apache.org/licenses/LICENSE-2.0 {TEMPLATES[9][1]}"),
    _whole("BSD-3-Clause", 16, 30, 31, 32, 17),
    _whole("BSD-2-Clause", 16, 30, 31, 17),
    _whole("ISC", 18, 33),
    _whole("GPL-3.0", 12, 34),
    _whole("GPL-2.0", 14, 34),
)
_WORD = re.compile(r"[^\W_]+")
_COPYRIGHT = re.compile(r"^\W*(?:copyright|\(c\)|©)\b.*\d{4}.*$", re.IGNORECASE)


def normalised(text: str) -> list[str]:
    """Lower-case words and figures without punctuation; British spelling as American."""
    return ["license" + w[7:] if w.startswith("licence") else w for w in _WORD.findall(text.lower())]


def bigrams(words: list[str]) -> Counter:
    """Pairs of neighbouring words, with marks at both ends so that short notices have some."""
    return Counter(zip(["^", *words], [*words, "$"], strict=True)) if words else Counter()


def dice(a: Counter, b: Counter) -> float:
    """Twice the common bigrams over all bigrams, repeats included; 0 if both are empty."""
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Matcher:
    """Templates by size. `least` is the smallest coefficient reported."""

    def __init__(self, templates=TEMPLATES, least: float = MIN_DICE):
        self.least, self.bound = least, least / (2 - least)
        made = sorted(((bigrams(normalised(t)), name, k) for k, (name, t) in enumerate(templates)), key=lambda x: (x[0].total(), x[2]))
        self.templates, self.sizes = made, [m[0].total() for m in made]
        #: Bigrams to look for -> (place in `templates`, number of words, place in the template).
        self.anchors: dict[tuple[str, str], list[tuple[int, int, int]]] = {}
        for m, (_, _, k) in enumerate(made):
            words = normalised(templates[k][1])
            inner = sorted(enumerate(zip(words, words[1:], strict=False)), key=lambda x: (-len(x[1][0]) - len(x[1][1]), x[0]))
            for at, pair in inner[: int((1 - least) * (len(words) + 1) + 1e-9) + 1]:
                self.anchors.setdefault(pair, []).append((m, len(words), at))
        self.first = frozenset(a for a, _ in self.anchors)
        self.words = frozenset(w for m in made for pair in m[0] for w in pair) - {"^", "$"}

    def best(self, piece: str) -> tuple[str, int, float] | None:
        """Licence, template number and coefficient of the template most alike, the earliest of equals."""
        if _COPYRIGHT.match(piece) and len(piece) < 200:
            return None
        words = normalised(piece)
        size = len(words) + 1
        lo, hi = bisect_left(self.sizes, size * self.bound), bisect_right(self.sizes, size / self.bound)
        # A coefficient of t over pairs needs a share of t / (2 - t) of the pairs, so of the words, from some template.
        if not words or lo == hi or sum(w in self.words for w in words) < self.bound * len(words) - 1:
            return None
        mine, found = bigrams(words), None
        for template, name, k in self.templates[lo:hi]:
            d = dice(mine, template)
            if d >= self.least and (found is None or (-d, k) < (-found[2], found[1])):
                found = (name, k, d)
        return found

    def windows(self, words: list[str]) -> list[tuple[str, int, int, int, float]]:
        """(licence, template, first word, end, coefficient) of windows that don't overlap, those with most in common first."""
        starts: dict[tuple[int, int], set[int]] = {}
        for i, word in enumerate(words[:-1]):
            if word in self.first:
                for m, size, at in self.anchors.get((word, words[i + 1]), ()):
                    starts.setdefault((m, size), set()).add(i - at)
        found = []
        for (m, size), places in starts.items():
            template, name, k = self.templates[m]
            tried, cluster = set(), []
            for a in [*sorted(places), None]:
                if cluster and (a is None or a - cluster[0] > max(1, size // 4)):
                    tried |= {(c, c + size) for c in cluster} | {(cluster[0], cluster[-1] + size)}  # the last: words inserted
                    tried |= {(cluster[-1], cluster[0] + size)}  # words dropped
                    cluster = []
                if a is not None:
                    cluster.append(a)
            for a, b in {(max(a, 0), min(b, len(words))) for a, b in tried}:
                d = dice(bigrams(words[a:b]), template) if a < b else 0.0
                if d >= self.least:
                    found.append((-d * (b - a + 1 + template.total()), -d, k, a, b, name))
        out, taken = [], set()
        for _, d, k, a, b, name in sorted(found):
            if taken.isdisjoint(range(a, b)):
                taken.update(range(a, b))
                out.append((name, k, a, b, -d))
        return out


def pieces(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the lines, of the paragraphs of two or more lines, and of a text of two or more paragraphs.

    A line without a word, such as an empty comment line, parts paragraphs.
    """
    at, start, lines, paragraphs = 0, 0, 0, 0
    for line in [*text.split("\n"), ""]:
        if _WORD.search(line):
            if not lines:
                start = at
            yield at, at + len(line)
            lines, end = lines + 1, at + len(line)
        elif lines:
            if lines > 1:
                yield start, end
            lines, paragraphs = 0, paragraphs + 1
        at += len(line) + 1
    if paragraphs > 1:
        yield 0, len(text)


def scan(text: str | None, matcher: Matcher) -> list[tuple[str, int, int, int, float]]:
    """(licence, template, start, end, dice) of every piece that is like a template, in code points.

    Then of windows that are, unless pieces with the same licence cover half of them. The "All rights reserved" of a
    copyright line, or beside another notice, is no notice of its own. A paragraph that several licences share counts for
    the one of them that the text names otherwise, else for all of them, joined by OR.
    """
    found = _hits(text, matcher)
    if len(found) > 1 and any(name == "proprietary" for name, *_ in found):
        others = sorted((a, b) for name, _, a, b, _ in found if name != "proprietary")
        starts = [a for a, _ in others]
        ends = list(accumulate((b for _, b in others), max))

        def beside(a: int, b: int) -> bool:
            at = bisect_right(starts, b + NEAR)
            return at > 0 and ends[at - 1] >= a - NEAR

        found = [h for h in found if h[0] != "proprietary" or not beside(h[2], h[3])]
    if any(k in SHARED for _, k, *_ in found):
        named = {name for name, k, *_ in found if k not in SHARED}
        found = [(_one_of(SHARED[h[1]], named), *h[1:]) if h[1] in SHARED else h for h in found]
    return found


def _in_copyright_line(text: str, start: int, end: int) -> bool:
    begin = text.rfind("\n", max(start - 200, 0), start) + 1
    return (begin > 0 or start < 200) and end - begin < 200 and bool(_COPYRIGHT.match(text[begin:end]))


def _one_of(licenses: tuple[str, ...], named: set[str]) -> str:
    return " OR ".join([n for n in licenses if n in named] or licenses)


def _hits(text: str | None, matcher: Matcher) -> list[tuple[str, int, int, int, float]]:
    found = []
    for start, end in pieces(text or ""):
        hit = matcher.best(text[start:end])
        if hit:
            found.append((hit[0], hit[1], start, end, hit[2]))
    words = normalised(text or "")
    if matcher.first.isdisjoint(words) or matcher.anchors.keys().isdisjoint(zip(words, words[1:], strict=False)):
        return found
    # Lower case may have another length, so places are taken from the text as it is.
    spans, words = [], []
    for m in _WORD.finditer(text):
        for word in normalised(m[0]):
            spans.append(m.span())
            words.append(word)
    known: dict[str, list[list[int]]] = {}  # spans of a licence, joined where they overlap
    for name, _, start, end, _ in sorted(found, key=lambda h: h[2]):
        spans_of = known.setdefault(name, [])
        if spans_of and start <= spans_of[-1][1]:
            spans_of[-1][1] = max(spans_of[-1][1], end)
        else:
            spans_of.append([start, end])
    more = []
    for name, k, a, b, d in matcher.windows(words):
        start, end = spans[a][0], spans[b - 1][1]
        covered, joined = 0, known.get(name, ())
        for s, e in joined[bisect_right(joined, start, key=lambda x: x[1]) :]:
            if s >= end:
                break
            covered += min(e, end) - max(s, start)
        if 2 * covered < end - start and not (name == "proprietary" and _in_copyright_line(text, start, end)):
            more.append((name, k, start, end, d))
    return found + sorted(more, key=lambda s: (s[2], s[3]))


def license_spans(docs: DataFrame, least: float = MIN_DICE) -> DataFrame:
    """(doc_id, license, template, start, end, dice): one row for each piece or window of each whole text that
    matches.

    Null, empty and unlicensed texts give no rows; repeated rows of `docs` repeat theirs. Other columns are not read.
    """

    @F.pandas_udf("array<struct<license:string,template:int,start:int,end:int,dice:double>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(least=least)
        names = ("license", "template", "start", "end", "dice")
        for batch in batches:
            yield pd.Series([[dict(zip(names, s, strict=True)) for s in scan(t, matcher)] for t in batch])

    return docs.select("doc_id", F.explode(spans("text")).alias("s")).select("doc_id", "s.*")
