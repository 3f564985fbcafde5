"""Licence texts found by the Dice coefficient of word bigrams, anywhere in a text.

Words are runs of letters, digits and underscores in lower case, so case, marks
and layout do not count. A text is one value in a task, where its words are held at
once, so it should stay below some hundred MB. A text is read as one row of words, and every window of
it, inside a line, a paragraph or across them, is held against every template.
A window of a distinct bigrams can reach Dice t with a template of n only if a
is between n t / (2 - t) and n (2 - t) / t and it shares n t / (2 - t) bigrams
at least. So a template that shares fewer with the whole text is left out, and
as words that share nothing only lower the coefficient, windows start and end
with a bigram of the template. Nothing is sampled.

Of each template the windows of the highest coefficient are taken that share no
word. A match gives way to another that explains half of its bigrams or more
and lies further above t (the shared bigrams, doubled, less t (a + n)); within a
licence, only to one of no lower coefficient. Of equals the name first in order
stays.

A coefficient cannot tell "version 2" from "version 3", nor CC BY-NC from CC
BY-NC-ND: they differ in a word. So versions and variants are templates under
names of their own, and a match must state the numbers and variants of its
template and no others, up to the word after it. The numbers are all those of a
notice of at most ``SHORT`` words, in longer texts those after "version".

Null and empty texts match nothing. Repeated rows get equal results. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.tokens import slices

WORDS = re.compile(r"\w+")
LEAST_DICE = 0.8

# Short notices and opening texts of common licences, as their publishers word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License."""),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# The paragraphs of notices and of whole licences. Placeholders for names and years are left out.
_MIT = ("""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:""",
    """The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""")  # fmt: skip
_BSD = ("""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met:""",
    """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer.""",
    """2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution.""")  # fmt: skip
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
        USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
        ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE."""
_UNLICENSE = ("This is free and unencumbered software released into the public domain.",
    """Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form
        or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    """In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
        copyright interest in the software to the public domain. We make this dedication for the benefit of the public at
        large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
        relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    _MIT[2].replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS"))


def _gnu(name: str, version: str, thing: str, mark: str) -> tuple[str, str, str]:
    """Header of a GNU licence without its last paragraph, and the last one with the address on the web."""
    return (f"""This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} as
        published by the Free Software Foundation{"," if mark == ":" else ";"} either version {version} of the License, or (at your
        option) any later version.""",
        f"""This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.""",
        f"""You should have received a copy of the GNU {name} along with this {thing}. If not, see
        <https://www.gnu.org/licenses/>.""")  # fmt: skip


def _by_post(name: str, thing: str) -> str:
    return f"""You should have received a copy of the GNU {name} along with this {thing}; if not, write to the Free Software
        Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."""


def _opening(name: str, version: str, years: str) -> tuple[str, str]:
    return (f"GNU {name} Version {version} Copyright (C) {years} Free Software Foundation, Inc.",
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.")


_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_GPL2, _GPL3 = _gnu(_GPL, "2", "program", ";"), _gnu(_GPL, "3", "program", ":")
_LGPL21 = _gnu(_LGPL, "2.1", "library", ";")

PARAGRAPHS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("0BSD", ("""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted.""", _ISC_END)),
    ("AGPL-3.0", (f"This work is licensed under the GNU {_AGPL}, version 3.",)),
    ("AGPL-3.0", _gnu(_AGPL, "3", "program", ":")),
    ("AGPL-3.0", _opening(_AGPL, "3, 19 November 2007", "2007")),
    ("Apache-2.0", ("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
        """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""")),
    ("Apache-2.0", ("""Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE,
        REPRODUCTION, AND DISTRIBUTION""",)),
    ("BSD-2-Clause", ("Licensed under the BSD 2-Clause License.",)),
    ("BSD-2-Clause", (*_BSD, _BSD_END)),
    ("BSD-3-Clause", (*_BSD, _BSD_NAMES, _BSD_END)),
    ("GPL-2.0", (*_GPL2[:2], _by_post(_GPL, "program"))),
    ("GPL-2.0", _GPL2),
    ("GPL-2.0", (f"""This program is free software; you can redistribute it and/or modify it under the terms of the GNU {_GPL}
        version 2 as published by the Free Software Foundation.""", _GPL2[1])),
    ("GPL-2.0", _opening(_GPL, "2, June 1991", "1989, 1991")),
    ("GPL-3.0", _GPL3),
    ("GPL-3.0", _opening(_GPL, "3, 29 June 2007", "2007")),
    ("ISC", ("""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""", _ISC_END)),
    ("LGPL-2.1", (f"This work is licensed under the GNU {_LGPL}, version 2.1.",)),
    ("LGPL-2.1", (*_LGPL21[:2], _by_post(_LGPL, "library"))),
    ("LGPL-2.1", _LGPL21),
    ("LGPL-2.1", _opening(_LGPL, "2.1, February 1999", "1991, 1999")),
    ("LGPL-3.0", (f"This work is licensed under the GNU {_LGPL}, version 3.",)),
    ("LGPL-3.0", _gnu(_LGPL, "3", "program", ":")),
    ("LGPL-3.0", _opening(_LGPL, "3, 29 June 2007", "2007")),
    ("MIT", _MIT),
    ("Unlicense", _UNLICENSE),
)


# Versions of the Creative Commons licences and of the GNU licences, and identifiers a line may declare.
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_VARIANTS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
GNU_VERSIONS = (("GPL", _GPL, ("1", "2", "3")), ("LGPL", "Library General Public License", ("2",)), ("LGPL", _LGPL, ("2.1", "3")), ("AGPL", _AGPL, ("1", "3")))
DECLARED = ("0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "ISC", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense", "Zlib", "EPL-1.0", "EPL-2.0")
DECLARATION = "SPDX-License-Identifier:"
#: Words that tell a variant from its neighbours.
VARIANTS = frozenset("nc nd sa noncommercial noderivatives noderivs sharealike lesser affero only later".split())
SHORT = 14


def _variants() -> tuple[tuple[str, str], ...]:
    """Notices of every version and variant, lines that declare an identifier, and headings."""
    out = []
    for variant, name in CC_VARIANTS.items():
        for version in CC_VERSIONS:
            kind = "International" if version == "4.0" else "Unported" if version == "3.0" else ""
            out.append((f"CC-{variant}-{version}", f"Licensed under CC {variant} {version}."))
            out.append((f"CC-{variant}-{version}", f"This work is licensed under a Creative Commons {name} {version} {kind} License."))
            out.append((f"CC-{variant}-{version}", f"{DECLARATION} CC-{variant}-{version}"))
    for short, name, versions in GNU_VERSIONS:
        for version in versions:
            full = f"{short}-{version if '.' in version else version + '.0'}"
            out.append((full, f"This work is licensed under the GNU {name}, version {version}."))
            out.append((full, f"Licensed under {short}v{version}"))
            out += [(full, f"{DECLARATION} {full}{end}") for end in ("", "-only", "-or-later")]
            thing, mark = ("library", ";") if name in (_LGPL, "Library General Public License") and version != "3" else ("program", ":" if version == "3" else ";")
            out += [(full, " ".join(_gnu(name, version, thing, mark)[:1]))]
    out += [(name, f"{DECLARATION} {name}") for name in DECLARED]
    out += [(name, f"Licensed under {name}") for name in DECLARED]
    out += [("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"), ("ISC", "ISC License"), ("Unlicense", "The Unlicense")]
    return tuple(out)


def known() -> tuple[tuple[str, str], ...]:
    """All templates: the short ones, each paragraph by itself, all paragraphs of an entry as one, and the variants.

    A paragraph that several licences share is named by all of them, the last
    first, so that among equals each of them alone comes before it.
    """
    owners: dict[str, set[str]] = {}
    for name, texts in [*((n, (t,)) for n, t in (*TEMPLATES, *_variants())), *PARAGRAPHS]:
        for text in {*texts, " ".join(texts)}:
            owners.setdefault(" ".join(normalised(text)), set()).add(name)
    return tuple((" OR ".join(sorted(names, reverse=True)), text) for text, names in owners.items())


Bigrams = set[tuple[str, str]]


def bigrams(words: list[str]) -> Bigrams:
    return set(zip(words, words[1:], strict=False))


def normalised(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def telling(words: list[str], short: bool) -> set[str]:
    """The words that tell a version or a variant."""
    numbered = (w for before, w in zip(["", *words], words) if w.isdigit() and (short or before in ("version", "v")))
    return {*numbered, *(w for w in words if w in VARIANTS)}


@dataclass(frozen=True)
class Match:
    license: str
    dice: float
    #: Bigrams first to last, both included; those that the template shares; and how far the match is above the least coefficient.
    first: int
    last: int
    shared: np.ndarray
    above: float


class Templates:
    """In order of size."""

    def __init__(self, named: tuple[tuple[str, str], ...], least: float):
        self.least = least
        found = [(len(b), name, b, normalised(text)) for name, text in named if (b := bigrams(normalised(text)))]
        found.sort(key=lambda x: x[:2])
        self.found = [x[:3] for x in found]
        self.short = [len(x[3]) <= SHORT for x in found]
        self.telling = [telling(x[3], len(x[3]) <= SHORT) for x in found]
        self.declared = [x[3][3:] if x[3][:3] == normalised(DECLARATION) else [] for x in found]
        self.sizes = [n for n, _, _ in self.found]
        self.slack = 1e-9
        self.fewest = self.sizes[0] * least / (2 - least) - self.slack if self.sizes else float("inf")
        self.need = np.array([math.ceil(n * least / (2 - least) - self.slack) for n in self.sizes], np.int64)
        every = sorted(set().union(*(b for _, _, b in self.found)))
        self.words = {w: i for i, w in enumerate(sorted({w for pair in every for w in pair}), 1)}
        self.number = np.zeros((len(self.words) + 1) ** 2, np.int32)  # of a bigram of templates, from those of its words
        self.number[[self.words[v] * (len(self.words) + 1) + self.words[w] for v, w in every]] = np.arange(1, len(every) + 1)
        self.member = np.array([[False] * len(self.found), *([pair in b for _, _, b in self.found] for pair in every)], bool).reshape(-1, len(self.found))

    def matches(self, words: list[str]) -> list[Match]:
        """In order of their first words."""
        if len(words) - 1 < self.fewest:
            return []
        ids = np.fromiter(map(self.words.get, words, repeat(0)), np.int64, len(words))
        numbers = self.number[ids[:-1] * (len(self.words) + 1) + ids[1:]]
        met = np.unique(numbers)
        may = np.flatnonzero(self.member[met].sum(axis=0) >= self.need)
        if not len(may):
            return []
        row = Row(words)
        found = [m for k in may.tolist() for m in self._windows(row, k, self.member[numbers, k]) if self._tells(words, k, m)]
        return sorted(_standing(found), key=lambda m: (m.first, m.last, m.license))

    def _tells(self, words: list[str], k: int, m: Match) -> bool:
        """Whether a match states the version and variant of its template."""
        window = words[m.first : m.last + 2]
        mine, last = telling(window, self.short[k]), window[-1]
        if not set(self.declared[k]) <= set(window):
            return False
        after = words[m.last + 2 : m.last + 3]
        if after and (after[0] in VARIANTS or (after[0].isdigit() and not last.isdigit() and any(w.isdigit() for w in self.telling[k]))):
            mine.add(after[0])
        return mine == self.telling[k]

    def _windows(self, row: Row, k: int, inside: np.ndarray) -> Iterator[Match]:
        n, name, _ = self.found[k]
        need, most, at = int(self.need[k]), n * (2 - self.least) / self.least + self.slack, np.flatnonzero(inside)

        def rate(first: int, stop: int) -> tuple[float, int, int] | None:
            """Closest window from ``first`` on that ends before ``stop``, its coefficient negative."""
            stop, width = min(stop, int(row.after[first])), 2 * int(most) + 2
            while True:
                end = min(first + width, stop)
                new = row.before[first:end] < first
                size = new.cumsum()
                if end == stop or size[-1] > most:
                    break
                width *= 2
            dice = 2 * (new & inside[first:end]).cumsum() / (size + n)
            last = int(dice.argmax())
            return (-float(dice[last]), first, first + last) if dice[last] >= self.least else None

        # A window needs so many shared bigrams, and bigrams that are new to the text count in any window.
        start, end = at[: len(at) - need + 1], at[need - 1 :]
        start = start[(row.fresh[end + 1] - row.fresh[start] <= most) & (end < row.after[start])]
        heap = [x for i in start.tolist() if (x := rate(i, len(inside)))]
        heapq.heapify(heap)
        firsts, lasts = [], []  # of the windows taken, in order
        while heap:
            dice, first, last = heapq.heappop(heap)
            place = bisect_right(firsts, first)
            if place and lasts[place - 1] + 1 >= first:
                continue
            if place < len(firsts) and last + 1 >= firsts[place]:
                if firsts[place] - 1 > first and (x := rate(first, firsts[place] - 1)):
                    heapq.heappush(heap, x)
                continue
            firsts.insert(place, first)
            lasts.insert(place, last)
            shared = first + np.flatnonzero(inside[first : last + 1])
            size = int((row.before[first : last + 1] < first).sum())
            yield Match(name, -dice, first, last, shared, (-dice - self.least) * (size + n))


class Row:
    """Where the bigrams of a text stand before and after, and how many are new."""

    def __init__(self, words: list[str]):
        own: dict[str, int] = {}
        ids = np.array([own.setdefault(w, len(own)) for w in words], np.int64)
        codes = ids[:-1] * len(own) + ids[1:]
        order = np.argsort(codes, kind="stable")
        again = codes[order[1:]] == codes[order[:-1]]
        self.before, self.after = np.full(len(codes), -1), np.full(len(codes), len(codes))
        self.before[order[1:][again]] = order[:-1][again]
        self.after[order[:-1][again]] = order[1:][again]
        self.fresh = np.concatenate([[0], (self.before < 0).cumsum()])


def _standing(found: list[Match]) -> Iterator[Match]:
    """Matches that no better one explains."""

    def of_group(group: list[Match]) -> list[Match]:
        kept: list[Match] = []
        for m in sorted(group, key=lambda m: (-m.above, -m.dice, m.license, m.first)):
            rivals = (k for k in kept if k.first <= m.last and m.first <= k.last and (k.license != m.license or k.dice >= m.dice))
            if not any(2 * np.isin(m.shared, k.shared, assume_unique=True).sum() >= len(m.shared) for k in rivals):
                kept.append(m)
        return kept

    group, end = [], -1
    for m in sorted(found, key=lambda m: m.first):
        if m.first > end:
            yield from of_group(group)
            group = []
        group.append(m)
        end = max(end, m.last)
    yield from of_group(group)


def find(templates: Templates, text: str | None) -> list[tuple[str, float, int, int]]:
    """license, dice, first_line and n_lines of every match."""
    text = (text or "").lower()
    found = templates.matches(WORDS.findall(text))
    if not found:
        return []
    upto = np.cumsum([len(WORDS.findall(x)) for x in text.split("\n")])
    lines = [np.searchsorted(upto, [m.first, m.last + 1], "right").tolist() for m in found]
    return [(m.license, m.dice, a, b - a + 1) for m, (a, b) in zip(found, lines, strict=True)]


def _scan(named: tuple[tuple[str, str], ...], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(named, least)
        for whole in batches:
            for a, b in slices(pc.binary_length(whole.column(1)).fill_null(0).to_pylist(), 8 << 20):
                batch = whole.slice(a, b - a)
                found = [find(templates, text) for text in batch.column(1).to_pylist()]
                kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int64()), ("n_lines", pa.int64())]))
                matches = pa.array([[dict(zip(("license", "dice", "first_line", "n_lines"), m, strict=True)) for m in ms] for ms in found], kind)
                yield pa.RecordBatch.from_arrays([batch.column(0), matches], names=["id", "matches"])

    return run


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] | None = None, least: float = LEAST_DICE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Against ``known()`` unless told otherwise: id and matches (license, dice, first_line, n_lines; in order of their places) of every row."""
    match = T.StructType([T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("first_line", T.LongType()), T.StructField("n_lines", T.LongType())])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("matches", T.ArrayType(match))])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(_scan(known() if templates is None else templates, least), schema)
