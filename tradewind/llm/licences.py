"""Licence scan: Dice coefficient over word bigrams against licence templates."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_DICE = 0.8
EPSILON = 1e-9
WORD = re.compile(r"[^\W_]+")
# Lines and sentences: the units whose runs are compared.
UNIT = re.compile(r"[^\n]+?(?:[.!?;:](?=\s)|(?=\n)|\Z)|[^\n]+")

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met: Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""
_GNU_NOTICE = """This {work} is free software: you can redistribute it and/or modify it under the
terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the
License, or (at your option) any later version. This {work} is distributed in the hope that it will
be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of the
GNU {name} along with this {work}."""
_BSD_THIRD = """Neither the name of the copyright holder nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written
permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD
TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
_MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If
a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/."""
_EPL_NOTICE = """This program and the accompanying materials are made available under the terms of the
Eclipse Public License {version} which accompanies this distribution, and is available at
https://www.eclipse.org/legal/epl-{version}."""
_BOOST_NOTICE = """Distributed under the Boost Software License, Version 1.0. (See accompanying file
LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to
copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software. Permission is
granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions: The origin of this
software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated
but is not required. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. This notice may not be removed or altered from any
source distribution."""
_CC0 = """To the extent possible under law, the author has waived all copyright and related or
neighboring rights to this work."""

# Licences of families that share a wording, with names, versions and short forms.
_GNU = (
    ("GPL-2.0", "General Public License", "2", "GPL"),
    ("GPL-3.0", "General Public License", "3", "GPL"),
    ("LGPL-2.1", "Lesser General Public License", "2.1", "LGPL"),
    ("LGPL-3.0", "Lesser General Public License", "3", "LGPL"),
    ("AGPL-3.0", "Affero General Public License", "3", "AGPL"),
)
_CREATIVE_COMMONS = (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
_CREATIVE_COMMONS_VERSIONS = (("2.0", "Generic"), ("3.0", "Unported"), ("4.0", "International"))
# Names in "Released under the ... License." and the like.
_NAMED = (
    ("MIT", "MIT"),
    ("ISC", "ISC"),
    ("BSD-2-Clause", "BSD 2-Clause"),
    ("BSD-3-Clause", "BSD 3-Clause"),
    ("Apache-2.0", "Apache 2.0"),
    ("MPL-2.0", "Mozilla Public 2.0"),
    ("BSL-1.0", "Boost Software 1.0"),
    ("Zlib", "zlib"),
)


def _templates() -> tuple[tuple[str, str], ...]:
    """(licence, wording) of all licences and their short notices; several may share a name."""
    out = [
        ("MIT", _MIT_GRANT),
        ("MIT", _MIT_WARRANTY),
        ("MIT", f"{_MIT_GRANT} {_MIT_WARRANTY}"),
        ("BSD", _BSD_CONDITIONS),
        ("BSD-2-Clause", f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
        ("BSD-3-Clause", f"{_BSD_CONDITIONS} {_BSD_THIRD} {_BSD_DISCLAIMER}"),
        ("ISC", _ISC_GRANT),
        ("ISC", f"{_ISC_GRANT} {_ISC_WARRANTY}"),
        ("Apache-2.0", _APACHE_NOTICE),
        ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
        ("MPL-2.0", _MPL_NOTICE),
        ("EPL-1.0", _EPL_NOTICE.format(version="1.0")),
        ("EPL-2.0", _EPL_NOTICE.format(version="2.0")),
        ("BSL-1.0", _BOOST_NOTICE),
        ("Unlicense", _UNLICENSE),
        ("Zlib", _ZLIB),
        ("CC0-1.0", _CC0),
        ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
        ("CC0-1.0", "Licensed under CC0 1.0."),
    ]
    for licence, name in _NAMED:
        out += [
            (licence, f"Released under the {name} License."),
            (licence, f"This project is licensed under the {name} License."),
        ]
    for licence, name, version, short in _GNU:
        out += [
            (licence, _GNU_NOTICE.format(work=work, name=name, version=version))
            for work in ("program", "library")
        ]
        out += [
            (licence, f"This work is licensed under the GNU {name}, version {version}."),
            (licence, f"Licensed under the GNU {name} v{version}."),
            (licence, f"Released under the {short} version {version} license."),
        ]
    for version, kind in _CREATIVE_COMMONS_VERSIONS:
        for short, name in _CREATIVE_COMMONS:
            text = f"This work is licensed under a Creative Commons {name} {version} {kind} License."
            out += [
                (f"CC-{short}-{version}", text),
                (f"CC-{short}-{version}", f"Licensed under CC {short} {version}."),
            ]
    return tuple(out)


TEMPLATES = _templates()

# Words that tell one licence from another of the same wording.
TELLING = frozenset(
    "lesser affero gpl lgpl agpl mozilla eclipse boost zlib apache mit isc bsd cc0 "
    "noncommercial nc noderivatives noderivs nd sharealike sa endorse".split()
)
VERSION = re.compile(r"v?(\d{1,2})")


def telling(words: list[str]) -> set[str]:
    """The words of a wording that name a licence, and its numbers of one or two digits."""
    found = {word for word in words if word in TELLING}
    return found | {m[1] for word in words if (m := VERSION.fullmatch(word))}


def bigrams(text: str) -> list[tuple[str, str]]:
    """Word bigrams of normalised text: lower case, punctuation and white space aside."""
    words = WORD.findall(text.lower())
    return list(zip(words, words[1:], strict=False))


def size_bounds(size: int, least: float) -> tuple[int, int]:
    """Numbers of bigrams another text may have for a Dice coefficient of ``least``."""
    low, high = least * size / (2 - least), (2 - least) * size / least
    return math.ceil(low - EPSILON), math.floor(high + EPSILON)


class Templates:
    """Templates with their bigram counts, size bounds and an index of all bigrams."""

    def __init__(self, templates, least: float = LEAST_DICE):
        self.least = least
        self.names = [name for name, _ in templates]
        self.counts = [Counter(bigrams(text)) for _, text in templates]
        self.sizes = [sum(c.values()) for c in self.counts]
        self.bounds = [size_bounds(n, least) for n in self.sizes]
        self.known = frozenset(pair for c in self.counts for pair in c)
        self.telling = [telling(WORD.findall(text.lower())) for _, text in templates]
        # Most bigrams outside a template that a matching run can have.
        self.slack = [2 * n * (1 - least) / least + EPSILON for n in self.sizes]

    def find(self, text: str) -> list[tuple[str, float, int, int]]:
        """(name, dice, start, end) of the best runs of units, none overlapping another."""
        units = []
        last_word = None
        for m in UNIT.finditer(text):
            words = WORD.findall(m[0].lower())
            if words:
                pairs = list(zip(words, words[1:], strict=False))
                across = None if last_word is None else (last_word, words[0])
                units.append((m.start(), m.end(), pairs, across, telling(words)))
                last_word = words[-1]
        found = []
        for first, (_, _, pairs, *_) in enumerate(units):
            onward = [units[first + 1][3]] if first + 1 < len(units) else []
            if self._worth(self.known, pairs, onward):
                found += self._runs(units, first, onward)
        # What has most of a template stays: a whole licence before a part of it.
        found.sort(key=lambda f: (-f[4], -f[1], f[2], f[3], f[0]))
        taken: list[tuple[str, float, int, int]] = []
        for *one, _ in found:
            one = tuple(one)
            # None of those taken overlap, so only the neighbours can.
            at = bisect.bisect_left(taken, one[2], key=lambda f: f[2])
            if (at == 0 or taken[at - 1][3] <= one[2]) and (
                at == len(taken) or one[3] <= taken[at][2]
            ):
                taken.insert(at, one)
        return taken

    def _worth(self, known, pairs: list, onward: list) -> bool:
        """Whether a best match may begin with a unit of these bigrams.

        A first unit is worth its place only if at least half of ``least`` of what it adds,
        alone or with the bigram that leads on from it, is in the template: without it the
        coefficient would be higher, and the shorter run be preferred.
        """
        hits = sum(pair in known for pair in pairs)
        if pairs and hits >= self.least / 2 * len(pairs) - EPSILON:
            return True
        hits += sum(pair in known for pair in onward)
        return bool(onward) and hits >= self.least / 2 * (len(pairs) + 1) - EPSILON

    def _told_apart(self, template: int, said: set[str]) -> bool:
        """Whether a run names the template's licence and no other.

        Versions count only where the template has one.
        """
        want = self.telling[template]
        if not any(word.isdigit() for word in want):
            said = {word for word in said if not word.isdigit()}
        return said == want

    def _runs(self, units: list, first: int, onward: list) -> list[tuple]:
        """Matches (name, dice, start, end, shared bigrams) of the runs that begin at a unit.

        A template is given up when more bigrams are outside it than any match could have:
        2 T / (2 T + misses) is the most that a run with so many can reach.
        """
        begin, _, pairs, *_ = units[first]
        active = [t for t, c in enumerate(self.counts) if self._worth(c, pairs, onward)]
        found = []
        size = 0
        inside = dict.fromkeys(active, 0)
        seen: Counter = Counter()
        said: set[str] = set()
        for i in range(first, len(units)):
            _, end, pairs, across, words = units[i]
            said |= words
            if i > first:
                pairs = [across, *pairs]
            size += len(pairs)
            for pair in pairs:
                if pair in self.known:
                    seen[pair] += 1
                    for t in active:
                        if seen[pair] <= self.counts[t][pair]:
                            inside[t] += 1
            for t in active:
                low, high = self.bounds[t]
                if low <= size <= high:
                    dice = 2 * inside[t] / (size + self.sizes[t])
                    if dice >= self.least and self._told_apart(t, said):
                        found.append((self.names[t], dice, begin, end, inside[t]))
            active = [t for t in active if size - inside[t] <= self.slack[t]]
            if not active:
                break
        return found


FOUND = "array<struct<licence:string,dice:double,start:int,end:int>>"


def with_licences(
    docs: DataFrame, templates=TEMPLATES, least: float = LEAST_DICE
) -> DataFrame:
    """``docs`` with ``__licences``, the licence wordings found in each whole text.

    Texts and templates are normalised to lower-case words. A text is cut into lines and
    sentences; runs of these are compared with each template whose size allows a Dice
    coefficient of ``least`` over word bigrams, counted with repeats. Licences whose wordings
    hardly differ are told apart by ``TELLING`` words and version numbers: a run with others than its
    template is no match, so an unknown version is not given a known one's name. Of overlapping
    matches the one that shares most bigrams stays, then the best, earlier, shorter, first in name. A
    null or empty text has none; very long texts are searched whole; repeated rows stay; an empty table
    gives an empty table. Other columns may have any names but ``__licences``. Templates are code, so
    what tasks carry does not grow with the data.
    """

    def run(texts: pd.Series) -> pd.Series:
        ready = Templates(templates, least)
        return pd.Series([ready.find(text) for text in texts])

    return docs.withColumn(
        "__licences", F.pandas_udf(run, FOUND)(F.coalesce("text", F.lit("")))
    )


def licence_matches(docs: DataFrame, **options) -> DataFrame:
    """One row per match: doc_id, licence, dice, start_at and end_at (code points)."""
    return with_licences(docs, **options).select(
        "doc_id", F.explode("__licences").alias("m")
    ).select(
        "doc_id",
        "m.licence",
        "m.dice",
        F.col("m.start").alias("start_at"),
        F.col("m.end").alias("end_at"),
    )
