"""Licence scans: parts of a text compared with licence templates by Dice coefficient."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter, OrderedDict
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

RESULT = ("license", "dice", "segment", "n_matches")
#: Least Dice coefficient of a match.
LEAST_DICE = 0.8

# Licence texts and the notices that name a licence.
TEMPLATES = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
        OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "AGPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more
        details.""",
    "Apache-2.0 name": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
        BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
        EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
        CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
        PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
        TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0 notice": """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at
        https://www.boost.org/LICENSE_1_0.txt)""",
    "CC-BY-4.0 name": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 name": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 name": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0 notice": """To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to
        this work to the public domain worldwide. This work is distributed without any warranty.""",
    "GPL-2.0 notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-3.0 name": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
        THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
        WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
        ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
        is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT name": "Released under the MIT License.",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
        origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
        software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
        source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice
        may not be removed or altered from any source distribution.""",
}


WORD = re.compile("[A-Za-z0-9]+")
PARAGRAPH = re.compile("\n[ \t\r]*\n")


def words(text: str) -> list[str]:
    """A text's words: runs of ASCII letters and digits, lowered."""
    return [w.lower() for w in WORD.findall(text)]


def bigrams(found: list[str]) -> set[tuple[str, ...]]:
    """The distinct pairs of words that follow one another; a single word stands alone."""
    return set(zip(found, found[1:])) if len(found) > 1 else {tuple(found)} if found else set()


class Templates:
    """Licence templates as bigram sets in order of size."""

    def __init__(self, texts: Mapping[str, str], least_dice: float):
        sets = {name: bigrams(words(body)) for name, body in texts.items()}
        self.sets = sorted(((len(s), name, s) for name, s in sets.items() if s), key=lambda x: x[:2])
        self.sizes = [size for size, _, _ in self.sets]
        self.words = frozenset(w for _, _, s in self.sets for pair in s for w in pair)
        self.holders: dict[tuple[str, ...], list[int]] = {}
        for at, (_, _, grams) in enumerate(self.sets):
            for gram in grams:
                self.holders.setdefault(gram, []).append(at)
        self.least = least_dice
        # Dice >= d of sizes s and t needs s >= low * t and t >= low * s; rounding must not make a bound sharper.
        self.low = least_dice / (2 - least_dice) * (1 - 1e-9)

    def matches(self, part: str) -> Iterator[tuple[float, str]]:
        """The coefficient and name of each template that the part reaches the least coefficient with."""
        found = words(part)
        # Two strange words make at least one strange bigram, and of a match's
        # bigrams at least d (1 + low) / 2 are the template's.
        strange = len(set(found) - self.words)
        if not found or strange > 2 * len(found) * (1 - self.least * (1 + self.low) / 2) + 1:
            return
        own = bigrams(found)
        for at in range(bisect_left(self.sizes, int(self.low * len(own))), len(self.sets)):
            size, name, grams = self.sets[at]
            if self.low * size > len(own):
                return
            dice = 2.0 * len(own & grams) / (len(own) + size)
            if dice >= self.least:
                yield dice, name

    def runs(self, text: str) -> Iterator[tuple[float, str, str]]:
        """The coefficient, name and text of the best run of lines of each template that a run reaches the least coefficient with.

        Paragraphs are runs of lines, so runs of paragraphs are among them. Of
        equal runs the one with the fewest lines counts, then the first.
        """
        lines = text.split("\n")
        found = words(text) if len(lines) > 1 else []
        grams = list(zip(found, found[1:]))
        # A match has at least low times the template's bigrams.
        hits = Counter(at for gram in self.holders.keys() & set(grams) for at in self.holders[gram])
        able = [at for at, n in hits.items() if n >= self.low * self.sets[at][0]]
        if not able:
            return
        line = [k for k, one in enumerate(lines) for _ in WORD.findall(one)]
        best: dict[int, tuple[float, int, int]] = {}
        # From the last word backward: the bigrams in the order in which they come next, and where.
        ahead: OrderedDict[tuple[str, ...], int] = OrderedDict()
        touched: set[int] = set()
        for i in range(len(grams) - 1, -1, -1):
            ahead[grams[i]] = i
            ahead.move_to_end(grams[i])
            touched.update(self.holders.get(grams[i], ()))
            if i and line[i - 1] == line[i]:
                continue
            # A best run's first line brings a bigram of the template.
            for at in touched.intersection(able):
                got = self._longer(at, ahead, line)
                if got is not None:
                    rank = (-got[0], got[1] - line[i], line[i])
                    best[at] = min(best.get(at, rank), rank)
            touched.clear()
        for at, (dice, more, start) in best.items():
            yield -dice, self.sets[at][1], "\n".join(lines[start : start + more + 1])

    def _longer(self, at: int, ahead: Mapping[tuple[str, ...], int], line: list[int]) -> tuple[float, int] | None:
        """The best coefficient of a run that starts at the first bigram ahead, and its last line."""
        size, _, grams = self.sets[at]
        own = common = 0
        top, end, last = 0.0, 0, None
        for gram in reversed(ahead):
            now = line[ahead[gram] + 1]
            if last is not None and now > last and (dice := 2.0 * common / (own + size)) > top:
                top, end = dice, last
            own, last = own + 1, now
            common += gram in grams
            # No longer run reaches the least coefficient, or more than the best one.
            if 2.0 * size / (own + size) < max(self.least, top):
                break
        else:
            if (dice := 2.0 * common / (own + size)) > top:
                top, end = dice, last
        return (top, end) if top >= self.least else None

    def best(self, text: str | None) -> dict:
        """The best match of a text's parts and runs, and the number of matches."""
        text = text or ""
        found = []
        for part in {text, *PARAGRAPH.split(text), *text.split("\n")}:
            found += [(-dice, name, part) for dice, name in self.matches(part)]
        alone: dict[str, float] = {}
        for dice, name, _ in found:
            alone[name] = max(alone.get(name, 0.0), -dice)
        found += [(-dice, name, part) for dice, name, part in self.runs(text) if dice > alone.get(name, 0.0)]
        if not found:
            return {"license": None, "dice": None, "segment": None, "n_matches": 0}
        ranked = min((dice, name, hashlib.sha256(part.encode()).hexdigest()) for dice, name, part in found)
        return {"license": ranked[1], "dice": -ranked[0], "segment": ranked[2], "n_matches": len(found)}


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    least_dice: float = LEAST_DICE,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the best ``license``, its ``dice``, the ``segment`` and ``n_matches``.

    The parts of a text are the whole, its paragraphs and its lines, each
    different one once. The Dice coefficient is twice the common word bigrams
    over both sizes; templates whose size lies outside the bounds that the least
    coefficient sets for a part are not compared with it. Of equal coefficients
    the first licence by name counts, with the part whose SHA-256, given as
    ``segment``, is first. ``n_matches`` counts the pairs of a part and a licence
    that reach ``least_dice``. Runs of consecutive lines, and so of paragraphs,
    are compared as well: where a run reaches more than every part, a licence's
    best run counts as one more part. A text without match, null and empty texts
    included, has a null licence and no match. Extra columns pass through, but
    for those named like a result column.
    """
    known = Templates(templates, least_dice)
    kind = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("segment", pa.string()), ("n_matches", pa.int64())])

    @F.arrow_udf("struct<license:string,dice:double,segment:string,n_matches:long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([known.best(t) for t in texts.to_pylist()], kind)

    docs = without(docs, RESULT, keep=[text_col])
    found = docs.withColumn("license", run(F.col(f"`{text_col}`")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], "license.*")
