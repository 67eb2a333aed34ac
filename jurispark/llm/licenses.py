"""License scans: phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.llm.common import alnum_words, lean, raw

#: Phrases and their labels. Fixed values.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices that texts are joined with, and their labels. Fixed values.
TEMPLATES = [
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at', "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1", "lgpl-2.1"),
    ("Licensed under CC BY 4.0", "cc-by-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("All rights reserved. No part of this publication may be reproduced without permission", "all-rights-reserved"),
]
#: A text meets a template in a run of so many times the template's words: it may be wrapped, or hold other words.
RUN = 2
#: Whole texts and notices, with their labels. Fixed values.
TEXTS = [
    (
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
    rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
    persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
    this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
    "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
    MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
    BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
    OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "mit",
    ),
    (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
    provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS
    IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
    MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
    DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
    NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
        "isc",
    ),
    (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
    this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
    distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE
    COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
    IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
    COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
    DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
    BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
    (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
    POSSIBILITY OF SUCH DAMAGE.""",
        "bsd",
    ),
    (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
    License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
    law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
    WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
    permissions and limitations under the License.""",
        "apache-2.0",
    ),
    (
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
    License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
    version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
    implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
    details. You should have received a copy of the GNU General Public License along with this program. If not, see
    <https://www.gnu.org/licenses/>.""",
        "gpl-3.0",
    ),
    (
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
    for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
    purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
    restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
    software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
    is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
    original software. 3. This notice may not be removed or altered from any source distribution.""",
        "zlib",
    ),
    (
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
    compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
    commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of
    this software dedicate any and all copyright interest in the software to the public domain.""",
        "unlicense",
    ),
]


def token_frequencies(docs: DataFrame, tokens: set[bytes], text_col: str) -> dict[bytes, int]:
    """In how many texts each of the given tokens stands, over all of docs. As many rows as tokens reach the driver."""

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for t in raw(batch.column(0)):
                seen.update(tokens.intersection(alnum_words(t)))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([*seen], pa.binary()), pa.array([*seen.values()], pa.int64())], names=["token", "n"])

    rows = docs.select(text_col).mapInArrow(lean(run), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {bytes(r.token): r.n for r in rows}


class Size:
    """Templates of about one size, and the blocks of text that they are joined with.

    A block is ``2 * step`` words, and the next begins ``step`` words on, wherever lines end; step is at least
    twice a template's words, so each run of that many words lies in a block. Both sides of the join
    are sets in the global order (rare tokens first), a block's without tokens that no template of the size has.
    """

    def __init__(self, step: int, templates: list[tuple[list[bytes], str]], threshold: float, frequency: dict[bytes, int]):
        self.step = step
        order = sorted({w for words, _ in templates for w in words}, key=lambda t: (frequency.get(t, 0), t))
        self.rank = {w: i for i, w in enumerate(order)}
        self.sets, self.index = [], {}
        for words, label in templates:
            tokens = sorted({self.rank[w] for w in words})
            least = max(1, math.ceil(threshold * len(tokens) - 1e-9))
            # of so many first tokens a block that holds ``least`` must hold one
            for at, token in enumerate(tokens[: len(tokens) - least + 1]):
                self.index.setdefault(token, []).append((len(self.sets), at))
            self.sets.append((frozenset(tokens), least, label, RUN * len(words)))
        self.least = min(least for _, least, _, _ in self.sets)
        self.prefix = frozenset(order[i] for i in self.index)
        self.dropped = {"length": 0, "prefix": 0, "position": 0}  # what the filters spared, for tests

    def candidates(self, block: list[int]) -> set[int]:
        """Templates that a block, its ranks in order, can meet."""
        if len(block) < self.least:
            self.dropped["length"] += 1
            return set()
        first = len(block) - self.least + 1
        self.dropped["prefix"] += len(block) - first
        shared: Counter = Counter()
        gone = set()
        for i, token in enumerate(block[:first]):
            for number, at in self.index.get(token, ()):
                tokens, least, _, _ = self.sets[number]
                if number in gone:
                    continue
                if len(block) < least:
                    self.dropped["length"] += 1
                    gone.add(number)
                # position: what both still have behind this token must be enough
                elif shared[number] + 1 + min(len(block) - i, len(tokens) - at) - 1 < least:
                    self.dropped["position"] += 1
                    gone.add(number)
                else:
                    shared[number] += 1
        return shared.keys() - gone

    def join(self, words: list[bytes], places: list[int]):
        """(label, greatest containment) of every template that a run of the text meets; places: where prefix tokens stand."""
        best: dict[int, int] = {}
        for k in sorted({k for p in places for k in (p // self.step, p // self.step - 1) if k >= 0}):
            text = words[k * self.step : (k + 2) * self.step]
            ranks = [*map(self.rank.get, text)]
            for number in self.candidates(sorted({r for r in ranks if r is not None})):
                tokens, least, _, length = self.sets[number]
                most = best_run([(i, r) for i, r in enumerate(ranks) if r in tokens], length)
                if most >= least:
                    best[number] = max(most, best.get(number, 0))
        for number, most in best.items():
            yield self.sets[number][2], most / len(self.sets[number][0])


def best_run(places: list[tuple[int, int]], length: int) -> int:
    """The greatest number of different tokens in ``length`` words in a row. places: (word, token), in order."""
    held: Counter = Counter()
    first = most = 0
    for i, token in places:  # the run that ends here
        held[token] += 1
        while places[first][0] <= i - length:
            gone = places[first][1]
            held[gone] -= 1
            if not held[gone]:
                del held[gone]
            first += 1
        most = max(most, len(held))
    return most


class Index:
    """All templates by size."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float, frequency: dict[bytes, int]):
        by_step: dict[int, list] = {}
        for text, label in templates:
            if words := alnum_words(text.encode()):
                by_step.setdefault(1 << (RUN * len(words) - 1).bit_length(), []).append((words, label))
        self.sizes = [Size(step, some, threshold, frequency) for step, some in sorted(by_step.items())]
        self.prefix = frozenset().union(*(s.prefix for s in self.sizes))

    def match(self, words: list[bytes]):
        hits = [(i, w) for i, w in enumerate(words) if w in self.prefix]
        for size in self.sizes:
            if places := [i for i, w in hits if w in size.prefix]:
                yield from size.join(words, places)


SCAN = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, *, text_col: str = "text", templates=(*TEMPLATES, *TEXTS), phrases=PHRASES, threshold: float = 0.75) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score to every row.

    Phrases: all places where a phrase's words stand one after the other. Templates: a text gets a template's
    label when some run of twice the template's words, wherever lines end, contains at least ``threshold`` of its
    distinct words. Such runs are found by an exact set-similarity join of overlapping blocks of the text, sized
    by the template, with the templates: words of both are ordered by the number of texts that hold them, counted over
    all of docs; length, the prefixes of both sides and positions leave few pairs, in which each run is looked at.
    score: 1 with a phrase, else the greatest containment found, else 0.

    Null and empty texts have no words and no labels; repeated rows get the same; other columns stay, and those
    that clash with the added ones are replaced. Two passes over the texts and no shuffle of them.
    """
    docs = docs.drop(*[c.split()[0] for c in SCAN.split(", ")])
    vocabulary = {w for text, _ in templates for w in alnum_words(text.encode())}
    index = Index(templates, threshold, token_frequencies(docs, vocabulary, text_col))
    needles = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
    heads = frozenset(p.encode().split()[0] for p in phrases) | index.prefix
    at = docs.columns.index(text_col)

    def one(text: bytes | None):
        words = alnum_words(text)
        if heads.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0
        line, starts, base = b" " + b" ".join(words) + b" ", [], set()
        for needle, label in needles:
            i, last, word = line.find(needle), 0, 0
            while i >= 0:
                word, last = word + line.count(b" ", last, i), i
                starts.append(word)
                base.add(label)
                i = line.find(needle, i + 1)
        found, best = set(base), 1.0 if starts else 0.0
        if not index.prefix.isdisjoint(words):
            for label, share in index.match(words):
                found.add(label)
                best = max(best, share)
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(found)), best

    def run(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        for batch in batches:
            columns = list(zip(*map(one, raw(batch.column(at))), strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[*batch.schema.names, *[c.split()[0] for c in SCAN.split(", ")]])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(run), f"{fields}, {SCAN}")
