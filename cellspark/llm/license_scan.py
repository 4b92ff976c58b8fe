"""License scans: a generalised suffix automaton over the words of license templates.

A text's words stream through the automaton; at every word the state and the matched length are the matching
statistics. The states on the suffix path hold, for every template and place, the longest match that ends there;
where the template does not go on like the text, a long enough one becomes a segment, also under a longer match
of another template. Segments of one template that follow each other in text and template are chained, and a chain
that covers enough of its template labels the text, unless it is a part only and stands inside another template that
is there whole (a notice of version 3 is not most of one of version 2). Short phrases that always count are read off the same states:
a phrase ends where its state is on the suffix path of the current one.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows are scanned alike; texts
of any length are streamed whole, in time that grows with their words and matches, words unknown to the templates only reset
the match; ties between chains go to the earlier one; a table without rows gives one without rows; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Phrases that always give their label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices of public licenses.
TEMPLATES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license as published by the free software foundation either version 3 of the license": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "the software is provided as is without warranty of any kind express or implied": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license": "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "mozilla public license version 2 0": "mpl-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "all rights reserved": "reserved",
}

# Whole texts of public licenses and the headers that some ask for, without names and years.
TEMPLATES |= {
    """
    Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
    files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
    modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
    is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
    included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
    KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
    NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
    WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
    OTHER DEALINGS IN THE SOFTWARE.
    """: "mit",
    """
    Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
    provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
    THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
    FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
    WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
    ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
    """: "isc",
    """
    Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
    conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
    following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
    the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of
    the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
    without specific prior written permission.
    """: "bsd-3",
    """
    THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
    BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
    SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
    CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
    PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
    TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
    POSSIBILITY OF SUCH DAMAGE.
    """: "bsd",
    """
    This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
    any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
    including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
    origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
    software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
    source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice
    may not be removed or altered from any source distribution.
    """: "zlib",
    """
    Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
    License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
    or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
    CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
    limitations under the License.
    """: "apache-2",
    """
    This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
    published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
    program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have
    received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/.
    """: "gpl-3",
    """
    This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
    published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This
    program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
    """: "gpl-2",
    """
    This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
    with this file, You can obtain one at http://mozilla.org/MPL/2.0/.
    """: "mpl-2",
}

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """Words of a text after A-Z are lower-cased."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())


@dataclass(frozen=True)
class Limits:
    least_match: int = 3  # words of a segment
    most_gap: int = 6  # words between two segments of a chain, in the text and in the template
    least_cover: float = 0.75  # share of its template that a chain must cover


class SuffixAutomaton:
    """Of all templates and phrases together."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]) -> None:
        self.templates = [(words_of(t), label) for t, label in templates.items()]
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        self.ids: dict[bytes, int] = {}
        # The word after each place of a template; -1, which no text has, at its end.
        self.after = [[*(self.ids.setdefault(w, len(self.ids) + 1) for w in words), -1] for words, _ in self.templates]
        self.longest, self.link, self.next = [0], [-1], [{}]
        ends: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for number, (words, _) in enumerate(self.templates + self.phrases):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, self.ids.setdefault(word, len(self.ids) + 1))
                if number < len(self.templates):
                    ends[last].add((number, place + 1))
        # Where the strings of a state end: its own places and those of the states that link to it.
        for state in sorted(range(len(self.longest)), key=lambda s: -self.longest[s]):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.ends = {state: sorted(places) for state, places in ends.items()}
        # Phrases that end at a state: (words, label), on the suffix path from it.
        at = {self._walk(words): (len(words), label) for words, label in self.phrases}
        self.phrase_ends: list[tuple[tuple[int, str], ...]] = []
        for state in range(len(self.longest)):
            found, up = [], state
            while up > 0:
                if up in at:
                    found.append(at[up])
                up = self.link[up]
            self.phrase_ends.append(tuple(found))

    def _walk(self, words: list[bytes]) -> int:
        state = 0
        for word in words:
            state = self.next[state][self.ids[word]]
        return state

    def _new(self, longest: int, link: int, following: dict[int, int]) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.next.append(following)
        return len(self.longest) - 1

    def _split(self, parent: int, word: int) -> int:
        """The state reached from ``parent`` by ``word``, cut so that its longest string is one word longer than the parent's."""
        target = self.next[parent][word]
        if self.longest[target] == self.longest[parent] + 1:
            return target
        clone = self._new(self.longest[parent] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while parent >= 0 and self.next[parent].get(word) == target:
            self.next[parent][word] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        state = self._new(self.longest[last] + 1, 0, {})
        parent = last
        while parent >= 0 and word not in self.next[parent]:
            self.next[parent][word] = state
            parent = self.link[parent]
        if parent >= 0:
            self.link[state] = self._split(parent, word)
        return state

    def statistics(self, words: list[int]):
        """(state, matched length) after every word."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.longest[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield state, length

    def held(self, state: int, length: int, least: int):
        """(template, place after the match, words) of the longest match at every place of every template, down to ``least`` words."""
        seen: set[tuple[int, int]] = set()
        while length >= least and state > 0:
            for place in self.ends.get(state, ()):
                if place not in seen:
                    seen.add(place)
                    yield *place, length
            state = self.link[state]
            length = self.longest[state]

    def scan(self, words: list[bytes], limits: Limits) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, float]]]:
        """Phrase places (start, label), and covered spans (first word, word after the last, label, share of the template)."""
        get = self.ids.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        known = np.flatnonzero(ids)
        places: list[tuple[int, str]] = []
        segments: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        # Only runs of known words can hold a match; shorter runs than the shortest match hold none.
        shortest = min(limits.least_match, min((len(p) for p, _ in self.phrases), default=limits.least_match))
        for run in np.split(known, np.flatnonzero(np.diff(known) > 1) + 1):
            if len(run) < shortest:
                continue
            first = int(run[0])
            numbers = ids[run].tolist()
            following = [*numbers[1:], 0]
            for place, (state, length) in enumerate(self.statistics(numbers)):
                end = first + place + 1
                places += [(end - n, label) for n, label in self.phrase_ends[state] if n <= length]
                if length >= limits.least_match:
                    for template, stop, n in self.held(state, length, limits.least_match):
                        if self.after[template][stop] != following[place]:
                            segments[template].append((end - n, stop - n, n))
        spans = []
        whole = sorted({(a, a + n) for template, found in segments.items() for a, _, n in found if n == len(self.templates[template][0])})
        starts, reach = [a for a, _ in whole], list(accumulate((b for _, b in whole), max))
        for template, found in segments.items():
            size, label = len(self.templates[template][0]), self.templates[template][1]
            for start, end, covered in _chains(sorted(found), limits.most_gap):
                # Inside a longer whole match: one that starts before and does not end before, or does not start after and ends after.
                before, until = bisect_left(starts, start), bisect_right(starts, start)
                inside = (before and reach[before - 1] >= end) or (until and reach[until - 1] > end)
                if covered / size >= limits.least_cover and not (covered < size and inside):
                    spans.append((start, end, label, covered / size))
        return places, sorted(spans)


def _chains(found: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(start, end, words covered) of chains: each segment goes on the chain with which it covers most, and is in one chain only."""
    best: list[tuple[int, int, int]] = []  # words covered up to a segment, the segment before it or -1, words new
    near: list[int] = []
    for number, (start, place, length) in enumerate(found):
        near = [i for i in near if start - found[i][0] - found[i][2] <= gap]
        most = (length, -1, length)
        for i in near:
            end, stop = found[i][0] + found[i][2], found[i][1] + found[i][2]
            new = length - max(0, end - start, stop - place)
            if new > 0 and place - stop <= gap and abs((start - end) - (place - stop)) <= gap and best[i][0] + new > most[0]:
                most = (best[i][0] + new, i, new)
        best.append(most)
        near.append(number)
    chains, used = [], set()
    for last in sorted(range(len(found)), key=lambda i: (-best[i][0], i)):
        if last in used:
            continue
        number, covered = last, 0
        while True:
            used.add(number)
            _, before, new = best[number]
            if before < 0 or before in used:
                break
            covered, number = covered + new, before
        chains.append((found[number][0], found[last][0] + found[last][2], covered + found[number][2]))
    return chains


SPAN = T.StructType().add("first", T.LongType()).add("after", T.LongType()).add("label", T.StringType()).add("cover", T.DoubleType())
SCHEMA = (
    T.StructType()
    .add("n_words", T.LongType())
    .add("n_base", T.LongType())
    .add("first_word", T.LongType())
    .add("last_word", T.LongType())
    .add("base_labels", T.StringType())
    .add("labels", T.StringType())
    .add("spans", T.ArrayType(SPAN))
    .add("score", T.DoubleType())
)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, limits: Limits = Limits()) -> DataFrame:
    """Per row ``doc_id`` and what the scan of its text found; the automaton travels with the function, its size is that of the templates."""
    automaton = SuffixAutomaton(templates, phrases)

    arrow_type = to_arrow_type(SCHEMA)

    @F.arrow_udf(SCHEMA)
    def scanned(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            words = words_of(text.as_py() or "")
            places, spans = automaton.scan(words, limits)
            starts = [p for p, _ in places]
            base = {label for _, label in places}
            rows.append(
                {
                    "n_words": len(words),
                    "n_base": len(places),
                    "first_word": min(starts, default=None),
                    "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted(base)),
                    "labels": ",".join(sorted(base | {label for _, _, label, _ in spans})),
                    "spans": [{"first": a, "after": b, "label": x, "cover": c} for a, b, x, c in spans],
                    "score": 1.0 if places else max((min(1.0, c) for *_, c in spans), default=0.0),
                }
            )
        return pa.array(rows, arrow_type)

    return docs.select("doc_id", scanned("text").alias("found")).select("doc_id", "found.*")
