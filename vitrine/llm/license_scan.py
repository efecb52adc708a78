"""Licence scan with a generalised suffix automaton of template tokens.

All templates go into one automaton; each state knows the longest token run it stands for and
all places in all templates that hold its last words.  A text is streamed through it once: after
every word the automaton has the longest suffix of the words so far that occurs in any template
(the matching statistic).  Every template's own maximal matches of enough words are chained while
they move forward in text and template with small gaps, and a chain that covers enough of the
template, or enough words of a long one, is a licence span unless it lies inside a longer one.
One-line notices are in an automaton of their own: a state knows the longest whole notice that ends
there, so a word gives at most one.  Runs of words that no template knows reset the automaton and cost one table lookup each,
and a text of any length is read word by word with a bounded number of open matches.

Fixed phrases are found beside that, wherever their words stand one after another.

Null and empty texts have no words and labels.  Repeated rows give repeated results, rows
without an id keep a null id, an empty table gives an empty result, and columns other than the
two that are named play no part.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_batches, utf8, worker_cache

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public licence texts by label. Whole where the text itself stands in files; of Apache, GPL, MPL and Creative Commons the
# whole notice that files carry.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        https://www.gnu.org/licenses/.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
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
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
        the original software. 3. This notice may not be removed or altered from any source distribution.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "cc": """This work is licensed under a Creative Commons Attribution 4.0 International License.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or
        authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
        dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
        dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
        copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more
        information, please refer to https://unlicense.org""",
}
_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
_CREATIVE = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}


def _gnu(kind: str, short: str, versions: tuple[str, ...]) -> list[str]:
    long = f"the GNU {kind} Public License"
    return [
        long, f"the terms of {long}", f"the {short}", f"the GNU {short}",
        *[n for v in versions for n in (
            f"{long}, version {v}", f"{long} v{v}", f"{long} v{v}.0", f"the GNU {short} version {v}", f"the GNU {short} v{v}",
            f"the {short} version {v}", f"the {short} v{v}", f"{short}v{v}", f"{short}-{v}.0", f"{short} {v}")],
    ]


#: names of licences as notices have them, by label
NAMES = {
    "mit": ["the MIT License", "MIT License"],
    "apache": [
        "the Apache License", "the Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0", "the Apache 2.0 License",
        "the Apache License v2.0", "Apache-2.0",
    ],
    "gpl": _gnu("General", "GPL", ("2", "3")),
    "lgpl": _gnu("Lesser General", "LGPL", ("2.1", "3")),
    "agpl": _gnu("Affero General", "AGPL", ("3",)),
    "bsd": [
        "the BSD License", "the New BSD License", "the Simplified BSD License", "a BSD-style license",
        *[n for k in (2, 3) for n in (f"the {k}-Clause BSD License", f"the BSD {k}-Clause License", f"BSD-{k}-Clause")],
    ],
    "isc": ["the ISC License"],
    "mpl": [
        "the Mozilla Public License", "the Mozilla Public License, version 2.0", "the Mozilla Public License, v. 2.0",
        "the Mozilla Public License 2.0", "the MPL 2.0", "MPL-2.0",
    ],
    "cc": [
        "CC0", "CC0 1.0", *[f"CC {k}" for k in _CREATIVE], *[f"CC {k} {v}" for k in _CREATIVE for v in _VERSIONS],
        *[
            f"{a} Creative Commons {k}{v} License" for a in ("a", "the") for k in _CREATIVE.values()
            for v in ("", " 4.0", " 4.0 International", " 3.0", " 3.0 Unported", " 2.5 Generic", " 2.0 Generic", " 1.0 Generic")
        ],
    ],
    "unlicense": ["the Unlicense"],
    "zlib": ["the zlib License"],
}
#: identifiers of licences in source files, by label
IDENTIFIERS = {
    "mit": ["MIT"], "apache": ["Apache-2.0"], "isc": ["ISC"], "mpl": ["MPL-2.0"], "unlicense": ["Unlicense"], "zlib": ["Zlib"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"], "cc": ["CC0-1.0", *[f"CC-{k}-{v}" for k in _CREATIVE for v in _VERSIONS]],
    **{label: [f"{label.upper()}-{v}{tail}" for v in versions for tail in ("", "+", "-only", "-or-later")]
       for label, versions in (("gpl", ("2.0", "3.0")), ("lgpl", ("2.1", "3.0")), ("agpl", ("3.0",)))},
}
HEADS = [
    *[f"{v} under" for v in ("Licensed", "Released", "Distributed", "Published", "Available")],
    *[f"This {what} is licensed under" for what in ("work", "project", "software", "program", "file")],
]
#: one-line notices as (label, sentence)
NOTICES = [
    *[(label, f"{head} {name}") for label, names in NAMES.items() for name in names for head in HEADS],
    *[(label, f"SPDX-License-Identifier: {name}") for label, names in IDENTIFIERS.items() for name in names],
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
#: words of the shortest match that counts (a shorter template must stand there whole), words that may lie between two matches of a chain, and the least share of a
#: template (or number of matched words) that a chain needs
SHORTEST, GAP, SHARE, ENOUGH = 5, 8, 0.5, 16

_CUT = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and characters beyond ASCII."""
    return text.translate(_CUT).split()


class SuffixAutomaton:
    """Suffix automaton of several token lists; ``own`` has the (template, end) of the prefixes that a state stands for."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.own: list[list[tuple[int, int]]] = [[]]
        self.known: dict[int, list[list[tuple[int, int]] | None]] = {}

    def _state(self, length: int, like: int | None = None) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else -1)
        self.length.append(length)
        self.own.append([])
        return len(self.length) - 1

    def _split(self, p: int, token, q: int) -> int:
        clone = self._state(self.length[p] + 1, q)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def add(self, template: int, tokens: list) -> None:
        self.known.clear()
        last = 0
        for i, token in enumerate(tokens):
            p, q = last, self.next[last].get(token)
            if q is not None:  # a prefix that another template has already
                last = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
            else:
                new = self._state(self.length[last] + 1)
                while p >= 0 and token not in self.next[p]:
                    self.next[p][token] = new
                    p = self.link[p]
                if p < 0:
                    self.link[new] = 0
                else:
                    q = self.next[p][token]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
                last = new
            self.own[last].append((template, i))

    def places(self, shortest: int) -> list[list[tuple[int, int]] | None]:
        """Per state all (template, end) of its last ``shortest`` words, None where it has fewer; states share the lists."""
        if shortest not in self.known:
            found: list[list[tuple[int, int]] | None] = [None] * len(self.length)
            for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
                if self.length[s] >= shortest:
                    if self.length[self.link[s]] < shortest:
                        found[s] = []
                    else:
                        found[s] = found[self.link[s]]
                    found[s] += self.own[s]
            self.known[shortest] = found
        return self.known[shortest]

    def sentences(self, tokens: list, sizes: list[int]) -> list[tuple[int, int, int]]:
        """(start, stop, template) of the longest whole template that ends at each word, if one does."""
        if None not in self.known:
            whole: list[int | None] = [None] * len(self.length)
            for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
                whole[s] = next((t for t, end in self.own[s] if end + 1 == sizes[t] == self.length[s]), whole[self.link[s]])
            self.known[None] = whole
        whole, found, state, length = self.known[None], [], 0, 0
        nxt, link, lengths = self.next, self.link, self.length
        root = nxt[0]
        for i, token in enumerate(tokens):
            if not state and token not in root:
                continue
            while state and token not in nxt[state]:
                state = link[state]
                length = lengths[state]
            if token in nxt[state]:
                state, length = nxt[state][token], length + 1
            if state:
                t = whole[state] if length == lengths[state] else whole[link[state]]
                if t is not None:
                    found.append((i + 1 - sizes[t], i + 1, t))
        return found

    def matches(self, tokens: list, shortest: int, every: bool = False) -> list[tuple[int, int, int, int]]:
        """Maximal matches as (text start, text stop, template, template start), from the matching statistics.

        They are those that no longer one holds, in all templates that have them, or (``every``) all of each template.
        """
        found, state, length = [], 0, 0
        nxt, link, lengths, places = self.next, self.link, self.length, self.places(shortest)
        root = nxt[0]
        open_: dict[tuple[int, int], int] = {}  # (template, place there less place in the text): start in the text
        for i, token in enumerate(tokens):
            if not state and token not in root:
                continue
            while state and token not in nxt[state]:
                state = link[state]
                length = lengths[state]
            if token in nxt[state]:
                state, length = nxt[state][token], length + 1
            if length < shortest:
                if open_:
                    found += [(a, i, t, a + d) for (t, d), a in open_.items()]
                    open_ = {}
                continue
            still = {}
            for t, end in places[state]:
                still[t, end - i] = open_.pop((t, end - i), i + 1 - shortest)
            found += [(a, i, t, a + d) for (t, d), a in open_.items()]
            open_ = still
        found += [(a, len(tokens), t, a + d) for (t, d), a in open_.items()]
        found.sort()
        if every:
            return found
        widest, reach = [], (0, 0)
        for a, b, template, at in sorted(found, key=lambda m: (m[0], -m[1])):
            if b > reach[1] or (a, b) == reach:
                widest.append((a, b, template, at))
                reach = a, b
        return widest


def chains(matches: list[tuple[int, int, int, int]], gap: int = GAP, need: list[float] | None = None) -> list[dict]:
    """Join matches that move forward in the text and in one template, with at most ``gap`` words between them.

    A match goes on from the chain with most words; what both have is counted once.  Chains of one template lie apart.
    ``need`` has the least number of matched words of each template.
    """
    ends: list[tuple[int, int, int, int, int, int]] = []  # words, template, start, stop, template end, the one before
    last: dict[tuple[int, int], int] = {}
    for a, b, template, at in sorted(matches):
        best = (b - a, template, a, b, at + b - a, -1)
        for d in range(at - a - gap, at - a + gap + 1):
            i = last.get((template, d))
            if i is None:
                continue
            words, _, start, stop, end, _ = ends[i]
            both = max(0, stop - a, end - at)
            if both < b - a and a + both - stop <= gap and at + both - end <= gap and words + b - a - both > best[0]:
                best = (words + b - a - both, template, start, b, at + b - a, i)
        last[template, at - a] = len(ends)
        ends.append(best)
    done: list[dict] = []
    passed = {e[5] for e in ends}
    taken: dict[int, list[tuple[int, int]]] = {}
    heads = [e for i, e in enumerate(ends) if i not in passed and (need is None or e[0] >= need[e[1]])]
    for words, template, start, stop, end, _ in sorted(heads, key=lambda e: (-e[0], e[1:])):
        own = taken.setdefault(template, [])
        k = bisect_right(own, (start, stop))
        if (not k or own[k - 1][1] <= start) and (k == len(own) or stop <= own[k][0]):
            own.insert(k, (start, stop))
            done.append({"template": template, "start": start, "stop": stop, "end": end, "words": words})
    return done


def outermost(spans: list[dict], sizes: list[int]) -> list[dict]:
    """The chains that do not lie inside one with more words (or as many, and a larger share of its template)."""
    kept: list[dict] = []
    starts: list[int] = []  # of the widest spans so far, with their stops: both rise
    stops: list[int] = []
    for c in sorted(spans, key=lambda c: (-c["words"], sizes[c["template"]], c["template"], c["start"])):
        k = bisect_right(starts, c["start"])
        if k and stops[k - 1] >= c["stop"]:
            continue
        kept.append(c)
        k, m = bisect_left(starts, c["start"]), bisect_right(stops, c["stop"])
        starts[k : max(k, m)], stops[k : max(k, m)] = [c["start"]], [c["stop"]]
    return sorted(kept, key=lambda c: (c["start"], c["stop"]))


def build(texts: list[tuple[str, str]]) -> tuple[SuffixAutomaton, list[str], list[int]]:
    """The automaton of (label, text) templates, with the label and number of words of each."""
    automaton, labels, sizes = SuffixAutomaton(), [], []
    for label, text in texts:
        tokens = words_of(text.encode())
        automaton.add(len(labels), tokens)
        labels.append(label)
        sizes.append(len(tokens))
    return automaton, labels, sizes


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None, shortest: int = SHORTEST, gap: int = GAP, share: float = SHARE, enough: int = ENOUGH,
    notices: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Per row: phrase places and labels, covered template spans, all labels, and the covered share of its words (0 to 1).

    Spans count words from 0.  A span is kept if its matches hold ``share`` of the template or ``enough`` words, or if it is a whole
    notice.  Own templates come without NOTICES unless ``notices`` are given.
    """
    known = [(p.encode().split(), label) for p, label in (PHRASES if phrases is None else phrases).items()]
    keys = {p[-1] for p, _ in known}
    long = list((TEMPLATES if templates is None else templates).items())
    short = list(notices if notices is not None else NOTICES if templates is None else [])

    def start():
        (automaton, labels, sizes), (lines, line_labels, line_sizes) = worker_cache(("licences", *long, *short), lambda: (build(long), build(short)))
        need = [min(enough, share * n) for n in sizes]
        run = [min(shortest, n) for n in sizes]
        least = max(1, min([shortest, *run]))
        marks = [(key, [(p, label) for p, label in known if p[-1] == key]) for key in keys]

        def places(words: list[bytes]) -> list[tuple[int, str]]:
            found = []
            for key, choices in marks:
                i = -1
                for _ in range(words.count(key)):
                    i = words.index(key, i + 1)
                    found += [(i - len(p) + 1, label) for p, label in choices if i >= len(p) - 1 and words[i - len(p) + 1 : i + 1] == p]
            return found

        def judge(rows: dict) -> dict:
            out: dict = {k: [] for k in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for key, raw in zip(rows["doc_id"], utf8(rows["text"])):
                words = words_of(raw)
                base = places(words)
                found = [m for m in automaton.matches(words, least, every=True) if m[1] - m[0] >= run[m[2]]]
                notes = [{"template": len(long) + t, "start": a, "stop": b, "end": line_sizes[t], "words": b - a} for a, b, t in lines.sentences(words, line_sizes)]
                spans = outermost(chains(found, gap, need) + notes, sizes + line_sizes)
                covered, reach = 0, 0
                for a, b in sorted((c["start"], c["stop"]) for c in spans):
                    covered += max(0, b - max(a, reach))
                    reach = max(reach, b)
                own = {label for _, label in base}
                row = (
                    key, len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
                    ",".join(sorted(own)), ",".join(sorted(own | {(labels + line_labels)[c["template"]] for c in spans})),
                    covered / len(words) if words else 0.0,
                    [{"label": (labels + line_labels)[c["template"]], "start": c["start"], "stop": c["stop"], "words": c["words"]} for c in spans],
                )
                for name, value in zip(out, row):
                    out[name].append(value)
            return out

        return judge

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(
        source,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, start: long, stop: long, words: long>>",
        start,
    )
