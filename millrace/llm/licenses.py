"""License scans: matching statistics by a generalised suffix automaton of template words, chained into spans."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ascii_bytes, drop_names, struct_udf

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Phrases whose places are counted, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

_CC = {
    "cc-by": ("BY", "Attribution"), "cc-by-sa": ("BY-SA", "Attribution-ShareAlike"), "cc-by-nc": ("BY-NC", "Attribution-NonCommercial"),
    "cc-by-nd": ("BY-ND", "Attribution-NoDerivatives"), "cc-by-nc-sa": ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "cc-by-nc-nd": ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
}
_SPDX = {
    "mit": "MIT", "apache": "Apache-2.0", "gpl": "GPL-2.0 GPL-3.0", "lgpl": "LGPL-2.0 LGPL-2.1 LGPL-3.0", "agpl": "AGPL-3.0", "bsd": "BSD-2-Clause BSD-3-Clause", "isc": "ISC",
    "mpl": "MPL-1.1 MPL-2.0", "epl": "EPL-1.0 EPL-2.0", "unlicense": "Unlicense", "zlib": "Zlib", "boost": "BSL-1.0", "cc0": "CC0-1.0", "artistic": "Artistic-2.0", "wtfpl": "WTFPL",
    **{label: f"CC-{name}-3.0 CC-{name}-4.0" for label, (name, _) in _CC.items()},
}
_FREE = "free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version"
_HOPE = "This {} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details. You should have received a copy of the GNU {} along with this {}"
_GNU = {
    "gpl": ("General Public License", (("program", "2"), ("program", "3"))),
    "lgpl": ("Lesser General Public License", (("library", "2.1"), ("library", "3"), ("program", "2.1"), ("program", "3"))),
    "agpl": ("Affero General Public License", (("program", "3"),)),
}

#: Notices and passages of public licences, as their publishers word them: label, text. One-line forms are SPDX
#: tags, the Creative Commons chooser's lines, and the headers that the licences' own pages recommend.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", "Licensed under the MIT License. See License.txt in the project root for license information"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License"),
    ("apache", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership"),
    ("apache", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form"),
    *((label, f"This {what} is " + _FREE.format(name, version)) for label, (name, kinds) in _GNU.items() for what, version in kinds),
    *((label, _HOPE.format(what, name, name, what)) for label, (name, kinds) in _GNU.items() for what in dict(kinds)),
    ("gpl", "The GNU General Public License is a free, copyleft license for software and other kinds of works"),
    ("gpl", "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program, to make sure it remains free software for all its users"),
    ("lgpl", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below"),
    ("agpl", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("mpl", "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license under intellectual property rights (other than patent or trademark) Licensable by such Contributor to use, reproduce, make available, modify, display, perform, distribute, and otherwise exploit its Contributions, either on an unmodified basis, with Modifications, or as part of a Larger Work"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("artistic", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed"),
    ("wtfpl", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    *((label, f"This work is licensed under a Creative Commons {name} {version} License") for label, (_, name) in _CC.items() for version in ("4.0 International", "3.0 Unported")),
    *((label, f"licensed under CC {name} {version}") for label, (name, _) in _CC.items() for version in ("4.0", "3.0")),
    *((label, f"SPDX-License-Identifier: {name}") for label, names in _SPDX.items() for name in names.split()),
)


def words_of(data: bytes) -> list[bytes]:
    """The words of a text's UTF-8 bytes, A-Z lower-cased."""
    return _WORD.findall(data.lower())


@dataclass
class SuffixAutomaton:
    """A generalised suffix automaton over word ids: every state's longest string, link, and one template place."""

    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])

    def _state(self, length: int, next_: dict[int, int], link: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.length) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, word_ids: list[int], template: int) -> None:
        last = 0
        for place, c in enumerate(word_ids):
            if c in self.next[last]:
                q = self.next[last][c]
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
            else:
                p, new = last, self._state(self.length[last] + 1, {}, 0)
                while p >= 0 and c not in self.next[p]:
                    self.next[p][c] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][c]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
                last = new
            self.ends[last].add((template, place + 1))

    def close(self) -> None:
        """Hand each state's template places up its suffix links; call once, after the last template."""
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def statistics(self, word_ids: Iterable[int]) -> Iterable[tuple[int, int]]:
        """After each word: the state, and the length of the longest suffix read that some template holds."""
        state = matched = 0
        for c in word_ids:
            while state and c not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if c in self.next[state]:
                state, matched = self.next[state][c], matched + 1
            yield state, matched


class Scanner:
    """Templates and phrases, ready to scan texts; small, and the same for every text."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, min_match: int = 3, min_cover: float = 0.75, min_words: int = 12, gap: int = 8, short: int = 10) -> None:
        self.templates = [(label, words_of(text.encode())) for label, text in templates]
        self.min_match, self.min_cover, self.min_words, self.gap, self.short = min_match, min_cover, min_words, gap, short
        self.ids: dict[bytes, int] = {}
        self.automaton = SuffixAutomaton()
        for t, (_, words) in enumerate(self.templates):
            self.automaton.add([self.ids.setdefault(w, len(self.ids)) for w in words], t)
        self.automaton.close()
        self.phrases = [(label, [self.ids.setdefault(w, len(self.ids)) for w in words_of(p.encode())]) for p, label in phrases.items()]

    def base(self, ids: np.ndarray) -> tuple[int, int | None, int | None, set[str]]:
        """Count, first and last start, and labels of the phrases' places."""
        count, first, last, labels = 0, None, None, set()
        for label, phrase in self.phrases:
            n = len(ids) - len(phrase) + 1
            at = np.flatnonzero(ids[: max(n, 0)] == phrase[0])
            for k, c in enumerate(phrase[1:], 1):
                if not len(at):
                    break
                at = at[ids[at + k] == c]
            if len(at):
                count += len(at)
                labels.add(label)
                first = int(at[0]) if first is None else min(first, int(at[0]))
                last = int(at[-1]) if last is None else max(last, int(at[-1]))
        return count, first, last, labels

    def matches(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Longest matches as (template, start in it, start in the text, length), by text place.

        A word outside every template takes the automaton back to its root, so only runs of template
        words of at least ``min_match`` are streamed; what it finds there is what the whole text gives.
        """
        known = np.concatenate(([0], (ids >= 0).view(np.int8), [0]))
        edges = np.diff(known)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        found = []
        for s, e in zip(starts[ends - starts >= self.min_match].tolist(), ends[ends - starts >= self.min_match].tolist()):
            stats = list(self.automaton.statistics(ids[s:e].tolist()))
            for k, (state, n) in enumerate(stats):
                if n >= self.min_match and (k + 1 == len(stats) or stats[k + 1][1] <= n):
                    found += [(t, end - n, s + k + 1 - n, n) for t, end in self.automaton.ends[state] if end >= n]
        return found

    def spans(self, ids: np.ndarray) -> list[tuple[int, int, int, float]]:
        """Chains of a template's matches as (template, start, end, share of the template covered).

        A match goes on from the earlier one that makes it cover most, if both places go forward and the
        text's gap is at most ``gap`` words more than the template's; overlaps count once. A chain counts if it
        covers ``min_cover`` of its template, or ``min_words`` words and half as large a share; a template of
        under ``short`` words must stand there whole and in one piece. Of chains of one template that share words of the
        text the one that covers most counts, so copies in one text are spans of their own; and a passage is
        one licence's: a chain with most of its words in chains of another label that cover more doesn't count.
        """
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for t, a, b, n in self.matches(ids):
            by_template.setdefault(t, []).append((b, a, n))
        out = []
        for t, found in by_template.items():
            found.sort()
            size = len(self.templates[t][1])
            chains: list[tuple[int, int, int, int, int]] = []  # words covered, text start, text end, template end, match start
            for b, a, n in found:
                best = (n, b, b + n, a + n, b)
                if size < self.short:
                    chains += [best] if n == size else []
                    continue
                for covered, start, end, at, begin in reversed(chains):
                    if begin < b - 2 * size - self.gap:
                        break
                    skip = max(at - a, end - b, 0)
                    if skip < n and b + skip - end <= a + skip - at + self.gap and covered + n - skip > best[0]:
                        best = (covered + n - skip, start, b + n, a + n, b)
                chains.append(best)
            taken: list[tuple[int, int]] = []
            for covered, start, end, *_ in sorted(chains, key=lambda c: (-c[0], c[1])):
                if covered < self.min_cover * size and (covered < self.min_words or covered < self.min_cover / 2 * size):
                    break
                k = bisect_left(taken, (start, end))
                if (k == 0 or taken[k - 1][1] <= start) and (k == len(taken) or end <= taken[k][0]):
                    taken.insert(k, (start, end))
                    out.append((t, start, end, covered))
        return self._one_label(out, len(ids))

    def _one_label(self, chains: list[tuple[int, int, int, int]], n: int) -> list[tuple[int, int, int, float]]:
        """The chains that keep most of their words when those that cover more take theirs."""
        owner = np.full(n if len({self.templates[t][0] for t, *_ in chains}) > 1 else 0, -1, np.int32)
        numbers: dict[str, int] = {}
        kept = []
        for t, start, end, covered in sorted(chains, key=lambda c: (-c[3], c[2] - c[1], len(self.templates[c[0]][1]), c[1], c[0])):
            label, size = self.templates[t][0], len(self.templates[t][1])
            if len(owner):
                number, own = numbers.setdefault(label, len(numbers)), owner[start:end]
                if np.count_nonzero((own >= 0) & (own != number)) * 2 > end - start:
                    continue
                own[own < 0] = number
            kept.append((t, start, end, covered / size))
        return sorted(kept, key=lambda x: (x[1], x[0]))

    def scan(self, data: bytes) -> tuple:
        """SCAN's columns of a text."""
        words = words_of(data)
        ids = np.fromiter((self.ids.get(w, -1) for w in words), np.int32, len(words))
        count, first, last, labels = self.base(ids)
        spans = self.spans(ids)
        every = labels | {self.templates[t][0] for t, *_ in spans}
        score = max([0.0, *(min(1.0, s[3]) for s in spans)])
        return (len(words), count, first, last, ",".join(sorted(labels)), ",".join(sorted(every)), max(score, 0.5 if count else 0.0),
                [(self.templates[t][0], s, e, c) for t, s, e, c in spans])


SCAN = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, license_spans array<struct<label:string,start:bigint,end:bigint,covered:double>>"
_scanners: dict[tuple, Scanner] = {}


def scan_licenses(df: DataFrame, text_col: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``df`` with SCAN's columns, replacing columns of those names.

    labels: those of phrases found and of templates of which a chain covers 75 % (or 12 words and 37.5 %); where
    chains of different labels share words, the one that covers most. score: the largest share of a template that a chain covers, at least 0.5 where a phrase is. Spans
    are in words, ends exclusive. A null text is empty: no words, score 0, no first or last place. Repeated
    rows get equal results, an empty table stays empty. Templates, not documents,
    set the automaton's size. No shuffle: each text, however long, is streamed whole where it is read.
    """
    key = (tuple(templates), tuple(phrases.items()))

    def scan(texts):
        if key not in _scanners:
            _scanners[key] = Scanner(key[0], dict(key[1]))
        rows = [_scanners[key].scan(t) for t in texts]
        columns = list(zip(*rows)) if rows else [[]] * 8
        columns[7] = [[dict(zip(("label", "start", "end", "covered"), s)) for s in x] for x in columns[7]]
        return columns

    names = [f.split()[0] for f in SCAN.split(", ")]
    rows = drop_names(df.withColumn("__mr_scan", struct_udf(scan, SCAN, ascii_bytes(F.col(text_col)))), names)
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != "__mr_scan"], "__mr_scan.*")
