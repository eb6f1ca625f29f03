"""Licence passages: one label for one notice, and matches and chains against plain definitions."""

import random

import numpy as np
import pytest

from millrace.llm.licenses import TEMPLATES, Scanner, words_of

SCANNER = Scanner()
NOTICES = {
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "cc-by-nc-nd": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nd": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "boost": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software",
    "mpl": "SPDX-License-Identifier: MPL-2.0",
    "mit": "SPDX-License-Identifier: MIT",
    "bsd": "// SPDX-License-Identifier: BSD-3-Clause",
}


@pytest.mark.parametrize("label", NOTICES)
def test_a_notice_has_its_own_label(label):
    row = SCANNER.scan(f"some words before. {NOTICES[label]} and some after".encode())
    assert row[5] == label and row[6] > 0.5


def test_base_labels_stay():
    row = SCANNER.scan(b"Licensed under CC BY-NC-ND 4.0, not CC BY 4.0; Licensed under the Apache License")
    assert row[4] == "apache,cc-by" and row[5] == "apache,cc-by,cc-by-nc-nd"


@pytest.mark.parametrize("text", ["SPDX-License-Identifier: Foo-1.0", "this work is licensed under a strange licence", "free of charge to any person", "licensed under CC terms, version 4.0", ""])
def test_less_than_a_notice_has_no_label(text):
    assert SCANNER.scan(text.encode())[5] == ""


def test_two_notices_have_both_labels():
    row = SCANNER.scan((NOTICES["lgpl"] + " x y z " + NOTICES["cc-by-sa"]).encode())
    assert row[5] == "cc-by-sa,lgpl"


def test_every_template_is_found_whole_under_its_label():
    for label, text in TEMPLATES:
        row = SCANNER.scan(text.encode())
        assert label in row[5].split(",") and row[6] == 1.0, text


def plain_matches(scanner, words):
    """Right-maximal longest suffixes that some template holds, at each of their places."""
    places = {}
    for t, (_, own) in enumerate(scanner.templates):
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                places.setdefault(tuple(own[i:j]), []).append((t, i))
    longest = [max((n for n in range(e + 1) if n == 0 or tuple(words[e - n : e]) in places), default=0) for e in range(1, len(words) + 1)]
    found = set()
    for e, n in enumerate(longest, 1):
        if n >= scanner.min_match and (e == len(words) or longest[e] <= n):
            found |= {(t, i, e - n, n) for t, i in places[tuple(words[e - n : e])]}
    return found


def plain_chains(scanner, matches):
    """Chains without the search's bound, then the same rules for which count."""
    out = []
    for t in {m[0] for m in matches}:
        size, chains = len(scanner.templates[t][1]), []
        for b, a, n in sorted((b, a, n) for u, a, b, n in matches if u == t):
            best = (n, b, b + n, a + n)
            if size < scanner.short:
                chains += [best] if n == size else []
                continue
            for covered, start, end, at in reversed(chains):
                skip = max(at - a, end - b, 0)
                if skip < n and b + skip - end <= a + skip - at + scanner.gap and covered + n - skip > best[0]:
                    best = (covered + n - skip, start, b + n, a + n)
            chains.append(best)
        taken = []
        for covered, start, end, _ in sorted(chains, key=lambda c: (-c[0], c[1])):
            if (covered >= 0.75 * size or covered >= scanner.min_words and covered >= 0.375 * size) and all(end <= s or e <= start for s, e in taken):
                taken.append((start, end))
                out.append((t, start, end, covered))
    kept = []
    for t, start, end, covered in sorted(out, key=lambda c: (-c[3], c[2] - c[1], len(scanner.templates[c[0]][1]), c[1], c[0])):
        label = scanner.templates[t][0]
        lost = sum(1 for k in range(start, end) if (first := next((la for la, s, e in kept if s <= k < e), label)) != label)
        if lost * 2 <= end - start:
            kept.append((label, start, end))
    return sorted(kept)


def test_matches_and_chains_equal_brute_force_on_random_words():
    rnd = random.Random(7)
    for _ in range(150):
        bank = "abcdefg"[: rnd.randrange(3, 8)]
        templates = [(f"t{k % 3}", " ".join(rnd.choices(bank, k=rnd.randrange(4, 16)))) for k in range(4)]
        scanner = Scanner(templates, {}, min_match=2, min_words=6, gap=3, short=6)
        pieces = [w for _ in range(6) for w in (rnd.choices(bank + "z", k=4) if rnd.random() < 0.5 else rnd.choice(templates)[1].split()[rnd.randrange(3) :])]
        words = words_of(" ".join(pieces).encode())
        ids = np.array([scanner.ids.get(w, -1) for w in words], np.int32)
        found = set(scanner.matches(ids))
        assert found == plain_matches(scanner, words)
        assert sorted((scanner.templates[t][0], s, e) for t, s, e, _ in scanner.spans(ids)) == plain_chains(scanner, found)
