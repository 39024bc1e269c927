"""License scans by patience alignment.

Words that stand once in the text and once in the template are anchors. The longest increasing subsequence of their
places is aligned, and each gap between two aligned anchors is treated the same way on its own, where more words are
unique. Coverage is the share of the template's words that are aligned.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from importlib import resources
from itertools import accumulate, combinations
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices as their publishers word them.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
    " compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    ' documentation files (the "Software"), to deal in the Software without restriction',
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
    " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
    " later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
    " that the following conditions are met",
    "MIT-line": "Licensed under the MIT License",
    "Apache-2.0-line": "Licensed under the Apache License 2.0",
    "BSD-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
    " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
    " 2.0 which is available at",
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to"
    " this work",
}
GNU = {"GPL": "", "LGPL": "Lesser ", "AGPL": "Affero "}
GNU_VERSIONS = ("GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")  # those of GPL-3.0 are above
CREATIVE_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
SPDX = (
    "0BSD AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC0-1.0 EPL-2.0 GPL-2.0 GPL-3.0"
    " ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense Zlib"
).split()


def _templates() -> dict[str, str]:
    """The notices, their forms for other versions, SPDX lines, and the full texts of the package's ``license_texts``."""
    out = dict(NOTICES)
    for name in GNU_VERSIONS:
        kind, version = name.split("-")
        version = version.removesuffix(".0")
        title = f"GNU {GNU[kind]}General Public License"
        out[name] = f"This work is licensed under the {title}, version {version}."
        out[f"{name}-notice"] = (
            f"This program is free software: you can redistribute it and/or modify it under the terms of the {title} as published"
            f" by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
        )
    for short, title in CREATIVE_COMMONS.items():
        out[f"CC-{short}-4.0"] = f"Licensed under CC {short} 4.0."
        for version in ("4.0 International", "3.0 Unported"):
            out[f"CC-{short}-{version[:3]}-notice"] = f"This work is licensed under a Creative Commons {title} {version} License"
    out |= {f"{name}-spdx": f"SPDX-License-Identifier: {name}" for name in SPDX}
    for file in resources.files("millrace.llm.license_texts").iterdir():
        if file.name.endswith(".txt"):
            out[f"{file.name.removesuffix('.txt')}-text"] = file.read_text("utf-8")
    return out


TEMPLATES = _templates()
#: Templates of which one has so large a share of the other's words, in order, are rivals: of their occurrences at one
#: place the better counts.
RIVAL = 0.7
#: Share of a template's words that an occurrence must align, in order.
COVERAGE = 0.9
#: An occurrence may stretch over so many times the template's words, so that scattered common words are no notice.
STRETCH = 1.5
WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _increasing(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first place, whose second places increase (patience sorting)."""
    tops: list[int] = []
    index: list[int] = []
    before = [-1] * len(places)
    for k, (_, b) in enumerate(places):
        pile = bisect_left(tops, b)
        before[k] = index[pile - 1] if pile else -1
        tops[pile : pile + 1] = [b]
        index[pile : pile + 1] = [k]
    out, k = [], index[-1] if index else -1
    while k >= 0:
        out.append(places[k])
        k = before[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (in ``a``, in ``b``): equal words at increasing places of both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        lone_b = {w: k for k, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = _increasing([(k, lone_b[w]) for k, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in lone_b])
        out += anchors
        if anchors:
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(ends, ends[1:], strict=False)]
    return sorted(out)


class Scanner:
    """Occurrences of templates in a text.

    Candidate stretches of the text are found from the rarest words of a template: an occurrence that aligns ``coverage``
    of the template's ``n`` distinct words holds one of any ``n - ceil(coverage * n) + 1`` of them, and all but
    ``n - ceil(coverage * n)`` of all.
    """

    def __init__(self, templates: Mapping[str, str], coverage: float, stretch: float) -> None:
        self.coverage, self.stretch = coverage, stretch
        self.templates = {name: found for name, text in sorted(templates.items()) if (found := words(text))}
        common = Counter(w for t in self.templates.values() for w in set(t))
        #: For each key word its templates and its places there.
        self.keys: dict[str, dict[str, list[int]]] = {}
        for name, t in self.templates.items():
            times = Counter(t)
            distinct = sorted(times, key=lambda w: (times[w], common[w], len(w) < 4, w))
            missing = len(t) - self._needed(t)
            for w in distinct[: missing + 1]:
                self.keys.setdefault(w, {})[name] = [q for q, v in enumerate(t) if v == w]
        self.vocabularies = {name: frozenset(t) for name, t in self.templates.items()}
        #: Pairs of rivals, and whether the second has nearly all of the first.
        self.rivals: dict[tuple[str, str], bool] = {}
        for (x, a), (y, b) in combinations(self.templates.items(), 2):
            least = RIVAL * max(len(a), len(b))
            if min(len(a), len(b)) >= least and len(self.vocabularies[x] & self.vocabularies[y]) >= RIVAL * len(self.vocabularies[x]) / 2:
                n = len(align(a, b))
                if n >= least:
                    self.rivals[x, y], self.rivals[y, x] = n >= coverage * len(a), n >= coverage * len(b)

    def _needed(self, template: list[str]) -> int:
        return max(1, -int(-self.coverage * len(template) // 1))

    def scan(self, text: str | None) -> list[tuple[str, int, int, int, float]]:
        """(license, first word, last word, aligned words, coverage) of the occurrences, in order of their place."""
        found = words(text)
        distinct = frozenset(found)
        possible = []
        for name, t in self.templates.items():
            missing, vocabulary = len(t) - self._needed(t), self.vocabularies[name]
            if len(found) >= len(t) - missing and len(vocabulary & distinct) >= len(vocabulary) - missing:
                possible.append(name)
        if not possible:
            return []
        spots: dict[str, list[int]] = {name: [] for name in possible}
        for k, w in enumerate(found):
            for name in self.keys.get(w, ()):
                if name in spots:
                    spots[name].append(k)
        out = []
        for name, places in spots.items():
            template = self.templates[name]
            spare = self._spare(template)
            known = [0, *accumulate(w in self.vocabularies[name] for w in found)]
            reach, ends = self._reach(template), self._dense_ends(found, template)
            taken = -1
            for k in places:
                if k <= taken or ends[min(k + reach, len(found))] == ends[k]:
                    continue
                pairs: list[tuple[int, int]] = []
                for q in self.keys[found[k]][name]:
                    first, last = max(taken + 1, k - q - spare), min(len(found), k + len(template) - q + spare)
                    if known[last] - known[first] >= self._needed(template):
                        pairs = max(pairs, self._around(found, k, template, q, first, last), key=len)
                if len(pairs) >= self._needed(template):
                    taken = pairs[-1][0]
                    out.append((name, pairs[0][0], taken, len(pairs), len(pairs) / len(template)))
        return sorted(self._best(out), key=lambda x: (x[1], x[0]))

    def _best(self, hits: list[tuple[str, int, int, int, float]]) -> list[tuple[str, int, int, int, float]]:
        """``hits`` without those that overlap a better one of a rival.

        Hits of one template don't overlap, so those kept of it stand in order of their last words too.
        """
        kept: dict[str, list[tuple[str, int, int, int, float]]] = {}

        def beaten(name: str, first: int, last: int, coverage: float) -> bool:
            for rival, others in kept.items():
                if (name, rival) in self.rivals:
                    for at in range(bisect_left(others, first, key=lambda x: x[2]), len(others)):
                        if others[at][1] > last:
                            break
                        if coverage < others[at][4] or self.rivals[name, rival]:
                            return True
            return False

        for hit in sorted(hits, key=lambda x: (-x[3], -x[4], x[0], x[1])):
            name, first, last, _, coverage = hit
            if not beaten(name, first, last, coverage):
                insort(kept.setdefault(name, []), hit, key=lambda x: x[1])
        return [hit for some in kept.values() for hit in some]

    def _reach(self, template: list[str]) -> int:
        return int(len(template) * self.stretch) + 1

    def _spare(self, template: list[str]) -> int:
        return max(0, self._reach(template) - len(template))

    def _dense_ends(self, found: list[str], template: list[str]) -> list[int]:
        """How many of the windows that end before each place of the text could hold an occurrence.

        A window of the longest stretch holds none unless it has enough of the template's words, each counted at most as
        often as the template has it. No occurrence is lost by that: it aligns each word of either side once.
        """
        room, reach, needed = Counter(template), self._reach(template), self._needed(template)
        ends, held = [0], 0
        for end, w in enumerate(found):
            if w in room:
                held += room[w] > 0
                room[w] -= 1
            if end >= reach and found[end - reach] in room:
                room[found[end - reach]] += 1
                held -= room[found[end - reach]] > 0
            ends.append(ends[-1] + (held >= needed))
        return ends

    def _around(self, found: list[str], k: int, template: list[str], q: int, first: int, last: int) -> list[tuple[int, int]]:
        """Aligned places of words ``first`` to ``last`` with word ``k`` of the text on word ``q`` of the template.

        Both sides are aligned on their own, so that a copy before or after does not make the words of this one repeat.
        """
        before = [(p + first, b) for p, b in align(found[first:k], template[:q])]
        after = [(p + k + 1, b + q + 1) for p, b in align(found[k + 1 : last], template[q + 1 :])]
        return self._densest([*before, (k, q), *after], len(before), self._reach(template))

    @staticmethod
    def _densest(pairs: list[tuple[int, int]], key: int, reach: int) -> list[tuple[int, int]]:
        """The stretch of at most ``reach`` words of the text that holds most aligned words, among them that at ``key``;
        the first of equals."""
        best, low = (key, key + 1), 0
        for high in range(key, len(pairs)):
            while pairs[high][0] - pairs[low][0] >= reach:
                low += 1
            if low > key:
                break
            if high + 1 - low > best[1] - best[0]:
                best = (low, high + 1)
        return pairs[best[0] : best[1]]


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE, stretch: float = STRETCH
) -> DataFrame:
    """Occurrences of license texts in ``docs`` (doc_id, text): doc_id, license, first_word, last_word, n_aligned, coverage.

    One row per occurrence; a document without one has no row. Where texts of nearly the same words meet, as versions of
    a license do, the best aligned one counts. Words are runs of letters and digits in lower case. An
    occurrence aligns ``coverage`` of the template's words within ``stretch`` times its length, around one of the
    template's key words; occurrences of one license do not overlap, and of two that could begin at the same key word
    the first counts. Null and empty texts have none. Repeated rows give repeated occurrences, a null doc_id stays
    null; an empty table gives an empty result. Texts are scanned whole, and rows meet no others.
    """
    scanner = Scanner(templates, coverage, stretch)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *hit) for i, text in zip(batch["doc_id"], batch["text"], strict=True) for hit in scanner.scan(text)]
            if rows:
                out = pd.DataFrame(rows, columns=["doc_id", "license", "first_word", "last_word", "n_aligned", "coverage"])
                yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    kind = "doc_id long, license string, first_word int, last_word int, n_aligned int, coverage double"
    return docs.select("doc_id", "text").where(F.col("text").isNotNull()).mapInPandas(run, kind)
