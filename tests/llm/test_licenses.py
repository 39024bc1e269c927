"""License scans: the pruning loses no occurrence, full texts and repeated notices are found once each."""

from __future__ import annotations

import random

import pytest

from millrace.llm.licenses import COVERAGE, STRETCH, TEMPLATES, Scanner, words

SHORT = {name: text for name, text in TEMPLATES.items() if len(words(text)) < 200}


class Unpruned(Scanner):
    """Aligns at every key word, and compares every hit with every other."""

    def _dense_ends(self, found, template):
        return list(range(len(found) + 1))

    def _best(self, hits):
        kept = []
        for hit in sorted(hits, key=lambda x: (-x[3], -x[4], x[0], x[1])):
            name, first, last, _, coverage = hit
            if not any(
                (name, x[0]) in self.rivals and x[1] <= last and first <= x[2] and (coverage < x[4] or self.rivals[name, x[0]])
                for x in kept
            ):
                kept.append(hit)
        return kept


def mixed_text(rng: random.Random) -> str:
    """Notices one after another, some of their words replaced, dropped, repeated or surrounded by others."""
    out = []
    for name in rng.choices(sorted(SHORT), k=rng.randrange(1, 8)):
        share = rng.choice((0, 0, 0.05, 0.1, 0.2))
        for word in SHORT[name].split():
            if rng.random() >= share:
                out.append(word)
            elif rng.random() < 0.7:
                out += [rng.choice(out or ["the"])] * rng.randrange(3)
        out += rng.choices(["the", "of", "license", "software", "other", "version"], k=rng.choice((0, 1, 12)))
    return " ".join(out)


@pytest.fixture(scope="module")
def scanners():
    return Scanner(SHORT, COVERAGE, STRETCH), Unpruned(SHORT, COVERAGE, STRETCH)


def test_pruning_loses_no_occurrence(scanners):
    pruned, plain = scanners
    rng = random.Random(7)
    n_found = 0
    for _ in range(150):
        text = mixed_text(rng)
        found = pruned.scan(text)
        assert found == plain.scan(text)
        n_found += len(found)
    assert n_found > 150


def test_repeated_notices_are_found_one_by_one(scanners):
    found = scanners[0].scan("Released under the MIT License. Word. " * 3000)
    assert [(name, first) for name, first, *_ in found] == [("MIT", 6 * k) for k in range(3000)]


def test_a_full_text_is_found_whole():
    scanner = Scanner(TEMPLATES, COVERAGE, STRETCH)
    for name in ("GPL-3.0-text", "GPL-2.0-text", "Apache-2.0-text"):
        n = len(words(TEMPLATES[name]))
        assert (name, 0, n - 1, n, 1.0) in scanner.scan(TEMPLATES[name])
    assert scanner.scan(None) == scanner.scan("") == []


def test_windows_count_each_word_as_often_as_the_template_has_it(scanners):
    template = ["a", "b", "a", "c"]  # 4 of 4 needed, windows of 7 words
    pruned = scanners[0]
    for text in ("x x a b a c x", "a a a a b c", "a b c x x x x a", "c a x b x a", "", "a b a"):
        found = text.split()
        windows = [found[max(0, end - 6) : end + 1] for end in range(len(found))]
        held = [sum(min(w.count(x), template.count(x)) for x in "abc") >= 4 for w in windows]
        assert pruned._dense_ends(found, template) == [sum(held[:k]) for k in range(len(found) + 1)]
