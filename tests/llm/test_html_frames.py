"""Whole articles stay, frames of distinct articles go; the given pages against an independent parser."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest

from millrace.llm import html_extract
from millrace.llm.queries import QUERIES

KIND = "page_id long, url string, html string"


class Article(HTMLParser):
    """Blocks of the article element, by the standard library's parser."""

    OUT = {"nav", "header", "footer", "aside", "form", "script", "style"}
    BREAKS = {"p", "h1", "h2", "h3", "ul", "ol", "li", "div", "article", "blockquote", "table", "tr", "td"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.skip, self.blocks = 0, 0, [[]]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.skip += self.depth > 0 and tag in self.OUT
        if tag in self.BREAKS:
            self.blocks.append([])
        if tag == "br" and self.depth and not self.skip:
            self.blocks[-1].append(" ")

    def handle_endtag(self, tag):
        if tag in self.BREAKS:
            self.blocks.append([])
        self.skip -= bool(self.skip) and tag in self.OUT
        self.depth -= bool(self.depth) and tag == "article"

    def handle_data(self, data):
        if self.depth and not self.skip:
            self.blocks[-1].append(data)


def by_the_library(html):
    parser = Article()
    parser.feed(html or "")
    parser.close()
    return "\n".join(line for b in parser.blocks if (line := " ".join("".join(b).split())))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_given_pages_as_an_independent_parser_reads_them(spark, sf):
    """Among them three pages of one host that are copies of each other in part."""
    folder = f"/root/testdata/{sf}"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in QUERIES["op7_html_extract"].run(spark, folder).collect()}
    assert got.keys() == html.keys()
    assert [i for i in got if got[i] != by_the_library(html[i])] == []


def words(rng, n=12):
    return " ".join(rng.choice("abcdefghijklmnop") * rng.randrange(2, 7) for _ in range(n))


def extracted(spark, rows):
    return {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, KIND)).collect()}


def test_frames_of_distinct_articles_go_and_headings_stay(spark):
    rng, rows, want = random.Random(1), [], {}
    for k in range(20):
        own = [words(rng) for _ in range(4)]
        body = f"<article><h1>{own[0]}</h1><p>By <b>our staff</b></p><h2>History</h2><p>{own[1]}</p><h2>References</h2><p>{own[2]}</p><div>Read more</div></article>"
        rows.append((k, f"http://h.org/{k}", f"<nav>Menu</nav>{body}<footer>End</footer>"))
        want[k] = f"{own[0]}\nHistory\n{own[1]}\nReferences\n{own[2]}"
    assert extracted(spark, rows) == want


def test_near_copies_on_a_host_keep_what_they_share(spark):
    rng, rows = random.Random(2), []
    shared = [words(rng) for _ in range(30)]
    for k in range(8):  # two paragraphs of each copy are its own
        mine = list(shared)
        for at in rng.sample(range(30), 2):
            mine[at] = words(rng)
        rows.append((k, f"http://h.org/{k}", "<article>" + "".join(f"<p>{p}</p>" for p in mine) + "</article>"))
    passage = [words(rng) for _ in range(3)]
    for k in range(40, 60):  # distinct articles that quote the same three paragraphs
        parts = [*[words(rng) for _ in range(5)], *passage, *[words(rng) for _ in range(5)]]
        rows.append((k, f"http://h.org/{k}", "<article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article>"))
    got = extracted(spark, rows)
    assert [k for k, _, html in rows if got[k] != by_the_library(html)] == []


@pytest.mark.parametrize("name", ["share-price", "ad-hoc", "notice-board", "comment-on-law", "related-work"])
def test_names_inside_articles_count_as_a_whole(name):
    body = f'<article><p>One</p><div class="{name}">Two</div><p class="{name}">Three</p></article>'
    assert html_extract.main_text(body, frozenset()) == "One\nTwo\nThree"


@pytest.mark.parametrize("name", ["comments", "share-buttons", "ad", "ad-slot", "related-posts", "newsletter-signup", "cookie-notice", "comment-list"])
def test_asides_inside_articles_go(name):
    assert html_extract.main_text(f'<article><p>One</p><div class="{name}">Two</div></article>', frozenset()) == "One"


def test_a_very_long_page_and_ids_beside_null_ones(spark):
    rng = random.Random(3)
    long = [words(rng, 40) for _ in range(8000)]
    rows = [(2**62 + 1, "http://h.org/1", "<article>" + "".join(f"<p>{p}</p>" for p in long) + "</article>"), (None, None, "<p>x"), (3, "http://h.org/3", None)]
    assert extracted(spark, rows) == {2**62 + 1: "\n".join(long), None: "x", 3: ""}
