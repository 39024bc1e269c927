"""HTML extraction by equivalence classes of template tokens (Arasu and Garcia-Molina, EXALG, 2003).

Pages of one host come from a few templates. A token (a tag or a piece of text, told apart by the tags around it) has an
occurrence vector: how often it stands on each page of the host. Tokens that share their vector form an equivalence
class; classes of several tokens that several pages have, equally often on each, make up the host's templates, nested as
their elements are. A page's template has the classes that the page holds. What it leaves open are its slots: the
article's slots are kept, those inside navigation, notices and the like are not.

Each page is parsed once. What its elements leave of it, cut into blocks, is written down with the numbers of its tokens;
the template then decides on these blocks, so no html is shuffled, and no block of a page without a template.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bitmap, cut, join_split, with_hit
from millrace.llm.url_filter import split_url

#: A class belongs to a template if it is on so many pages, of whatever share of the host, has so many tokens ...
MIN_PAGES = 3
MIN_TOKENS = 2
#: ... and has a slot between its tokens. A class without one may be a passage that pages share; it must be on this share
#: of the host's pages or on so many of them.
MIN_SHARE = 0.5
SURE_PAGES = 10
#: Inside articles a class is a frame only if it has a slot, is on so many pages, and of the other texts that their
#: articles hold this share is on one page only: near copies of an article share much besides what all have in common.
FRAME_PAGES = 5
OWN_TEXTS = 0.9

# Fixed values of HTML: elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea svg math iframe object select head title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot"
    " th thead tr ul".split()
)
#: Raw elements that may end themselves, by ``/>``.
FOREIGN = frozenset(("svg", "math"))
ASIDE = frozenset("nav header footer aside form menu dialog button label fieldset search".split())
CONTENT = frozenset(("article", "main"))
WHOLE = frozenset(("html", "body"))
EMPHASIS = frozenset("b cite em i mark q s small strong sub sup u".split())
#: Words of class, id and role that mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus"
    " footer header menu modal nav navbar navigation newsletter notice popup promo related respond share sharing sidebar"
    " skip social sponsor sponsored subscribe toolbar widget".split()
)
#: A class name with one of these words tells how the page is laid out, not what the element is.
STATE_WORDS = frozenset("has no not with without".split())
#: Words that add nothing to the name of what is not the article. Inside an article a name counts if it has no others.
PLAIN_WORDS = frozenset(
    "area bar block bottom box button buttons container content form group item items link links list panel post posts"
    " section signup slot text title top unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT_WORDS = frozenset("article content entry main post story".split())
#: Where the search for an open ``p`` or ``li`` to end stops.
AROUND_P, AROUND_LI = BLOCK - {"p"}, frozenset(("ul", "ol", "menu"))

#: Attributes up to this length are remembered with their marks.
SHORT_ATTRIBUTES = 200

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<[!?/A-Za-z][^<>]*\Z", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


class Piece(NamedTuple):
    """A tag or a text of a page. ``path`` are the open elements around it."""

    tag: str
    text: str
    marks: frozenset[str]
    path: tuple[int, ...]

    @property
    def name(self) -> str:
        return f"<{self.tag} {' '.join(sorted(self.marks))}>" if self.tag else self.text


class Marks(NamedTuple):
    """The words of an element's class, id and role. ``aside`` and ``content`` tell whether they mark what is not the
    article, or what is; ``named_aside`` whether a whole name does, ``own_aside`` whether a name has no other words."""

    words: frozenset[str]
    aside: bool
    content: bool
    named_aside: bool
    own_aside: bool


class Element(NamedTuple):
    """``parents`` are the open elements around it."""

    tag: str
    marks: Marks
    parents: tuple[int, ...]

    @property
    def is_aside(self) -> bool:
        return self.tag not in WHOLE and (self.tag in ASIDE or self.tag in RAW or self.marks.aside)

    @property
    def is_aside_in_article(self) -> bool:
        return self.tag in ASIDE or self.tag in RAW or self.marks.own_aside

    @property
    def holds_no_article(self) -> bool:
        """Whether an article inside it is none of the page: by tag or whole names, as a word of a name around the
        article often tells of the layout. Some servers wrap the whole page in a form."""
        return self.tag not in WHOLE and (self.tag in RAW or (self.tag in ASIDE and self.tag != "form") or self.marks.named_aside)


@lru_cache(maxsize=10_000)
def _marks(attributes: str) -> Marks:
    values = {a.lower(): (b or c or d).lower() for a, b, c, d in ATTRIBUTE.findall(attributes)}
    names = [name for key in ("class", "id", "role") for name in values.get(key, "").split()]
    split = [frozenset(w for w in re.split(r"[^a-z]+", name) if w) for name in names]
    telling = frozenset().union(*(words for words in split if not words & STATE_WORDS))
    own = any(words & ASIDE_WORDS and words <= ASIDE_WORDS | PLAIN_WORDS for words in split)
    return Marks(
        frozenset().union(*split), bool(telling & ASIDE_WORDS), bool(telling & CONTENT_WORDS), not ASIDE_WORDS.isdisjoint(names), own
    )


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where the content of a raw element ends; an svg or math element without an end has none."""
    found = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
    return found.start() if found else at if tag in FOREIGN else len(page)


def pieces(page: str) -> tuple[list[Piece], list[Element]]:
    """The tags and texts of a page in order, and its elements by number.

    An end tag closes all open elements down to its own; one without an open element is ignored. ``p`` and ``li`` end
    where the next of their kind begins, and a block ends an open ``p``. Content of raw elements and comments is skipped.
    """
    out: list[Piece] = []
    elements: list[Element] = []
    stack: list[int] = []
    at = 0

    def text(until: int) -> None:
        if until <= at:
            return
        found = page[at:until]
        # white space alone only parts texts of one block
        if not found.isspace() or (out and out[-1].tag.lstrip("/") not in BLOCK):
            out.append(Piece("", found, frozenset(), tuple(stack)))

    def close(names: tuple[str, ...], stop: frozenset[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if elements[stack[k]].tag in names:
                del stack[k:]
                return
            if elements[stack[k]].tag in stop:
                return

    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            text(len(page))
            break
        text(found.start())
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            close((tag,), frozenset())
            out.append(Piece(f"/{tag}", "", frozenset(), tuple(stack)))
            continue
        empty = tag in VOID or (tag in FOREIGN and found[3].endswith("/"))
        if tag in RAW and tag != "head" and not empty:
            end = _raw_end(page, tag, at)
            empty = tag in FOREIGN and end == at
            at = end
        marks = (_marks if len(found[3]) <= SHORT_ATTRIBUTES else _marks.__wrapped__)(found[3])
        if tag in BLOCK:
            close(("p",), AROUND_P)
        if tag == "li":
            close(("li",), AROUND_LI)
        out.append(Piece(tag, "", marks.words, tuple(stack)))
        if not empty:
            elements.append(Element(tag, marks, tuple(stack)))
            stack.append(len(elements) - 1)
    return out, elements


def token_ids(found: list[Piece], elements: list[Element]) -> np.ndarray:
    """64-bit numbers of the tokens: the piece and the tags around it."""
    import xxhash

    context: dict[tuple[int, ...], str] = {}
    out = []
    for piece in found:
        if piece.path not in context:
            context[piece.path] = "/".join(elements[e].tag for e in piece.path)
        out.append(xxhash.xxh64_intdigest(f"{context[piece.path]}\0{piece.name}".encode("utf-8", "surrogatepass")))
    return np.array(out, np.uint64).view(np.int64)


#: Where a text that may be part of the article stands.
OUTSIDE, INSIDE = 1, 2


class Text(NamedTuple):
    """A text that the elements around it leave in: the number of its block, whether an article holds it (``where``),
    whether it is emphasised, and whether its block is a heading."""

    block: int
    text: str
    token: int
    where: int
    emphasised: bool
    heading: bool


def candidates(found: list[Piece], elements: list[Element], ids: np.ndarray) -> list[Text]:
    """Texts that lie in article or main elements (in elements so named by class or id if there are none, else all texts),
    except those inside elements that are not the article."""
    aside = [e.is_aside for e in elements]
    own_aside = [e.is_aside_in_article for e in elements]
    barred = [e.holds_no_article for e in elements]
    strong = any(e.tag in CONTENT and not any(barred[p] for p in e.parents) for e in elements)
    named = not strong and any(
        e.marks.content and not a and not any(barred[p] for p in e.parents) for e, a in zip(elements, aside, strict=True)
    )
    out: list[Text] = []
    block, last, kept, where = 0, None, False, OUTSIDE
    for piece, token in zip(found, ids.tolist(), strict=True):
        if piece.tag:
            if piece.tag.lstrip("/") in BLOCK:
                block += 1
            elif piece.tag == "br":
                out.append(Text(block, " ", 0, OUTSIDE, False, False))
            continue
        path = piece.path
        if path != last:
            inside = [e for e in path if elements[e].tag in CONTENT or (named and elements[e].marks.content and not aside[e])]
            # a header of the article itself is part of it, a site's header is not
            if inside:
                own = path[path.index(inside[-1]) + 1 :]
                kept = not any(own_aside[e] and elements[e].tag != "header" for e in own)
                kept = kept and not any(barred[e] for e in path[: path.index(inside[-1])])
            else:
                kept = not (strong or named) and not any(aside[e] for e in path)
            where = INSIDE if inside else OUTSIDE
            tags = [elements[e].tag for e in path]
            emphasised, heading = bool(tags) and tags[-1] in EMPHASIS, not HEADINGS.isdisjoint(tags)
            last = path
        if kept:
            out.append(Text(block, piece.text, 0 if piece.text.isspace() else token, where, emphasised, heading))
    return out


def assemble(texts: list[Text], template: frozenset[int]) -> str:
    """Blocks of ``texts`` in order, joined by a line feed, without what belongs to the template.

    Outside articles that goes text by text; inside, where labels and data share blocks, by whole blocks, and headings
    and blocks of several texts that are all emphasised stay. A template leaves a slot open: if it has all text of an
    article, that is a copy and stays.
    """
    lines: list[tuple[str, bool]] = []
    at = 0
    while at < len(texts):
        end = at
        while end < len(texts) and texts[end].block == texts[at].block:
            end += 1
        block = [t for t in texts[at:end] if not (t.token and t.where == OUTSIDE and t.token in template)]
        at = end
        line = " ".join(markup.unescape("".join(t.text for t in block)).split())
        if not line:
            continue
        words = [t for t in block if t.token]
        constant = all(t.where == INSIDE and t.token in template and not t.heading for t in words)
        lines.append((line, bool(words) and constant and not (len(words) > 1 and all(t.emphasised for t in words))))
    return "\n".join([line for line, constant in lines if not constant] or [line for line, _ in lines])


def main_text(page: str | None, template: frozenset[int]) -> str:
    """Text of the article of one page, given the texts of its template."""
    found, elements = pieces(page or "")
    return assemble(candidates(found, elements, token_ids(found, elements)), template) if found else ""


PARSED = (
    "page_id string, url string, host long, page long, block array<int>, text array<string>, text_at array<int>, text_kind array<int>,"
    " token array<long>, n array<int>, wanted array<int>, before array<int>, after array<int>"
)
_LOW = (1 << 31) - 1  # of neighbours only their differences count


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What is kept of each page: the texts that may be the article's; and for pages of a host the distinct tokens in the
    order of their first place, how often they occur, where they are such a text, and the texts before the first and
    after the last occurrence. ``text_at`` is the place of a text's token among those."""
    for batch in batches:
        rows = []
        for page_id, url, host, number, page in batch[["page_id", "url", "host", "page", "html"]].itertuples(index=False, name=None):
            found, elements = pieces(page)
            numbers = token_ids(found, elements)
            texts = candidates(found, elements, numbers)
            kinds = [t.where + 4 * t.emphasised + 8 * t.heading for t in texts]
            row = (page_id, url, host, number, [t.block for t in texts], [t.text for t in texts])
            if not host or not found:
                rows.append((*row, [0 if t.token else -1 for t in texts], kinds, [], [], [], [], []))
                continue
            ids = numbers.tolist()
            is_text = [not p.tag and not p.text.isspace() for p in found]
            before: dict[int, int] = {}
            near = 0
            for token, text in zip(ids, is_text, strict=True):
                before.setdefault(token, near)
                near = token if text else near
            after: dict[int, int] = {}
            near = 0
            for token, text in zip(reversed(ids), reversed(is_text), strict=True):
                after.setdefault(token, near)
                near = token if text else near
            wanted = {t.token: t.where for t in texts}
            n = Counter(ids)
            at = {token: k for k, token in enumerate(before)}
            near = [[x & _LOW for x in before.values()], [after[t] & _LOW for t in before]]
            rows.append((*row, [at[t.token] if t.token else -1 for t in texts], kinds, [*before], [n[t] for t in before], [wanted.get(t, 0) for t in before], *near))
        if rows:
            yield pd.DataFrame(rows, columns=[field.split()[0] for field in PARSED.split(", ")])


def deduce_templates(parsed: DataFrame) -> DataFrame:
    """(host, page, template): the texts of a page that its template classes hold, of ``parsed`` pages.

    ``page`` is a hash of html, so pages that are equal count once. Outside articles every valid class counts, inside
    articles frames alone. A template has only texts of its page, so its size is bounded by that of the page; pages that
    hold none have no row.
    """
    zipped = F.arrays_zip("token", "n", "wanted", "before", "after")
    each = parsed.select("host", "page", F.posexplode(zipped).alias("at", "t")).select("host", "page", "at", "t.*")
    vector = F.shiftrightunsigned(F.xxhash64("page", "n"), 24).cast("decimal(20,0)")
    # most texts are on one page: a count of bare tokens first, so that only the others carry more into a shuffle
    on = parsed.select("host", F.explode("token").alias("token")).groupBy("host", "token").agg(F.count("*").alias("n"))
    often = bitmap(on.where(F.col("n") >= MIN_PAGES), "host", "token")
    tokens = with_hit(each, often, F.col("host"), F.col("token")).where("_hit").groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.sum("n").alias("total"), F.sum(vector).alias("vector"), F.max("wanted").alias("wanted"),
        F.min(F.struct("page", "at")).alias("first"), F.max("page").alias("last_page"),
        (F.min("before") != F.max("before")).alias("opens"), (F.min("after") != F.max("after")).alias("closes"),
    )
    hosts = parsed.where("size(token) > 0").groupBy("host").agg(F.count("*").alias("n_pages"))
    repeated = tokens.where((F.col("pages") >= MIN_PAGES) & (F.col("first.page") != F.col("last_page")))
    shared = join_split(repeated, hosts, ["host"])
    # the first places are those on one page, as tokens of a class share their pages
    once = F.col("total") == F.col("pages")
    classes = shared.groupBy("host", "vector", "pages", "total", "n_pages").agg(
        F.count("*").alias("n_tokens"), F.max("wanted").alias("wanted"), F.min("token").alias("sign"),
        F.collect_list(F.when(F.col("wanted") > 0, F.col("token"))).alias("texts"),
        F.min(F.when(once & F.col("closes"), F.col("first.at"))).alias("slot_from"),
        F.max(F.when(once & F.col("opens"), F.col("first.at"))).alias("slot_to"),
    )
    has_slot = F.coalesce(F.col("slot_from") < F.col("slot_to"), F.lit(False))
    valid = classes.where(
        (F.col("n_tokens") >= MIN_TOKENS) & (F.col("total") % F.col("pages") == 0) & (F.col("wanted") > 0)
        & (has_slot | (F.col("pages") >= MIN_SHARE * F.col("n_pages")) | (F.col("pages") >= SURE_PAGES))
    )
    valid = cut(valid.select("host", "sign", "pages", "wanted", "texts", has_slot.alias("has_slot")), "classes")
    frames = _frames(each, valid).withColumn("is_frame", F.lit(True))
    constant = valid.join(frames, ["host", "sign"], "left").select("host", F.explode("texts").alias("token"), "is_frame")
    in_slots = with_hit(each.where("wanted > 0"), bitmap(constant, "host", "token"), F.col("host"), F.col("token")).where("_hit")
    held = join_split(in_slots.select("host", "page", "token", "wanted"), constant, ["host", "token"])
    held = held.where((F.col("wanted") == OUTSIDE) | F.col("is_frame"))
    return held.groupBy("host", "page").agg(F.collect_set("token").alias("template"))


def _frames(each: DataFrame, valid: DataFrame) -> DataFrame:
    """(host, sign) of the classes that are frames of distinct articles: see ``OWN_TEXTS``. ``sign`` is the token that
    stands for its class."""
    likely = valid.where((F.col("wanted") == INSIDE) & F.col("has_slot") & (F.col("pages") >= FRAME_PAGES)).select("host", "sign")
    signs = with_hit(each, bitmap(likely, "host", "sign"), F.col("host"), F.col("token")).where("_hit")
    places = join_split(signs.select("host", "page", F.col("token").alias("sign")), likely, ["host", "sign"]).distinct()
    places = cut(places, "class-pages")  # equal pages count once
    on_them = with_hit(each.where(F.col("wanted") == INSIDE), bitmap(places, "host", "page"), F.col("host"), F.col("page")).where("_hit")
    texts = on_them.select("host", "page", "token").distinct()
    met = join_split(texts, places, ["host", "page"]).groupBy("host", "sign", "token").agg(F.count("*").alias("on"))
    sizes = places.groupBy("host", "sign").agg(F.count("*").alias("pages")).where(F.col("pages") >= FRAME_PAGES)
    others = join_split(met, sizes, ["host", "sign"]).where(F.col("on") < F.col("pages"))
    shares = others.groupBy("host", "sign").agg(F.count("*").alias("different"), F.sum("on").alias("all"))
    return shares.where(F.col("different") >= OWN_TEXTS * F.col("all")).select("host", "sign")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html).

    Text is the article's: without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup
    and comments. Character references are decoded, white space inside a block becomes one space, blocks are joined by
    a line feed in the order of the page. Null and empty html give an empty text. Hosts with few pages have no template;
    their pages go by their elements alone, as do urls without a host. Broken and cut-off markup is read as far as it
    goes. Repeated rows get a row each; an empty table gives an empty result; other columns are ignored.
    """
    host, _, _ = split_url(F.col("url"))
    known = F.when(host != "", F.xxhash64(host)).otherwise(F.lit(0).cast("long"))  # 0 for a url without a host
    hosted = pages.select(
        F.col("page_id").cast("string").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), known.alias("host")
    ).withColumn("page", F.xxhash64("html"))
    parsed = cut(hosted.mapInPandas(_parsed, PARSED), "parsed-pages", compression="zstd")
    templates = cut(deduce_templates(parsed), "templates")
    marked = with_hit(parsed.select("page_id", "url", "host", "page", "block", "text", "text_at", "text_kind", "token"), bitmap(templates, "host", "page"), F.col("host"), F.col("page"))
    framed = join_split(marked.where("_hit").drop("_hit"), templates, ["host", "page"], "left")
    plain = marked.where("not _hit").drop("_hit").withColumn("template", F.lit(None).cast("array<long>"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for blocks, texts, places, kinds, names, template in zip(
                batch["block"], batch["text"], batch["text_at"], batch["text_kind"], batch["names"], batch["template"], strict=True
            ):
                # without a template it is enough to tell words from spaces
                tokens = [0 if k < 0 else 1 if template is None else int(names[k]) for k in places]
                found = [Text(b, t, k, m & 3, bool(m & 4), bool(m & 8)) for b, t, k, m in zip(blocks, texts, tokens, kinds, strict=True)]
                out.append(assemble(found, frozenset() if template is None else frozenset(template.tolist())))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": out, "n_chars": [len(t) for t in out]})

    columns = ["page_id", "url", "block", "text", "text_at", "text_kind", "template"]
    none = F.lit(None).cast("array<long>")
    both = plain.select(*columns, none.alias("names")).unionByName(framed.select(*columns, F.col("token").alias("names")))
    found = both.mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return found.withColumn("page_id", F.col("page_id").cast("long"))
