"""Operator 8, main text of web pages by flat text blocks and a decision tree.

A page is cut into a flat list of text blocks at block-level tags. Each block
has a few numbers: its words and link density and those of its neighbours, what
kinds of element it stands in, and whether the class or id of one of them names
a part of a page that is no article. A decision tree (grown here, by Gini
impurity, on the small labelled table below) says which blocks are main text.

Pages are independent: one pass, no shuffle, whole html of any length, in time
that grows with it.

Defined results: null, empty or unparsable html gives an empty text; an empty
table gives no rows; an unclosed quote in a tag does not hide its ``>``; character
references are decoded after cutting, so an encoded tag is text; white space in
a block becomes one space, blocks are joined by one space; repeated rows give
each their own; extra columns are kept.
"""

from __future__ import annotations

import functools
import html as html_entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

#: Elements that begin a block.
BLOCK_TAGS = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Elements without content.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of a page.
SILENT = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|select|textarea|button|title"
#: Elements for parts of a page beside its article.
OUTER_TAGS = frozenset("nav aside footer form dialog menu fieldset search head".split())
#: Names of such parts in class, id or role.
OUTER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle alert author-bio banner bio breadcrumb breadcrumbs byline captcha comment comments commentlist consent contentinfo cookie cookies cookiebar copyright "
    "dialog discussion disqus dropdown feedback footer form gdpr header login masthead menu menubar meta modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup "
    "privacy promo promotion promoted recommended related replies reply respond responses search share sharing shares sidebar signin signup skip skiplink social sponsor sponsored subscribe subscription taboola tags teaser toc toolbar topbar widget widgets complementary".split()
)

_SILENT = frozenset(SILENT.split("|"))
_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_QUOTE = re.compile(r"[>\"']")
#: Characters that may be looked at beyond the ends of tags, as a multiple of a page's length.
LOOK_AHEAD = 8
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
FEATURES = ("words", "link_density", "words_before", "words_after", "link_before", "link_after", "in_article", "page_has_article", "in_outer_tag", "in_outer_name", "in_header", "heading", "list_item", "ends_sentence")


def tags(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of the tags of a page in order; comments, declarations and silent elements have no name.

    Every character is looked at a bounded number of times: a mark that is not
    found once is not searched again, and once LOOK_AHEAD is used up, a tag ends
    at its first ``>``, quoted or not.
    """
    at, budget = 0, LOOK_AHEAD * len(html) + 1000
    while (start := html.find("<", at)) >= 0:
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(html)
            yield start, at, "", False, ""
            continue
        found = _NAME.match(html, start + 1)
        if not found and html[start + 1 : start + 2] not in ("!", "?"):
            at = start + 1
            continue
        first = html.find(">", found.end() if found else start + 2)
        if first < 0:
            return
        if not found:
            at = first + 1
            yield start, at, "", False, ""
            continue
        name, end = found[2].lower(), first
        if name in _SILENT:
            at = first + 1
            if not found[1]:
                close = re.compile(rf"</{name}\s*+[^>]*+>", re.I).search(html, at)
                at = close.end() if close else len(html)
                yield start, at, "", False, ""
            else:
                yield start, at, name, True, ""
            continue
        look = found.end()
        while budget > 0 and (mark := _QUOTE.search(html, look)):
            if mark[0] == ">":
                end = mark.start()
                break
            close = html.find(mark[0], mark.end())
            budget -= max((close if close >= 0 else len(html)) - max(look, first), 0)
            if close < 0:
                break
            look = close + 1
        at = end + 1
        yield start, at, name, bool(found[1]), html[found.end() : end]


class _Stack:
    """Open elements, with counts of the kinds that matter."""

    def __init__(self):
        self.tags: list[tuple[str, bool]] = []
        self.places: dict[str, list[int]] = {}  # of the open elements of each name
        self.walls: list[int] = []  # places of elements that a stray inline end tag does not close
        self.article = self.outer = self.named = self.header = self.link = self.heading = self.item = 0

    def _add(self, tag: str, named: bool, by: int) -> None:
        self.article += by * (tag in ("article", "main") and not named)
        self.outer += by * (tag in OUTER_TAGS)
        self.named += by * named
        self.header += by * (tag == "header")
        self.link += by * (tag == "a")
        self.heading += by * (len(tag) == 2 and tag[0] == "h" and tag[1] in "123456")
        self.item += by * (tag == "li")

    def open(self, tag: str, attributes: str) -> None:
        # an unclosed paragraph, item or cell ends where its next begins
        if tag in ("p", "li", "dt", "dd", "td", "th", "option") and self.tags and self.tags[-1][0] == tag:
            self.close(tag)
        named = False
        if attributes:
            for m in _NAMES.finditer(attributes):
                words = re.split(r"[\s_]+", (m[1] or m[2] or m[3] or "").lower())
                named = named or any(w in OUTER_NAMES or any(part in OUTER_NAMES for part in w.split("-")) for w in words)
        named = named and tag not in ("body", "html", "article", "main") or named and tag == "article" and "comment" in attributes.lower()
        self.places.setdefault(tag, []).append(len(self.tags))
        if tag in ("article", "main", "body", "table"):
            self.walls.append(len(self.tags))
        self.tags.append((tag, named))
        self._add(tag, named, 1)

    def close(self, tag: str) -> None:
        if not self.places.get(tag):
            return
        k = self.places[tag][-1]
        if tag not in BLOCK_TAGS and self.walls and self.walls[-1] > k:
            return
        for t, named in self.tags[k:]:
            self._add(t, named, -1)
            self.places[t].pop()
        del self.tags[k:]
        while self.walls and self.walls[-1] >= k:
            self.walls.pop()


def blocks(html: str) -> list[tuple[str, list[float]]]:
    """(text, FEATURES) of the text blocks of a page, in order."""
    stack, out, pieces, linked = _Stack(), [], [], 0

    def end() -> None:
        nonlocal pieces, linked
        if pieces:
            text = _SPACE.sub(" ", html_entities.unescape("".join(pieces))).strip()
            if text:
                words = text.count(" ") + 1
                out.append((text, [words, min(linked / len(text), 1.0), 0, 0, 0, 0, stack.article > 0, 0, stack.outer > 0, stack.named > 0, stack.header > 0, stack.heading > 0, stack.item > 0, text[-1] in ".!?…:;\"'”»)"]))
            pieces, linked = [], 0

    at = 0
    for start, stop, tag, closing, attributes in tags(html):
        if start > at:
            piece = html[at:start]
            pieces.append(piece)
            linked += len(piece.strip()) * (stack.link > 0)
        at = stop
        if tag in BLOCK_TAGS:
            end()
        if closing:
            stack.close(tag)
        elif tag and tag not in VOID_TAGS:
            stack.open(tag, attributes)
    if at < len(html):
        tail = html[at:]
        cut = re.compile(r"<[a-zA-Z/!?]").search(tail, tail.rfind(">") + 1)  # a tag broken off by the end
        pieces.append(tail[: cut.start()] if cut else tail)
    end()
    article = any(f[6] for _, f in out)
    for k, (_, f) in enumerate(out):
        if k:
            f[2], f[4] = out[k - 1][1][0], out[k - 1][1][1]
        if k + 1 < len(out):
            f[3], f[5] = out[k + 1][1][0], out[k + 1][1][1]
        f[7] = article
    return out


#: The labelled table: small pages whose main blocks begin with a section sign.
LABELLED = (
    '<header><a href="/">Daily Page</a></header><nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport</a></li></ul></nav><article><h1>§A bridge opens</h1><p>§The bridge over the river was opened on Monday after four years of work.</p><p>§Short.</p><p>§It carries <a href="/t">trams</a> and walkers, and the town hopes for less traffic in the old streets.</p></article><aside><p>Most read stories of this week, chosen by our editors for you.</p></aside><footer>&copy; Daily Page. All rights reserved by the publisher.</footer>',
    '<div class="cookie-notice"><p>We use cookies to make this site work better. Read our policy before you go on.</p></div><div class="menu"><a href="/1">One</a> <a href="/2">Two</a> <a href="/3">Three</a></div><main><h2>§On bread</h2><p>§Flour, water and salt are all that bread needs, besides time.</p><ul><li>§five hundred grams of flour</li><li>§ten grams of salt</li></ul><div class="ad">Buy the best oven now, only this week at half the price.</div><p>§Let it rest.</p></main><div class="comments"><h3>Comments</h3><p>I tried this and it came out very well, thank you for the recipe.</p></div>',
    '<div id="top"><p><a href="/home">Home</a> | <a href="/about">About us</a> | <a href="/contact">Contact</a></p></div><div><h1>§A walk in the hills</h1><p>§We left the village early, when fog still lay over the fields, and climbed for two hours.</p><p>§From the ridge one sees three lakes and, on clear days, the sea far to the west.</p></div><div><p><a href="/x">Next tour</a> <a href="/y">All tours</a></p><p>Terms of use</p></div>',
    '<form action="/s"><label>Search this site for words</label></form><article><header><h1>§Old clocks</h1><p>By a writer, Monday</p></header><p>§A clock that is wound each week will run for centuries if it is cleaned now and then.</p><blockquote>§Time is what you make of it.</blockquote><section class="related"><h3>Related</h3><p><a href="/r">Watches of the last century and their makers</a></p></section><p>§The museum shows forty of them.</p><section id="comments"><article class="comment"><p>My uncle had one like this, and it never stopped in all his years.</p></article></section></article><div class="sidebar"><p>Subscribe to our letter and get a story each week in your inbox.</p></div>',
    '<nav><a href="/q">Index</a></nav><div class="ad">A short offer.</div><article><h1>§Rain</h1><p>§It rained.<p>§For days the gutters ran over, and nobody went out but the postman.<p>§Yes.</article><footer>Imprint of the house. Printed on the hill.</footer>',
    '<table><tr><td><a href="/m1">Menu one</a></td><td><a href="/m2">Menu two</a></td></tr></table><div><p>§This long report on harvests tells of a dry spring, a wet summer and a late autumn, and of what the farmers made of it.</p><p>§Wheat did worst of all crops in the valley, maize did best on the upper fields.</p></div><div><a href="/p">Previous</a> <a href="/n">Next</a></div><p>Powered by a small program</p>',
    '<div class="banner">Sale ends today for all members of the club.</div><div class="newsletter"><p>Leave your address to hear from us once a month, no more often.</p></div><main><p>§Owls hear better than they see, though their eyes are large and open wide.</p><aside class="promo"><p>Get the bird book with many pictures for a small price.</p></aside><p>§They turn their heads.</p><footer>Filed under birds by the desk.</footer></main>',
    "<article><h1>§Only this</h1><p>§A page may hold its article and nothing else at all.</p><p>§No.</p><p>§Then all of it is text.</p></article>",
    "<div>Welcome to the site of our town, dear reader.</div><p>Offices are closed on Friday.</p><article><h1>§A well</h1><p>§Workers found an old well under the square, and it still holds water.</p><p>§It is deep.</p></article><div><p>More from our desk can be found among the stories of past years.</p></div><p>Call us.</p>",
    "<div><h2>Our house</h2><p>We have made papers since the year the town was founded.</p></div><main><p>§Snow fell on the pass, and drivers had to put on chains.</p><h2>§Later</h2><p>§The road was open at ten.</p></main><div><h3>Weather</h3><p>Cold and dry for the rest of the week.</p></div><p>Thank you for your visit to these pages.</p>",
    "<main><p>§Fog.</p><p>§It came at night and stayed until noon, and boats lay still.</p></main>",
    '<article><p>§Links <a href="/l">may stand in a line of an article</a> and be most of it.</p><p><a href="/e">Read on elsewhere in full</a></p><ul><li>§a list of things</li><li>§and one more</li></ul><form><p>Tell us what you think of this page.</p></form></article>',
    '<div class="content"><h1>§Notes from a garden</h1><p>§Beans climb, peas cling, and pumpkins run along the ground as far as they are let.</p><p>§Water in the evening.</p></div><div class="footer"><p>Legal notice and contact of this site are found here.</p></div><div role="navigation"><ul><li><a href="/k">Kitchen</a></li><li>Plants</li></ul></div>',
)


#: How often each labelled page enters the table, its blocks' texts repeated a varying number of times.
VARIANTS = 24


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """FEATURES and labels of the blocks of LABELLED; lengths are varied so that the tree does not learn those of the few pages."""
    random = np.random.Generator(np.random.PCG64(3))
    rows, labels = [], []
    for page in LABELLED:
        for variant in range(VARIANTS):
            times = lambda m: ">" + (m[1] + (" " + m[1].replace("§", "")) * (int(random.integers(0, 12)) if variant else 0)) + "<"  # noqa: E731, B023
            own = re.sub(r">([^<>]+)<", times, page)
            main = [text.startswith("§") for text, _ in blocks(own)]
            rows += [f for _, f in blocks(own.replace("§", ""))]
            labels += main
    return np.array(rows, np.float64), np.array(labels, np.int64)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 6) -> tuple:
    """A decision tree: ("leaf", share of main) or (feature, bound, tree where value <= bound, tree above)."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return ("leaf", share)
    best = None
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for bound in (values[:-1] + values[1:]) / 2:
            low = x[:, j] <= bound
            n = int(low.sum())
            if min(n, len(y) - n) < least:
                continue
            p, q = y[low].mean(), y[~low].mean()
            impurity = n * p * (1 - p) + (len(y) - n) * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, j, float(bound), low)
    if best is None:
        return ("leaf", share)
    _, j, bound, low = best
    return (j, bound, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def predict(tree: tuple, x: np.ndarray) -> np.ndarray:
    if tree[0] == "leaf":
        return np.full(len(x), tree[1])
    j, bound, below, above = tree
    low = x[:, j] <= bound
    out = np.empty(len(x))
    out[low], out[~low] = predict(below, x[low]), predict(above, x[~low])
    return out


@functools.cache
def tree() -> tuple:
    return grow(*labelled_table())


def main_text(pages: list[str | None], model: tuple | None = None) -> list[str]:
    """The main texts of whole pages."""
    model = model or tree()
    found = [blocks(p) if p else [] for p in pages]
    rows = [f for page in found for _, f in page]
    keep = iter((predict(model, np.array(rows, np.float64)) >= 0.5).tolist() if rows else [])
    return [" ".join(text for text, _ in page if next(keep)) for page in found]


def extract(pages: DataFrame, column: str = "html", model: tuple | None = None, out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``column`` as ``out`` in place of ``column``."""
    own = pages.drop(out)
    at = own.columns.index(column)
    model = model or tree()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array(main_text(batch.column(at).to_pylist(), model), pa.string())
            yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(batch.columns) if i != at], texts], [*[n for i, n in enumerate(batch.schema.names) if i != at], out])

    schema = StructType([*[f for i, f in enumerate(own.schema.fields) if i != at], StructField(out, StringType())])
    return own.mapInArrow(extracted, schema)
