"""Main text of web pages from streamed parser events.

``html.parser`` events are cut into lines, one a block element. Each line has a text-to-tag ratio; the ratios are
smoothed with a Gaussian and split by a two-means threshold, and the lines above it are marked as content. The marked
lines select the region: the smallest element that holds at least three quarters of their text, or the ``article``
around it, and any other ``article`` with marked text. In an ``article`` or ``main`` every line stays; in any other
element the lines from the first marked one to the last do, with the headings and paragraphs before and behind them.
Lines inside menus, headers, footers, sidebars, notices, adverts, forms, comments and other furniture never count.
Words of a class or id are weak evidence for furniture: they don't count for an element around an article, nor, on a
page without one, for an element that holds most of the page's text.

Defined results: null or empty html gives an empty text; a page without content lines gives an empty text; repeated
rows are each extracted; unclosed and stray tags are tolerated; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._shared import small_batches, worker

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Never text of the page.
_HIDDEN = frozenset("script style noscript template title head iframe object svg math canvas audio video select textarea datalist".split())
#: Furniture by element. A form may also be wrapped around a page.
_OUTSIDE = frozenset("nav aside footer button menu dialog input label fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Furniture by a word of class or id: what can't be meant otherwise, what can, and what readers write.
_SURE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar masthead cookie cookies consent newsletter subscribe signup login pagination pager toolbar popup modal overlay copyright".split())
_MAYBE = frozenset("banner widget footer header notice notices alert share sharing social related recommended disclaimer skip".split())
_READERS = frozenset("comment comments commentlist discussion replies reply respond disqus".split())
#: A class of its own that speaks against a word that can be meant otherwise, and the first part of a content's header.
_CONTENT = frozenset("article body content entry main post section story text title article-body article-content entry-content post-body post-content story-body".split())
_NEGATED = frozenset("no not without has with".split())
#: An article with one of these is not the page's own.
_OTHER_ARTICLES = frozenset("comment comments reply teaser related promo ad advert sponsored".split())
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = _HEADINGS | {"p", "blockquote", "pre"}
_HARD, _WRAP, _CLASS, _COMMENT, _HEAD = 1, 2, 3, 4, 5
_PLAIN_START = re.compile(r"<([a-zA-Z][a-zA-Z0-9]*)>")
_PLAIN_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
#: A closed element of these ends an open one of the same set.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table article main section div body td th nav aside footer header form blockquote".split())


def _kind_of_class(value: str) -> int:
    """What the words of a class or id tell: nothing (0), furniture or comments."""
    tokens = value.split()
    own, kind = {t.lower() for t in tokens}, 0
    for token in tokens:
        words = [w.lower() for w in _SPLIT.split(token) if w]
        for i, word in enumerate(words):
            pair = words[i - 1] + word if i else ""
            if i and words[i - 1] in _NEGATED or i > 1 and words[i - 2] in _NEGATED and pair in _SURE:
                continue
            if word in _READERS:
                return _COMMENT
            if word in _SURE or pair in _SURE:
                kind = _CLASS
            elif word == "header" and i and words[i - 1] in _CONTENT:
                kind = kind or _HEAD  # an article's own: its headings stay
            elif word in _MAYBE and own.isdisjoint(_CONTENT):
                kind = _CLASS
    return kind


class _Lines(HTMLParser):
    """Lines of one page as [text parts, tags, link parts, node], and its block elements as nodes of a tree."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[list] = []
        self.open: list[tuple[str, bool, int, bool, bool]] = []  # name, hidden, node, link, in an article
        self.parent, self.tag, self.kind = [-1], ["html"], [0]
        self.hidden, self.node, self.link, self.inside = False, 0, False, False
        self.new()

    def new(self) -> None:
        if not self.lines or self.lines[-1][0]:
            self.lines.append([[], 0, [], self.node])
        else:
            self.lines[-1][1:] = 0, [], self.node

    def updatepos(self, i: int, j: int) -> int:
        return j  # nothing here asks for line numbers

    def parse_starttag(self, i: int) -> int:
        """A start tag without attributes needs none of the general scan."""
        found = None if self.cdata_elem else _PLAIN_START.match(self.rawdata, i)
        tag = found and found[1].lower()
        if not found or tag in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "plaintext"):
            return super().parse_starttag(i)
        self.lasttag = tag
        self.handle_starttag(tag, [])
        return found.end()

    def parse_endtag(self, i: int) -> int:
        found = None if self.cdata_elem else _PLAIN_END.match(self.rawdata, i)
        if not found:
            return super().parse_endtag(i)
        self.handle_endtag(found[1].lower())
        return found.end()

    def state(self) -> None:
        _, self.hidden, self.node, self.link, self.inside = self.open[-1] if self.open else ("", False, 0, False, False)

    def kind_of(self, tag: str, attrs: list) -> int:
        kind = _HARD if tag in _OUTSIDE or tag == "header" and not self.inside else _WRAP if tag == "form" else 0
        if attrs and tag not in ("html", "body", "main"):
            for name, value in attrs:
                if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and (value or "").lower() in _ROLES:
                    return _HARD
                if value and not kind and name in ("class", "id"):
                    if tag == "article":
                        kind = 0 if _OTHER_ARTICLES.isdisjoint(w.lower() for w in _SPLIT.split(value)) else _COMMENT
                    else:
                        kind = _kind_of_class(value)
        return kind

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _CLOSES:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] in _CLOSES[tag]:
                    del self.open[k:]
                    self.state()
                    break
                if self.open[k][0] in _SCOPES:
                    break
        elif tag == "body":  # a head that was never closed ends here
            self.open = [x for x in self.open if x[0] not in ("head", "title")]
            self.state()
        if tag not in _VOID:
            kind, node = self.kind_of(tag, attrs), self.node
            if kind or tag in _BLOCK:
                self.parent.append(node)
                self.tag.append(tag)
                self.kind.append(kind)
                node = len(self.tag) - 1
            self.open.append((tag, self.hidden or tag in _HIDDEN, node, self.link or tag == "a", self.inside or tag in ("article", "main") and not kind))
            self.state()
            if kind and tag not in _BLOCK:
                self.new()
        if tag in _BLOCK:
            self.new()
        self.lines[-1][1] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag not in ("p", "div", "article", "main", "section"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.lines[-1][1] += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                before = self.node
                del self.open[k:]
                self.state()
                if tag not in _BLOCK and before != self.node:
                    self.new()
                break
        if tag in _BLOCK:
            self.new()

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        line = self.lines[-1]
        line[0].append(data)
        if self.link:
            line[2].append(data)

    def sums(self, amounts: list[int]) -> list[int]:
        """Amounts by node with those of all nodes inside it."""
        total = list(amounts)
        for n in range(len(total) - 1, 0, -1):
            total[self.parent[n]] += total[n]
        return total

    def furniture(self, chars: list[int]) -> list[bool]:
        """Whether each node is furniture or inside some; ``chars`` is the text directly in a node."""
        outside = [False] * len(self.kind)
        for n in range(1, len(self.kind)):
            outside[n] = outside[self.parent[n]] or self.kind[n] == _HARD
        text = self.sums([0 if o else c for c, o in zip(chars, outside)])
        own = self.sums([int(t in ("article", "main") and not k) for t, k in zip(self.tag, self.kind)])
        comments = [False] * len(self.kind)
        for n in range(1, len(self.kind)):
            comments[n] = comments[self.parent[n]] or self.kind[n] == _COMMENT
        readers = sum(c for c, o, r in zip(chars, outside, comments) if r and not o)
        head = [k == _HEAD for k in self.kind]
        for n in range(1, len(self.kind)):
            kind, above = self.kind[n], self.parent[n]
            if outside[above]:
                head[n] = head[above] and not kind
                outside[n] = not (head[n] and self.tag[n] in _HEADINGS)
            elif kind == _HEAD:
                outside[n] = True
            elif kind == _COMMENT:
                outside[n] = text[n] < text[0]
            elif kind in (_WRAP, _CLASS):
                outside[n] = not (own[n] if own[0] else not comments[n] and 2 * text[n] > text[0] - readers)
        return outside


def _smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.concatenate((np.full(reach, ratios[0]), ratios, np.full(reach, ratios[-1])))
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def _threshold(values: np.ndarray) -> float:
    """The middle between the two centres of a one-dimensional two-means clustering; lines at least at it are content."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        cut = (low + high) / 2
        below, above = values[values < cut], values[values >= cut]
        if not len(below):
            return cut
        new = float(below.mean()), float(above.mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _region(page: _Lines, mass: list[int], share: float) -> int:
    """The smallest node with ``share`` of the marked text, or the article around it."""
    held, inside = page.sums(mass), [[] for _ in page.tag]
    for n in range(1, len(page.tag)):
        inside[page.parent[n]].append(n)
    node = 0
    while True:
        deeper = next((n for n in inside[node] if held[n] >= share * held[0]), None)
        if deeper is None or page.tag[deeper] in _PROSE:
            break
        node = deeper
    above = node
    while above > 0 and page.tag[above] != "article":
        above = page.parent[above]
    return above or node


def extract_text(html: str | None, sigma: float = 1.0, link_share: float = 0.6, region_share: float = 0.75) -> str:
    """Main text of one page: its content blocks, white space inside each made one space, joined by one space."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    found, chars = [], [0] * len(page.tag)
    for parts, tags, linked, node in page.lines:
        text = " ".join("".join(parts).split())
        if text:
            link = len(" ".join("".join(linked).split())) if linked else 0
            found.append((text, node, link >= link_share * len(text), tags))
            chars[node] += len(text)
    outside = page.furniture(chars)
    found = [x for x in found if not outside[x[1]]]
    if not found:
        return ""
    ratio = np.array([(0 if mostly else len(text)) / max(1, tags) for text, _, mostly, tags in found])
    smooth = _smooth(ratio, sigma)
    threshold = _threshold(smooth)
    marked = (smooth >= threshold) | (ratio >= threshold)
    prose = marked & ~np.array([mostly for *_, mostly, _ in found])
    if prose.any():  # links choose a region only where nothing else does
        marked = prose
    mass = [0] * len(page.tag)
    for (text, node, *_), m in zip(found, marked):
        if m:
            mass[node] += len(text)
    region, held = _region(page, mass, region_share), page.sums(mass)
    in_region, in_article = [False] * len(page.tag), [False] * len(page.tag)
    for n in range(len(page.tag)):
        above = page.parent[n]
        in_region[n] = n == region or above >= 0 and in_region[above]
        in_article[n] = above >= 0 and in_article[above] or page.tag[n] == "article" and held[n] > 0 or n == region and page.tag[n] == "main"
    where = [k for k, x in enumerate(found) if in_region[x[1]] and marked[k]]
    # a line that only its neighbour marks doesn't end the region
    where = [k for k in where if ratio[k] >= threshold or page.tag[found[k][1]] in _PROSE] or where
    first, last = where[0], where[-1]
    chosen = []
    for k, (_, node, mostly, _) in enumerate(found):
        between = first <= k <= last or page.tag[node] in _PROSE and not mostly
        chosen.append(in_article[node] or in_region[node] and between)
    k = chosen.index(True) - 1
    while k >= 0 and page.tag[found[k][1]] in _HEADINGS:  # the headline may stand before the region
        chosen[k] = True
        k -= 1
    return " ".join(x[0] for x, c in zip(found, chosen) if c)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", block: int = 256) -> DataFrame:
    """id, url, text and n_chars (code points) of every page."""
    small_batches(pages.sparkSession)
    kind = pages.schema[id_column].dataType.simpleString()
    schema = StructType.fromDDL(f"`{id_column}` {kind}, `{url_column}` string, text string, n_chars bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                batch = whole.slice(at, block)
                texts = [extract_text(x) for x in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

    return pages.select(F.col(id_column), F.col(url_column), F.col(html_column)).mapInArrow(worker("html", run), schema)
