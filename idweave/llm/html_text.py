"""The main text of web pages, by scoring the element tree.

A page is read once into a tree of block elements (inline elements such as
``b`` or ``a`` only say whether text is link text). Every paragraph, that is
text directly inside a block element, is worth a point, a point per comma and
a point per 100 characters. Its container gets all of that, the container's
parent half of it, and so on upwards; what an element gets is multiplied by
the part of its text that is not link text. The best container is kept, and
of its siblings those that score a fifth of it or are paragraphs or headings
without many links. If the best container lies in an ``article`` (or
``main``), that whole element is the container.

Never part of the text: elements that are not content by their tag or role
(``APART``), by a word of their class or id (``APART_WORDS``), or hidden;
blocks that are nothing but links; a ``header`` inside the article but for
its headings. If nothing is left on a page by classes and ids, it is scored
once more without them, if that finds ``UNCLASSED`` characters or more.

Markup as found on the web is accepted: end tags left out or in excess,
unclosed links, comments and tags, any letter case, character references
without semicolon.

Defined cases: null or empty html, and pages without text, give the empty
text; pages are read whole; repeated rows are rows of their own; an empty
table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from idweave.llm.common import ship

# Names of HTML elements, roles and customary class names.
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are not part of an article's text, with all they hold.
APART = frozenset("""script style textarea title xmp iframe noembed noframes noscript template nav footer aside form
    button select datalist menu dialog svg math canvas object audio video map""".split())
APART_ROLES = frozenset("""navigation banner contentinfo complementary search form menu menubar toolbar dialog
    alertdialog alert""".split())
APART_WORDS = frozenset("""ad ads advert adverts advertisement advertising advertorial banner sponsor sponsored promo
    promotion cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe
    subscription signup login sidebar sidebars aside rail nav navbar navigation menu menus breadcrumb breadcrumbs
    pagination pager footer masthead topbar toolbar comment comments commentlist respond replies disqus share sharing
    social related recommended recommendations widget widgets form forms search""".split())
#: Words before one of those that turn it into a property of the layout.
LAYOUT = frozenset("has with no without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold one paragraph and are never the container.
PARAGRAPHS = HEADINGS | frozenset("p pre li dt dd figcaption caption summary address legend".split())
BLOCKS = PARAGRAPHS | APART | frozenset("""html head body article main section div header hgroup blockquote ul ol dl
    figure table thead tbody tfoot tr td th details fieldset center""".split())
#: Start tag -> open elements that it ends, up to the innermost container.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"}}
PARTS = PARAGRAPHS | frozenset("head thead tbody tfoot tr td th".split())
#: Characters of text that a page must have to be scored without classes.
UNCLASSED = 250

_TAG = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SEMANTIC = {"article": 4.0, "main": 2.0}


def _apart(tag: str, attributes: str, by_class: bool) -> bool:
    if tag in APART:
        return True
    if not attributes.strip() or tag in ("html", "body"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower().strip() in APART_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if by_class and name in ("class", "id") and tag != "main":
            for one in value.split():
                words = [w.lower() for w in _WORDS.findall(one)]
                if any(w in APART_WORDS and not LAYOUT.intersection(words[:k]) for k, w in enumerate(words)):
                    return True
    return False


class Page:
    """The block tree of a page in page order: a parent comes before its
    children; ``pieces`` are (element, run, text, in a link), where a run has
    no block boundary inside."""

    def __init__(self, source: str, by_class: bool = True):
        self.tags, self.parent, self.apart = ["html"], [-1], [False]
        self.pieces: list[tuple[int, int, str, bool]] = []
        self.by_class, self.open, self.run, self.link = by_class, [0], 0, 0
        #: depths of the open elements by name, and of the containers
        self.depths: dict[str, list[int]] = {"html": [0]}
        self.containers = [0]
        at = 0
        while at < len(source):
            tag = _TAG.search(source, at)
            if not tag:
                break
            self._text(source[at:tag.start()])
            at = tag.end()
            name = (tag[2] or tag[5] or "").lower()
            if not name:
                continue
            if tag[1] or tag[4]:
                self._end(name)
                continue
            attributes = tag[3] or tag[6] or ""
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
                self.run += name not in ("script", "style")
            else:
                self._start(name, attributes)
        self._text(source[at:])

    def _text(self, text: str) -> None:
        if text and not self.apart[self.open[-1]]:
            self.pieces.append((self.open[-1], self.run, html.unescape(text) if "&" in text else text, self.link > 0))

    def _close(self, depth: int) -> None:
        for element in reversed(self.open[depth:]):
            tag = self.tags[element]
            self.depths[tag].pop()
            if tag not in PARTS:
                self.containers.pop()
        del self.open[depth:]
        self.run, self.link = self.run + 1, 0

    def _start(self, name: str, attributes: str) -> None:
        if name in ("br", "hr"):
            self.run += name == "hr"
            self._text(" ")
            return
        if name in VOID:
            return
        apart = _apart(name, attributes, self.by_class)
        if name == "a" and not apart:
            self.link = 1
        elif name in BLOCKS or apart or self.depths.get(name):
            last = self.tags[self.open[-1]]
            if last == "p" or last in HEADINGS and name in HEADINGS:
                self._close(len(self.open) - 1)
            ends = max((self.depths[t][-1] for t in ENDS.get(name, ()) if self.depths.get(t)), default=0)
            if ends > self.containers[-1]:
                self._close(ends)
            here = self.open[-1]
            self.depths.setdefault(name, []).append(len(self.open))
            if name not in PARTS:
                self.containers.append(len(self.open))
            self.open.append(len(self.tags))
            self.tags.append(name)
            self.parent.append(here)
            self.apart.append(self.apart[here] or apart)
            self.run += 1

    def _end(self, name: str) -> None:
        if name == "a":
            self.link = 0
        if name != "html" and self.depths.get(name):
            self._close(self.depths[name][-1])

    def holder(self, element: int) -> int:
        """The element that the points of text in ``element`` go to: of a
        cell's own text the table."""
        if self.tags[element] in ("td", "th"):
            while element and self.tags[element] != "table":
                element = self.parent[element]
        elif self.tags[element] in PARAGRAPHS:
            element = self.parent[element]
        return element


def _within(page: Page, roots: set[int]) -> list[bool]:
    """Per element, whether it is one of ``roots`` or inside one."""
    out = [False] * len(page.tags)
    for e, up in enumerate(page.parent):
        out[e] = e in roots or up >= 0 and out[up]
    return out


def _kept(page: Page) -> list[bool]:
    """Per element, whether its own text belongs to the main text."""
    size = len(page.tags)
    runs: dict[tuple[int, int], list[str]] = {}
    text, linked, score = [0] * size, [0] * size, [0.0] * size
    links = [0] * size
    before = None
    for element, run, piece, link in page.pieces:
        runs.setdefault((element, run), []).append(piece)
        chars = len(piece.strip())
        text[element] += chars
        if link and chars:
            linked[element] += chars
            links[element] += before != (element, run, True)
        before = element, run, link
    for (element, _), parts in runs.items():
        words = " ".join("".join(parts).split())
        if words and page.tags[element] not in HEADINGS:
            worth = (len(words) >= 25) + words.count(",") + len(words) / 100
            score[page.holder(element)] += worth
    for e in range(size - 1, 0, -1):
        up = page.parent[e]
        text[up] += text[e]
        linked[up] += linked[e]
        links[up] += links[e]
        score[up] += score[e] / 2
    density = [linked[e] / text[e] if text[e] else 0.0 for e in range(size)]
    score = [s * (1 - d) * _SEMANTIC.get(t, 1.0) for s, d, t in zip(score, density, page.tags)]
    inside = [e for e in range(size) if not page.apart[e] and page.tags[e] not in PARAGRAPHS and score[e] > 0]
    if not inside:
        return [False] * size
    best = max(inside, key=lambda e: (score[e], -e))
    chain, up = [], best
    while up >= 0:
        chain.append(up)
        up = page.parent[up]
    for tag in ("article", "main"):
        whole = [e for e in chain if page.tags[e] == tag]
        if whole:
            best = whole[-1]
            break
    roots = {best}
    alike = page.tags[best] in _SEMANTIC
    for e in range(1, size):
        if page.parent[e] != page.parent[best] or e == best or page.apart[e] or not text[e]:
            continue
        if alike:
            more = page.tags[e] == page.tags[best] and score[e] >= score[best] / 5
        else:
            more = density[e] < 0.25 and (score[e] >= score[best] / 5 or page.tags[e] in PARAGRAPHS - {"li"})
        if more:
            roots.add(e)
    menus = {e for e in range(size) if links[e] > 1 and density[e] > 0.9 and page.tags[e] not in PARAGRAPHS}
    heads = {e for e in range(size) if page.tags[e] == "header"}
    here, menu, head = _within(page, roots), _within(page, menus - roots), _within(page, heads - roots)
    return [here[e] and not page.apart[e] and not menu[e] and (not head[e] or page.tags[e] in HEADINGS)
            for e in range(size)]


def main_text(source: str | None) -> str:
    """The main text of one page."""
    for by_class in (True, False):
        page = Page(source or "", by_class)
        kept = _kept(page)
        parts, last = [], None
        for element, run, piece, _ in page.pieces:
            if kept[element]:
                if last is not None and last != (element, run):
                    parts.append(" ")
                parts.append(piece)
                last = element, run
        out = " ".join("".join(parts).split())
        if out and (by_class or len(out) >= UNCLASSED):
            return out
    return ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for each row of ``pages``."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"),
                 pa.array([main_text(h.as_py()) for h in batch.column("html")], pa.string())],
                names=["page_id", "url", "text"])

    kind = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(
        each, f"page_id {kind['page_id']}, url {kind['url']}, text string")


ship(__name__)
