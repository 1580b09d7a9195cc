"""Main text of web pages by tag-path ratios.

Every visible text node has a root-to-leaf tag path.  Over a page, each path collects the text length, the
punctuation and the number of its nodes; length and punctuation per node are smoothed over neighbouring
nodes and fused into one ratio, which is high for paths of running text and low for menus and link lists.
A node's score is its path's ratio, of which only a small share (``BELIEF``) is believed where an element around it
announces something else than the article: see ``OUTSIDE`` and ``OUTSIDE_WORDS`` (tags, and words of class, id and role).  Nodes
that score at least a share of the length-weighted mean of the nodes that nothing speaks against are content nodes.  The deepest
element that holds nearly all of their text is the article; within it nodes on weaker paths (headings,
one-word paragraphs) are content as well, unless they are link lists or announced as something else.  In an ``<article>`` or ``<main>`` a
single linked line is no list.  A ``<main>`` with three fifths of the content text is the page for this.

A word of a class, id or role counts on a container if it is one of the name's words, and on a paragraph, heading, list item, cell or
inline element only if all of the name's words are such words.  It counts nowhere if the name says what a page has
(``with-sidebar``), nor around an ``<article>`` or ``<main>``.

Each page is handled on its own in the task that reads it; time and memory are linear in the page, however
deep its elements are nested: paths and elements are numbers with parents.
Defined results: a null or empty page, a page without text and a page of which every visible text is announced as
something else than the article give an empty text; broken markup is read
as far as it goes (unclosed elements end with their parent, an unclosed comment or script at the end of
the page); repeated rows give repeated results; equal ratios are chosen alike; further columns are kept by ``extract``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean_text, workers_import

#: Fixed tables of HTML: elements without an end tag, elements that start a block, what is never shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead tr ul""".split())
HIDDEN = frozenset("""head script style noscript template iframe object svg math canvas audio video map datalist
    title""".split())
#: Elements that may hold a whole article (a paragraph or list item can't).
HOLDERS = frozenset("html body main article section div td center details".split())
#: Elements beside the article.
OUTSIDE = HIDDEN | frozenset("nav header footer aside form button select textarea input menu dialog label".split())
#: Words of class, id or role that mark such elements.
OUTSIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored promo
    promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer bottombar
    colophon copyright sidebar aside rail widget widgets related recommended recommendations share sharing social
    follow newsletter subscribe subscription signup login cookie cookies consent gdpr notice notices alert popup modal
    overlay disclaimer comment comments commentlist replies reply respond disqus discussion form search searchbox
    toolbar pagination pager tags skip toc contentinfo complementary dialog""".split())
#: Words of names that tell what a page has, not what an element is.
ABOUT_PAGE = frozenset("has with without no layout page".split())
#: Elements that count as a menu, an advert and so on if one word of their name says so.
CONTAINERS = frozenset("""address aside center details dialog div dl fieldset figure footer form header iframe ins menu nav ol
    section table tbody ul""".split())
#: An element that closes an open one of the same row when it starts (HTML's optional end tags).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
          "th": {"table", "tr"}, "option": {"select"}, "tbody": {"table"}}
MARKS = re.compile(r"[.,;:!?。、，；：！？…]")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|iframe|template)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Share of the mean from which a node is content; of the content text that the article holds; of that in a
#: <main> that is the page for this reason; what is believed of a ratio where something speaks against it.
LEAST_RATIO, ARTICLE_SHARE, MARKED_SHARE, BELIEF = 0.3, 0.9, 0.6, 0.005


class Page:
    """The text nodes of a page in order, as columns, and its elements with their parents.

    A node has its text, path, innermost element, block (nodes between two block limits share one), and whether it is
    linked, in an ``<article>`` or ``<main>``, outside the article, and hidden.  An element has its parent (an earlier one, -1
    for none), tag, and whether itself or one around it is outside or hidden.
    """

    def __init__(self):
        self.text: list[str] = []
        self.path: list[int] = []
        self.element: list[int] = []
        self.block: list[int] = []
        self.linked: list[bool] = []
        self.marked: list[bool] = []
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.barred: list[bool] = []  # by its own tag
        self.named: list[bool] = []   # by a word of its class, id or role
        self.hidden: list[bool] = []

    def outside(self) -> list[bool]:
        """Whether each element, or one around it, is announced as something else than the article."""
        holds = [t in ("article", "main") for t in self.tag]
        for e in range(len(holds) - 1, -1, -1):  # children have higher numbers
            if holds[e] and self.parent[e] >= 0:
                holds[self.parent[e]] = True
        out: list[bool] = []
        for e, up in enumerate(self.parent):
            own = self.barred[e] or self.hidden[e] or (self.named[e] and not holds[e])
            out.append(own or (up >= 0 and out[up]))
        return out


def marked_outside(tag: str, attributes: str) -> bool:
    """Whether a class, id or role says that an element isn't the article."""
    for found in ATTRIBUTE.finditer(attributes):
        for name in next(v for v in found.groups() if v is not None).split():
            words = [w.lower() for w in WORDS.findall(name)]
            if not words or not ABOUT_PAGE.isdisjoint(words):
                continue
            if not OUTSIDE_WORDS.isdisjoint(words) if tag in CONTAINERS else OUTSIDE_WORDS.issuperset(words):
                return True
    return False


def read_page(html: str) -> Page:
    page = Page()
    paths: dict[tuple[int, str], int] = {}
    stack: list[tuple[str, int, int]] = []  # tag, path, element
    open_at: dict[str, list[int]] = {}      # tag: depths at which it is open
    blocks_at: list[int] = []               # depths of open block elements
    block = at = 0

    def last(tags) -> int:
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=-1)

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag = stack.pop()[0]
            open_at[tag].pop()
            if blocks_at and blocks_at[-1] == len(stack):
                blocks_at.pop()

    def add(text: str) -> None:
        if text:
            _, path, element = stack[-1] if stack else ("", -1, -1)
            page.text.append(unescape(text))
            page.path.append(path)
            page.element.append(element)
            page.block.append(block)
            page.linked.append(bool(open_at.get("a")))
            page.marked.append(bool(open_at.get("article") or open_at.get("main")))

    for token in TOKEN.finditer(html):
        add(html[at:token.start()])
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            block += 1
        inner = blocks_at[-1] if blocks_at else -1  # the innermost open block
        if token["end"] or token["end2"]:
            depth = last((tag,))
            if depth >= 0 and (tag in BLOCK or depth > inner):  # an inline end tag doesn't close blocks
                close(depth)
            continue
        if tag in VOID:
            continue
        if tag in BLOCK and inner >= 0 and stack[inner][0] == "p":
            close(inner)
        if tag in CLOSES:
            depth = last(CLOSES[tag])
            if depth > last(SCOPES[tag]):
                # the outermost of the row's elements that are open in this scope
                close(min(d for t in CLOSES[tag] for d in open_at.get(t, ())[-1:] if d > last(SCOPES[tag])))
        attributes = token["attrs"] or token["attrs2"] or ""
        if attributes.rstrip().endswith("/") and tag in ("svg", "iframe"):
            continue
        _, up, parent = stack[-1] if stack else ("", -1, -1)
        path = paths.setdefault((up, tag), len(paths))
        page.parent.append(parent)
        page.tag.append(tag)
        page.hidden.append(tag in HIDDEN or (parent >= 0 and page.hidden[parent]))
        page.barred.append(tag in OUTSIDE)
        page.named.append(tag not in ("html", "body", "article", "main") and marked_outside(tag, attributes))
        open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            blocks_at.append(len(stack))
        stack.append((tag, path, len(page.tag) - 1))
    add(html[at:])
    return page


def path_ratios(path: np.ndarray, length: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The fused ratio of each node's path."""
    which = np.unique(path, return_inverse=True)[1].reshape(-1)
    count = np.bincount(which)
    fused = []
    for values in (length, marks):
        ratio = (np.bincount(which, values) / count)[which]
        padded = np.concatenate([ratio[:1], ratio, ratio[-1:]])
        smooth = 0.25 * padded[:-2] + 0.5 * padded[1:-1] + 0.25 * padded[2:]
        fused.append((np.bincount(which, smooth) / count)[which])
    return fused[0] * (1 + fused[1])


def content(page: Page, nodes: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """Which of the nodes with the given numbers belong to the article; ``outside`` is by node of the page."""
    if not len(nodes) or outside[nodes].all():
        return nodes[:0]
    texts = [page.text[i] for i in nodes]
    linked, element = np.array(page.linked)[nodes], np.array(page.element)[nodes]
    strange = outside[nodes]
    ratio = path_ratios(np.array(page.path)[nodes], np.array([len(t.strip()) for t in texts], float),
                        np.array([len(MARKS.findall(t)) for t in texts], float))
    length = np.array([len(t) for t in texts], float)
    score = np.where(strange, BELIEF, 1.0) * ratio
    chosen = score >= LEAST_RATIO * np.average(score[~strange], weights=length[~strange])
    chosen &= ~linked | (ratio >= ratio[~strange].max())
    if not chosen.any():
        return nodes[:0]
    total = float(length[chosen].sum())
    up = page.parent

    def holder(tags: frozenset, share: float) -> int:
        """The deepest such element that holds this share of the content nodes' text; -1 if none does."""
        held = np.zeros(len(up) + 1)
        np.add.at(held, element[chosen], length[chosen])  # -1, no element, is the last place
        for e in range(len(up) - 1, -1, -1):
            if up[e] >= 0:
                held[up[e]] += held[e]
        return max((e for e in range(len(up)) if page.tag[e] in tags and held[e] >= share * total and held[e] > 0), default=-1)

    def within(one: int) -> np.ndarray:
        """Whether each node is in element ``one``."""
        inside = np.zeros(len(up) + 1, bool)
        for e in range(one, len(up)):
            inside[e] = e == one or (up[e] >= 0 and inside[up[e]])
        return inside[element]

    main = holder(frozenset(["main"]), MARKED_SHARE)
    if main >= 0 and not within(main).all():
        return content(page, nodes[within(main)], outside)  # a page has one <main>; what is beside it isn't
    article = holder(HOLDERS, ARTICLE_SHARE)
    block = np.unique(np.array(page.block)[nodes], return_inverse=True)[1].reshape(-1)
    links = np.bincount(block, length * linked) > np.bincount(block, length * ~linked)
    beside = np.concatenate([[False], links[:-1]]) | np.concatenate([links[1:], [False]])
    listed = (links & beside)[block]
    alone = np.array(page.marked)[nodes] & ~listed  # a single linked line of a marked article is no list
    weak = (within(article) if article >= 0 else np.ones(len(nodes), bool)) & ~strange & (~links[block] | alone)
    return nodes[chosen | weak]


def main_text(html: str | None) -> str:
    """Blocks of the article, white space inside a block as one space, joined by blank lines."""
    if not html:
        return ""
    page = read_page(html)
    at = np.array(page.element, np.int64)
    outside = np.append(np.array(page.outside(), bool), False)[at] if len(at) else np.zeros(0, bool)
    hidden = np.append(np.array(page.hidden, bool), False)[at] if len(at) else np.zeros(0, bool)
    words = np.array([bool(t.strip()) for t in page.text], bool)
    wanted = set(content(page, np.flatnonzero(words & ~hidden), outside).tolist())
    blocks: dict[int, list[str]] = {}
    for i, text in enumerate(page.text):
        if i in wanted or not (words[i] or hidden[i]):
            blocks.setdefault(page.block[i], []).append(text)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def main_text_column(html: Column) -> Column:
    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array((main_text(p.as_py()) for p in pages), pa.string())

    return extracted(html)


def extract(pages: DataFrame, html_col: str = "html", output_col: str = "text") -> DataFrame:
    """Add the main text of every page."""
    workers_import(pages.sparkSession)
    return pages.withColumn(output_col, main_text_column(clean_text(html_col)))


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    done = extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text")
    return done.withColumn("n_chars", F.length("text").cast("long"))
