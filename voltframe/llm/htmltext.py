"""Operator 6: main text of HTML by boosted trees over DOM-node features.

Method: a tolerant reader turns a page into element nodes; every node gets features (tag, attribute
tokens, depth, subtree text, link and tag density, punctuation, place among its siblings and their
text, share of the parent's and the page's text, what its ancestors are); gradient-boosted trees
give the log odds that it is main content (a node is, if it lies in the article or holds it).
Hierarchical decoding then picks the most likely labelling of the whole tree in which no node
under a dropped node is kept (exact, by one pass up and one down). The text of the kept nodes is
put out block by block.

Training data are made from a bounded sample of about ``TRAIN_PAGES`` rows of the table itself:
each sampled page as it is, labelled by its semantic tags and attribute tokens, and ``VARIANTS``
rebuilt pages: its own headline, paragraphs and short texts put into a random layout whose parts
are known (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, with or
without telling tags and classes). No sampled page: a built-in text.

Text: character references decoded; white space within a block is one space; blocks trimmed,
joined by a blank line, in page order; script, style, title, textarea, iframe and the like, up to
their end tag or the end of the page, and a template or select that has its end tag never are text.
svg, object, canvas and noscript are nodes like others; the text of math is its surroundings'. One
of these without an end tag is markup only. A tag or comment cut off by the end of the page is markup.

Defined results: NULL or empty html gives the empty text; a page without elements gives its plain
text; repeated rows get a row each; a NULL page_id or url stays NULL; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm import gbtree
from voltframe.llm.common import bounded_sample, map_batches, pick, table

TRAIN_PAGES, VARIANTS = 200, 6

#: HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
#: Elements that may hold elements of their own kind: those skipped whole, and nodes if they have an end tag.
SKIPPED, PAIRED = frozenset(("template", "select")), frozenset(("template", "select", "svg", "object", "canvas", "noscript"))
CHOICES = frozenset(("option", "optgroup"))
#: What may hold text in svg; its other elements (shapes, groups) are no nodes.
SVG_TEXT = frozenset(("svg", "text", "foreignobject", "desc", "a"))
#: MathML: no nodes, their text is that of the node around.
MATH = frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul caption".split())
#: What an implied end looks at.
FENCES = BLOCKS | {"td", "th"}
#: An opening tag closes an open element of these first, up to the nearest of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"})}
#: Attribute tokens and tags that speak for and against main content.
GOOD_TOKENS = frozenset("article body content entry main post story text hentry blog page".split())
BAD_TOKENS = frozenset("ad ads advert advertisement adverts aside banner bottombar breadcrumb breadcrumbs button byline comment comments consent cookie cookies copyright disqus footer form gdpr header login masthead menu meta modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted related recommended replies reply respond search share sharing sidebar signup skip skyscraper social sponsor sponsored subscribe tags toolbar topbar widget".split())
GOOD_TAGS, BAD_TAGS = frozenset(("article", "main")), frozenset(("nav", "footer", "aside", "form", "header", "menu", "button", "dialog", "fieldset", "search"))
_TAGS = ("p", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "a", "table", "td", "span", "body", "html", "head", "blockquote", "pre", "b", "button")
_BAD_NAMES = tuple(sorted(BAD_TOKENS))
_HAS_BLOCK = re.compile(r"<(?:%s)\b" % "|".join(sorted(BLOCKS)))
_HEADS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>="']++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Za-z]+|[0-9]+")
_POINTS = re.compile(r"[.,;:!?]")
_RIGHTS = re.compile(r"\u00a9|copyright|rights reserved", re.I)


def _raw_end(html: str, tag: str, pos: int) -> int:
    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, pos)
    return end.end() if end else len(html)


class Page:
    """Element nodes of one page (node 0 is the document) and its pieces of text."""

    def __init__(self, html: str | None):
        self.tag, self.parent, self.depth, self.tokens, self.told = ["#"], [-1], [0], [()], [None]
        self.end = [1]                                # behind the last node below
        self.text: list[tuple[int, int, str]] = []    # node, block, piece
        self.block = 0
        self.stack: list[int] = [0]                   # the open nodes
        self.places: dict[str, list[int]] = defaultdict(list)      # where in it each tag stands
        self.fences: list[int] = []                   # where in it blocks and cells stand
        if html:
            self._read(html)
            self._cut(0)

    def _open(self, tag: str, attributes: str, at: int) -> int:
        told, tokens = None, []
        if attributes.strip():
            for m in _ATTRIBUTE.finditer(attributes):
                value = m[2] or m[3] or m[4] or ""
                if m[1].lower() == "data-y":
                    told = int(value)
                else:
                    tokens += [w.lower() for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value))]
        self.tag.append(tag)
        self.parent.append(at)
        self.depth.append(self.depth[at] + 1)
        self.tokens.append(tuple(tokens))
        self.told.append(told)
        self.end.append(len(self.tag))
        return len(self.tag) - 1

    def _push(self, node: int, tag: str) -> None:
        self.places[tag].append(len(self.stack))
        if tag in FENCES:
            self.fences.append(len(self.stack))
        self.stack.append(node)

    def _cut(self, at: int) -> None:
        """Close the open nodes from place ``at`` on."""
        for place in range(len(self.stack) - 1, at - 1, -1):
            node = self.stack.pop()
            self.end[node] = len(self.tag)
            if place:
                self.places[self.tag[node]].pop()
                if self.tag[node] in FENCES:
                    self.fences.pop()

    @staticmethod
    def _pairs(html: str, pos: int) -> dict[int, int]:
        """From behind the opening tag to behind the end tag, for each PAIRED element from ``pos`` on
        that has one; an end tag is that of the nearest open element of its kind."""
        found, started = {}, {t: [] for t in PAIRED}
        while m := _MARKUP.search(html, pos):
            pos = m.end()
            tag = (m[2] or "").lower()
            if tag in PAIRED:
                if not m[1]:
                    if not m[3].endswith("/"):
                        started[tag].append(pos)
                elif started[tag]:
                    found[started[tag].pop()] = pos
            elif tag in RAW and not m[1] and not (started["svg"] and m[3].endswith("/")):
                pos = _raw_end(html, tag, pos)
        return found

    def _read(self, html: str) -> None:
        stack, pos, pairs = self.stack, 0, None
        while True:
            m = _MARKUP.search(html, pos)
            piece = html[pos:m.start() if m else len(html)]
            if piece:
                self.text.append((stack[-1], self.block, unescape(piece) if "&" in piece else piece))
            if not m:
                return
            pos = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
            else:
                self._implied(tag)
                if tag in BLOCKS:
                    self.block += 1
                elif tag in ("br", "td", "th"):
                    self.text.append((stack[-1], self.block, " "))
                if tag in VOID or tag in MATH:
                    continue
                if tag in RAW:
                    if not (m[3].endswith("/") and self.places["svg"]):     # within svg a tag may close itself
                        pos = _raw_end(html, tag, pos)
                    continue
                if self.tag[stack[-1]] == "svg" and tag not in SVG_TEXT and tag not in BLOCKS:
                    continue
                if tag in PAIRED and not m[3].endswith("/"):
                    if pairs is None:
                        pairs = self._pairs(html, m.start())
                    if tag in SKIPPED or pos not in pairs:
                        pos = pairs.get(pos, pos)
                        continue
                node = self._open(tag, m[3], stack[-1])
                if not m[3].endswith("/") or tag in BLOCKS:
                    self._push(node, tag)

    def _implied(self, tag: str) -> None:
        if tag in BLOCKS:      # a block ends an open paragraph, and an open choice
            while self.fences:
                at = self.fences[-1]
                open_tag = self.tag[self.stack[at]]
                if open_tag != "p" and (open_tag not in CHOICES or tag in CHOICES):
                    break
                self._cut(at)
                if open_tag == "p":
                    break
        if tag in CLOSES:
            ended, limit = (max((self.places[t][-1] for t in kinds if self.places[t]), default=0) for kinds in CLOSES[tag])
            if ended > limit:
                self._cut(ended)

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self.block += 1
        if self.places[tag]:
            self._cut(self.places[tag][-1])

    def blocks(self, kept) -> str:
        """Text of the kept nodes, block by block."""
        out: list[list[str]] = []
        last = None
        for node, block, piece in self.text:
            if kept[node]:
                if block != last:
                    out.append([])
                    last = block
                out[-1].append(piece)
        return "\n\n".join(t for t in (" ".join("".join(b).split()) for b in out) if t)


class Forest:
    """Node arrays of many pages, one after the other. Nodes are in page order, so what lies below
    a node is a range: sums below and along the way up are differences of running sums (exact, as
    all are of whole numbers), at a cost that does not depend on the depth."""

    def __init__(self, pages: list[Page]):
        self.start = np.cumsum([0] + [len(p.tag) for p in pages])
        self.parent = np.concatenate([np.array(p.parent) + s for p, s in zip(pages, self.start)])
        self.end = np.concatenate([np.array(p.end) + s for p, s in zip(pages, self.start)])
        self.depth = np.concatenate([p.depth for p in pages])
        self.page = np.repeat(np.arange(len(pages)), np.diff(self.start))
        self.n = len(self.parent)

    def sums(self, own: np.ndarray) -> np.ndarray:
        """Own values plus those of all nodes below."""
        total = np.concatenate([[0.0], np.cumsum(own, dtype=np.float64)])
        return total[self.end] - total[:-1]

    def inherited(self, own: np.ndarray) -> np.ndarray:
        """How many proper ancestors have the mark."""
        change = np.zeros(self.n + 1)
        change[1:] += own
        np.subtract.at(change, self.end, own)
        return np.cumsum(change[:-1])

    def decode(self, odds: np.ndarray) -> np.ndarray:
        """Most likely labelling in which nothing under a dropped node is kept."""
        keep, drop = (-np.logaddexp(0, -odds)).tolist(), (-np.logaddexp(0, odds)).tolist()
        parent, roots = self.parent.tolist(), set(self.start.tolist())
        for i in range(self.n - 1, 0, -1):
            if i not in roots:
                up = parent[i]
                keep[up] += max(keep[i], drop[i])
                drop[up] += drop[i]
        out = [True] * self.n
        for i in range(self.n):
            if i not in roots:
                out[i] = out[parent[i]] and keep[i] >= drop[i]
        return np.array(out, dtype=bool)


def features(pages: list[Page], forest: Forest) -> np.ndarray:
    n = forest.n
    own, points, rights = np.zeros(n), np.zeros(n), np.zeros(n)
    for p, s in zip(pages, forest.start):
        for node, _, piece in p.text:
            size = len(piece.split()) and len(piece.strip())
            if size:
                own[s + node] += size
                points[s + node] += len(_POINTS.findall(piece))
                rights[s + node] += _RIGHTS.search(piece) is not None
    tags = np.array([t for p in pages for t in p.tag])
    tokens = [t for p in pages for t in p.tokens]
    good, bad = np.array([len(GOOD_TOKENS.intersection(t)) for t in tokens]), np.array([len(BAD_TOKENS.intersection(t)) for t in tokens])
    good_tag, bad_tag = np.isin(tags, list(GOOD_TAGS)).astype(float), np.isin(tags, list(BAD_TAGS)).astype(float)
    in_link = forest.inherited((tags == "a").astype(float)) + (tags == "a")
    linked = np.where(in_link > 0, own, 0)
    text, marks, links = forest.sums(own), forest.sums(points), forest.sums(linked)
    count, paragraphs, long_text = forest.sums(np.ones(n)), forest.sums(tags == "p"), forest.sums(np.where(own >= 60, own, 0))
    up = np.maximum(forest.parent, 0)
    up = np.where(forest.parent < 0, np.arange(n), up)
    whole = np.maximum(text[forest.start[forest.page]], 1)
    brothers = np.bincount(up, minlength=n)[up].astype(float)
    order = np.lexsort((np.arange(n), up))
    first = np.r_[True, up[order][1:] != up[order][:-1]]
    run = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    place = np.zeros(n)
    place[order] = run
    around = (np.bincount(up, text, minlength=n)[up] - text) / np.maximum(brothers - 1, 1)
    per = lambda a, b: a / np.maximum(b, 1)
    cols = [np.log1p(own), np.log1p(text), per(links, text), per(marks, text), per(count, text), np.log1p(per(text, count)), per(text, whole), per(text, text[up]),
            forest.depth, count, np.log1p(paragraphs), per(long_text, text), brothers, place, per(place, brothers), np.log1p(around), (np.arange(n) - forest.start[forest.page]) / np.diff(forest.start)[forest.page],
            good, bad, good_tag, bad_tag, forest.inherited(good), forest.inherited(bad), forest.inherited(good_tag), forest.inherited(bad_tag), good[up], bad[up],
            forest.sums(good) - good, forest.sums(bad) - bad, forest.sums(good_tag) - good_tag, np.isin(tags, list(_HEADS)).astype(float), in_link, per(links[up], text[up]), np.log1p(text[up])]
    headed = forest.sums(tags == "h1") > 0
    small_bad = ((bad > 0) & ~headed).astype(float)
    cols += [rights, per(forest.sums(rights), text), headed, small_bad, forest.inherited(small_bad), forest.inherited(headed.astype(float)), per(long_text, long_text[forest.start[forest.page]]), per(long_text, long_text[up])]
    cols += [(tags == t).astype(float) for t in _TAGS] + [(tags[up] == t).astype(float) for t in ("body", "div", "li", "article", "p", "td")]
    return np.stack(cols, axis=1).astype(np.float32)


def told_labels(page: Page) -> np.ndarray | None:
    """Labels of a rebuilt page (its parts are marked), or of a page with an article or main
    element by its tags and tokens; None if nothing tells. No token speaks against what holds the
    headline (h1): an article of class social-story is an article."""
    n = len(page.tag)
    y = np.zeros(n, dtype=np.int64)
    if any(t is not None for t in page.told):
        for i in range(1, n):
            y[i] = page.told[i] if page.told[i] is not None else y[page.parent[i]]
        inside = y == 1
    else:
        if not GOOD_TAGS.intersection(page.tag):
            return None
        inside, heads = np.zeros(n, dtype=bool), np.cumsum([0, *(t == "h1" for t in page.tag)])
        for i in range(1, n):
            headed = heads[page.end[i]] > heads[i]
            bad = page.tag[i] in BAD_TAGS and page.tag[i] != "header" or not headed and BAD_TOKENS.intersection(page.tokens[i])
            inside[i] = (inside[page.parent[i]] or page.tag[i] in GOOD_TAGS) and not bad
    y = inside.astype(np.int64)
    for i in range(n - 1, 0, -1):      # what holds content is content
        if y[i]:
            y[page.parent[i]] = 1
    return y


def rebuilt(page: Page, rng: random.Random) -> str:
    """A page of a random layout, made of this page's texts; each part is marked with its label. A part
    of the layouts are ``bare``: nothing but div and span, without a name; in a part of the others the
    article's own names speak against it."""
    y = told_labels(page)
    body = page.blocks(y if y is not None else np.ones(len(page.tag), dtype=bool)).split("\n\n")
    rest = page.blocks(~(y > 0) if y is not None else np.zeros(len(page.tag), dtype=bool)).split("\n\n")
    body = [b for b in body if b] or ["Lorem ipsum dolor sit amet, consectetur adipiscing elit. Sed do eiusmod tempor."] * 4
    words = " ".join([*body, *rest]).split()
    some = lambda a, b: escape(" ".join(rng.choice(words) for _ in range(rng.randint(a, b))))
    title, paragraphs = escape(body[0][:120]), [escape(b) for b in body[1:]] or [some(20, 60)]
    rng.shuffle(paragraphs)
    paragraphs = paragraphs[:rng.choice((1, 2, 4, 8, 40))]

    def tagged(tag, tokens, inner, label):
        names = {0: "", 1: f' class="{rng.choice(tokens)}"', 2: f' id="{rng.choice(tokens)}"', 3: f' class="{some(1, 1)} {rng.choice(tokens)}-{rng.choice(("box", "wrap", "inner", "1"))}"'}
        return f'<{tag}{names[rng.choice((0, 1, 1, 2, 3)) if tag in ("div", "section", "ul", "ol", "p", "table", "span") else rng.choice((0, 0, 1))]} data-y="{label}">{inner}</{tag}>'

    link = lambda: f'<a href="/{rng.randint(0, 99)}">{some(1, 3)}</a>'
    links = lambda a, b: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(a, b))) + "</ul>"
    named = lambda tokens, inner: f'<{(t := rng.choice(("div", "div", "section", "div" if _HAS_BLOCK.search(inner) else "p")))} class="{rng.choice(tokens)}" data-y="0">{inner}</{t}>'
    menu = lambda: tagged(rng.choice(("nav", "div", "ul")), ("nav", "menu", "navbar", "navigation"), rng.choice((links(3, 12), " | ".join(link() for _ in range(rng.randint(3, 9))))), 0)
    top = lambda: tagged(rng.choice(("header", "div")), ("header", "masthead", "topbar", "banner"), f"<a href='/'>{some(1, 3)}</a> {some(0, 8)}" + rng.choice(("", menu())), 0) if rng.random() < 0.5 else tagged("header", ("header",), f"<h2>{some(1, 4)}</h2><p>{some(2, 12)}</p>", 0)
    foot = lambda: tagged("footer", ("footer",), rng.choice(("&copy; ", "")) + some(3, 25) + rng.choice(("", links(2, 6))), 0) if rng.random() < 0.6 else named(("footer", "copyright", "site-footer", "bottombar"), "&copy; " + some(3, 25))
    side = lambda: tagged("aside", ("sidebar", "widget", "related"), f"<h3>{some(1, 4)}</h3>" + rng.choice((links(3, 8), f"<p>{some(5, 40)}</p>")), 0) if rng.random() < 0.5 else named(("sidebar", "widget", "related", "recommended"), f"<h3>{some(1, 4)}</h3>" + rng.choice((links(3, 8), f"<p>{some(5, 40)}</p>")))
    advert = lambda: named(("ad", "ads", "advert", "banner", "sponsored", "promo", "ad-slot"), rng.choice((some(3, 30), f"<p>{some(5, 30)}</p>", f"<a href='/x'>{some(2, 12)}</a>")))
    notice = lambda: named(("cookie-notice", "notice", "consent", "gdpr", "newsletter", "popup", "subscribe"), rng.choice((some(5, 40), f"<p>{some(5, 40)}</p><button>{some(1, 2)}</button>")))
    form = lambda: tagged("form", ("search", "login", "signup"), f"<label>{some(1, 4)}</label><input name='q'><button>{some(1, 2)}</button><p>{some(0, 12)}</p>", 0)
    share = lambda: named(("share", "social", "tags", "breadcrumbs", "byline", "pagination"), " ".join(link() for _ in range(rng.randint(2, 5))))
    comments = lambda: named(("comments", "comment-list", "replies", "disqus"), f"<h3>{some(1, 3)}</h3>" + "".join(f'<{(t := rng.choice(("div", "li", "article")))} class="{rng.choice(("comment", "reply", "c"))}"><b>{some(1, 2)}</b><p>{some(4, 50)}</p></{t}>' for _ in range(rng.randint(1, 6))))
    bare = rng.random() < 0.3
    head = rng.choice((f"<h1>{title}</h1>",) * 4 + (f"<div><h1>{title}</h1></div>", f'<div class="{rng.choice(_BAD_NAMES)}"><h1>{title}</h1></div>', f'<header class="{some(1, 1)}-header"><h1>{title}</h1></header>'))
    parts = [head] if rng.random() < 0.85 else []
    wraps = ("<div>{}</div>",) if bare and rng.random() < 0.3 else ("<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<blockquote><p>{}</p></blockquote>", "<p><em>{}</em></p>")
    for p in paragraphs:
        kind = rng.random()
        if kind < 0.06:
            parts.append(f"<h2>{some(2, 8)}</h2>")
        if kind > 0.94:
            parts.append("<ul>" + "".join(f"<li>{some(3, 15)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        p = p.replace(" ", f' <a href="/y">{some(1, 3)}</a> ', 1) if rng.random() < 0.15 else p
        parts.append(rng.choice(wraps).replace("{}", p))
    if bare:
        owned = lambda: f'<div data-y="0">{rng.choice(("&copy; ", "Copyright ", "&copy; 2020 "))}{some(1, 8)}{rng.choice((".", ". All rights reserved."))}{rng.choice(("", links(2, 6)))}</div>'
        return _bare_page(title, parts, menu, owned, share, form, rng)
    for piece in (advert, share, side, form, notice):
        if rng.random() < 0.25:
            parts.insert(rng.randint(0, len(parts)), piece())
    if rng.random() < 0.2:
        parts.append(comments())
    inner = "".join(parts)
    main = tagged(rng.choice(("article", "article", "main", "div", "div", "section")), _main_names(rng), inner, 1)
    if rng.random() < 0.3:
        main = tagged(rng.choice(("main", "div", "section")), ("main", "content", "wrapper", "container", "page"), rng.choice(("", advert(), side(), share())) + main + rng.choice(("", side(), comments(), form())), 1)
    outer = [piece() for piece in (top, menu, notice, advert, form) if rng.random() < 0.5] + [main] + [piece() for piece in (side, comments, advert, notice, share, menu) if rng.random() < 0.35] + ([foot()] if rng.random() < 0.9 else [])
    return f'<!DOCTYPE html><html><head><title>{title}</title></head><body>{"".join(outer)}</body></html>'


def _main_names(rng: random.Random) -> tuple[str, ...]:
    """Names for the article's element: telling ones, or one that speaks against it."""
    if rng.random() < 0.75:
        return ("article", "content", "post", "entry-content", "story", "main", "col", "x")
    bad = rng.choice(_BAD_NAMES)
    return (bad, f"{bad}-{rng.choice(sorted(GOOD_TOKENS))}", f"{rng.choice(sorted(GOOD_TOKENS))} {bad}")


def _bare_page(title: str, parts: list[str], menu, foot, share, form, rng: random.Random) -> str:
    """A page of div elements without names; only what its links, its place or its fields tell is beside the article."""
    cut = rng.choice((0, 0, 1))                                     # the headline may stand apart
    inner = "".join(parts)
    main = rng.choice(("", '<div data-y="1">' + "".join(parts[:cut]) + "</div>")) + '<div data-y="1">' + "".join(parts[cut:]) + "</div>" if cut else rng.choice((
        f'<div data-y="1">{inner}</div>', f'<div data-y="1"><div>{inner}</div></div>', f'<div data-y="1"><div>{inner}</div><div data-y="0">{share()}</div></div>'))
    if rng.random() < 0.25:                                         # or all of it right in the body
        main = "".join(re.sub(r"^<(\w+)", r'<\1 data-y="1"', p) for p in parts)
    outer = [piece() for piece in (menu, menu, form) if rng.random() < 0.6] + [main] + [piece() for piece in (share, menu) if rng.random() < 0.6]
    if rng.random() < 0.8:
        outer.append(foot())
    plain = re.sub(r"<(/?)(?:nav|header|footer|aside|section|article|main)\b", r"<\1div", "".join(outer))
    return f"<html><head><title>{title}</title></head><body>{re.sub(r' (?:class|id)="[^"]*"', '', plain)}</body></html>"


def training_nodes(html: str | None, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights of one sampled page and its rebuilt variants (each page weighs the same)."""
    rng, given = random.Random(seed), Page(html)
    pages = [given] * (told_labels(given) is not None and len(given.tag) > 1) + [Page(rebuilt(given, rng)) for _ in range(VARIANTS)]
    forest = Forest(pages)
    y = np.concatenate([told_labels(p) for p in pages])
    return features(pages, forest), y, (1 / np.diff(forest.start))[forest.page]


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> dict:
    """Boosted trees from about ``train_pages`` rows of ``pages(page_id, html)``."""
    def run(b: pa.RecordBatch) -> dict:
        out = [training_nodes(h, 17 + (p or 0)) for p, h in zip(b.column("page_id").to_pylist(), b.column("html").to_pylist())]
        return {"page_id": b.column("page_id"), **{c: [o[i].astype(t).tobytes() for o in out] for i, (c, t) in enumerate((("x", "f4"), ("y", "i8"), ("w", "f8")))}}

    chosen = bounded_sample(pages.where("page_id IS NOT NULL AND html IS NOT NULL"), ["page_id"], train_pages, seed=6)
    rows = sorted((r.page_id, r.x, r.y, r.w) for r in map_batches(chosen.select("page_id", "html"), run, "page_id long, x binary, y binary, w binary").collect())
    sets = [tuple(np.frombuffer(v, dtype=t) for v, t in zip(r[1:], ("f4", "i8", "f8"))) for r in rows]
    if not sets:
        x, y, w = training_nodes(None, 17)
        sets = [(x.ravel(), y, w)]
    y = np.concatenate([s[1] for s in sets])
    return gbtree.fit(np.concatenate([s[0] for s in sets]).reshape(len(y), -1), y, np.concatenate([s[2] for s in sets]) * len(y) / len(sets) / (VARIANTS + 1))


def extract(html: list[str | None], model: dict) -> list[str]:
    """Main text of each page."""
    pages = [Page(h) for h in html]
    forest = Forest(pages)
    kept = forest.decode(gbtree.margins(features(pages, forest), model))
    return [p.blocks(kept[s:e]) for p, s, e in zip(pages, forest.start, forest.start[1:])]


def main_text(pages: DataFrame, model: dict, keep: dict[str, str]) -> DataFrame:
    """``keep`` columns of every row plus ``text``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> dict:
        html = b.column("html").to_pylist()
        return {c: b.column(c) for c in keep} | {"text": [t for i in range(0, len(html), 200) for t in extract(html[i:i + 200], shared.value)]}

    return map_batches(pages.select(*keep, "html"), run, ", ".join(f"{c} {t}" for c, t in keep.items()) + ", text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pick(table(spark, sf_dir, "pages"), page_id="long", url="string", html="string")
    return main_text(pages, fit(pages), {"page_id": "long", "url": "string"}).withColumn("n_chars", F.length("text").cast("long"))
