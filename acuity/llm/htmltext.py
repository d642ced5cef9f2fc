"""Main text of web pages by equivalence-class template deduction (after Arasu and Garcia-Molina 2003).

Pages of one host are read together, in groups of bounded size. Tokens (opening and closing
tags told apart by their path, and constant lines) that occur equally often on every
page form an equivalence class. A class is valid if its tokens keep one order; classes
that occur once a page form the template, and classes that repeat nest in one of its gaps.
The gaps are slots. Slots whose enclosing elements are menus, adverts and the like, or
whose text is mostly links, are dropped, and what the other slots hold is the text. Main
elements are read by slots as well; lines and lists of links that all unlike articles have go.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import ship, table
from acuity.session import stored

#: hosts that are sent to all tasks; of more, pages are joined with their host's number of groups
MOST_HOSTS = 100_000

# --- fixed values: elements by their role ----------------------------------------
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp", "noembed", "noframes"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
))
SIDE = frozenset((
    "head", "nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset", "datalist", "object",
    "audio", "video", "canvas", "map", "applet", "frameset",
))
MAIN = frozenset(("article", "main"))
#: elements that an opening tag of the same group ends
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
#: where the search for what to end stops
HOLDS = frozenset(("ul", "ol", "dl", "table", "select", "div", "article", "section", "main", "body", "td", "th", "blockquote", "aside", "nav"))
# --- fixed values: words of class and id names, and roles, of what isn't the article
HINTS = frozenset((
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "adsense", "adbox", "banner", "breadcrumb", "breadcrumbs", "byline", "comment",
    "comments", "commentlist", "consent", "contentinfo", "cookie", "cookies", "copyright", "disclaimer", "disqus", "dropdown", "footer",
    "gdpr", "header", "hidden", "legal", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notification", "outbrain", "overlay", "pager", "pagination", "paywall", "popup", "privacy", "promo", "promotion", "recommended",
    "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
    "subscribe", "taboola", "tags", "toolbar", "topbar", "tracking", "widget", "widgets",
))

_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:_-]*")
_STOP = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HEADING = re.compile(r"h[1-6](?:\.|$)")
_CLOSERS = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}


def _roles(attributes: str) -> tuple[str, bool, int]:
    """(name of an element's class and id, whether it is hidden, how far names say that it isn't the article).

    2: a name is made of hints only (``social-share``); 1: a hint is one word of a name (``share-price``).
    """
    names, side, hint = [], False, 0
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "style":
            side |= "display:none" in value.replace(" ", "").lower()
        elif key == "hidden":
            side = True
        elif key == "aria-hidden":
            side |= value.lower() == "true"
        else:
            names.append(value)
            for name in value.split():
                hinted = [w.lower() in HINTS for w in _WORDS.findall(name)]
                hint = max(hint, any(hinted) + (any(hinted) and all(hinted)))
    return " ".join(names), side, hint


@dataclass
class Page:
    """What a page is made of: structural tokens in order, and blocks of text between them."""

    tokens: list[tuple] = field(default_factory=list)
    # (place among the tokens, text, characters in links, aside, in the main element, path, (path, hint) of hinted elements around)
    blocks: list[tuple[int, str, int, bool, bool, tuple, tuple]] = field(default_factory=list)


class _Reader:
    """One pass over a page; unclosed and misnested tags are borne."""

    def __init__(self) -> None:
        self.page = Page()
        # (tag, path, aside, main, hinted)
        self.open: list[tuple[str, tuple, bool, bool, tuple]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0

    def state(self) -> tuple[tuple, bool, bool, tuple]:
        return self.open[-1][1:] if self.open else ((), False, False, ())

    def flush(self) -> None:
        if self.parts:
            text = "".join(self.parts)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                path, side, main, hinted = self.state()
                self.page.blocks.append((len(self.page.tokens), text, self.linked, side, main, path, hinted))
            self.parts, self.linked = [], 0

    def text(self, s: str) -> None:
        self.parts.append(s)
        if self.links:
            self.linked += len(s)

    def pop(self) -> None:
        tag, path, *_ = self.open[-1]
        if tag not in INLINE:
            self.flush()
            self.page.tokens.append(("/", path))
        elif tag == "a":
            self.links = max(0, self.links - 1)
        self.open.pop()

    def start(self, tag: str, attributes: str, alone: bool) -> None:
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                if tag == "br":
                    self.parts.append(" ")
                return
            path, side, main, hinted = self.state()
            if attributes and not alone:
                name, aside, hint = _roles(attributes)
                if (aside or hint == 2) and not side:
                    # what an inline advert holds is a block of its own
                    self.flush()
                    inner = (*path, f"{tag}.{name}")
                    self.open.append((tag, inner, aside, main, hinted if aside else (*hinted, (inner, hint))))
                    self.links += tag == "a"
                    return
            if not alone:
                self.links += tag == "a"
                self.open.append((tag, path, side, main, hinted))
            return
        self.flush()
        ends = ENDS.get(tag, () if tag in ("col", "param", "source", "track") else ("p",))
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in ends:
                while len(self.open) > k:
                    self.pop()
                break
            if self.open[k][0] in HOLDS:
                break
        path, side, main, hinted = self.state()
        name, aside, hint = _roles(attributes) if attributes else ("", False, 0)
        inner = (*path, f"{tag}.{name}" if name else tag)
        main_here = main or tag in MAIN or name.lower() == "main"
        # a header inside the article heads the article
        if tag == "form":  # a form can hold the whole page
            hint = 2
        else:
            aside = aside or tag in SIDE and not (tag == "header" and main)
        if tag in MAIN | {"body", "html"} and not main:
            aside, hint = False, 0
        if main_here and not main:
            hinted = ()  # the main element starts anew, whatever holds it is called
        if hint:
            hinted = (*hinted, (inner, hint))
        self.page.tokens.append(("", inner))
        if tag in VOID or alone:
            self.page.tokens.append(("/", inner))
            return
        self.open.append((tag, inner, side or aside, main_here, hinted))

    def end(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                if tag in INLINE:
                    # only what is inline may stand open above it
                    if any(o[0] not in INLINE for o in self.open[k + 1 :]):
                        return
                    if self.open[k][1] != (self.open[k - 1][1] if k else ()):
                        self.flush()
                while len(self.open) > k:
                    self.pop()
                return

    def read(self, html: str) -> Page:
        at, n = 0, len(html)
        blind: set[str] = set()  # quotes that no later one closes
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self.text(html[at:])
                break
            if lt > at:
                self.text(html[at:lt])
            after = html[lt + 1 : lt + 2]
            if after == "!" or after == "?":
                if html.startswith("<!--", lt):
                    stop = html.find("-->", lt + 4 if not html.startswith("<!-->", lt) else lt + 2)
                    at = n if stop < 0 else stop + 3
                elif html.startswith("<![CDATA[", lt):
                    stop = html.find("]]>", lt)
                    at = n if stop < 0 else stop + 3
                else:
                    stop = html.find(">", lt)
                    at = n if stop < 0 else stop + 1
                continue
            close = after == "/"
            m = _NAME.match(html, lt + 1 + close)
            if not m:
                if close:
                    stop = html.find(">", lt)
                    at = n if stop < 0 else stop + 1
                else:
                    self.text("<")
                    at = lt + 1
                continue
            stop = m.end()
            while (s := _STOP.search(html, stop)) and s.group() != ">":
                quote, stop = s.group(), s.end()
                if quote not in blind:
                    end = html.find(quote, stop)
                    if end < 0:
                        blind.add(quote)
                    else:
                        stop = end + 1
            tag = m.group().lower()
            if not s:
                break  # the last tag isn't closed
            at = s.end()
            if close:
                self.end(tag)
                continue
            attributes = html[m.end() : s.start()]
            alone = attributes.endswith("/") and (tag in VOID or tag == "svg")
            if tag in RAW and not alone:
                found = _CLOSERS[tag].search(html, at)
                if not found:
                    at = n
                else:
                    gt = html.find(">", found.end())
                    at = n if gt < 0 else gt + 1
                continue
            self.start(tag, attributes, alone)
        while self.open:
            self.pop()
        self.flush()
        return self.page


def read(html: str | None) -> Page:
    return _Reader().read(html or "")


@dataclass
class Template:
    """Tokens of the template in order, each with its place; ``repeats`` are the nested classes by gap.

    ``apart`` are the hinted elements that are slots of their own, apart from the article. ``constant`` are
    lines outside the main elements, ``inner`` those inside, ``menus`` slots of links inside.
    """

    order: dict[tuple, int]
    repeats: dict[tuple, int]
    constant: set[tuple]
    apart: set[tuple] = field(default_factory=set)
    inner: set[tuple] = field(default_factory=set)
    menus: set[int] = field(default_factory=set)


def _unlike(pages: list[Page]) -> list[Page]:
    """Pages whose main elements are no copies: at most half of the text is in those before."""
    out, seen = [], set()
    for page in pages:
        lines = [b[1] for b in page.blocks if b[4] and not b[3]]
        if lines and 2 * sum(len(x) for x in lines if x in seen) <= sum(map(len, lines)):
            out.append(page)
            seen.update(lines)
    return out


def _inner(pages: list[Page], order: dict[tuple, int], repeats: dict[tuple, int]) -> tuple[set[tuple], set[int]]:
    """(lines, slots of links) of the template inside the main elements, learned from unlike ones alone."""
    some = _unlike(pages)
    if len(some) < 3:
        return set(), set()
    on: dict[tuple, int] = defaultdict(int)
    slots: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    for page in some:
        blocks = [b for b in page.blocks if b[4] and not b[3]]
        for line in {(b[5], b[1]) for b in blocks}:
            on[line] += 1
        for b, gap in zip(page.blocks, _gaps(page, order), strict=True):
            if b[4] and not b[3]:
                # a linked heading is no menu
                links = not any(_HEADING.match(x) for x in b[5]) and ("", b[5]) in repeats
                for i, x in enumerate((len(b[1]), b[2], links)):
                    slots[gap][i] += x
    every = sum(size for size, _, _ in slots.values())
    menus = {gap for gap, (size, linked, n) in slots.items() if linked > 0.6 * size and n >= 2 * len(some) and 2 * size < every}
    # however often a page has the line
    return {line for line, n in on.items() if n == len(some)}, menus


def _gaps(page: Page, order: dict[tuple, int]) -> list[int]:
    """The slot of each block."""
    marks = [(k, order[t]) for k, t in enumerate(page.tokens) if t in order]
    starts = [k for k, _ in marks]
    places = (bisect_right(starts, b[0] - 1) - 1 for b in page.blocks)
    return [marks[at][1] if at >= 0 else -1 for at in places]


def deduce(pages: list[Page]) -> Template:
    """The template of a group of pages from the classes of tokens with equal occurrence vectors."""
    counts: dict[tuple, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    for i, page in enumerate(pages):
        for token in page.tokens:
            counts[token][i] += 1
        for _, text, _, _, main, path, _ in page.blocks:
            if not main:
                counts[("=", path, text)][i] += 1
    classes: dict[tuple, list[tuple]] = defaultdict(list)
    for token, own in counts.items():
        classes[tuple(sorted(own.items()))].append(token)
    support = max(1, len(pages) // 2)
    frequent = {v: t for v, t in classes.items() if len(v) >= support}
    singles = {t: len(v) for v, tokens in frequent.items() if all(n == 1 for _, n in v) for t in tokens if t[0] != "="}
    # one order for all pages: tokens by their mean share of the page; those that break it go
    place: dict[tuple, list[int]] = defaultdict(list)
    kept = [[t for t in page.tokens if t in singles] for page in pages]
    for page in kept:
        for k, token in enumerate(page):
            place[token].append(k)
    order = {t: i for i, t in enumerate(sorted(place, key=lambda t: (sum(place[t]) / len(place[t]), t)))}
    broken = set()
    for page in kept:
        last = -1
        for token in page:
            if order[token] < last:
                broken.add(token)
            else:
                last = order[token]
    order = {t: i for i, t in enumerate(t for t in order if t not in broken)}
    gaps: dict[tuple, set[int]] = defaultdict(set)
    for page in pages:
        gap = -1
        for token in page.tokens:
            if token in order:
                gap = order[token]
            elif token[0] != "=":
                gaps[token].add(gap)
    repeats = {t: next(iter(g)) for t, g in gaps.items() if len(g) == 1}
    # a line that each page has once outside the article is the template's, if the pages differ
    whole = {tuple(b[1] for b in p.blocks) for p in pages}
    constant = set()
    if len(pages) >= 3 and len(whole) >= 3:
        constant = {t[1:] for v, tokens in classes.items() if len(v) == len(pages) and all(n == 1 for _, n in v) for t in tokens if t[0] == "="}
    apart = set()
    if len(pages) >= 3 and len(whole) >= 3:
        size: dict[tuple, int] = defaultdict(int)
        for page in pages:
            for _, text, _, side, main, _, hinted in page.blocks:
                if not side:
                    size[main] += len(text)
                    for path, hint in dict(hinted).items():
                        if hint == 1:
                            size[main, path] += len(text)
        # what holds half of the text is the article, whatever its name
        apart = {t[1] for t in order if t[0] == "" and any(0 < 2 * size.get((main, t[1]), 0) < size[main] for main in (False, True))}
    return Template(order, repeats, constant, apart, *_inner(pages, order, repeats))


def extract(pages: list[Page], template: Template) -> list[str]:
    """The text of each page: the blocks of the slots that remain, by lines."""
    slots: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    placed = []
    for page in pages:
        own = _gaps(page, template.order)
        for block, gap in zip(page.blocks, own, strict=True):
            slots[gap][0] += len(block[1])
            slots[gap][1] += block[2]
        placed.append(own)
    menus = {gap for gap, (size, linked) in slots.items() if linked > 0.6 * size}
    out = []
    for page, own in zip(pages, placed, strict=True):
        rest = [(b, gap) for b, gap in zip(page.blocks, own, strict=True) if not b[3] and not any(p in template.apart for p, _ in b[6])]
        # names that would leave nothing are not heeded
        rest = [(b, gap) for b, gap in rest if not any(hint == 2 for _, hint in b[6])] or rest
        main = [b for b, _ in rest if b[4]]
        # a main element is a hint for what the slots hold; the template's lines and links in it go
        main = [b for b, gap in rest if b[4] and gap not in template.menus and (b[5], b[1]) not in template.inner] or main
        if not main:
            main = [b for b, gap in rest if gap not in menus and (b[5], b[1]) not in template.constant]
        out.append("\n".join(b[1] for b in main))
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group: int = 64, folder: str | None = None) -> DataFrame:
    """(id, url, text) of every page, from its whole html.

    Pages of a host are dealt by a hash of the page into groups of about ``group`` pages, each of which
    deduces the host's template for itself; the groups are spread over tasks one by one, so a host of any
    size is. Where the rows lie in files is of no effect. A NULL
    or empty html gives the empty text; pages without a readable host form one host of their own.
    Rows are kept one for one; an empty table gives an empty result; other columns are
    ignored.
    """
    ship(pages.sparkSession)
    host = F.coalesce(F.lower(F.try_parse_url(F.col(url_col).cast("string"), F.lit("HOST"))), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    sizes = rows.groupBy("host").agg(F.ceil(F.count("*") / group).alias("parts")).where("parts > 1")
    sizes = stored(sizes, "hosts", folder)
    # the pages are sent out once where the hosts with several groups are few enough for every task to know
    if sizes.count() <= MOST_HOSTS:
        sizes = F.broadcast(sizes)
    page = F.xxhash64("id", "url", "html")
    dealt = rows.join(sizes, "host", "left").withColumn("part", F.pmod(page, F.coalesce("parts", F.lit(1)))).drop("parts")
    dealt = dealt.repartition("host", "part")

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [read(h) for h in pdf["html"]]
        return pd.DataFrame({"id": pdf["id"], "url": pdf["url"], "text": extract(found, deduce(found))})

    kind = rows.schema["id"].dataType.simpleString()
    return dealt.groupBy("host", "part").applyInPandas(work, f"id {kind}, url string, text string")


def op9(spark, folder: str) -> DataFrame:
    found = main_text(table(spark, folder, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
