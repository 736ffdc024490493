"""Main text of web pages by composite text density.

A page is read into a tree of elements.  For every element i, with C characters and T tags below
it, of which LC characters and LT tags stand in links, and b the body:

    density(i) = C/T * log( C/LC * T/LT ) / log( 1 + log( C/(C-LC) * LC + LC_b/C_b * C + e ) )

(a divisor of 0 counts as 1; the 1 in the last logarithm keeps pages without links from dividing
by 0): characters per tag, lowered where links make up the text.  The sum
of an element's children's densities is largest where paragraphs stand side by side; the element
with the largest sum is the main one.  The least density on its path up to the body is the
threshold: elements beside it that reach the threshold, or are headings, belong to the text as
well.  Inside an ``article`` or ``main`` element the text is that whole element, with the elements
beside it that reach the threshold (a second article, say); headings beside it do not count.

Elements that hold no running text by their kind (scripts, menus, forms ...), by a token of their
class, id or role (advert, sidebar-left, comments ...) or because they are hidden are left out
before densities are taken.

Nulls, empty pages and pages without text give ''.  Repeated rows are read one by one.  Pages of
any length are read whole, one at a time, in linear time; damaged markup is read as far as it
makes sense.  An empty table gives no rows.  Other columns are carried along untouched.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- FIXED VALUES: kinds of elements --------------------------------------------------------
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr", "label", "ruby", "rb", "rt"}
NO_TEXT = {"head", "nav", "footer", "aside", "form", "button", "select", "option", "svg", "math", "canvas", "audio",
           "video", "object", "template", "dialog", "menu", "map", "datalist", "fieldset", *RAW}
NO_TEXT_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner",
                 "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb",
                 "breadcrumbs", "pagination", "pager", "footer", "masthead", "topbar", "toolbar", "sidebar", "aside",
                 "widget", "related", "recommended", "share", "sharing", "social", "cookie", "cookies", "consent",
                 "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
                 "login", "search", "comment", "comments", "commentlist", "disqus", "replies", "respond", "reactions",
                 "contentinfo", "complementary", "alert", "alertdialog", "dialog"}
HEADER_WORDS = {"header"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
KEEPS_IN = {"ul", "ol", "dl", "table", "select", "article", "section", "main", "div", "body", "td", "blockquote"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_PART = re.compile(r"[a-z]+")
_SIZE = re.compile(r"\d+(?:x\d+)?")
#: parts of a token that only say where or in what form an element stands
PLACE_WORDS = {"left", "right", "top", "bottom", "primary", "secondary", "box", "list", "area", "block", "section", "item",
               "items", "bar", "unit", "slot", "panel", "button", "buttons", "form", "links", "container", "wrapper", "wrap"}
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}


def _no_text(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in NO_TEXT or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("body", "html", "article", "main") and "role" not in attributes and \
            "comment" not in attributes.lower():
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" and value.strip() != "until-found" or name == "aria-hidden" and value.strip() == "true" \
                or name == "style" and _NO_DISPLAY.search(value):
            return True
        if name in ("class", "id", "role") and any(_named(t, in_article) for t in value.split()):
            return True
    return False


def _named(token: str, in_article: bool) -> bool:
    """Whether a class, id or role token names a kind without running text: as a whole, or by parts
    that all name such kinds or places, as in sidebar-left; with-sidebar does not."""
    words = NO_TEXT_WORDS if in_article else NO_TEXT_WORDS | HEADER_WORDS
    parts = set(_PART.findall(_SIZE.sub("", token)))
    return bool(parts & words) and not parts - words - PLACE_WORDS


class Open:
    """The open elements of a page, with the places of every kind, so that no question walks the stack."""

    def __init__(self):
        self.stack, self.tags = [0], ["#page"]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks = [0]  # places of elements that are not inline

    def push(self, element: int, tag: str) -> None:
        self.places[tag].append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(element)
        self.tags.append(tag)

    def cut(self, place: int) -> None:
        """Closes the elements from ``place`` on."""
        while len(self.stack) > place:
            tag = self.tags.pop()
            self.stack.pop()
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()

    def nearest(self, tags: set[str]) -> int:
        """The last place of any of these kinds, 0 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close_up_to(self, tags: set[str], stops: set[str]) -> None:
        """Closes the nearest element of ``tags`` unless one of ``stops`` stands above it."""
        place = self.nearest(tags)
        if place > self.nearest(stops - tags):
            self.cut(place)

    def end(self, name: str) -> None:
        """An end tag; those of inline elements close nothing beyond the block they stand in."""
        place = self.nearest({name})
        if place and (name not in INLINE or place > self.blocks[-1]):
            self.cut(place)


class Page:
    """The elements of a page in document order, without those that hold no running text."""

    def __init__(self, source: str):
        self.tag, self.parent, self.last = ["#page"], [-1], [0]
        self.items: list[tuple[int, str]] = []  # (element, text); text ' ' for a break
        opened, drop = Open(), 0  # drop: size of the stack above which everything is left out
        stack = opened.stack
        at, n = 0, len(source)
        self.body = 0
        for m in iter(lambda: _TAG.search(source, at), None):
            if m.start() > at and not drop:
                self._text(stack[-1], source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            name, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
            if closing:
                opened.end(name)
                if drop and len(stack) < drop:
                    drop = 0
            else:
                self._imply(opened, name)
                if drop and len(stack) < drop:
                    drop = 0
                if name in VOID:
                    if not drop and name not in INLINE:
                        self.items.append((stack[-1], " "))
                    continue
                out = drop or _no_text(name, attributes, opened.nearest({"article", "main"}) > 0)
                if name in RAW:
                    end = _RAW_END[name].search(source, at)
                    at = end.end() if end else n
                    continue
                if attributes.endswith("/") and name not in INLINE and name in ("svg", "path"):
                    continue
                if not out and name == "body":
                    self.body = len(self.tag)
                self.tag.append(name)
                self.parent.append(stack[-1])
                self.last.append(len(self.tag) - 1)
                opened.push(len(self.tag) - 1, name)
                if out and not drop:
                    drop = len(stack)
            if not drop and name not in INLINE:
                self.items.append((stack[-1], " "))
        if at < n and not drop:
            self._text(stack[-1], source[at:])
        for i in range(len(self.tag) - 1, 0, -1):
            p = self.parent[i]
            self.last[p] = max(self.last[p], self.last[i])

    def _text(self, element: int, text: str) -> None:
        self.items.append((element, html.unescape(text) if "&" in text else text))

    def _imply(self, opened: Open, name: str) -> None:
        if name in CLOSED_BY:
            opened.close_up_to(CLOSED_BY[name], KEEPS_IN - {"td"} if name in ("td", "th", "tr") else KEEPS_IN)
        elif name not in INLINE and name not in VOID:
            opened.close_up_to({"p"}, KEEPS_IN)
        if name == "body" and opened.tags[-1] == "head":
            opened.cut(len(opened.stack) - 1)

    def densities(self) -> tuple[list[float], list[int]]:
        """The density of every element, and its characters."""
        n = len(self.tag)
        chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = self.tag[i] == "a" or in_link[self.parent[i]]
        for i, text in self.items:
            c = len(" ".join(text.split())) if text != " " else 0
            chars[i] += c
            if in_link[i]:
                links[i] += c
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            for of, own in ((chars, 0), (links, 0), (tags, 1), (link_tags, in_link[i])):
                of[p] += of[i] + own
        share = links[self.body] / max(1, chars[self.body])
        out = [0.0] * n
        for i in range(n):
            c, lc = chars[i], links[i]
            if c:
                t, lt = max(1, tags[i]), max(1, link_tags[i])
                x = c / max(1, c - lc) * lc + share * c
                out[i] = c / t * math.log(max(1.0, c / max(1, lc) * t / lt)) / math.log(1 + math.log(x + math.e))
        return out, chars

    def main(self) -> list[int]:
        """The elements whose subtrees are the main text, in page order."""
        density, chars = self.densities()
        total = [0.0] * len(density)
        for i in range(1, len(density)):
            total[self.parent[i]] += density[i]
        inside = [i for i in range(self.body, self.last[self.body] + 1) if chars[i]]
        if not inside:
            return []
        best = max(inside, key=lambda i: (total[i], chars[i], -i))
        path = [best]
        while path[-1] != self.body:
            path.append(self.parent[path[-1]])
        threshold = min(density[i] for i in path)
        for kind in ("article", "main"):
            for top in path:
                if self.tag[top] == kind:
                    return [i for i in inside if self.parent[i] == self.parent[top]
                            and (i == top or density[i] >= threshold)]
        if best == self.body:
            return [best]
        return [i for i in inside if self.parent[i] == self.parent[best]
                and (i == best or density[i] >= threshold or self.tag[i] in HEADINGS)]


def main_text(source: str | None) -> str:
    """The main text of a page, blocks joined by one space."""
    if not source:
        return ""
    page = Page(source)
    taken = bytearray(len(page.tag))
    for i in page.main():  # subtrees do not overlap
        taken[i: page.last[i] + 1] = b"\x01" * (page.last[i] + 1 - i)
    text = "".join(t for i, t in page.items if taken[i])
    return " ".join(text.split())


def with_main_text(pages: DataFrame, source: str = "html", out: str = "text") -> DataFrame:
    column = F.pandas_udf(lambda pages: pages.map(main_text), "string")
    return pages.withColumn(out, column(F.coalesce(F.col(source), F.lit(""))))
