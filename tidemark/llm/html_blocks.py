"""Leaf blocks of an HTML page with what stands around them: a small reader for the extraction model."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# HTML elements by how they are read.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html ins legend li main menu nav noframes ol option "
    "p pre search section select summary table tbody td textarea tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset(("script", "style"))
UNREAD_TAGS = RAW_TAGS | frozenset("head title template noscript svg math iframe object canvas audio video".split())
CLOSED_BY = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"),
}
SCOPES = frozenset("ul ol dl table select body article section div".split())
# Words in class, id and role, by what they say about an element.
HINTS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar tabs skip sitemap",
    "header": "header masthead banner topbar logo branding tagline",
    "footer": "footer colophon copyright legal contentinfo bottom",
    "sidebar": "sidebar aside side widget widgets related recommended recommendations trending popular rail complementary "
    "teaser teasers",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay dialog toast disclaimer newsletter "
    "subscribe subscription signup paywall message warning announcement",
    "advert": "ad ads adv advert adverts advertisement advertising adsbygoogle adsense sponsor sponsored promo promotion "
    "promoted commercial",
    "form": "form search searchbox login signin register contact input",
    "comments": "comment comments commentlist commenter discussion replies reply respond disqus reviews feedback thread",
    "share": "share sharing social tags tag byline meta author pubdate",
    "content": "article content main post entry story articlebody maincontent bodytext prose",
}
_HINT_OF = {word: kind for kind, words in HINTS.items() for word in words.split()}

#: A tag whose quoted values hold neither `<` nor `>`; the match never goes beyond the next `>`.
_PLAIN_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)([^\"'>]*+(?:\"[^\"<>]*+\"[^\"'>]*+|'[^'<>]*+'[^\"'>]*+)*+)>"
)
_TAG_START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_BODY = re.compile(r"<body\b", re.IGNORECASE)
_QUOTE_OR_END = re.compile("[\"'>]")
_HINT_ATTRIBUTES = re.compile(
    r"""(?:^|\s)(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    """A leaf block: its text, its element, features of all elements around it, linked characters, its container."""

    text: str
    tag: str
    around: frozenset[str]
    linked: int
    container: int


class _Open(NamedTuple):
    tag: str
    around: frozenset[str]
    number: int


def _features(tag: str, attributes: str, outer: frozenset[str]) -> frozenset[str]:
    found = set(outer)
    nested = "t:article" in outer or "t:main" in outer
    found.add(f"t:{tag}-inside" if nested and tag in ("header", "footer", "section", "div") else f"t:{tag}")
    for name, value in _HINT_ATTRIBUTES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true":
            found.add("x:hidden")
        elif name == "style":
            if "display:none" in value.replace(" ", "").lower():
                found.add("x:hidden")
        else:
            for word in _WORD.findall(value):
                if kind := _HINT_OF.get(word.lower()):
                    found.add(f"x:{kind}")
    return frozenset(found)


class _Markup:
    """Places of tags in a page. All searches together take time in proportion to the page's length.

    A failed search is remembered: nothing is looked for twice behind the same place.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self._ends: dict[int, int] = {}
        self._elements: dict[str, dict[int, int]] = {}
        self._body: int | None = None

    def _end(self, at: int) -> int:
        """Place of the `>` that ends the tag whose attributes begin here, outside quotes; -1 if a quote stays open."""
        seen = []
        while at not in self._ends:
            seen.append(at)
            found = _QUOTE_OR_END.search(self.page, at)
            if found is None or found[0] != ">" and found.start() >= self.last[found[0]]:
                end = -1
                break
            if found[0] == ">":
                end = found.start()
                break
            at = self.page.index(found[0], found.end()) + 1
        else:
            end = self._ends[at]
        self._ends.update(dict.fromkeys(seen, end))
        return end

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, name, attributes) of the next markup from here; the name of no tag is empty."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), "", "", ""
            if at > self.last[">"]:
                at = page.find("<!--", at)  # without a `>`, only a comment can still begin
                if at < 0:
                    return None
                continue
            if page[at + 1] in "!?":
                return at, page.index(">", at) + 1, "", "", ""
            if found := _PLAIN_TAG.match(page, at):
                return at, found.end(), found[1], found[2], found[3]
            if found := _TAG_START.match(page, at):
                end = self._end(found.end())
                end = end if end >= 0 else page.index(">", at)
                return at, end + 1, found[1], found[2], page[found.end() : end]
            at += 1
        return None

    def element_end(self, tag: str, start: int, end: int) -> int:
        """Place behind the element that starts here; behind its start tag if it is never closed.

        Elements of one kind may be nested. Scripts and styles hold no markup and, unclosed, take the rest of the page.
        """
        if tag in RAW_TAGS:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(self.page, end, self.last[">"] + 1)
            return stop.end() if stop else len(self.page)
        if tag not in self._elements:
            self._elements[tag], held = {}, []
            for found in re.compile(rf"<(/?){tag}\b([^>]*)>", re.IGNORECASE).finditer(self.page, 0, self.last[">"] + 1):
                if not found[1]:
                    if not found[2].endswith("/"):
                        held.append(found.start())
                elif held:
                    self._elements[tag][held.pop()] = found.end()
        return max(end, self._elements[tag].get(start, end))

    def body_after(self, at: int) -> int:
        """Place of the next start of a body, -1 if there is none."""
        if self._body is None or 0 <= self._body < at:
            found = _BODY.search(self.page, at)
            self._body = found.start() if found else -1
        return self._body


class _Stack:
    """Open elements, with the places of each kind, so that an end tag finds its element at once."""

    def __init__(self) -> None:
        self.items = [_Open("", frozenset(), 0)]
        self._at: dict[str, list[int]] = {}
        self._scopes = [0]

    def push(self, item: _Open) -> None:
        self._at.setdefault(item.tag, []).append(len(self.items))
        if item.tag in SCOPES:
            self._scopes.append(len(self.items))
        self.items.append(item)

    def cut(self, level: int) -> None:
        while len(self.items) > level:
            tag = self.items.pop().tag
            self._at[tag].pop()
            if tag in SCOPES:
                self._scopes.pop()

    def end(self, tag: str) -> None:
        """Close the innermost element of this kind; a list item or cell only inside its list or table."""
        if (places := self._at.get(tag)) and not (tag in CLOSED_BY and self._scopes[-1] > places[-1]):
            self.cut(places[-1])


def read_blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, references decoded, white space runs one space, empty blocks left out.

    Markup that HTML leaves open is closed as browsers do in the usual cases (paragraphs, list items, cells); a `<`
    that starts no markup is text. Scripts, styles and the head are not read.
    """
    blocks: list[Block] = []
    stack = _Stack()
    opened = 0
    segments: list[str] = []
    linked, link_level = 0, 0

    def flush() -> None:
        nonlocal linked
        if segments:
            text = " ".join("".join(segments).split())
            segments.clear()
            if text:
                top = stack.items[-1]
                parent = stack.items[-2].number if len(stack.items) > 1 else 0
                blocks.append(Block(text, top.tag, top.around, linked, parent if top.tag in ("p", "li", "td") else top.number))
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            segments.append(raw)
            if link_level:
                linked += len(raw.strip())

    def close(tags: tuple[str, ...]) -> None:
        """Close open elements of these kinds, but none beyond the element that may hold them."""
        while stack.items[-1].tag in tags:
            stack.cut(len(stack.items) - 1)

    markup, at = _Markup(page), 0
    while found := markup.next(at):
        start, end, slash, name, attributes = found
        add(page[at:start])
        at = end
        if not name:
            continue
        tag = name.lower()
        if tag in UNREAD_TAGS:
            if not slash and not (attributes.endswith("/") and tag not in RAW_TAGS):
                at = markup.element_end(tag, start, end)
                if tag == "head" and at == end:
                    at = max(end, markup.body_after(end))
        elif tag == "br":
            segments.append(" ")
        elif tag == "a":
            link_level = 0 if slash else len(stack.items)
        elif tag in BLOCK_TAGS:
            flush()
            if slash:
                stack.end(tag)
                if link_level > len(stack.items):
                    link_level = 0
            else:
                if tag not in ("button", "ins"):
                    close(("p",))
                close(CLOSED_BY.get(tag, ()))
                if tag not in VOID_TAGS:
                    opened += 1
                    stack.push(_Open(tag, _features(tag, attributes, stack.items[-1].around), opened))
    add(page[at:])
    flush()
    return blocks
