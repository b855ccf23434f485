"""HTML pages as flat text blocks with the facts that tell content from the rest."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: Comments, declarations and tags; a tag that the page's end cuts off counts to the end. A
#: quote opens a value only after an equals sign; anywhere else it is a character of the tag.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
TOKEN = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")
HEADINGS = {f"h{i}" for i in range(1, 7)}

#: Element and attribute names of the HTML standard and usual class names.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "select", "button"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr del".split()
)
CONTENT = {"article", "main"}
BOILERPLATE = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "fieldset", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu"}
HINTS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar cookie cookies consent gdpr notice notices "
    "notification alert newsletter subscribe subscription signup login search share sharing social related recommended more "
    "comment comments commentlist respond reply replies disqus discussion popup modal overlay widget pagination pager "
    "copyright legal disclaimer paywall teaser form".split()
)
CLOSED_BY = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}}


#: Elements whose own class says nothing about what they hold, and words before a class part that deny it.
WHOLE = {"html", "body"}
DENIED = {"has", "with", "no", "without", "is"}
#: Share of a page's words from which on an element is the page itself, whatever it is called.
WRAPPER = 0.9


@dataclass
class Block:
    """Text between two block-level tags, and the elements it stands in."""

    text: str
    words: int
    linked: int
    heading: bool
    inside: list[Element]
    content: bool = False
    boilerplate: bool = False


@dataclass
class Element:
    """An open element: what its name and its class, id or role say, and the words in it."""

    name: str
    content: bool
    boilerplate: bool
    hinted: bool
    words: int = 0


@dataclass
class _Reader:
    """Open elements and the text of the block under way."""

    stack: list[Element] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    in_link: bool = False
    blocks: list[Block] = field(default_factory=list)

    def add(self, text: str) -> None:
        self.parts.append(text)
        if self.in_link:
            self.linked.append(text)

    def end_block(self) -> None:
        text = SPACE.sub(" ", html.unescape("".join(self.parts))).strip() if self.parts else ""
        if text:
            words = len(text.split())
            linked = len(html.unescape(" ".join(self.linked)).split()) if self.linked else 0
            heading = bool(self.stack) and self.stack[-1].name in HEADINGS
            for element in self.stack:
                element.words += words
            self.blocks.append(Block(text, words, min(linked, words), heading, list(self.stack)))
        self.parts, self.linked = [], []

    def open(self, name: str, attributes: str) -> None:
        shut = CLOSED_BY.get(name)
        if shut and self.stack and self.stack[-1].name in shut:
            self.stack.pop()
        self.stack.append(Element(name, name in CONTENT, name in BOILERPLATE, name not in WHOLE and hinted(attributes)))

    def close(self, name: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].name == name:
                del self.stack[i:]
                return

    def finished(self) -> list[Block]:
        """The blocks with their marks, now that the words of every element are known."""
        whole = WRAPPER * sum(b.words for b in self.blocks)
        for b in self.blocks:
            for e in b.inside:
                # A page header is boilerplate, one that opens an article belongs to it. A form
                # or a class around nearly the whole page says nothing about its parts.
                wraps = e.words > whole
                outside = e.boilerplate and not (e.name == "form" and wraps) or e.hinted and not wraps
                if e.content:
                    b.content, b.boilerplate = True, False
                elif outside and not (e.name == "header" and b.content):
                    b.boilerplate = True
        return self.blocks


def hinted(attributes: str) -> bool:
    """Whether class, id, role or visibility name something other than content."""
    for m in ATTRIBUTE.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            for part in map(TOKEN.findall, value.split()):
                if part and part[0] not in DENIED and not HINTS.isdisjoint(part):
                    return True
        if name == "role" and value.strip() in ROLES:
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in their order, without scripts, styles and markup."""
    page = page or ""
    reader, at = _Reader(), 0
    while m := MARKUP.search(page, at):
        if m.start() > at:
            reader.add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in RAW:
            if not closing and not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            if name not in ("button", "select"):
                reader.end_block()
        elif name in INLINE:
            if name == "a":
                reader.in_link = not closing
            elif name == "br":
                reader.add(" ")
        else:
            reader.end_block()
            if name not in VOID:
                if closing:
                    reader.close(name)
                else:
                    reader.open(name, m[3])
    if at < len(page):
        reader.add(page[at:])
    reader.end_block()
    return reader.finished()


def facts(blocks: list[Block]) -> list[list[float]]:
    """Per block: words and link density of the one before, itself and the next; what it stands in."""
    own = [[float(b.words), b.linked / b.words] for b in blocks]
    marked = any(b.content for b in blocks)  # then what stands elsewhere isn't content
    around = [[0.0, 0.0], *own, [0.0, 0.0]]
    return [
        [*around[i], *around[i + 1], *around[i + 2], float(b.content), float(b.boilerplate or marked and not b.content), float(b.heading)]
        for i, b in enumerate(blocks)
    ]
