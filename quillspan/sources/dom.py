"""A small element tree with the selectors that page layouts need: tag, .class, #id, [attribute], [attribute*=text], nesting."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_PART = re.compile(r"""([.#]?[\w-]+)|\[([\w-]+)(?:\*=["']?([^"'\]]*)["']?)?\]""")

#: Pages that are read by one pattern: lower-case tags with quoted attributes, texts without references, nothing else. Elements whose
#: content HTMLParser reads in another way are not among them.
_TAG = r"<(/?)(?!(?:script|style|title|textarea|iframe|noembed|noframes|noscript|xmp|plaintext|svg|math)\b)([a-z][a-z0-9]*)((?: [a-z-]+=\"[^\"<>&]*\")*)>"
_PLAIN, _TOKEN, _ATTRIBUTE = re.compile(rf"(?:(?=</[a-z0-9]+>|<[a-z]){_TAG}|[^<&]++)*+"), re.compile(rf"{_TAG}|([^<&]+)"), re.compile(r'([a-z-]+)="([^"]*)"')


def feed(parser: HTMLParser, html: str) -> None:
    """The parser's calls for a whole page; of a plain page by one pattern."""
    if not _PLAIN.fullmatch(html):
        parser.feed(html)
        parser.close()
        return
    for end, tag, attrs, data in _TOKEN.findall(html):
        if data:
            parser.handle_data(data)
        elif end:
            parser.handle_endtag(tag)
        else:
            parser.handle_starttag(tag, _ATTRIBUTE.findall(attrs) if attrs else [])


class Element:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Element]:
        stack = [self]
        while stack:
            e = stack.pop()
            yield e
            stack.extend(c for c in reversed(e.children) if isinstance(c, Element))

    def text(self, without: str = "") -> str:
        """Text in document order, without elements that a selector list names. Scripts and styles have none."""
        out, stack = [], [self]
        while stack:
            e = stack.pop()
            if isinstance(e, str):
                out.append(e)
            elif e is self or not (e.tag in ("script", "style") or (without and e.matches(without))):
                stack.extend(reversed(e.children))
        return "".join(out).strip()

    def _fits(self, simple: tuple) -> bool:
        for name, attr, part in simple:
            if attr:
                value = self.attrs.get(attr)
                if value is None or part not in value:
                    return False
            elif name[0] == ".":
                if name[1:] not in self.attrs.get("class", "").split():
                    return False
            elif name[0] == "#":
                if self.attrs.get("id") != name[1:]:
                    return False
            elif self.tag != name:
                return False
        return True

    def matches(self, selector: str) -> bool:
        for chain in _parsed(selector):
            if not self._fits(chain[-1]):
                continue
            left, up = len(chain) - 2, self.parent
            while left >= 0 and up is not None:
                left -= up._fits(chain[left])
                up = up.parent
            if left < 0:
                return True
        return False

    def select(self, selector: str) -> list[Element]:
        return [e for e in self.walk() if e is not self and e.matches(selector)]


@lru_cache(256)
def _parsed(selector: str) -> list[list[tuple]]:
    return [[tuple((m[1], m[2], m[3] or "") for m in _PART.finditer(simple)) for simple in chain.split()] for chain in selector.split(",")]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in _VOID:
            self.at = e

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        e = self.at
        while e.parent is not None and e.tag != tag:
            e = e.parent
        if e.parent is not None:
            self.at = e.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    b = _Builder()
    feed(b, html or "")
    return b.root
