"""Leaf blocks of HTML pages: text runs between block-level tags, with the tags around them."""
from __future__ import annotations

import re
import zlib
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

from shelfwise.llm.common import ship

#: fixed values: HTML elements that stay inside a line of text
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
#: fixed values: HTML elements without content
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: fixed values: elements whose content is not text of the page
SILENT = frozenset("script style template noscript svg math iframe object canvas audio video select textarea datalist".split())
#: fixed values: an open element of the set's key ends where one of its values begins
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
                   "pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
#: fixed values: silent elements that a block element ends, as browsers leave foreign content and choices
BROKEN_OUT = frozenset("svg math select datalist".split())
_WORDS = re.compile(r"[a-z]+|[0-9]+")
WEIGHTS = 1 << 13  # numbers that feature names are hashed to


def slot(name: str) -> int:
    return zlib.crc32(name.encode()) % WEIGHTS


class Block:
    """One leaf block: its text, its nearest block element, the features of all its ancestors, and how much of it is link text."""

    __slots__ = ("text", "near", "around", "linked")

    def __init__(self, text: str, near: str, around: tuple[int, ...], linked: int):
        self.text, self.near, self.around, self.linked = text, near, around, linked


class _Open(NamedTuple):
    tag: str
    block: str  # the nearest block element, itself included
    around: tuple[int, ...]  # distinct features of it and its ancestors; shared with the parent where nothing is new


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Open("", "", ())]
        self.open: Counter = Counter()
        self.silent: list[str] = []
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0
        self.blocks: list[Block] = []
        self.ends: dict[str, int] = {}

    def read(self, html: str) -> None:
        for m in _SILENT_END.finditer(html):
            self.ends[m[1].lower()] = m.start()
        self.lines = [0, *(m.end() for m in re.finditer("\n", html))]
        self.feed(html)
        self.close()
        self.flush()

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, self.stack[-1].block, self.stack[-1].around, self.linked))
        self.parts, self.linked = [], 0

    def parse_marked_section(self, i, report=1):
        """``<![`` begins a comment up to the next ``>``, as in browsers; the base class fails on unknown sections."""
        return self.parse_bogus_comment(i, report)

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            if tag == "br":
                self.parts.append(" ")
        else:
            self.flush()
            while self.silent and self.silent[-1] in BROKEN_OUT and tag in CLOSED_BY["p"] and not self.open["foreignobject"]:
                self._close(self.silent[-1])
            while tag in CLOSED_BY.get(self.stack[-1].block, ()):
                self._close(self.stack[-1].block)
        if tag in VOID:
            return
        if tag in SILENT and tag not in ("script", "style"):
            line, column = self.getpos()
            if self.ends.get(tag, -1) < self.lines[line - 1] + column:
                return  # it never ends, so it hides nothing
        last = self.stack[-1]
        if tag in INLINE:
            entry = _Open(tag, last.block, last.around)
        else:
            named = {k: v for k, v in attrs if k in ("class", "id", "role") and v}
            words = dict.fromkeys(_WORDS.findall(" ".join(named.values()).lower()))
            own = dict.fromkeys([slot(f"in:{tag}"), *(slot(f"mark:{w}") for w in words if len(w) > 1)])
            new = tuple(x for x in own if x not in last.around)
            entry = _Open(tag, tag, last.around + new if new else last.around)
        self.stack.append(entry)
        self.open[tag] += 1
        if tag in SILENT:
            self.silent.append(tag)
        self.links += tag == "a"

    def _close(self, tag: str) -> None:
        while len(self.stack) > 1:
            last = self.stack.pop().tag
            self.open[last] -= 1
            if last in SILENT:
                self.silent.pop()
            self.links -= last == "a"
            if last == tag:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        if self.open[tag] > 0:
            self._close(tag)

    def handle_data(self, data):
        if self.silent:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len("".join(data.split()))


_SILENT_END = re.compile(f"</({'|'.join(sorted(SILENT))})", re.I)


def blocks(html: str | None) -> list[Block]:
    """Leaf blocks in page order; scripts, styles, comments and form choices are no blocks. Never fails on broken markup.

    A silent element without an end tag after it hides nothing, but for script and style, which take the rest of the page as in
    browsers; svg, math and choices end where a block element begins. Time follows the page's length, however deep it nests.
    """
    reader = _Reader()
    reader.read(html or "")
    return reader.blocks


ship(__name__)
