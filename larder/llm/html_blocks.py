"""HTML to leaf blocks: runs of text between block-level borders, with their open elements."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>"
    r"|<[!?/][^>]*+>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template title iframe".split())
#: Elements inside a line: phrases, formulas, drawings and what stands in for media.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msup msub msubsup munder mover munderover mspace semantics annotation "
    "svg g defs path circle rect line polyline polygon ellipse text tspan desc use object audio video canvas embed param source track".split()
)
#: Opening the key closes an open element of the first set, unless one of the second lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
KEPT_ATTRIBUTES = ("class", "id", "role", "aria-label")


#: A block-level start ends an open paragraph unless one of these lies between.
PARAGRAPH_WALLS = ("button", "td", "th", "table")


@dataclass
class Block:
    text: str
    path: frozenset[str]  # features of the open elements: in:<tag> and word:<attribute word>
    tag: str  # innermost block-level element
    linked: int  # characters inside links
    mark: bool | None  # nearest data-main attribute, in labelled pages


def _signature(tag: str, attributes: str) -> tuple[list[str], bool | None]:
    words = [f"in:{tag}"]
    mark = None
    if "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            name = m[1].lower()
            if name in KEPT_ATTRIBUTES:
                words += [f"word:{w}" for w in WORD.findall((m[2] or m[3] or m[4] or "").lower())]
            elif name == "data-main":
                mark = (m[2] or m[3] or m[4]) == "1"
    return words, mark


class _Open:
    """The open elements, and where each tag and the block-level ones lie among them."""

    def __init__(self) -> None:
        # tag, features of the path, mark, block-level tag
        self.stack: list[tuple[str, frozenset[str], bool | None, str]] = [("", frozenset(), None, "body")]
        self.places: dict[str, list[int]] = {}
        self.levels: list[int] = [0]

    def last(self, *tags: str) -> int:
        return max([self.places[t][-1] for t in tags if self.places.get(t)], default=0)

    def push(self, tag: str, words: list[str], mark: bool | None) -> None:
        _, path, above, level = self.stack[-1]
        if not path.issuperset(words):
            path = path.union(words)
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.levels.append(len(self.stack))
            level = tag
        self.stack.append((tag, path, above if mark is None else mark, level))

    def pop_to(self, i: int) -> None:
        while len(self.stack) > i:
            tag = self.stack.pop()[0]
            self.places[tag].pop()
            if tag not in INLINE:
                self.levels.pop()

    def end(self, tag: str) -> None:
        """An end tag without a start is nothing; one inside a line doesn't close blocks."""
        i = self.last(tag)
        if i and (tag not in INLINE or i > self.levels[-1]):
            self.pop_to(i)

    def begin(self, tag: str) -> None:
        """Ends what a block-level start ends."""
        i = self.last("p")
        if i > self.last(*PARAGRAPH_WALLS):
            self.pop_to(i)
        if tag in CLOSES:
            ends, walls = CLOSES[tag]
            i = self.last(*ends)
            if i > self.last(*walls):
                self.pop_to(i)


def _tokens(page: str):
    """(text before, slash, tag, attributes, end) of each tag, in one pass; the tag is None for comments and the end."""
    pos, last = 0, page.rfind(">")
    while pos <= last:
        m = TOKEN.search(page, pos)
        if not m:
            break
        slash, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        pos = (yield page[pos : m.start()], slash, tag, attributes, m.end()) or m.end()
    # behind the last border only a comment can begin
    yield page[pos:].partition("<!--")[0], None, None, None, len(page)


def blocks(page: str | None, known=None) -> list[Block]:
    """Leaf blocks in page order; character references decoded, white space turned into one space.

    ``known``: the path features that matter (all, if not given), so that a path never holds more.
    """
    out: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked = 0
    at_start = open_.stack[0]
    page = page or ""
    signatures: dict[tuple[str, str], tuple[list[str], bool | None]] = {}

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, at_start[1], at_start[3], min(linked, len(text)), at_start[2]))
        parts, linked = [], 0

    tokens = _tokens(page)
    jump = None
    while True:
        try:
            text, slash, tag, attributes, pos = tokens.send(jump)
        except StopIteration:
            break
        jump = None
        if text:
            links = bool(open_.places.get("a"))
            if not parts and not text.isspace():
                # a linked block hangs on its nearest block-level element; links count by length
                at_start = open_.stack[open_.levels[-1] if links else -1]
            if parts or not text.isspace():
                parts.append(text)
                if links:
                    linked += len(text.strip())
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        elif slash:
            if tag not in INLINE:
                flush()
            open_.end(tag)
        elif tag in RAW:
            end = re.compile(f"</{tag}[^a-zA-Z]", re.I).search(page, pos)
            stop = page.find(">", end.start()) if end else -1
            jump = stop + 1 if stop >= 0 else len(page)
        elif tag not in INLINE or not (tag in VOID or attributes.endswith("/")):
            if tag not in INLINE:
                flush()
                open_.begin(tag)
                if tag in VOID:
                    continue
            if tag in ("body", "html") and len(open_.stack) >= 3:
                attributes = ""
            key = (tag, attributes)
            if key not in signatures:
                words, mark = _signature(tag, attributes)
                signatures[key] = words if known is None else [w for w in words if w in known], mark
            open_.push(tag, *signatures[key])
    flush()
    return out
