"""Text blocks of a page, in order, with the path of elements that hold them."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

# Elements of the HTML standard by how they shape text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img".split()
)
UNSEEN = ("script", "style", "noscript", "template", "title", "textarea", "select", "svg", "math", "iframe", "object", "canvas", "head")
#: An opening tag ends open elements of these kinds.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements that keep what is inside apart from what is open outside.
WALLS = frozenset("table td th ul ol dl body html article section div nav aside main form".split())

#: Attributes with quoted values, which hold no tag; where a quote is missing, all up to the next ``>``.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"(?:[^\"<]|<(?![a-zA-Z/]))*\"|'(?:[^'<]|<(?![a-zA-Z/]))*')*+(?=>|\Z)|[^>]*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_CLOSES = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in UNSEEN}


@dataclass(frozen=True, eq=False, slots=True)
class Node:
    """An open element: its label (tag and names), the element around it, and how deep it stands."""

    label: str
    parent: Node | None
    depth: int


def node_of(path: Sequence[str]) -> Node | None:
    """The innermost element of a path from the outside in."""
    node = None
    for depth, label in enumerate(path, 1):
        node = Node(label, node, depth)
    return node


@dataclass
class Block:
    """Joined text, the innermost element that holds it, and characters inside links."""

    text: str
    node: Node | None
    linked: int

    @property
    def path(self) -> tuple[str, ...]:
        """Labels from the outside in."""
        out, node = [], self.node
        while node:
            out.append(node.label)
            node = node.parent
        return tuple(reversed(out))

    @property
    def depth(self) -> int:
        return self.node.depth if self.node else 0


@dataclass
class _Reader:
    """Open elements, with the places of each tag, of walls and of links among them: no step looks through all."""

    stack: list[tuple[str, Node]] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)
    walls: list[int] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    begun: bool = False
    node: Node | None = None
    linked: int = 0

    def add(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        if text.strip():
            if not self.begun:
                self.begun, self.node = True, self.stack[-1][1] if self.stack else None
            if self.places.get("a"):
                self.linked += len(text.strip())
        self.parts.append(text)

    def flush(self) -> None:
        if self.begun:
            self.blocks.append(Block(" ".join("".join(self.parts).split()), self.node, self.linked))
        self.parts, self.begun, self.node, self.linked = [], False, None, 0

    def push(self, tag: str, label: str) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in WALLS:
            self.walls.append(len(self.stack))
        self.stack.append((tag, Node(label, self.stack[-1][1] if self.stack else None, len(self.stack) + 1)))

    def close(self, tags: tuple[str, ...], walled: bool) -> None:
        """Ends the innermost open element of one of the kinds, and all inside it."""
        at = max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)
        if at < 0 or (walled and self.walls and self.walls[-1] > at):
            return
        while len(self.stack) > at:
            tag, _ = self.stack.pop()
            self.places[tag].pop()
            if tag in WALLS:
                self.walls.pop()

    def open(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self.flush()
            self.close(("p",), walled=True)
            if tag in ENDS:
                self.close(ENDS[tag], walled=False if tag in ("td", "th", "tr") else True)
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if attributes else ""
        if tag not in VOID:
            self.push(tag, " ".join([tag, *_WORD.findall(names.lower())]) if names else tag)


def read_blocks(page: str) -> list[Block]:
    """Blocks of visible text. Comments, scripts, styles, forms' values and the head are not text.

    Inline elements and line breaks stay inside a block; every other tag ends it.
    White space of any kind becomes one blank; character references are decoded.
    Unclosed and stray tags are taken as browsers do: a paragraph ends where the
    next block begins, a stray end tag changes nothing.
    """
    reader, at = _Reader(), 0
    while True:
        found = _TOKEN.search(page, at)
        if not found:
            reader.add(page[at:])
            break
        if found.start() > at:
            reader.add(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag == "br":
                reader.parts.append(" ")
                continue
            if tag not in INLINE:
                reader.flush()
            reader.close((tag,), walled=False if tag not in INLINE else True)
            continue
        if tag == "br":
            reader.parts.append(" ")
            continue
        if tag in _CLOSES and not page[found.end() - 2 : found.end()] == "/>":
            if tag not in INLINE:
                reader.flush()
            end = _CLOSES[tag].search(page, at)
            body = re.compile(r"<body", re.I).search(page, at) if tag == "head" else None
            stop = min((m.start() if m is body else m.end() for m in (end, body) if m), default=len(page))
            at = stop
            continue
        reader.open(tag, found[3] or "")
    reader.flush()
    return reader.blocks
