"""Blocks of a web page: runs of text between block-level tags, with where they stand."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

#: Fixed values of HTML: elements that end a run of text, that have no end tag, and whose content is no text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul button label".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = "script|style|template|iframe|textarea"
#: Elements without text that hold tags: they end at their end tag or that of an element around them.
VEILED = frozenset("head svg object noscript".split())
#: What may stand in a head; any other tag ends it, and so does text.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript title".split())
#: Tags that end a drawing, as they cannot stand in one.
NO_DRAWING = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span "
    "strong strike sub sup table tt u ul var article aside main section header footer nav form".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<skip>" + HIDDEN + r")\b[^>]*(?<!/)>.*?(?:</(?P=skip)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attr>(?:\"[^\"]*\"|'[^']*'|[^<>\"'])*+)>", re.S | re.I)
_MARK = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """The elements that hold text, each with its parent, and the blocks in order.

    Element 0 is the page itself. An element's marks are its tag and the words
    of its class, id and role.
    """

    def __init__(self) -> None:
        self.parent, self.marks, self.depth = [0], [()], [0]
        self.blocks: list[Block] = []

    def add(self, parent: int, marks: tuple[str, ...]) -> int:
        self.parent.append(parent)
        self.marks.append(marks)
        self.depth.append(self.depth[parent] + 1)
        return len(self.parent) - 1


@dataclass
class Block:
    text: str
    page: Page
    element: int  # the innermost element around it
    linked: int  # characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        """Marks of all elements around the block, from the root down."""
        own, at = [], self.element
        while at:
            own.append(self.page.marks[at])
            at = self.page.parent[at]
        return tuple(m for marks in reversed(own) for m in marks)

    def last_marks(self, number: int) -> list[str]:
        """The end of ``path``, without walking further up than it takes."""
        own, at = [], self.element
        while at and len(own) < number:
            own = [*self.page.marks[at], *own]
            at = self.page.parent[at]
        return own[-number:]


class _Open:
    """Open elements, outermost first, with the places of each name: every question costs the same at any depth."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.elements: list[int] = []
        self.places: dict[str, list[int]] = {}

    def push(self, name: str, element: int) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.elements.append(element)

    def pop(self) -> str:
        name = self.names.pop()
        self.elements.pop()
        self.places[name].pop()
        return name

    def last(self, name: str) -> int:
        """Place of the innermost open element of this name, -1 if there is none."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def element(self) -> int:
        return self.elements[-1] if self.elements else 0


def blocks(html: str) -> list[Block]:
    """The page's blocks in order. Tags that are missing or doubled end where browsers end them, or never."""
    page, stack = Page(), _Open()
    parts: list[tuple[str, bool]] = []
    links = 0
    veil = -1  # place in the stack of the outermost element without text

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                page.blocks.append(Block(text, page, stack.element(), sum(len(p.strip()) for p, a in parts if a)))
            parts = []

    def close(name: str) -> None:
        nonlocal links, veil
        at = stack.last(name)
        if at < 0:
            return
        while len(stack.names) > at:
            links -= stack.pop() == "a"
        if veil >= at:
            veil = -1

    def say(text: str) -> None:
        if veil >= 0 and stack.names[-1] == "head" and veil == len(stack.names) - 1 and text.strip():
            close("head")
        if veil < 0:
            parts.append((unescape(text), links > 0))

    def lift(name: str) -> bool:
        """Whether a start tag counts as part of what is hidden; one that cannot stand there ends it."""
        kind = stack.names[veil]
        if kind == "head":
            if name == "body" or stack.names[-1] == "head" and name not in IN_HEAD:
                close("head")
        elif kind == "svg" and name in NO_DRAWING and all(stack.last(n) < veil for n in ("foreignobject", "desc", "title")):
            close("svg")
        return veil >= 0

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            say(html[at: m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if veil >= 0 and m["end"] and stack.names[veil] == "head" and name in ("body", "html"):
            close("head")
        if veil >= 0:
            if m["end"]:
                if name in BLOCK and 0 <= stack.last(name) < veil:
                    flush()
                if stack.names[veil] != "head" or stack.last(name) >= veil:
                    close(name)
                continue
            if lift(name):
                if name not in VOID and not m["attr"].rstrip().endswith("/") and (stack.names[-1] == "head" or stack.names[veil] != "head"):
                    stack.push(name, stack.element())
                    links += name == "a"
                continue
        if name == "br":
            parts.append((" ", False))
        elif m["end"]:
            if name in BLOCK:
                flush()
            close(name)
        elif name in VEILED and not m["attr"].rstrip().endswith("/"):
            veil = len(stack.names)
            stack.push(name, stack.element())
        else:
            if name in BLOCK:
                flush()
                close("p")
                own = stack.last(name)
                if own >= 0 and name in ("li", "td", "th", "tr", "dt", "dd", "option"):
                    inner = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}.get(name, ("table",))
                    if all(stack.last(n) < own for n in inner):
                        close(name)
            if name not in VOID and not m["attr"].rstrip().endswith("/"):
                marks = [name]
                for found in _MARK.findall(m["attr"]):
                    marks += ["." + w.lower() for w in _WORD.findall("".join(found))]
                stack.push(name, page.add(stack.element(), tuple(marks)))
                links += name == "a"
    if at < len(html):
        say(html[at:])
    flush()
    return page.blocks
