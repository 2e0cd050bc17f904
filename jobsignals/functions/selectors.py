"""Elements of a page by selectors, in one pass over its tags.

A selector is a list of steps: ``nav > ul li.x:nth-child(2) a[href^="/j"]``. A step is a
tag or ``*`` with classes, an id, attributes (``[a]``, ``[a=v]``, ``~= ^= $= *=``) and
``:first-child`` or ``:nth-child(n | odd | even | an+b)``; a blank stands for any depth,
``>`` for a child. A comma joins alternatives.

Pages are read as browsers read them in the main: an end tag closes the nearest open
element of its name and all inside, and is passed over if there is none; elements without
content hold nothing; a new item, row, cell, option or paragraph ends the open one before it;
what is open at the end of the page ends there. Each tag costs the same, however many
elements are open.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

from jobsignals.functions.html import BLOCK_TAGS, tag_rest

# --- Fixed values: elements without content, with text only, and which start tag ends which
# open element unless one of the last list stands between
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = ("script", "style", "textarea", "title")
ENDED_BY = {
    "li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
PARAGRAPH_ENDS = frozenset(BLOCK_TAGS) - {"br", "body", "html", "li", "td", "th", "tr", "dt", "dd"}
PARAGRAPH_SCOPE = ("table", "td", "th", "button")
# --- End of fixed values

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)(?=[\s/>])({tag_rest()})", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=<>/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s<>"'][^\s<>]*)?)?""")
_STEP = re.compile(
    r"""\s*(>)?\s*([A-Za-z][\w-]*|\*)?((?:\.[\w-]+|\#[\w-]+|\[[^\]]*\]|:first-child|:nth-child\([^)]*\))*)""")
_PART = re.compile(r"\.([\w-]+)|\#([\w-]+)|\[\s*([\w-]+)\s*(?:([~^$*]?=)\s*(?:\"([^\"]*)\"|'([^']*)'|([^\]\s]*))\s*)?\]"
                   r"|(:first-child)|:nth-child\(\s*([^)]*?)\s*\)")


@dataclass(frozen=True)
class Step:
    tag: str | None
    child: bool
    tests: tuple[tuple[str, str, str], ...] = ()  # attribute, comparison, value
    nth: tuple[int, int] | None = None  # every so many, first

    def accepts(self, tag: str, attributes: dict[str, str], place: int) -> bool:
        if self.tag and tag != self.tag:
            return False
        if self.nth:
            every, first = self.nth
            if (place != first) if not every else ((place - first) % every or (place - first) // every < 0):
                return False
        return all(_holds(attributes.get(name), how, value) for name, how, value in self.tests)


def _holds(given: str | None, how: str, value: str) -> bool:
    if given is None or how == "":
        return given is not None
    if how == "=":
        return given == value
    if how == "~=":
        return value in given.split()
    if not value:
        return False
    return {"^=": given.startswith, "$=": given.endswith, "*=": given.__contains__}[how](value)


def _nth(text: str) -> tuple[int, int]:
    text = {"odd": "2n+1", "even": "2n"}.get(text.lower(), text.lower()).replace(" ", "")
    found = re.fullmatch(r"([+-]?\d*)n([+-]\d+)?|([+-]?\d+)", text)
    if not found:
        raise ValueError(f"not a place: {text}")
    if found[3]:
        return 0, int(found[3])
    every = found[1] + "1" if found[1] in ("", "+", "-") else found[1]
    return int(every), int(found[2] or 0)


@lru_cache(maxsize=256)
def steps(selector: str) -> tuple[tuple[Step, ...], ...]:
    """The alternatives of a selector; ValueError if it is none."""
    out = []
    for alternative in re.split(r",(?![^\[(]*[\])])", selector):
        at, found = 0, []
        text = alternative.strip()
        while at < len(text):
            match = _STEP.match(text, at)
            if match.end() == at or not (match[2] or match[3]):
                raise ValueError(f"not a selector: {selector}")
            tests, nth = [], None
            for cls, ident, name, how, *quoted, first, place in (p.groups() for p in _PART.finditer(match[3])):
                if cls or ident:
                    tests.append(("class", "~=", cls) if cls else ("id", "=", ident))
                elif name:
                    tests.append((name.lower(), how or "", next((q for q in quoted if q is not None), "")))
                else:
                    nth = (0, 1) if first else _nth(place)
            tag = None if match[2] in (None, "*") else match[2].lower()
            found.append(Step(tag, match[1] == ">", tuple(tests), nth))
            at = match.end()
        if not found:
            raise ValueError(f"not a selector: {selector}")
        out.append(tuple(found))
    return tuple(out)


@dataclass
class Element:
    """An element that a selector found; ``end`` is known when it is closed."""

    selector: int
    tag: str
    attributes: dict[str, str]
    start: int
    end: int = -1


@dataclass
class _Open:
    tag: str
    start: int
    children: int = 0
    #: Steps of each alternative that this element, or one around it, has come to (bits).
    here: tuple[int, ...] = ()
    above: tuple[int, ...] = ()
    found: list[Element] = field(default_factory=list)


def attributes_of(text: str) -> dict[str, str]:
    """Attributes of a start tag, the first of a name; references decoded."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        out.setdefault(name.lower(), references.unescape(value))
    return out


def _tokens(page: str) -> Iterator[tuple[bool, str, str, int, int]]:
    """End tag or not, name, rest, where the tag starts and ends; no comments, no raw text."""
    at, low = 0, page.lower()
    while found := _TOKEN.search(page, at):
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        yield found[1] == "/", name, found[3], found.start(), at
        if name in RAW and found[1] == "":
            end = re.compile(rf"</{name}(?=[\s/>])").search(low if len(low) == len(page) else page, at)
            at = end.start() if end else len(page)


class _Reader:
    def __init__(self, selectors: tuple[str, ...]) -> None:
        self.alternatives = [(n, alternative) for n, s in enumerate(selectors) for alternative in steps(s)]
        nothing = (0,) * len(self.alternatives)
        self.open = [_Open("", 0, here=nothing, above=nothing)]
        #: Places of the open elements of each name.
        self.places: dict[str, list[int]] = {}
        self.found: list[Element] = []

    def last(self, names: tuple[str, ...]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def close_from(self, place: int, end: int) -> None:
        while len(self.open) > place:
            gone = self.open.pop()
            self.places[gone.tag].pop()
            for element in gone.found:
                element.end = end

    def start(self, tag: str, rest: str, start: int, end: int) -> None:
        if tag in ENDED_BY:
            ended, scope = ENDED_BY[tag]
            limit = self.last(scope)
            due = [p for n in ended for p in self.places.get(n, [])[-1:] if p > limit]
            if due:
                self.close_from(min(due), start)
        if tag in PARAGRAPH_ENDS:
            place = self.last(("p",))
            if place > self.last(PARAGRAPH_SCOPE):
                self.close_from(place, start)
        parent = self.open[-1]
        parent.children += 1
        attributes: dict[str, str] | None = None
        here, above, found = [], [], []
        for i, (selector, alternative) in enumerate(self.alternatives):
            bits = 0
            around = parent.above[i] | parent.here[i]
            for k, step in enumerate(alternative):
                if step.tag and step.tag != tag:
                    continue
                if k and not (parent.here[i] if step.child else around) >> (k - 1) & 1:
                    continue
                if step.child and not k:  # a leading > asks for the outermost elements
                    if len(self.open) > 1:
                        continue
                if attributes is None:
                    attributes = attributes_of(rest)
                if step.accepts(tag, attributes, parent.children):
                    bits |= 1 << k
            here.append(bits)
            above.append(around)
            if bits >> (len(alternative) - 1) & 1 and not any(e.selector == selector for e in found):
                found.append(Element(selector, tag, attributes or {}, end))
        self.found += found
        if tag in VOID:
            for element in found:
                element.end = end
            return
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(_Open(tag, end, 0, tuple(here), tuple(above), found))

    def read(self, page: str) -> list[Element]:
        for ends, tag, rest, start, end in _tokens(page):
            if not ends:
                self.start(tag, rest, start, end)
            elif self.places.get(tag):
                self.close_from(self.places[tag][-1], start)
        self.close_from(1, len(page))
        return self.found


def elements(page: str, selectors: tuple[str, ...]) -> list[Element]:
    """The elements of a page that each selector finds, in the order of their start tags."""
    return _Reader(selectors).read(page)
