"""Reading elements out of page markup with column expressions.

A selector step is a tag with classes, ``div.job-description``. Pages are taken
as they come: attribute order, quoting and letter case vary, elements may be
left open (they then reach to the end of the page). A tag ends at its first ``>``
outside quotes and holds no ``<`` outside quotes; repeated pieces are possessive,
which Java evaluates without recursion and without trying again.
"""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column, functions as F

from jobsignals.functions.binding import let
from jobsignals.functions.text import strip, strip_tags

# Elements that start a new line, and those that HTML does not nest in their like.
BLOCK_TAGS = [
    "address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li",
    "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul",
]
FLAT_TAGS = {"a", "h1", "h2", "h3", "h4", "h5", "h6", "title"}

# A value after its equals sign; the rest of a tag; what stands before a given attribute.
_VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s<>"'][^\s<>]*+)?+"""
_REST = rf"(?:[^<>=]++|{_VALUE})*+>"


def tag_rest() -> str:
    """Expression for what follows a tag's name, up to and with its end."""
    return _REST


def _before(name: str) -> str:
    return rf"(?:[^<>=\s/]++|[\s/]++(?!(?i:{name})[\s=/>])|{_VALUE})*+[\s/]++(?i:{name})\s*+=\s*+"

_UNSEEN = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|script(?=[\s/>]).*?(?:</script[^<>]*>|\z)"
    r"|style(?=[\s/>]).*?(?:</style[^<>]*>|\z))"
)


def visible_markup(html: Column) -> Column:
    """The page without comments, scripts and style sheets."""
    return F.regexp_replace(html, _UNSEEN, "")


def open_tag(step: str) -> str:
    """Expression for the opening tag of a step such as ``a.item.link``."""
    tag, *classes = step.split(".")
    checks = "".join(
        rf"""(?={_before("class")}(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|"""
        rf"""'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>])))"""
        for name in map(re.escape, classes)
    )
    return rf"<(?i:{tag})(?=[\s/>]){checks}{_REST}"


def _pieces(text: Column, tag: str) -> Column:
    """The text cut in front of each start and end tag of this kind."""
    return F.split(text, rf"(?=</?(?i:{tag})[\s/>])", -1)


def _depths(parts: Column, tag: str) -> Column:
    """Depth of open elements after the pieces, from 1, and how many pieces come before
    it falls to 0."""

    def step(state: Column, piece: Column) -> Column:
        ends = piece.rlike(rf"^</(?i:{tag})[\s/>]")
        starts = piece.rlike(rf"^<(?i:{tag})[\s/>]")
        depth = (
            F.when(state["depth"] == 0, F.lit(0))
            .when(ends, state["depth"] - 1)
            .when(starts, state["depth"] + 1)
            .otherwise(state["depth"])
        )
        return F.struct(
            depth.alias("depth"),
            (state["kept"] + F.when(depth > 0, 1).otherwise(0)).alias("kept"),
        )

    return F.aggregate(parts, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept")), step)


def _up_to_close(text: Column, tag: str) -> Column:
    """The part of ``text`` before the end tag of the element it starts in."""
    if tag in FLAT_TAGS:
        return F.get(F.split(text, rf"</(?i:{tag})(?=[\s/>])", 2), F.lit(0))
    return let(_pieces(text, tag), lambda parts: F.array_join(
        F.slice(parts, F.lit(1), _depths(parts, tag)["kept"]), ""))


def first_inner(html: Column, step: str) -> Column:
    """Markup inside the first element of this kind; NULL if there is none."""
    rest = F.get(F.split(html, open_tag(step), 2), F.lit(1))
    tag = step.split(".")[0]
    return let(rest, lambda r: F.when(r.isNotNull(), _up_to_close(r, tag)))


def _levels(parts: Column, tag: str) -> Column:
    """Start and end tags among the pieces, as (level, at, ends) in this order: a start tag
    and its end tag have one level and stand side by side. End tags without an element are
    left out.

    An array grows by copying it, so a fold that keeps one number per piece takes blocks of
    about the square root of the pieces: first how each block changes the depth, then the
    depth at its start, then the levels inside.
    """
    none = F.array().cast("array<int>")

    def below(depth: Column, sign: Column) -> Column:
        return F.greatest(depth + sign, F.lit(0))

    def change(block: Column) -> Column:
        # What is added to the depth, and the least on the way.
        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("low"))
        return F.aggregate(block, start, lambda s, sign: F.struct(
            (s["sum"] + sign).alias("sum"), F.least(s["low"], s["sum"] + sign).alias("low")))

    def starts(changes: Column) -> Column:
        def step(depths: Column, c: Column) -> Column:
            depth = F.element_at(depths, -1)
            return F.concat(depths, F.array(depth + c["sum"] - F.least(F.lit(0), depth + c["low"])))

        return F.aggregate(changes, F.array(F.lit(0)), step)

    def inside(block: Column, depth: Column) -> Column:
        start = F.struct(depth.alias("depth"), none.alias("levels"))
        return F.aggregate(block, start, lambda s, sign: F.struct(
            below(s["depth"], sign).alias("depth"),
            F.concat(s["levels"], F.array(F.greatest(s["depth"], s["depth"] + sign))).alias("levels")))["levels"]

    def levels(signs: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(signs))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(signs) / size).cast("int") - 1),
                             lambda b: F.slice(signs, b * size + 1, size))
        whole = let(blocks, lambda bs: let(starts(F.transform(bs, change)), lambda ds: F.flatten(
            F.transform(bs, lambda block, i: inside(block, F.get(ds, i))))))
        placed = let(whole, lambda all_levels: F.transform(signs, lambda sign, i: F.struct(
            F.get(all_levels, i).alias("level"), i.alias("at"), (sign < 0).alias("ends"))))
        return F.array_sort(F.filter(placed, lambda t: t["level"] > 0))

    # The first piece may be text before any tag.
    signs = F.transform(parts, lambda p: F.when(p.rlike(rf"^</(?i:{tag})[\s/>]"), F.lit(-1))
                        .when(p.rlike(rf"^<(?i:{tag})[\s/>]"), F.lit(1)).otherwise(F.lit(0)))
    return let(signs, levels)


def all_inner(html: Column, step: str) -> Column:
    """Markup inside each element of this kind, also of those inside another one. An
    element left open is read up to the next of its kind. A page is cut once, and its
    tags are matched by sorting them."""
    tag = step.split(".")[0]
    opening = open_tag(step)

    def flat(page: Column) -> Column:
        # Cut in front of each opening tag; what stands before the first one is left out.
        pieces = F.filter(F.split(page, f"(?={opening})", -1), lambda p: p.rlike("^" + opening))
        return F.transform(pieces, lambda p: _up_to_close(F.get(F.split(p, opening, 2), F.lit(1)), tag))

    def nested(parts: Column) -> Column:
        def elements(tags: Column) -> Column:
            def element(t: Column, i: Column) -> Column:
                after = F.get(tags, i + 1)
                closed = after["ends"] & (after["level"] == t["level"])
                return F.struct(t["at"].alias("at"), F.when(closed, after["at"]).alias("end"), t["ends"].alias("ends"))

            own = F.filter(F.transform(tags, element), lambda e: ~e["ends"] & F.get(parts, e["at"]).rlike("^" + opening))
            return F.array_sort(own)

        def contents(found: Column) -> Column:
            def content(e: Column, i: Column) -> Column:
                end = F.coalesce(e["end"], F.get(found, i + 1)["at"], F.size(parts))
                first = F.get(F.split(F.get(parts, e["at"]), opening, 2), F.lit(1))
                return F.concat(first, F.array_join(F.slice(parts, e["at"] + 2, end - e["at"] - 1), ""))

            return F.transform(found, content)

        return let(let(_levels(parts, tag), elements), contents)

    def inside(page: Column) -> Column:
        found = flat(page) if tag in FLAT_TAGS else let(_pieces(page, tag), nested)
        return F.when(page.isNotNull(), F.when(page.rlike(opening), found).otherwise(F.array().cast("array<string>")))

    return let(html, inside)


def attributes(markup: Column, tag: str, name: str) -> Column:
    """Values of an attribute, one per tag that has it."""
    found = F.regexp_extract_all(
        markup,
        F.lit(rf"""<(?i:{tag})(?=[\s/]){_before(name)}("[^"]*+"|'[^']*+'|[^\s<>"'][^\s<>]*+|){_REST}"""),
        F.lit(1),
    )

    def value(written: Column) -> Column:
        quoted = written.startswith('"') | written.startswith("'")
        return F.when(quoted, F.substr(written, F.lit(2), F.char_length(written) - 2)).otherwise(written)

    return F.transform(found, lambda written: decode_entities(value(written)))


# Names of HTML 5, from the standard library. A reader sees a no-break space as a space.
_CHARACTERS = {n[:-1]: c for n, c in html5.items() if n.endswith(";")} | {"nbsp": " "}
# A map is searched from its start, so the names pages are full of have one of their own.
_COMMON = {n: _CHARACTERS[n] for n in ("amp", "nbsp", "lt", "gt", "quot", "apos", "copy", "middot", "hellip", "ndash", "mdash")}
_REFERENCE = r"^(?:#[0-9]++|#[xX][0-9A-Fa-f]++|[A-Za-z][A-Za-z0-9]*+);"
# Browsers read the control characters 128 to 159 as Windows-1252.
_CONTROLS = {str(i): str(ord(bytes([i]).decode("cp1252"))) for i in range(128, 160)
             if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def _character(code: Column) -> Column:
    four_bytes = F.unhex(F.lpad(F.hex(code), 8, "0"))
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(four_bytes, "UTF-32")).otherwise("\ufffd")


def decode_entities(c: Column) -> Column:
    """Character references as characters: numeric ones and the names of HTML 5."""
    common, named, controls = (
        F.from_json(F.lit(json.dumps(m)), "map<string,string>") for m in (_COMMON, _CHARACTERS, _CONTROLS))

    def numbered(digits: Column, base: int) -> Column:
        # Seven significant digits hold any character; what is longer is none.
        short = F.ltrim(digits, F.lit("0"))
        code = F.when(F.length(short) > 7, F.lit(0x110000)).otherwise(F.conv(F.concat(F.lit("0"), short), base, 10).cast("long"))
        return let(F.coalesce(F.try_element_at(controls, code.cast("string")).cast("long"), code), _character)

    def resolved(rest: Column) -> Column:
        def character(name: Column) -> Column:
            return (
                F.when(name.rlike("^#[xX]"), numbered(F.substr(name, F.lit(3)), 16))
                .when(name.startswith("#"), numbered(F.substr(name, F.lit(2)), 10))
                .otherwise(F.coalesce(F.try_element_at(common, name), F.try_element_at(named, name),
                                      F.concat(F.lit("&"), name, F.lit(";"))))
            )

        name = F.substring_index(rest, ";", 1)
        return F.concat(let(name, character), F.substr(rest, F.char_length(name) + 2))

    def decode(text: Column) -> Column:
        # Each part but the first follows an ampersand; those of a reference start with its
        # name. A split at one character takes no regular expression.
        parts = F.transform(F.split(text, "&", -1), lambda p, i: F.when(i == 0, p).when(
            p.rlike(_REFERENCE), resolved(p)).otherwise(F.concat(F.lit("&"), p)))
        return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)

    return let(c, decode)


def visible_text(markup: Column) -> Column:
    """Text as a reader sees it: one line per block, single spaces, no tags."""
    block = rf"</?(?i:{'|'.join(BLOCK_TAGS)})(?=[\s/>]){_REST}"
    # Every run of white space but a single space, which needs no change. The look at the
    # next character spares the alternatives at most positions.
    one_line = F.regexp_replace(markup, r"(?=\s)(?:[\t\n\x0B\f\r]\s*+| \s++)", " ")
    lines = F.regexp_replace(one_line, block, "\n")
    # Tags with quoted values that hold > first, then whatever else looks like one.
    plain = F.regexp_replace(lines, rf"</?[A-Za-z]{_REST}", "")
    # A run of spaces and new lines is one new line, or one space if it holds no new line.
    single = F.regexp_replace(let(plain, strip_tags), r"(?=[ \n])(?: *+(\n)[ \n]*+|( ) ++)", "$1$2")
    return strip(decode_entities(single))


def _without_dots(address: Column) -> Column:
    """The address with the steps ``.`` and ``..`` of its path taken."""

    def step(taken: Column, name: Column) -> Column:
        return (
            F.when(name == "..", F.slice(taken, F.lit(1), F.greatest(F.size(taken) - 1, F.lit(1))))
            .when(name == ".", taken)
            .otherwise(F.concat(taken, F.array(name)))
        )

    def resolved(a: Column) -> Column:
        path = F.regexp_extract(a, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
        steps = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
        return F.concat(
            F.regexp_extract(a, r"^([^:/?#]+://[^/?#]*)", 1),
            F.array_join(steps, "/"),
            F.when(path.rlike(r"/\.\.?$"), "/").otherwise(""),  # the last step is a folder
            F.regexp_extract(a, r"(?s)^[^?#]*(.*)", 1),
        )

    dotted = address.rlike(r"^[^:/?#]+://[^?#]*/\.\.?(?:[/?#]|$)")
    return F.when(dotted, let(address, resolved)).otherwise(address)


def absolute(link: Column, page: Column) -> Column:
    """The link as a full address, read relative to the page it stands on."""
    scheme = F.regexp_extract(page, r"^([^:/?#]+:)", 1)
    origin = F.regexp_extract(page, r"^([^:/?#]+://[^/?#]*)", 1)
    document = F.regexp_extract(page, r"^([^?#]*)", 1)
    folder = F.regexp_extract(page, r"^([^:/?#]+://[^/?#]*/(?:[^?#]*/)?)", 1)
    base = F.when(folder != "", folder).otherwise(F.concat(origin, F.lit("/")))
    full = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("#"), F.concat(F.substring_index(page, "#", 1), link))
        .when(link.startswith("?"), F.concat(document, link))
        .when(link == "", F.substring_index(page, "#", 1))
        .otherwise(F.concat(base, link))
    )
    return let(full, _without_dots)
