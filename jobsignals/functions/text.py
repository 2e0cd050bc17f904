"""Scalar text operators. All are JVM-side column expressions."""

from __future__ import annotations

import re
import sys

from pyspark.sql import Column, functions as F

from jobsignals.functions.binding import let

# Every character str.strip() removes.
WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())

# --- Fixed values: section titles of a posting, its default text and its label
SECTION_HEADERS = [
    "Mô tả công việc",
    "Yêu cầu ứng viên",
    "Quyền lợi",
    "Địa điểm làm việc",
    "Thời gian làm việc",
    "Cách thức ứng tuyển",
]
MISSING = "N/A"
SPECIALTY_LABEL = "Chuyên môn "
# --- End of fixed values

# Letters whose upper case Spark writes as several, and the single one that stands for it.
_WIDE = [c for c in map(chr, range(128, sys.maxunicode + 1)) if len(c.upper()) > 1]
_WIDE_UPPER = {c: "ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in _WIDE}


def strip(c: Column) -> Column:
    """Remove white space, Unicode included, at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def upper(c: Column) -> Column:
    """Upper case letter by letter, so that lower case gives the text back: ``ß`` becomes ``ẞ``,
    where ``F.upper`` writes ``SS``. A letter without a single upper form stays."""
    wide = F.create_map(*[F.lit(x) for pair in _WIDE_UPPER.items() for x in pair])

    def letters(t: Column) -> Column:
        each = F.transform(F.split(t, ""), lambda x: F.coalesce(F.try_element_at(wide, x), F.upper(x)))
        return F.when(t.rlike(f"[{''.join(_WIDE)}]"), F.array_join(each, "")).otherwise(F.upper(t))

    return let(c, letters)


def strip_tags(c: Column) -> Column:
    """Delete every ``<...>``, also across lines; an unclosed ``<`` stays.

    The text behind the last ``>`` cannot hold a tag and is left out of the
    search: a ``<`` without an end would otherwise be followed to the end of
    the text, once for each of them. Texts without a ``<`` are left as they are.
    """
    tail = F.substring_index(c, ">", -1)
    head = F.left(c, F.char_length(c) - F.char_length(tail))
    return F.when(c.contains("<"), F.concat(F.regexp_replace(head, "<[^>]*>", ""), tail)).otherwise(c)


def clean(c: Column) -> Column:
    """Strip tags, then spaces (only spaces) at both ends."""
    return F.trim(strip_tags(c))


def join_texts(a: Column, b: Column) -> Column:
    """The two texts with one space between; space-padded terms match at the seam."""
    return F.concat(a, F.lit(" "), b)


def nfkc(c: Column) -> Column:
    """Unicode NFKC form, computed in the JVM by the ICU library Spark ships.

    Texts in ASCII are left out; ICU returns those already normal after a check.
    """
    composed = F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True)
    )
    return F.when(F.octet_length(c) > F.char_length(c), composed).otherwise(c)


def or_missing(c: Column) -> Column:
    return F.coalesce(c, F.lit(MISSING))


def specialty(c: Column) -> Column:
    """Specialty without its label, wherever the label occurs."""
    return F.replace(c, F.lit(SPECIALTY_LABEL), F.lit(""))


def sections(c: Column, headers: list[str] = SECTION_HEADERS) -> Column:
    """Map of header -> stripped text up to the next header.

    Headers match by exact case, text before the first one is dropped and the
    last occurrence of a repeated header wins. NULL text gives NULL.
    """
    # The look at the first letter spares the alternatives at most positions.
    initials = "".join(sorted({re.escape(h[0]) for h in headers}))
    any_header = f"(?=[{initials}])(?:{'|'.join(re.escape(h) for h in headers)})"
    # Reversed, so that the first position found is the last occurrence. The
    # reversed bodies carry the dropped leading text as one extra last element.
    found = F.struct(
        F.reverse(F.regexp_extract_all(c, F.lit(f"({any_header})"), F.lit(1))).alias("header"),
        F.reverse(F.split(c, any_header, -1)).alias("body"),
    )

    def last_body(parts: Column, header: Column) -> Column:
        at = F.array_position(parts["header"], header).cast("int")
        return strip(F.get(parts["body"], at - 1))

    def as_map(parts: Column) -> Column:
        entries = F.transform(
            F.array(*[F.lit(h) for h in headers]),
            lambda h: F.struct(h.alias("key"), last_body(parts, h).alias("value")),
        )
        return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))

    return F.when(c.isNotNull(), let(found, as_map))


def section(section_map: Column, header: str) -> Column:
    """One section of :func:`sections`, or the default text."""
    return or_missing(F.try_element_at(section_map, F.lit(header)))
