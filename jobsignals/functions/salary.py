"""Salary bins (millions of VND) out of the free text of a benefits section."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F

from jobsignals.functions.binding import let
from jobsignals.functions.text import nfkc, strip

# --- Fixed values: what counts as a money amount, in order. Each entry: the
# expression, the group that holds the amount, and lower-case texts of which
# any match must contain one (none: no cheap test exists).
#
# Each expression is linear in the text: a run of digits is entered at its start
# only (look-behind; \G allows the rest of a run a match ended in), and repeated
# groups are possessive, which Java evaluates without recursion.
MONEY = [
    (r"lương(?:từ| )++(?<=[ừ ] )([\p{Nd}.]+)", 1, ["lương"]),
    (r"(?<![\p{Nd}.\- ])([\p{Nd}.\- ]+(?: |triệu(?:triệu| )*+))đồng", 1, ["đồng"]),
    (r"(?:(?<![\p{Nd}.,])|\G)[\p{Nd}.,]+.000.000", 0, ["000"]),
    (r"(?<![\p{Nd} \-])[\p{Nd} \-]+\p{Nd} *(?:triệu|m)", 0, []),
    (r"\$(?:\p{Nd}+|\.)", 0, ["$"]),
    (r"(?<![\p{Nd}.])[\p{Nd}.]+ *(?:USD|\$)++", 0, ["usd", "$"]),
    (r"(?<![\p{Nd}.,])[\p{Nd}.,]+,000,000", 0, [",000,000"]),
]
MILLION_UNITS = "triệu|Triệu|TRIỆU|m|M"
USD_RATE = 23  # thousand VND per dollar
BIN_SIZE = 5
BIN_CAP = 100
# --- End of fixed values

# The largest decimal Spark holds. For bins, and only there, it stands for longer numbers:
# all of them fall in the last bin.
_LARGEST = "9" * 38
_DIGITS = "".join(
    chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"
)
_ASCII_DIGITS = "".join(str(unicodedata.decimal(ch)) for ch in _DIGITS)


def _empty(element_type: str) -> Column:
    return F.array().cast(f"array<{element_type}>")


def salary_candidates(benefits: Column) -> Column:
    """All money amounts in the text, expression by expression, as found."""

    def found(text: Column) -> Column:
        def all_of(low: Column) -> Column:
            lists = []
            for pattern, group, needed in MONEY:
                hits = F.regexp_extract_all(text, F.lit("(?iud)" + pattern), F.lit(group))
                if needed:
                    possible = low.contains(needed[0])
                    for other in needed[1:]:
                        possible = possible | low.contains(other)
                    hits = F.when(possible, hits).otherwise(_empty("string"))
                lists.append(hits)
            return F.concat(*lists)

        return let(F.lower(text), all_of)

    return F.coalesce(let(nfkc(benefits), found), _empty("string"))


def whole_number(c: Column, longer: str | None = None) -> Column:
    """Integer written in ``c`` as a decimal of 38 digits: decimal digits of any script,
    white space around, a plus sign and single underscores between digits allowed; else
    NULL. For a number of more digits ``longer`` is given instead, by default NULL."""

    def parse(t: Column) -> Column:
        ascii_digits = F.when(
            t.rlike(r"[^\x00-\x7F]"), F.translate(t, _DIGITS, _ASCII_DIGITS)
        ).otherwise(t)
        digits = F.ltrim(F.translate(ascii_digits, "+_", ""), F.lit("0"))
        number = let(
            digits,
            lambda d: F.when(F.length(d) > 38, F.lit(longer).cast("decimal(38,0)"))
            .when(F.length(d) == 0, F.lit(0).cast("decimal(38,0)"))
            .otherwise(d.try_cast("decimal(38,0)")),
        )
        return F.when(t.rlike(r"^\+?\p{Nd}+(?:_\p{Nd}+)*+$"), number)

    return let(strip(c), parse)


def vnd_millions(c: Column, longer: str | None = None) -> Column:
    """Whole millions in a VND amount such as ``10 triệu`` or ``10.000.000``."""
    zeros = F.regexp_replace(c, MILLION_UNITS, "000000")
    return F.floor(whole_number(F.translate(zeros, ". ,", ""), longer) / 1_000_000)


def usd_amount(c: Column, longer: str | None = None) -> Column:
    """Dollars in an amount marked ``$``, ``USD`` or ``usd``; NULL if it is none."""
    digits = (
        F.when(
            c.contains("$"),
            F.when(c.startswith("$"), F.substring(c, 2, 2**31 - 1)).otherwise(
                F.left(c, F.char_length(c) - 1)
            ),
        )
        .when(c.contains("USD"), F.replace(c, F.lit("USD"), F.lit("")))
        .when(c.contains("usd"), F.replace(c, F.lit("usd"), F.lit("")))
    )
    return whole_number(F.replace(digits, F.lit("."), F.lit("")), longer)


def amount_bin(millions: Column) -> Column:
    """The bin of one amount; amounts from the cap on share the last bin."""
    capped = F.least(millions - millions % BIN_SIZE, F.lit(BIN_CAP)).cast("int")
    return F.when(millions.isNotNull(), capped)  # least() skips NULL


def range_bins(start: Column, end: Column) -> Column:
    """All bins a range touches, the end capped; none if it is reversed."""
    # A start above the cap meets no bin, however far above. Capped before they are divided: the
    # quotient of a number of 38 digits has no room for its fraction.
    first = F.floor(F.least(start, F.lit(BIN_CAP + BIN_SIZE)) / BIN_SIZE).cast("long")
    last = F.floor(F.least(end, F.lit(BIN_CAP)) / BIN_SIZE).cast("long")
    # sequence() counts downwards when the start lies above the end.
    return F.when(
        end.isNotNull() & (first <= last),
        F.transform(F.sequence(first, last), lambda i: (i * BIN_SIZE).cast("int")),
    )


def candidate_bins(c: Column, usd_rate: float = USD_RATE) -> Column:
    """Bins of one amount as found in the text; NULL if it cannot be read.

    In a range of VND the start is taken as millions as written and only the
    end is read with its unit; further parts are ignored.
    """

    def vnd(parts: Column) -> Column:
        start = whole_number(F.translate(strip(F.get(parts, F.lit(0))), ".,", ""), _LARGEST)
        end = F.when(start.isNotNull(), vnd_millions(F.get(parts, F.lit(1)), _LARGEST))
        single = let(vnd_millions(F.get(parts, F.lit(0)), _LARGEST),
                     lambda m: F.when(m.isNotNull(), F.array(amount_bin(m))))
        both = let(F.struct(start.alias("s"), end.alias("e")),
                   lambda r: range_bins(r["s"], r["e"]))
        return F.when(F.size(parts) == 1, single).otherwise(both)

    def bins(usd: Column) -> Column:
        # As a double: above 2 ** 53 dollars only the last bin is left at any usual rate.
        from_usd = F.array(amount_bin(F.floor(usd.cast("double") * usd_rate / 1000)))
        parts = F.split(F.btrim(strip(c), F.lit("-")), "-", -1)
        return F.when(usd.isNotNull(), from_usd).otherwise(let(parts, vnd))

    return let(usd_amount(c, _LARGEST), bins)


def salary_bins(benefits: Column, usd_rate: float = USD_RATE) -> Column:
    """Ascending distinct bins of all money amounts in the text; NULL text gives none."""
    found = F.transform(
        salary_candidates(benefits),
        lambda c: F.coalesce(candidate_bins(c, usd_rate), _empty("int")),
    )
    return F.array_sort(F.array_distinct(F.flatten(found)))
