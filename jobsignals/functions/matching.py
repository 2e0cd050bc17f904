"""Vocabulary match: which terms of a list occur in a text.

A term matches anywhere in the text, also inside words, without regard to case.
Terms are regular expressions; nearly all are plain text. The plain ones of a
vocabulary are found in one scan of the lower-cased text by a single expression
with shared prefixes, so cost does not grow with the number of terms as it does
when the text is searched once per term.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from jobsignals.functions import vocabulary as terms
from jobsignals.functions.binding import let

_SPECIAL = set("\\^$.|?*+()[]{}")


@dataclass(frozen=True)
class Vocabulary:
    """An ordered term list; characters in ``escape`` lose their regex meaning."""

    name: str
    terms: tuple[str, ...]
    escape: str = ""

    def pattern(self, term: str) -> str:
        return "".join("\\" + ch if ch in self.escape else ch for ch in term)

    def is_plain(self, term: str) -> bool:
        return not any(ch in _SPECIAL and ch not in self.escape for ch in term)


FRAMEWORKS = Vocabulary("framework_platforms", tuple(terms.FRAMEWORKS))
LANGUAGES = Vocabulary("languages", tuple(terms.LANGUAGES), escape="+()")
DESIGN_PATTERNS = Vocabulary("design_patterns", tuple(terms.DESIGN_PATTERNS))
KNOWLEDGES = Vocabulary("knowledges", tuple(terms.KNOWLEDGES))
ALL = (FRAMEWORKS, LANGUAGES, DESIGN_PATTERNS, KNOWLEDGES)


def folded(c: Column) -> Column:
    """Lower case under which texts are compared. Three letters whose upper or
    lower form is an ASCII letter are folded to it by hand."""

    def fold(t: Column) -> Column:
        odd = t.contains("İ") | t.contains("ı") | t.contains("ſ")
        return F.lower(F.when(odd, F.translate(t, "İıſ", "iis")).otherwise(t))

    return let(c, fold)


def _quote(ch: str) -> str:
    return ch if ch.isalnum() or ord(ch) > 127 else "\\" + ch


def _branches(children: list[tuple[str, str]]) -> str:
    """Alternatives by first character. Beyond eight (measured), a look at the
    character halves the choice first: alternatives are tried one by one."""
    if len(children) <= 8:
        return "|".join(_quote(ch) + rest for ch, rest in children)
    half = len(children) // 2
    return "|".join(
        f"(?=[{''.join(_quote(ch) for ch, _ in part)}])(?:{_branches(part)})"
        for part in (children[:half], children[half:])
    )


def _longest_of(words: Sequence[str]) -> str:
    """Expression for the longest of ``words`` at a position."""
    by_first: dict[str, list[str]] = {}
    for word in words:
        if word:
            by_first.setdefault(word[0], []).append(word[1:])
    if not by_first:
        return ""
    body = _branches([(ch, _longest_of(rest)) for ch, rest in sorted(by_first.items())])
    if "" in words:
        return f"(?:{body})?"
    return f"(?:{body})" if len(by_first) > 1 else body


def _required_text(pattern: str) -> str | None:
    """Text every match of a simple pattern (only ``.`` and ``x*``) holds."""
    if set(pattern) & (_SPECIAL - set(".*")):
        return None
    return max(re.split(r".\*|\.", pattern.lower()), key=len) or None


def _regex_hit(low: Column, pattern: str) -> Column:
    hit = low.rlike("(?iud)" + pattern)
    needed = _required_text(pattern)
    return low.contains(needed) & hit if needed else hit


def term_positions(text: Column, vocabularies: Sequence[Vocabulary]) -> Column:
    """Ascending positions, in the joined term lists, of the terms found in ``text``."""
    entries = [(v, t) for v in vocabularies for t in v.terms]
    plain: dict[str, list[int]] = {}
    odd: list[tuple[int, str]] = []
    for pos, (vocab, term) in enumerate(entries):
        if vocab.is_plain(term):
            plain.setdefault(term.lower(), []).append(pos)
        else:
            odd.append((pos, vocab.pattern(term)))

    # A hit is the longest term at its place; the terms it begins with are there too.
    by_hit = {
        word: [p for w, ps in plain.items() if word.startswith(w) for p in ps] for word in plain
    }
    # Written as one literal, which Spark folds to a constant map when planning.
    lookup = F.from_json(F.lit(json.dumps(by_hit)), "map<string,array<int>>")
    # A look-ahead consumes nothing, so terms that overlap are all found.
    scan = F.lit(f"(?=({_longest_of(list(plain))}))")

    def positions(low: Column) -> Column:
        parts = []
        if plain:
            hits = F.array_distinct(F.regexp_extract_all(low, scan, F.lit(1)))
            parts.append(F.flatten(F.transform(hits, lambda h: F.try_element_at(lookup, h))))
        for pos, pattern in odd:
            parts.append(F.when(_regex_hit(low, pattern), F.array(F.lit(pos)))
                         .otherwise(F.array().cast("array<int>")))
        return F.array_sort(F.array_distinct(F.concat(*parts)))

    return F.coalesce(let(folded(text), positions), F.array().cast("array<int>"))


def terms_at(positions: Column, vocabularies: Sequence[Vocabulary], wanted: Vocabulary) -> Column:
    """The terms of ``wanted`` among the positions found for ``vocabularies``."""
    first = sum(len(v.terms) for v in vocabularies[: list(vocabularies).index(wanted)])
    last = first + len(wanted.terms) - 1
    words = F.split(F.lit("\n".join(wanted.terms)), "\n")  # a constant array after planning
    mine = F.filter(positions, lambda p: p.between(first, last))
    return F.transform(mine, lambda p: F.get(words, p - first))


def match_terms(text: Column, vocabulary: Vocabulary) -> Column:
    """Terms of one vocabulary found in ``text``, in list order; NULL text gives none."""
    return terms_at(term_positions(text, [vocabulary]), [vocabulary], vocabulary)
