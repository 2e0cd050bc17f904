"""Benchmark items in documents, up to an edit budget: pigeonhole pieces and Myers.

Items and texts are compared as lower-case words with single blanks, other marks left
out and a blank at either end, so an item ends where words end: "cat" is not in
"concatenate". An item of n characters (without those blanks) may differ by k = floor(rate n)
edits; short items by none, and at a longer one a lost word edge is an edit. It is cut into k + 1
pieces; an occurrence with at most k edits leaves one piece unchanged, so exact hits of
all pieces, found by one automaton pass over the text, name all places to look at. Around
each place the item is matched by Myers' bit-parallel algorithm, which gives the least
number of edits of the item against any stretch of the text.

Documents are read once per block of items and never shuffled. A block holds about
``BLOCK_CHARS`` characters of items; that bounds what a task gets, and further blocks
are further passes. Tasks hold one text at a time.

Defined results: items or texts without letters or digits match nothing; an item that
occurs several times in a text gives one row with its best place, the first of equal
ones; each of several equal items, and each of several equal rows, gives its own rows;
an item of one short word marks every text with that word; letters are compared as they
are coded, without a Unicode normal form; NULL ids are kept; no items or no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.tables import table

#: Edits allowed per character of an item.
RATE = 0.05
BLOCK_CHARS = 2_000_000
FOUND = "doc_id long, item_id long, edits int, item_chars int, start long, end long"
_WORD = re.compile(r"[^\W_]+")


def normal(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


def edged(words: str) -> str:
    """With the blanks that make the first and last word whole."""
    return f" {words} "


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces of about equal length, with their offsets."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str, budget: int) -> tuple[int, int] | None:
    """The least edits of ``item`` against a stretch of ``text`` and the first end of such
    a stretch; None if more than ``budget``."""
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    size = len(item)
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = budget + 1, -1
    for at, c in enumerate(text):
        equal = masks.get(c, 0)
        across = equal | minus
        down = (((equal & plus) + plus) ^ plus) | equal
        up_plus = minus | ~(down | plus) & full
        up_minus = plus & down
        if up_plus & high:
            score += 1
        elif up_minus & high:
            score -= 1
        # The first row is zero everywhere: a match may begin at any place.
        up_plus, up_minus = (up_plus << 1) & full, (up_minus << 1) & full
        plus = up_minus | ~(across | up_plus) & full
        minus = up_plus & across
        if score < best:
            best, end = score, at + 1
            if not best:
                break
    return None if end < 0 else (best, end)


def occurrence(item: str, text: str, budget: int) -> tuple[int, int, int] | None:
    """Edits, start and end of the best stretch of ``text`` for ``item``."""
    at = text.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    found = myers(item, text, budget)
    if found is None:
        return None
    edits, end = found
    begin = max(0, end - len(item) - budget)
    back = myers(item[::-1], text[begin:end][::-1], edits)
    return edits, end - (back[1] if back else len(item)), end


class Items:
    """Benchmark items of one block with the automaton of their pieces."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float) -> None:
        self.items = [(i, edged(t), int(rate * len(t))) for i, t in items if t]
        self.automaton = None

    def _built(self) -> ahocorasick.Automaton:
        if self.automaton is None:
            places: dict[str, list[tuple[int, int]]] = {}
            for number, (_, item, budget) in enumerate(self.items):
                for offset, piece in pieces(item, budget):
                    places.setdefault(piece, []).append((number, offset))
            self.automaton = ahocorasick.Automaton()
            for piece, at in places.items():
                self.automaton.add_word(piece, (len(piece), at))
            self.automaton.make_automaton()
        return self.automaton

    def found(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """Number of an item, edits, start and end in ``text``, a normal form with its edges."""
        windows: dict[int, list[list[int]]] = {}
        for last, (length, places) in self._built().iter(text):
            for number, offset in places:
                _, item, budget = self.items[number]
                begin = max(0, last + 1 - length - offset - budget)
                end = last + 1 - length - offset + len(item) + budget
                held = windows.setdefault(number, [])
                # Hits come by their ends, so windows of an item nearly come in order.
                if held and begin <= held[-1][1]:
                    held[-1][0], held[-1][1] = min(begin, held[-1][0]), max(end, held[-1][1])
                else:
                    held.append([begin, end])
        for number, held in windows.items():
            _, item, budget = self.items[number]
            best = None
            for begin, end in held:
                here = occurrence(item, text[begin:end], budget if best is None else best[0] - 1)
                if here:
                    best = here[0], here[1] + begin, here[2] + begin
                    if not best[0]:
                        break
            if best:
                yield number, *best


def _places(text: str, start: int, end: int) -> tuple[int, int]:
    """Characters of the text that a stretch of its normal form covers, by whole words."""
    begins, spans, size = [], [], 0
    for match in _WORD.finditer(text):
        begins.append(size)
        spans.append(match.span())
        size += len(match[0].lower()) + 1
    return spans[bisect_right(begins, start) - 1][0], spans[bisect_right(begins, max(start, end - 1)) - 1][1]


def _searched(items: list[tuple[int | None, str]], rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Items(items, rate)
        for batch in batches:
            out: list[tuple] = []
            for at in range(batch.num_rows):
                text = batch.column("text")[at].as_py()
                if not text:
                    continue
                words = edged(normal(text))
                for number, edits, start, end in block.found(words):
                    item_id, item, _ = block.items[number]
                    # Without the edges, in the normal form.
                    start, end = start - (words[start] != " "), end - 1 - (words[end - 1] == " ")
                    # Lower-casing may change a text's length; words keep their order.
                    out.append((batch.column("doc_id")[at].as_py(), item_id, edits, len(item) - 2,
                                *_places(text, start, end)))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)],
                names=["doc_id", "item_id", "edits", "item_chars", "start", "end"])

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """Items in blocks of about ``block_chars`` characters, one at a time on the driver."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull())
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-size // block_chars))
    for block in range(count if size else 0):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).collect()
        yield sorted(((r["item_id"], normal(r["text"])) for r in part), key=str)


def contaminated(documents: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, edits, item_chars
    (of the normal form), start and end of the characters it covers."""
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = [texts.mapInArrow(_searched(items, rate), FOUND)
             for items in _blocks(benchmark, item_col, item_text_col, block_chars)]
    if not parts:
        return texts.sparkSession.createDataFrame([], FOUND)
    return reduce(DataFrame.unionAll, parts)


def decontaminated(documents: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text",
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""

    def clean(items: list[tuple]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Items(items, rate)
            for batch in batches:
                texts = (batch.column(text_col)[i].as_py() for i in range(batch.num_rows))
                stays = [not text or next(block.found(edged(normal(text))), None) is None for text in texts]
                yield batch.filter(pa.array(stays, pa.bool_()))

        return run

    for items in _blocks(benchmark, item_col, item_text_col, block_chars):
        documents = documents.mapInArrow(clean(items), documents.schema)
    return documents


def op1_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
