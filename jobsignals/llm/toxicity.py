"""Toxicity by a weighted lexicon, matched on folded text by an Aho-Corasick automaton.

Texts are folded first: lower case, compatibility forms, look-alike letters and digit
substitutions to Latin letters, other marks to blanks. Accents stay; words differ by them. Lexicon entries are word
beginnings or whole words with a weight. Entries inside an exception phrase do not
count. The sum of weights, alone and in proportion to the text's length, and the
heaviest entry give the score through a logistic function.

The lexicon is learned from a bounded sample of labelled rows (``TRAIN_ROWS``): entries
that stand in toxic texts more than in others, chosen until each toxic text holds up
to ``COVER`` of them; their weights are the log ratio of how often they occur per word
in toxic and in other texts. Exception phrases are pairs of words
with an entry that occur in clean texts only. Labels, language, source and id are no
inputs. Every term that ``LEAST_TEXTS`` toxic texts hold and whose weight is great enough is a
candidate, and every exception phrase that two clean texts hold counts: the sample alone
bounds the lexicon. Scoring is a map over whole texts; the lexicon is the only thing sent to tasks.

Defined results: a NULL or empty text holds no entry and gets the lowest score; rows of
one id are scored by their own texts; without labels of both kinds the lexicon is empty
and all scores are the share of label 1 (or 0); no rows give no rows; other columns are
ignored.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.labelled import fold_of, training_rows
from jobsignals.llm.quality import scored
from jobsignals.llm.tables import kept, table

TRAIN_ROWS = 20_000
#: Toxic texts of the sample that hold an entry, at least.
LEAST_TEXTS = 3
#: Entries looked for in each toxic text of the sample.
COVER = 3
#: Numbers that the logistic function works on.
INPUTS = 5
#: Least log odds, over texts, of an entry.
LEAST_WEIGHT = 2.0
#: Letters of the word beginnings that are considered.
SHORTEST, LONGEST = 3, 10

#: Letters and signs that stand for Latin letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "и": "u", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m",
    "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "һ": "h", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}

_FOLD = str.maketrans(LOOKALIKES)
_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.compile(r"[@$0-9]")


def words_of(text: str) -> list[str]:
    """Words of the folded text."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    if not text.isascii() or _SIGNS.search(text):
        text = text.translate(_FOLD)
    return _WORD.findall(text)


def _terms(words: list[str]) -> set[str]:
    """Beginnings of the words, and the words themselves with a blank at the end."""
    out = set()
    for word in set(words):
        out.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
        if len(word) >= 3:
            out.add(word + " ")
    return out


class Lexicon:
    """Entries with weights, exception phrases, and the logistic function on top."""

    def __init__(self, weights: dict[str, float], exceptions: set[str], model: np.ndarray) -> None:
        self.weights, self.exceptions, self.model = weights, exceptions, model
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def hits(self, words: list[str]) -> tuple[Counter, list[tuple[int, int]], str]:
        """Entries found at word beginnings, once per word (the heaviest), outside exceptions."""
        line = " " + " ".join(words) + " "
        found: Counter = Counter()
        places = []
        if self.weights:
            if self._automaton is None:
                self._automaton = ahocorasick.Automaton()
                for entry in self.weights:
                    self._automaton.add_word(" " + entry, (" " + entry, entry, True))
                for phrase in self.exceptions:
                    self._automaton.add_word(f" {phrase} ", (f" {phrase} ", phrase, False))
                self._automaton.make_automaton()
            best: dict[int, str] = {}
            excepted: list[tuple[int, int]] = []
            for end, (key, entry, counts) in self._automaton.iter(line):
                start = end - len(key) + 1
                if not counts:
                    excepted.append((start, end))
                elif start not in best or self.weights[entry] > self.weights[best[start]]:
                    best[start] = entry
            for start, entry in best.items():
                if not any(a <= start < b for a, b in excepted):
                    found[entry] += 1
                    places.append((start, start + len(entry)))
        return found, places, line

    def inputs(self, text: str) -> tuple[float, ...]:
        words = words_of(text)
        found = self.hits(words)[0]
        total = sum(self.weights[e] * n for e, n in found.items())
        heaviest = max((self.weights[e] for e in found), default=0.0)
        return 1.0, np.log1p(total), np.log1p(1000 * total / (len(words) + 20)), heaviest, np.log1p(len(words))

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        x = np.array([self.inputs(t.decode("utf-8", "replace")) for t in texts]).reshape(len(texts), INPUTS)
        return 1 / (1 + np.exp(-np.clip(x @ self.model, -40, 40)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each kind that hold a term, per task."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
            (toxic if label else clean).update(_terms(words_of(text or "")))
    terms = list(toxic.keys() | clean.keys())
    for at in range(0, len(terms), 100_000):
        some = terms[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([
            pa.array(some), pa.array([toxic[t] for t in some], pa.int64()),
            pa.array([clean[t] for t in some], pa.int64())], names=["term", "toxic", "clean"])


def _beginning(term: str) -> str:
    """The longest shorter term that every text with ``term`` holds too."""
    return term[:-1][:LONGEST] if term.endswith(" ") else term[:-1]


def _distinct(counts: dict[str, tuple[int, int]]) -> list[str]:
    """The terms without beginnings that say the same as a longer term: equal counts of
    texts mean the same texts. Those would never be chosen before the longer term."""
    same = {b for t, n in counts.items() if counts.get(b := _beginning(t)) == n}
    return sorted(counts.keys() - same)


def _covering(held: Iterable[Sequence[int]], terms: list[str], weights: dict[str, float],
              least: int = LEAST_TEXTS) -> list[str]:
    """Terms, best first, until each text holds COVER of the chosen ones or no term adds
    ``least`` texts. Best is what covers most texts times its weight above the least, so a
    stem wins over its many words, and a whole word over a beginning that clean words share.
    ``held`` gives the places in ``terms`` (sorted) of the terms of each text. What a term
    adds only falls, so the best of a heap is looked at again before it is taken."""
    texts: dict[int, list[int]] = {}
    need = []
    for i, numbers in enumerate(held):
        need.append(COVER)
        for number in numbers:
            texts.setdefault(number, []).append(i)

    def entry(number: int, gain: int) -> tuple[float, int, int, int]:
        term = terms[number]
        return -gain * (weights[term] - LEAST_WEIGHT / 2), -len(term), -number, gain

    heap = [entry(number, len(found)) for number, found in texts.items()]
    heapq.heapify(heap)
    chosen: list[str] = []
    stems: list[str] = []
    sizes: set[int] = set()
    known: set[str] = set()
    while heap:
        _, _, number, before = heapq.heappop(heap)
        term = terms[-number]
        # Words that start with a chosen beginning, and its own beginnings, say the same.
        at = bisect_left(stems, bare := term.rstrip(" "))
        if at < len(stems) and stems[at].startswith(bare) or any(term[:n] in known for n in sizes):
            continue
        gain = sum(need[i] > 0 for i in texts[-number])
        if gain < least:
            continue
        if gain < before:
            heapq.heappush(heap, entry(-number, gain))
            continue
        chosen.append(term)
        insort(stems, bare)
        sizes.add(len(bare))
        known.add(bare)
        for i in texts[-number]:
            need[i] -= 1
    return chosen


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a small penalty, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (p - y) + 0.1 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fitted(documents: DataFrame, labels: DataFrame, used: Column, label: str = "toxic",
           train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """A lexicon learned from the labelled rows that ``used`` (a condition on doc_id) accepts."""
    rows = kept(training_rows(documents, labels, label, used, train_rows, id_col, text_col), "toxic-training")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Lexicon({}, set(), np.array([8.0 if sizes.get(1) else -8.0, 0, 0, 0, 0]))
    weight = (F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1)))
    counts = rows.mapInArrow(_counted, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    found = (counts.where((F.col("toxic") >= LEAST_TEXTS) & (weight >= LEAST_WEIGHT))
             .select("term", "toxic", "clean", weight.alias("weight")).collect())
    terms = _distinct({r["term"]: (r["toxic"], r["clean"]) for r in found})
    weights = {r["term"]: r["weight"] for r in found}
    numbers = {term: number for number, term in enumerate(terms)}

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(
                [[numbers[t] for t in _terms(words_of(text or "")) & numbers.keys()]
                 for text in batch.column("text").to_pylist()], pa.list_(pa.int32()))], names=["terms"])

    held = rows.where("label = 1").select("text").mapInArrow(holding, "terms array<int>").toArrow()
    chosen = _covering((text.as_py() for text in held.column("terms")), terms, weights)
    bare = Lexicon({t: weights[t] for t in chosen}, set(), np.zeros(INPUTS))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for kind, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text or "")
                counts[None, int(kind)] += len(words)
                for entry, n in bare.hits(words)[0].items():
                    counts[entry, int(kind)] += n
            yield pa.RecordBatch.from_arrays([
                pa.array([e for e, _ in counts], pa.string()), pa.array([k for _, k in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64())], names=["entry", "label", "n"])

    counted = {(r["entry"], r["label"]): r["n"] for r in rows.select("label", "text").mapInArrow(
        occurrences, "entry string, label int, n long").groupBy("entry", "label").agg(F.sum("n").alias("n")).collect()}
    per_word = lambda e, kind: (counted.get((e, kind), 0) + 0.5) / (counted.get((None, kind), 0) + 1)
    ratios = {e: float(np.log(per_word(e, 1) / per_word(e, 0))) for e in chosen}
    bare = Lexicon({e: w for e, w in ratios.items() if w > 0}, set(), np.zeros(INPUTS))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kind, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                seen = set()
                _, places, line = bare.hits(words_of(text or ""))
                for start, _ in places:
                    end = line.index(" ", start + 1)
                    before, after = line.rfind(" ", 0, start), line.find(" ", end + 1)
                    if before >= 0:
                        seen.add(line[before + 1 : end])
                    if after >= 0:
                        seen.add(line[start + 1 : after])
                out += [(phrase, int(kind)) for phrase in seen]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int32())],
                names=["phrase", "label"])

    excepted = (rows.select("label", "text").mapInArrow(phrases, "phrase string, label int").groupBy("phrase")
                .agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).where("toxic = 0 AND n >= 2")
                .select("phrase").collect())
    lexicon = Lexicon(bare.weights, {r["phrase"] for r in excepted}, np.zeros(INPUTS))

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [list(lexicon.inputs(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["label", "x"])

    data = rows.select("label", "text").mapInArrow(inputs, "label int, x array<double>").toArrow()
    x = np.array(data.column("x").to_pylist()).reshape(-1, INPUTS)
    y = data.column("label").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))
    lexicon.model = _logistic(x[order], y[order])
    return lexicon


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = lambda c: fold_of(c, 5) == 0
    lexicon = fitted(documents, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return scored(documents, lexicon).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
