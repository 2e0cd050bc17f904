"""Collocations against counting with dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from jobsignals.llm import stripes
from jobsignals.llm.stripes import Filter, collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    key = lang, tuple(words[i : i + m])
                    counts[key] = counts.get(key, 0) + 1
    frequent = {k: n for k, n in counts.items() if n >= least}
    out = {}
    for (lang, phrase), a in frequent.items():
        held = any(
            other == lang and len(q) > len(phrase) and 100 * n >= 80 * a
            and any(q[i : i + len(phrase)] == phrase for i in range(len(q) - len(phrase) + 1))
            for (other, q), n in frequent.items())
        if len(phrase) > 1 and not held:
            cuts = []
            for k in range(1, len(phrase)):
                l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
                cuts.append((2_000_000 * a // (l + r), k, l, r))
            score, _, l, r = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, totals[lang], -s)
        for lang, found in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def documents(spark, rows):
    return spark.createDataFrame([(1, t, lang, 0, "x") for lang, t in rows], "doc_id long, text string, lang string, n int, phrase string")


def text(rng, words):
    ends = [" "] * 8 + ["  ", "\t", ". ", ",", "\n", " ; ", "!"]
    return "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(60)))


def random_rows(seed):
    rng = random.Random(seed)
    words = ["a", "A", "b", "cé", "new", "York", "city", "x:y", "É", " ", "und", "-", "'s"]
    rows = [(rng.choice(["en", "de", None, "und"]), text(rng, words)) for _ in range(120)]
    rows += [("en", "new york city hall of a b c. " * 12), ("en", None), (None, None), ("fr", ""), ("fr", "..,,"), ("es", "q " * 50)]
    return rows + rows[:10]


@pytest.mark.parametrize("seed, least, top, split, portion", [(1, 3, 2000, 200_000, None), (2, 8, 5, 4, 500), (3, 2, 2000, 1, 200)])
def test_random_texts(spark, monkeypatch, seed, least, top, split, portion):
    rows = random_rows(seed)
    got = sorted(tuple(r) for r in collocations(documents(spark, rows).repartition(5), least, top, split=split).collect())
    assert got == plain(rows, least, top) and len(got) > 10


def test_small_portions_give_the_same_stripes():
    import pyarrow as pa

    rows = random_rows(4)
    batch = pa.RecordBatch.from_pylist([{"lang": lang or "und", "text": t} for lang, t in rows])
    for portion in (1, 1 << 20):
        old, stripes.PORTION = stripes.PORTION, portion
        try:
            counts = Counter()
            for out in stripes._word_stripes(64)(iter([batch])):
                for row in out.to_pylist():
                    for stripe in row["stripes"]:
                        for word, n in zip(stripe["next"], stripe["counts"]):
                            counts[row["lang"], word] += n
        finally:
            stripes.PORTION = old
        want = Counter()
        for lang, t in rows:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
                want.update((lang or "und", w) for w in re.findall(r"[^\x20\x09]+", piece))
        assert counts == want


def test_nothing(spark):
    assert collocations(documents(spark, [("en", None)])).collect() == []
    assert collocations(documents(spark, [("en", "a b")]).limit(0)).collect() == []
    assert collocations(documents(spark, [("en", "a b")])).collect() == []


def test_a_filter_lets_all_of_its_phrases_through(spark):
    rng = random.Random(9)
    known = {("en", f"w{rng.randrange(500)} v{rng.randrange(500)}") for _ in range(3000)} | {("de", "w1 v1")}
    passes = Filter.of(spark.createDataFrame(sorted(known), "lang string, phrase string").repartition(3))

    def asked(lang, pairs):
        first, last = (stripes._hashes(lang, [p[i].encode() for p in pairs]) for i in (0, 1))
        return passes(stripes._joined_hashes(first, last))

    assert asked("en", [p.split() for lang, p in known if lang == "en"]).all()
    assert asked("en", [(f"n{i}", f"m{i}") for i in range(4000)]).mean() < 0.1
    assert isinstance(passes.bits, np.ndarray) and len(passes.bits) * 64 >= len(known)


def test_repeated_facts_are_not_broadcast(spark, monkeypatch, tmp_path):
    """Facts over the bound are dealt out by a shuffle, however small Spark takes them for."""
    from jobsignals.llm import tables

    monkeypatch.setattr(tables, "FEW", 10)
    given = spark.createDataFrame([(None, -1), *((str(i), i) for i in range(40))], "k string, v int")
    given.write.parquet(str(tmp_path / "facts"))  # files have a size, which is small
    facts = spark.read.parquet(str(tmp_path / "facts"))
    rows = spark.createDataFrame([(None, 0), *((str(i % 50), i) for i in range(200))], "k string, x int")
    found = tables.looked_up(rows, facts, ["k"])
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()
    expected = [(None, 0, -1)] + [(str(i % 50), i, i % 50) for i in range(200) if i % 50 < 40]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
