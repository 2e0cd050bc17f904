"""Exact substring dedup against a search with Python sets."""

import hashlib
import random

import pytest

from jobsignals.llm.repeats import op10_suffix_dedup, without_repeats


def by_force(rows, threshold):
    owner = {}
    for doc, text in rows:
        if doc is None:
            continue
        b = (text or "").encode()
        for i in range(len(b) - threshold + 1):
            w = b[i : i + threshold]
            owner[w] = min(doc, owner.get(w, doc))
    out = []
    for doc, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - threshold + 1) if doc is not None else ():
            if owner[b[i : i + threshold]] < doc:
                gone[i : i + threshold] = b"\1" * threshold
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        left = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def solved(df):
    rows = [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest())
            for r in df.collect()]
    return sorted(rows, key=str)


def sample(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(40)]
    passages = [" ".join(rng.choices(words, k=rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(0, 50)))
                 for _ in range(rng.randint(0, 6))]
        rows.append((rng.randint(0, 3 * n), " ".join(parts)))
    return rows


@pytest.mark.parametrize("threshold,limit", [(50, 1 << 20), (20, 1 << 20), (50, 60)])
def test_equals_a_search_with_sets(documents, threshold, limit):
    rows = sample(3, 80)
    got = without_repeats(documents(rows).repartition(5), threshold=threshold, group_windows=limit,
                          digit=min(16, threshold - 8))
    assert solved(got) == by_force(rows, threshold)


def test_odd_rows(documents):
    line = "The same line of boilerplate text that stands in every page of it."
    long_text = "".join(random.Random(5).choices("abcdefgh ", k=1_200_000))
    rows = [(1, None), (2, ""), (3, line), (3, line), (3, line + " more"), (4, line), (None, line),
            (5, "a" * 3000), (6, "a" * 200 + "b" + "a" * 49), (7, long_text), (8, "x" + long_text[500_000:900_000]),
            (9, "short"), (-1, "zz " + line), (10, long_text)]
    assert solved(without_repeats(documents(rows))) == by_force(rows, 50)


def test_no_documents(documents):
    assert without_repeats(documents([])).collect() == []


def test_query_equals_a_search_with_sets(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op10_suffix_dedup(spark, sf_dir).collect()), key=str)
    assert got == by_force(rows, 50)
