"""Codes of vector parts against a plain reading of the rounds."""

import hashlib
import math
import random

import numpy as np
import pytest

from jobsignals.llm.gridcodes import LARGEST, _Cells, codes


def plain(rows, entries=256, rounds=4):
    """(id, vector, label) rows to {place: (code, error, label_error)} and the codebooks' hash."""
    good = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    number = [[math.floor(1024 * max(-LARGEST, min(LARGEST, x))) for x in v] for _, v, _ in good]
    order = sorted(range(len(good)), key=lambda n: (good[n][0] is None, good[n][0] or 0, np.array(number[n], "<i4").tobytes()))
    length = len(number[order[0]])
    fits = [n for n in order if len(number[n]) == length]
    cuts = [p * length // 4 for p in range(5)]
    out, books = {n: ["", 0] for n in fits}, []
    for a, b in zip(cuts[:-1], cuts[1:]):
        book = [number[n][a:b] for n in fits[:entries]]
        for turn in range(rounds + 1):
            near = {}
            for n in fits:
                near[n] = min((sum((x - y) ** 2 for x, y in zip(number[n][a:b], e)), k) for k, e in enumerate(book))
            if turn < rounds:
                for k in range(len(book)):
                    mine = [number[n][a:b] for n in fits if near[n][1] == k]
                    book[k] = [sum(c) // len(mine) for c in zip(*mine)] if mine else book[k]
        for n in fits:
            out[n][0] += f"{near[n][1]:02x}"
            out[n][1] += near[n][0]
        books += [str(x) for e in book for x in e]
    labels = {}
    for n in fits:
        labels[good[n][2]] = labels.get(good[n][2], 0) + out[n][1]
    found = [(good[n][0], *out.get(n, (None, None)), labels.get(good[n][2])) for n in range(len(good))]
    return sorted(found, key=str), hashlib.sha256(",".join(books).encode()).hexdigest()


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows],
                                 "vec_id long, embedding array<double>, label int, code string, n int").repartition(3)


def check(spark, rows, **options):
    got = codes(table(spark, rows), **options).collect()
    want, digest = plain(rows, **{k: v for k, v in options.items() if k != "cell_bits"})
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == want
    assert {r.codebooks_sha256 for r in got} == {digest}


@pytest.mark.parametrize("cell_bits", [2, 6, 12])
def test_codes_do_not_depend_on_the_cells(spark, cell_bits):
    rng = random.Random(4)
    centers = [[rng.gauss(0, 0.2) for _ in range(8)] for _ in range(9)]
    rows = [(i, [c + rng.gauss(0, 0.02) for c in rng.choice(centers)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(60)]  # copies
    check(spark, rows, entries=20, cell_bits=cell_bits)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.5, -0.001, 1.0, 2.0], 1), (1, [0.5, -0.001, 1.0, 2.0], 1), (1, [0.1, 0.2, 0.3, 0.4], None), (None, [9.0, 9.0, 9.0, 9.0], None),
            (4, None, 1), (5, [1.0, None, 1.0, 1.0], 1), (6, [nan, 1.0, 1.0, 1.0], 1), (7, [1.0, 1.0, -inf, 1.0], 1), (8, [1.0, 2.0], 7),
            (9, [], 1), (10, [1e300, -1e300, 0.0, 0.0], 2), (2, [0.0] * 4, 2)]
    check(spark, rows, entries=3)
    check(spark, rows, entries=256)
    got = {(r.vec_id, r.code, r.error, r.label_error) for r in codes(table(spark, rows)).collect() if r.vec_id in (8, 9)}
    assert got == {(8, None, None, None), (9, None, None, got and next(r[3] for r in got if r[0] == 9))}


def test_lengths_that_do_not_divide(spark):
    rng = random.Random(1)
    for length in (1, 3, 6):
        check(spark, [(i, [rng.gauss(0, 1) for _ in range(length)], i % 2) for i in range(40)], entries=5)


def test_no_rows(spark):
    assert codes(table(spark, [(1, None, 1)])).collect() == [] and codes(table(spark, [(1, [1.0], 1)]).limit(0)).collect() == []


def test_cells_leave_out_dominated_entries_only():
    rng = np.random.default_rng(3)
    book = rng.integers(-500, 500, size=(200, 5))
    parts = rng.integers(-600, 600, size=(3000, 5))
    every = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    for bits in (0, 5, 9):
        cells = _Cells(book, bits)
        index, distance = cells.nearest(parts)
        assert (index == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    kept = np.unpackbits(np.stack(list(_known(book, parts, 5).values())), axis=1, count=200).sum(axis=1)
    assert kept.mean() < 60  # most entries are dominated in a cell of 32


def _known(book, parts, bits):
    cells = _Cells(book, bits)
    cells.nearest(parts)
    return cells.known
