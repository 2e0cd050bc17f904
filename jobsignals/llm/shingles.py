"""Sets of word shingles as sorted 64-bit hashes, with numpy.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; whole texts
are read. A shorter text's only shingle is its whole sequence of words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from jobsignals.llm.bytehash import SEGMENT, RangeHashes, mix64

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    return mix64(values)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of some bytes."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    data = _LOWER[data]
    space = _SPACE[data]
    start = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    end = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
    out = np.empty(len(start), np.uint64)
    begin = 0
    while begin < len(start):
        stop = int(np.searchsorted(end, start[begin] + 2 * SEGMENT, side="right"))
        if stop == begin:  # a word longer than the helpers look at
            word = data[start[begin] : end[begin]].tobytes()
            out[begin] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            begin += 1
            continue
        base = start[begin]
        hashes = RangeHashes(data[base : end[stop - 1]])
        out[begin:stop] = hashes(start[begin:stop] - base, end[begin:stop] - base)
        begin = stop
    return start, out


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text: offsets (one more than texts) and values."""
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    stops = np.cumsum(lengths)
    start, hashes = word_hashes(np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8))
    first = np.searchsorted(start, stops - lengths)
    counts = np.searchsorted(start, stops) - first
    parts = []
    if len(hashes):
        grams = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
        for i in range(words if len(grams) else 0):
            grams = grams * _STEP + hashes[i : len(hashes) - words + 1 + i]
        grams = mix64(grams)
    for at, n in zip(first.tolist(), counts.tolist()):
        if n >= words:
            found = np.sort(grams[at : at + n - words + 1])
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            parts.append(found[keep])
        elif n:
            value = np.array([n], np.uint64)
            for i in range(n):
                value = value * _STEP + hashes[at + i]
            parts.append(mix64(value + np.uint64(1)))
        else:
            parts.append(np.empty(0, np.uint64))
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return offsets, np.concatenate(parts) if parts else np.empty(0, np.uint64)


def portions(batches, columns: tuple[str, ...], text: str, limit: int = SEGMENT) -> Iterator[tuple]:
    """Rows of Arrow batches in portions of about ``limit`` text bytes: a list per column,
    the texts as bytes last."""
    from jobsignals.llm.tables import text_bytes

    held: tuple[list, ...] = tuple([] for _ in (*columns, text))
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), text_bytes(batch.column(text))):
            for column, value in zip(held, row):
                column.append(value)
            size += len(row[-1])
            if size >= limit:
                yield held
                held, size = tuple([] for _ in held), 0
    if held[0]:
        yield held
