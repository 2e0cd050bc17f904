"""Exact substring dedup: suffixes sorted only to the threshold, by radix passes.

Each byte position of a document starts a suffix, of which the first
``threshold`` bytes count (its window). A most-significant-digit radix sort puts
equal windows into one group without comparing suffixes: a pass deals the rows
out by one digit of the key, drops what stands alone in its group, and only the
rest goes on to the next digit. The digits are parts of the window that are
found by its content, so that neighbouring suffixes can travel in one row:

1. *leading digit*: ``digit`` bytes from the window's leading position, the place
   whose 8 bytes hash least. Neighbouring suffixes have the same leading
   position; such a run is one row, about one for 18 bytes of text.
2. *run digit*: all bytes that the run's windows cover. In a group of equal runs
   every run of a later document is a repeat; the runs of the smallest id stand
   for the group.
3. *full depth*: runs whose leading digit meets other contexts in another
   document are cut into single windows, which are grouped by 128-bit hashes of
   all their bytes. Equal groups at this depth are exactly the repeated windows.

Bounded memory: groups are read as sorted streams. Copies inside a task are
settled before the first shuffle, so a group of copies costs one row per task
and text position; a leading digit with very many contexts is dealt out again by
its windows.

Defined results: a NULL or empty text has no bytes and stays; texts shorter than
the threshold stay; rows of equal id never remove bytes from each other, and
equal rows get equal results; rows with a NULL id neither lose bytes nor cause
losses; other columns are ignored. Equality of windows is equality of 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.bytehash import SEGMENT, RangeHashes, leading_positions
from jobsignals.llm.tables import (
    as_long, kept, long_array, packed_texts, table, text_bytes, text_key, unpacked,
)

THRESHOLD = 50
DIGIT = 16
GRAM = 8
#: Text bytes whose runs are compared inside a task before the shuffle.
LOCAL_BYTES = 48 << 20
#: Windows of one leading digit that a task sorts in memory; more are dealt out again.
GROUP_WINDOWS = 1 << 20
#: A row's place: 32 bits tell rows of one id apart, 31 bits are the position.
_AT = 31

RUNS = "digit long, context long, doc_id long, at long, windows int"
SETTLED = "doc_id long, at long, windows int, digit long, open boolean"


def _segments(texts: list[bytes], threshold: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in portions of up to SEGMENT bytes: their numbers, offsets and bytes. A
    longer text is cut so that each window lies in exactly one piece."""
    step = SEGMENT - threshold + 1
    numbers, offsets, pieces, size = [], [], [], 0
    for number, text in enumerate(texts):
        for offset in range(0, max(len(text) - threshold + 1, 0), step):
            piece = text[offset : offset + SEGMENT]
            if size + len(piece) > SEGMENT:
                yield numbers, offsets, pieces
                numbers, offsets, pieces, size = [], [], [], 0
            numbers.append(number)
            offsets.append(offset)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield numbers, offsets, pieces


def _runs(texts: list[bytes], threshold: int, digit: int) -> dict[str, np.ndarray]:
    """Runs of neighbouring suffixes with one leading position, of all texts."""
    parts = []
    for numbers, offsets, pieces in _segments(texts, threshold):
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        lengths = np.array([len(p) for p in pieces])
        ends = np.cumsum(lengths)
        n = len(data) - threshold + 1
        lead = leading_positions(data, GRAM, threshold - digit + 1)[:n]
        piece = np.repeat(np.arange(len(pieces)), lengths)[:n]
        valid = np.arange(n) + threshold <= ends[piece]
        first = np.ones(n, dtype=bool)
        first[1:] = (lead[1:] != lead[:-1]) | (piece[1:] != piece[:-1]) | (valid[1:] != valid[:-1])
        start = np.flatnonzero(first)
        last = np.append(start[1:], n) - 1
        start, last = start[valid[start]], last[valid[start]]
        lead, piece = lead[start], piece[start]
        hashes = RangeHashes(data)
        parts.append({
            "digit": hashes(lead, lead + digit).view(np.int64),
            "context": (hashes(start, last + threshold) + (lead - start).astype(np.uint64)).view(np.int64),
            "number": np.array(numbers)[piece],
            "start": start - (ends - lengths)[piece] + np.array(offsets)[piece],
            "windows": last - start + 1,
        })
    if not parts:
        return {k: np.empty(0, np.int64) for k in ("digit", "context", "number", "start", "windows")}
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _spans(doc: np.ndarray, at: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of window starts, merged where one follows another."""
    if not len(doc):
        return doc, at, windows
    order = np.lexsort((at, doc))
    doc, at, end = doc[order], at[order], (at + windows)[order]
    first = np.ones(len(doc), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (at[1:] != end[:-1])
    begin = np.flatnonzero(first)
    stop = np.append(begin[1:], len(doc)) - 1
    return doc[begin], at[begin], end[stop] - at[begin]


def _leaders(*keys: np.ndarray) -> np.ndarray:
    """Where a row begins a new group of equal keys, in sorted rows."""
    first = np.ones(len(keys[0]), dtype=bool)
    first[1:] = False
    for key in keys:
        first[1:] |= key[1:] != key[:-1]
    return first


def _described(threshold: int, digit: int):
    """Runs of a task's documents; runs that repeat a smaller id inside the task
    leave as settled spans (without a context)."""

    def portion(ids: list[int], rows: list[int], texts: list[bytes]) -> pa.RecordBatch:
        runs = _runs(texts, threshold, digit)
        doc = np.array(ids, dtype=np.int64)[runs["number"]]
        at = (np.array(rows, dtype=np.int64)[runs["number"]] << _AT) | runs["start"]
        order = np.lexsort((doc, runs["context"], runs["digit"]))
        doc, at, windows = doc[order], at[order], runs["windows"][order]
        digits, context = runs["digit"][order], runs["context"][order]
        first = _leaders(digits, context)
        smallest = doc[np.flatnonzero(first)][np.cumsum(first) - 1] if len(doc) else doc
        repeat = doc > smallest
        span_doc, span_at, span_windows = _spans(doc[repeat], at[repeat], windows[repeat])
        stays = ~repeat
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([as_long(digits[stays]), as_long(span_doc * 0x9E3779B9 + span_at)]),
            pa.concat_arrays([as_long(context[stays]), pa.nulls(len(span_doc), pa.int64())]),
            pa.array(np.concatenate((doc[stays], span_doc))),
            pa.array(np.concatenate((at[stays], span_at))),
            pa.array(np.concatenate((windows[stays], span_windows)).astype(np.int32)),
        ], names=["digit", "context", "doc_id", "at", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, texts, size = [], [], [], 0
        for batch in batches:
            for doc, row, text in zip(batch.column("doc_id").to_pylist(),
                                      batch.column("row").to_pylist(), text_bytes(batch.column("text"))):
                if doc is None or len(text) < threshold:
                    continue
                ids.append(doc)
                rows.append(row)
                texts.append(text)
                size += len(text)
                if size >= LOCAL_BYTES:
                    yield portion(ids, rows, texts)
                    ids, rows, texts, size = [], [], [], 0
        yield portion(ids, rows, texts)

    return run


def _settled_batch(doc, at, windows, digit=None) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays([
        pa.array(doc), pa.array(at), pa.array(windows.astype(np.int32)),
        pa.nulls(n, pa.int64()) if digit is None else pa.array(digit),
        pa.array(np.full(n, digit is not None)),
    ], names=["doc_id", "at", "windows", "digit", "open"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by digit, context and id: runs of later documents are settled;
    runs whose digit stands for several contexts and documents stay open. What is
    held from batch to batch are the runs of one document in one digit."""
    names = ("digit", "context", "doc_id", "at", "windows")
    held = [np.empty(0, np.int64) for _ in names] + [np.empty(0, bool)]
    for batch in batches:
        local = batch.filter(batch.column("context").is_null())
        if local.num_rows:
            yield _settled_batch(*(long_array(local.column(c)) for c in names[2:]))
        batch = batch.filter(batch.column("context").is_valid())
        new = [long_array(batch.column(c)) for c in names] + [np.zeros(batch.num_rows, bool)]
        digit, context, doc, at, windows, sent = (np.concatenate(x) for x in zip(held, new))
        if not len(digit):
            continue
        begins = _leaders(digit, context)
        smallest = doc[np.flatnonzero(begins)][np.cumsum(begins) - 1]
        stands = doc == smallest
        if not stands.all():
            yield _settled_batch(doc[~stands], at[~stands], windows[~stands])
        opens = np.flatnonzero(_leaders(digit))
        group = np.cumsum(_leaders(digit)) - 1
        several = (np.minimum.reduceat(smallest, opens) < np.maximum.reduceat(smallest, opens)) \
            | np.logical_or.reduceat(sent, opens)
        out = stands & several[group] & ~sent
        if out.any():
            yield _settled_batch(doc[out], at[out], windows[out], digit[out])
        if several[-1]:  # the last digit may go on: its last context's smallest id is needed
            keep = np.array([np.flatnonzero(begins)[-1]])
        else:
            keep = np.flatnonzero(stands & (group == group[-1]))
        held = [x[keep] for x in (digit, context, doc, at, windows)]
        held.append(np.full(len(keep), several[-1]))


def _contexts(threshold: int):
    """Bytes of the open runs of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, runs, text in zip(batch.column("doc_id").to_pylist(),
                                       batch.column("runs").to_pylist(), unpacked(batch.column("packed"))):
                for run in runs:
                    start = run["at"] & ((1 << _AT) - 1)
                    out.append((run["digit"], doc, run["at"], text[start : start + run["windows"] + threshold - 1]))
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["digit", "doc_id", "at", "content"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["digit", "doc_id", "at", "content"])

    return run


def _windows(doc: np.ndarray, at: np.ndarray, contents: list[bytes], threshold: int) -> list[np.ndarray]:
    """Both hashes, id and place of each window of some runs."""
    parts: list[tuple[np.ndarray, ...]] = []
    begin = 0
    while begin < len(contents):
        end, size = begin, 0
        while end < len(contents) and (size + len(contents[end]) <= 2 * SEGMENT or end == begin):
            size += len(contents[end])
            end += 1
        lengths = np.array([len(c) for c in contents[begin:end]])
        data = np.frombuffer(b"".join(contents[begin:end]), dtype=np.uint8)
        counts = lengths - threshold + 1
        row = np.repeat(np.arange(begin, end), counts)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = np.repeat(np.cumsum(lengths) - lengths, counts) + inside
        hashes = RangeHashes(data)
        parts.append((hashes(start, start + threshold), hashes(start, start + threshold, "second"),
                      doc[row], at[row] + inside))
        begin = end
    return [np.concatenate(x) for x in zip(*parts)]


def _repeated(first_hash, second_hash, doc, at) -> tuple[np.ndarray, ...]:
    """Spans of windows that a smaller id has too, of complete groups."""
    order = np.lexsort((doc, second_hash, first_hash))
    first_hash, second_hash, doc, at = first_hash[order], second_hash[order], doc[order], at[order]
    begins = _leaders(first_hash, second_hash)
    again = doc > doc[np.flatnonzero(begins)][np.cumsum(begins) - 1]
    return _spans(doc[again], at[again], np.ones(again.sum(), np.int64))


FULL_DEPTH = "doc_id long, at long, windows int, h1 long, h2 long, open boolean"


def _full_depth(threshold: int, limit: int):
    """Open runs sorted by digit: spans repeated from a smaller id. Windows of a
    digit with more than ``limit`` windows leave unsettled, for one more pass."""

    def rows(doc, at, windows, h1=None, h2=None) -> pa.RecordBatch:
        n = len(doc)
        return pa.RecordBatch.from_arrays([
            pa.array(doc), pa.array(at), pa.array(windows.astype(np.int32)),
            pa.nulls(n, pa.int64()) if h1 is None else as_long(h1),
            pa.nulls(n, pa.int64()) if h2 is None else as_long(h2),
            pa.array(np.full(n, h1 is not None)),
        ], names=["doc_id", "at", "windows", "h1", "h2", "open"])

    def solved(held: list[tuple]) -> pa.RecordBatch:
        doc, at, contents = (np.array([r[1] for r in held]), np.array([r[2] for r in held]),
                             [r[3] for r in held])
        return rows(*_repeated(*_windows(doc, at, contents, threshold)))

    def raw(held: list[tuple]) -> pa.RecordBatch:
        h1, h2, doc, at = _windows(np.array([r[1] for r in held]), np.array([r[2] for r in held]),
                                   [r[3] for r in held], threshold)
        return rows(doc, at, np.ones(len(doc), np.int64), h1, h2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []      # whole groups
        group: list[tuple] = []     # the group being read
        done_size = size = 0
        digit, large = None, False
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("digit", "doc_id", "at", "content"))):
                if row[0] != digit:
                    if large:
                        if group:
                            yield raw(group)
                    else:
                        done += group
                        done_size += size
                        if done_size > limit:
                            yield solved(done)
                            done, done_size = [], 0
                    group, size, digit, large = [], 0, row[0], False
                group.append(row)
                size += len(row[3]) - threshold + 1
                if size > limit:
                    large = True
                    yield raw(group)
                    group, size = [], 0
        if large:
            if group:
                yield raw(group)
        else:
            done += group
        if done:
            yield solved(done)

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows sorted by hashes and id: those with an id above their group's first."""
    last = None
    for batch in batches:
        h1, h2, doc, at = (long_array(batch.column(c)) for c in ("h1", "h2", "doc_id", "at"))
        if last is not None:
            h1, h2, doc, at = (np.concatenate(([a], b)) for a, b in zip(last, (h1, h2, doc, at)))
        begins = np.flatnonzero(_leaders(h1, h2))
        smallest = doc[begins][np.cumsum(_leaders(h1, h2)) - 1]
        again = doc > smallest
        spans = _spans(doc[again], at[again], np.ones(again.sum(), np.int64))
        last = [x[begins[-1]] for x in (h1, h2, doc, at)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(spans[0]), pa.array(spans[1]), pa.array(spans[2].astype(np.int32))],
            names=["doc_id", "at", "windows"])


def _remaining(threshold: int):
    """Merged byte spans of each text, and the text without them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, rests = [], [], []
            for found, text in zip(batch.column("runs").to_pylist(), unpacked(batch.column("packed"))):
                merged: list[list[int]] = []
                for run in sorted((r["at"] & ((1 << _AT) - 1), r["windows"]) for r in found or []):
                    start, end = run[0], run[0] + run[1] + threshold - 1
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(end, merged[-1][1])
                    else:
                        merged.append([start, end])
                rest, begin = [], 0
                for start, end in merged:
                    rest.append(text[begin:start])
                    begin = end
                sizes.append(len(text))
                spans.append([{"start": s, "end": e} for s, e in merged])
                rests.append(b"".join([*rest, text[begin:]]))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(rests, pa.binary()),
            ], names=["doc_id", "n_bytes", "spans", "kept"])

    return run


def repeated_windows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     threshold: int = THRESHOLD, digit: int = DIGIT,
                     group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Runs of window starts that a document with a smaller id has too: doc_id, at
    (text key and position), windows."""
    described = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("row"),
        F.col(text_col).alias("text"),
    ).mapInArrow(_described(threshold, digit), RUNS)
    settled = kept(
        described.repartition("digit").sortWithinPartitions("digit", "context", "doc_id")
        .mapInArrow(_settle, SETTLED), "repeat-runs", "open")
    runs = settled.where("open").groupBy("doc_id", F.shiftright("at", _AT).alias("row")).agg(
        F.collect_list(F.struct("digit", "at", "windows")).alias("runs"))
    depth = kept(
        packed_texts(documents, id_col, text_col).join(runs, ["doc_id", "row"])
        .mapInArrow(_contexts(threshold), "digit long, doc_id long, at long, content binary")
        .repartition("digit").sortWithinPartitions("digit")
        .mapInArrow(_full_depth(threshold, group_windows), FULL_DEPTH), "repeat-windows", "open")
    again = depth.where("open").repartition("h1").sortWithinPartitions("h1", "h2", "doc_id").mapInArrow(
        _later, "doc_id long, at long, windows int")
    columns = ["doc_id", "at", "windows"]
    return (settled.where("NOT open").select(*columns)
            .unionAll(depth.where("NOT open").select(*columns)).unionAll(again))


def without_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: int = THRESHOLD, **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (start, end of removed bytes)
    and kept, the remaining bytes."""
    found = repeated_windows(documents, id_col, text_col, threshold, **options)
    runs = found.groupBy("doc_id", F.shiftright("at", _AT).alias("row")).agg(
        F.collect_list(F.struct("at", "windows")).alias("runs"))
    return packed_texts(documents, id_col, text_col).join(runs, ["doc_id", "row"], "left").mapInArrow(
        _remaining(threshold),
        "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeats(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
