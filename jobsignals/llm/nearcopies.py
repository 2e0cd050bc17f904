"""Near copies by a grouped prefix join on word shingles, with exact results.

Two documents link when the Jaccard similarity of their sets of five-word shingles is
0.8 or more. All sets follow one order of shingles: rare ones first, by hash within.
Linked documents then share a shingle among their first n - ceil(0.8 n) + 1 (prefix).

1. *Describe*: size, 128-bit set hash and a parity bitmap of each document, and a
   table of fixed size that counts shingles. Slots far above the mean hold frequent
   shingles and come last in the order. What the table misses costs time, not links.
2. *Group*: documents with identical prefixes and size form one group, which posts
   its prefix once per task; equal sets form one class. Shingles that a single group
   posts are dropped.
3. *Filter*: the lists that remain name pairs of groups. Sizes must fit, and parity
   bitmaps bound the difference of two sets from below: 9 popcount(x xor y) <= n + m
   holds for every linked pair. A group's bitmap knows the bits in which its classes agree.
4. *Expand* the group pairs that pass to pairs of classes, by the bitmaps of the classes.
   The classes of one group are a list of their own.
5. *Verify* the class pairs by their whole sets.

Lists with many candidates for their length, and those with a pair that a group of several
classes is in, are dense. For the components (:meth:`NearCopies.documents`) a dense list first
gives pairs that would connect its members, at most one per member, a group by one of
its classes; what is linked so is one component, and pairs within a component are not
looked at again. That is repeated while it connects, then all pairs between components are
taken. So a group of n near copies costs some n pairs, not n * n; pairs that are not
similar enough are all verified. The join's links (:meth:`NearCopies.pairs`) take all pairs of the
dense lists, and grow with the square of a group of differing near copies. There
dense lists are dealt out to tasks in pairs of slices of ``DENSE_ROWS``; a pair that shares
several lists comes from the least of them.

A group of copies costs one posting per task and shingle, and one class in the pairs.
Components are found in tables, not on the driver.

Defined results: documents without words or text (NULL, empty) have no shingles and
are their own component; a component's id is its least doc_id, NULL only if all are
NULL; rows of one id are rows of their own; equal rows get equal results; other
columns are ignored; no rows give no rows. Sets are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsignals.llm.components import components
from jobsignals.llm.shingles import mixed, portions, shingle_sets
from jobsignals.llm.tables import as_long, given, kept, long_array, table, text_key, veil_of, veiled

WORDS = 5
#: Slots of the table that counts shingles: 2 ** 18, one row each per task at most.
SLOT_BITS = 18
#: Part of a set, least hashes first, that is counted; a little over the prefix.
COUNTED = 0.3
LIST_ROWS = 20_000
#: Rows of a slice of a dense list, whose candidate pairs go with the square.
DENSE_ROWS = 2_000
BLOCK = 1024
#: Dense lists are searched for pairs that connect while one in so many connects.
LEAST_LINKED = 20
#: Documents up to which the ids to compare are sent to all tasks (16 bytes each).
BROADCAST_IDS = 1_000_000

DESCRIBED = ("kind string, doc_id long, row long, n int, set1 long, set2 long, bits binary, "
             "slots array<int>, counts array<long>")
POSTED = "token long, grp long, n int, set1 long, set2 long"


def _prefix(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, n - (4 * n + 4) // 5 + 1, 0)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums modulo 2 ** 64 of the values between offsets."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _set_hashes(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = mixed(values ^ np.uint64(0x5851F42D4C957F2D))
    return _sums(first, offsets), _sums(mixed(first + np.uint64(0x14057B7EF767814F)), offsets)


def _slots(values: np.ndarray) -> np.ndarray:
    return (mixed(values + np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _bitmap(values: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of about n slots (a power of two)."""
    size = max(64, 1 << (min(len(values), 1 << 15) - 1).bit_length())
    slots = (values & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(slots, minlength=size) & 1).astype(bool), bitorder="little").tobytes()


def _described(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "doc_id", "row", "n", "set1", "set2", "bits", "slots", "counts"]
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for ids, rows, texts in portions(batches, ("doc_id", "row"), "text"):
            offsets, values = shingle_sets(texts, words)
            n = np.diff(offsets)
            set1, set2 = _set_hashes(values, offsets)
            owner = np.repeat(np.arange(len(n)), n)
            inside = np.arange(len(values)) - offsets[owner]
            fresh = np.zeros(len(n), bool)
            fresh[np.unique(set1, return_index=True)[1]] = True
            part = (inside < np.maximum(_prefix(n), np.ceil(COUNTED * n))[owner]) & fresh[owner]
            counts += np.bincount(_slots(values[part]), minlength=len(counts))
            size = len(ids)
            yield pa.RecordBatch.from_arrays([
                pa.array(["doc"] * size), pa.array(ids, pa.int64()), pa.array(rows, pa.int64()),
                pa.array(n.astype(np.int32)), as_long(set1), as_long(set2),
                pa.array([_bitmap(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()),
                pa.nulls(size, pa.list_(pa.int32())), pa.nulls(size, pa.list_(pa.int64())),
            ], names=names)
        slots = np.flatnonzero(counts)
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array(["slot"]), none, none, none.cast(pa.int32()), none, none, pa.nulls(1, pa.binary()),
            pa.array([slots.astype(np.int32)], pa.list_(pa.int32())), pa.array([counts[slots]], pa.list_(pa.int64())),
        ], names=names)

    return run


def _frequent(described: DataFrame) -> np.ndarray:
    """Slots of frequent shingles: far above what the mean lets expect. At most
    2 ** SLOT_BITS numbers reach the driver."""
    slots = described.where("kind = 'slot'").select(F.explode(F.arrays_zip("slots", "counts")).alias("at"))
    slots = slots.groupBy(F.col("at.slots").alias("slot")).agg(F.sum("at.counts").alias("count"))
    mean = (slots.agg(F.sum("count")).first()[0] or 0) / (1 << SLOT_BITS)
    limit = mean + 10 * mean ** 0.5 + 32
    out = np.zeros(1 << SLOT_BITS, bool)
    out[[r["slot"] for r in slots.where(F.col("count") > limit).select("slot").collect()]] = True
    return np.packbits(out)


def _posted(words: int, frequent: np.ndarray):
    """Prefix shingles of each group, and the classes of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.unpackbits(frequent).astype(bool)
        for (texts,) in portions(batches, (), "text", limit=8 << 20):
            offsets, values = shingle_sets(texts, words)
            set1, set2 = _set_hashes(values, offsets)
            fresh = np.unique(set1, return_index=True)[1]
            fresh = fresh[np.diff(offsets)[fresh] > 0]
            late = last[_slots(values)]
            n = np.diff(offsets)[fresh]
            length = _prefix(n)
            prefixes = []
            for at, size in zip(fresh.tolist(), length.tolist()):
                found, late_ones = values[offsets[at] : offsets[at + 1]], late[offsets[at] : offsets[at + 1]]
                early = found[~late_ones]
                if len(early) < size:
                    early = np.concatenate((early, found[late_ones]))
                prefixes.append(early[:size])
            if not prefixes:
                continue
            tokens = np.concatenate(prefixes)
            bounds = np.concatenate(([0], np.cumsum(length)))
            grp = mixed(_sums(mixed(tokens), bounds) + n.astype(np.uint64))
            once = np.unique(grp, return_index=True)[1]
            posts = np.zeros(len(grp), bool)
            posts[once] = True
            owner = np.repeat(np.arange(len(n)), length)
            chosen = posts[owner]
            tokens, owner = tokens[chosen], owner[chosen]
            none = pa.nulls(len(tokens), pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([as_long(tokens), as_long(grp)]),
                pa.concat_arrays([as_long(grp[owner]), as_long(grp)]),
                pa.array(np.concatenate((n[owner], n)).astype(np.int32)),
                pa.concat_arrays([none, as_long(set1[fresh])]), pa.concat_arrays([none, as_long(set2[fresh])]),
            ], names=["token", "grp", "n", "set1", "set2"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shingle and group: repeated postings and shingles of a single
    group are left out. One row is held from batch to batch."""
    names = ["token", "grp", "n", "set1", "set2"]
    held = None
    for batch in batches:
        classes = batch.filter(batch.column("set1").is_valid())
        if classes.num_rows:
            yield classes
        batch = batch.filter(batch.column("set1").is_null())
        token, grp, n = (long_array(batch.column(c)) for c in names[:3])
        sent = np.zeros(len(token), bool)
        if held is not None:
            token, grp, n, sent = (np.concatenate(([a], b)) for a, b in zip(held, (token, grp, n, sent)))
        if not len(token):
            continue
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (grp[1:] != grp[:-1])
        token, grp, n, sent = token[new], grp[new], n[new], sent[new]
        begins = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        sizes = np.diff(np.append(begins, len(token)))
        several = np.repeat((sizes > 1) | sent[begins], sizes)
        out = several & ~sent
        held = (token[-1], grp[-1], n[-1], several[-1])
        if out.any():
            none = pa.nulls(int(out.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(token[out]), pa.array(grp[out]), pa.array(n[out].astype(np.int32)), none, none], names=names)


def _agreed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of rows that lie together in one, by grp: the least node, its bitmap, and the bits
    in which all agree (NULL in a group of one class, where all do)."""
    whole: dict[int, tuple] = {}

    def given_back() -> pa.RecordBatch:
        rows = [(grp, *row) for grp, row in whole.items()]
        whole.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
            names=["grp", "node", "n", "bits", "known"])

    last = None
    for batch in batches:
        for grp, *row in zip(*(batch.column(c).to_pylist() for c in ("grp", "node", "n", "bits", "known"))):
            if grp != last and len(whole) >= 10_000:
                yield given_back()
            last = grp
            if grp not in whole:
                whole[grp] = tuple(row)
                continue
            one, other = sorted((whole[grp], tuple(row)))
            x, y = (np.frombuffer(r[2], np.uint8) for r in (one, other))
            known = ~(x ^ y)
            for r in (one, other):
                known = known if r[3] is None else known & np.frombuffer(r[3], np.uint8)
            whole[grp] = (*one[:3], known.tobytes())
    if whole:
        yield given_back()


class _Bits:
    """Parity bitmaps of a list's members, to compare one with many. Of some members only
    some bits are known, the others count as equal."""

    def __init__(self, sizes: np.ndarray, bits: list[bytes], known: list[bytes | None]) -> None:
        self.sizes, self.bits = sizes, bits
        self.words = np.array([len(b) // 8 for b in bits])
        self.known = [b"\xff" * len(x) if k is None else k for k, x in zip(known, bits)] if any(known) else None
        self.by_length: dict[tuple[int, bool], np.ndarray] = {}

    def _folded(self, length: int, known: bool = False) -> np.ndarray:
        """All bitmaps of at least ``length`` words, folded to it; others are zero."""
        if (length, known) not in self.by_length:
            out = np.zeros((len(self.bits), length), np.uint64)
            source, fold = (self.known, np.bitwise_and) if known else (self.bits, np.bitwise_xor)
            for words in np.unique(self.words[self.words >= length]):
                at = np.flatnonzero(self.words == words)
                raw = np.frombuffer(b"".join(source[i] for i in at), np.uint64)
                out[at] = fold.reduce(raw.reshape(len(at), words // length, length), axis=1)
            self.by_length[length, known] = out
        return self.by_length[length, known]

    def _differences(self, one: int, others: np.ndarray, length: int) -> np.ndarray:
        """Lower bounds of the set differences to others, by bitmaps of some length."""
        rows = self._folded(length)
        apart = rows[others] ^ rows[one]
        if self.known is not None:
            known = self._folded(length, True)
            apart &= known[others] & known[one]
        return np.bitwise_count(apart).sum(axis=1, dtype=np.int64)

    def near(self, one: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` (any sizes) that can link with ``one``."""
        n, m = self.sizes[one], self.sizes[others]
        others = others[(5 * np.minimum(n, m) >= 4 * np.maximum(n, m)) & (others != one)]
        bounds = np.empty(len(others), np.int64)
        lengths = np.minimum(self.words[others], self.words[one])
        for length in np.unique(lengths):
            at = lengths == length
            bounds[at] = self._differences(one, others[at], int(length))
        return others[9 * bounds <= n + self.sizes[others]]


def _lists(batches: Iterator[pa.RecordBatch], key: tuple[str, ...], columns: tuple[str, ...], block: int | None):
    """Rows of one list after another, in blocks of up to ``block`` rows."""
    at, held = None, []
    for batch in batches:
        for row in zip(zip(*(batch.column(c).to_pylist() for c in key)),
                       *(batch.column(c).to_pylist() for c in columns)):
            if row[0] != at or (block and len(held) >= block):
                if len(held) > 1:
                    yield at, held
                at, held = row[0], []
            held.append(row[1:])
    if len(held) > 1:
        yield at, held


def _pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    unique = sorted({(min(p), max(p)) for p in pairs})
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in unique], pa.int64()), pa.array([p[1] for p in unique], pa.int64())], names=["a", "b"])


def _near_pairs(sizes: list[int], bits: list[bytes]) -> list[tuple[int, int]]:
    """All candidate pairs of a short list."""
    whole = [int.from_bytes(b, "little") for b in bits]
    pairs = []
    for i, j in combinations(range(len(sizes)), 2):
        if 5 * min(sizes[i], sizes[j]) < 4 * max(sizes[i], sizes[j]):
            continue
        x, y, width = whole[i], whole[j], min(len(bits[i]), len(bits[j])) * 8
        for length in _halves(len(bits[i]) * 8, width):
            x = (x >> length) ^ (x & ((1 << length) - 1))
        for length in _halves(len(bits[j]) * 8, width):
            y = (y >> length) ^ (y & ((1 << length) - 1))
        if 9 * (x ^ y).bit_count() <= sizes[i] + sizes[j]:
            pairs.append((i, j))
    return pairs


def _halves(width: int, least: int) -> Iterator[int]:
    while width > least:
        width //= 2
        yield width


def _few(members: _Bits, labels: np.ndarray, most: int) -> list[tuple[int, int]] | None:
    """All candidate pairs of a list that differ in label, or None if they are more than ``most``."""
    pairs: list[tuple[int, int]] = []
    numbers = np.arange(len(members.sizes))
    for at in range(len(numbers) - 1):
        others = numbers[at + 1 :]
        pairs += [(at, other) for other in members.near(at, others[labels[others] != labels[at]]).tolist()]
        if len(pairs) > most:
            return None
    return pairs


def _connecting(members: _Bits, labels: np.ndarray) -> list[tuple[int, int]]:
    """Candidate pairs that, if all were links, would connect what all candidates of the list
    connect: at most one less than members. Members of one label are connected."""
    labels, pairs = labels.copy(), []
    numbers = np.arange(len(labels))
    for at in numbers[:-1].tolist():
        others = numbers[at + 1 :]
        near = members.near(at, others[labels[others] != labels[at]])
        new, first = np.unique(labels[near], return_index=True)
        pairs += [(at, other) for other in near[first].tolist()]
        if len(new):
            labels[np.isin(labels, new)] = labels[at]
    return pairs


#: A list with more candidate pairs per member is dense.
PAIRS_PER_MEMBER = 4
#: What a task knows of a member of a list; the label is that of its component so far.
MEMBER = ("node", "n", "bits", "known", "label")


def _closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of each list; of dense or long lists those that connect, and the token."""
    out: list[tuple[int, int]] = []
    again: list[int] = []

    def rows_of(tokens: list[int], pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        batch = _pairs_batch(pairs)
        tokens = sorted(set(tokens))
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([batch.column(0), pa.nulls(len(tokens), pa.int64())]),
            pa.concat_arrays([batch.column(1), pa.nulls(len(tokens), pa.int64())]),
            pa.concat_arrays([pa.nulls(batch.num_rows, pa.int64()), pa.array(tokens, pa.int64())]),
        ], names=["a", "b", "token"])

    last = None
    for (token,), rows in _lists(batches, ("token",), MEMBER, BLOCK):
        nodes, sizes, bits, known, labels = (list(c) for c in zip(*rows))
        several = any(known)
        if len(rows) <= 6 and not several:
            pairs = [(i, j) for i, j in _near_pairs(sizes, bits) if labels[i] != labels[j]]
        else:
            members, labels = _Bits(np.array(sizes), bits, known), np.array(labels)
            pairs = None if len(rows) == BLOCK else _few(members, labels, PAIRS_PER_MEMBER * len(rows))
            if pairs is None:
                pairs = _connecting(members, labels)
                again.append(token)
            elif any(known[i] or known[j] for i, j in pairs):
                again.append(token)
        if token == last:  # the blocks of a list are not compared with each other
            again.append(token)
        out += [(nodes[i], nodes[j]) for i, j in pairs]
        last = token
        if len(out) > 50_000:
            yield rows_of(again, out)
            out, again = [], []
    yield rows_of(again, out)


def _among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of each pair of slices, or of members of one slice, with the groups of
    those that stand for several classes. A pair belongs to the least of the lists that hold
    both of its members, so no other list gives it."""
    out: list[tuple] = []
    kinds = (("a", pa.int64()), ("b", pa.int64()), ("ga", pa.int64()), ("gb", pa.int64()))

    def rows_of(pairs: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], kind) for i, (_, kind) in enumerate(kinds)],
                                          names=[name for name, _ in kinds])

    for (token, i, j), rows in _lists(batches, ("token", "i", "j"), (*MEMBER, "grp", "slice", "lists"), None):
        nodes, sizes, bits, known, labels, groups, slices, lists = zip(*rows)
        earlier = [{t for t in found if t < token} for found in lists]
        slices, labels = np.array(slices), np.array(labels)
        members = _Bits(np.array(sizes), list(bits), list(known))
        groups = [g if k else None for g, k in zip(groups, known)]
        numbers = np.arange(len(rows))
        for at in range(len(rows) - 1):
            others = numbers[at + 1 :] if i == j else numbers[at + 1 :][slices[at + 1 :] != slices[at]]
            others = others[labels[others] != labels[at]]
            out += [(nodes[at], nodes[y], groups[at], groups[y]) for y in members.near(at, others).tolist()
                    if earlier[at].isdisjoint(earlier[y])]
            if len(out) > 50_000:
                yield rows_of(out)
                out = []
    yield rows_of(out)


def _fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes from pairs of groups that pass the filter themselves."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("a", "n", "x", "b", "m", "y")))
        yield _pairs_batch([(a, b) for a, n, x, b, m, y in rows if _near_pairs([n, m], [x, y])])


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, texts in portions(batches, ("node",), "text"):
            offsets, values = shingle_sets(texts, words)
            yield pa.RecordBatch.from_arrays([
                pa.array(nodes, pa.int64()),
                pa.array([values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()),
            ], names=["node", "shingles"])

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y"))):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= 80 * (len(x) + len(y) - common):
                out.append((a, b))
        yield _pairs_batch(out)


class NearCopies:
    """The join on one table: :meth:`pairs` gives its links, :meth:`documents` the components."""

    def __init__(self, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = WORDS, list_rows: int = LIST_ROWS, broadcast_ids: int = BROADCAST_IDS) -> None:
        self.words, self.list_rows, self.broadcast_ids = words, list_rows, broadcast_ids
        self._links: DataFrame | None = None
        self.texts = documents.select(
            F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("row"),
            F.col(text_col).alias("text"))
        self.described = kept(self.texts.mapInArrow(_described(words), DESCRIBED), "described", "kind")
        docs = self.described.where("kind = 'doc'")
        self.rows = docs.select("doc_id", "row", "n", "set1", "set2")
        place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
        self.classes = kept(
            docs.where("n > 0").groupBy("set1", "set2").agg(
                F.first("n").alias("n"), F.first("bits").alias("bits"), F.min(place).alias("place"))
            .withColumn("node", F.monotonically_increasing_id()), "classes")

    def members(self) -> DataFrame:
        """Groups in the lists of shared prefix shingles, and classes in the list of their group:
        token, node (a group's least class), grp (NULL in the latter), n, bits, known."""
        posted = self.texts.select("text").mapInArrow(_posted(self.words, _frequent(self.described)), POSTED)
        shared = kept(
            posted.repartition("token").sortWithinPartitions("token", "grp").mapInArrow(_shared, POSTED)
            .withColumn("kind", F.when(F.col("set1").isNull(), "list").otherwise("group")), "lists", "kind")
        self.groups = kept(
            shared.where("kind = 'group'").select("grp", "set1", "set2").distinct()
            .join(self.classes.select("set1", "set2", "node", "n", "bits"), ["set1", "set2"])
            .select("grp", "node", "n", "bits", F.lit(None).cast("binary").alias("known")), "groups")
        whole = kept(
            self.groups.mapInArrow(_agreed, self.groups.schema).repartition("grp").sortWithinPartitions("grp")
            .mapInArrow(_agreed, self.groups.schema), "groups")
        inside = self.groups.join(whole.where("known IS NOT NULL").select("grp"), "grp").select(
            F.col("grp").alias("token"), "node", F.lit(None).cast("long").alias("grp"), "n", "bits", "known")
        lists = shared.where("kind = 'list'").select("token", "grp").join(whole, "grp")
        return lists.select("token", "node", "grp", "n", "bits", "known").unionAll(inside)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose whole sets are similar enough."""
        ids = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
        wanted = kept(ids.join(self.classes.select("node", "place"), "node").select("node", "place.doc_id", "place.row"),
                      "compared")
        if wanted.limit(self.broadcast_ids + 1).count() <= self.broadcast_ids:
            wanted = F.broadcast(wanted)
        same = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.row") == F.col("w.row"))
        sets = (
            self.texts.alias("t").join(wanted.alias("w"), same).select("node", "text")
            .mapInArrow(_sets(self.words), "node long, shingles binary").dropDuplicates(["node"]))
        sets = kept(sets, "sets")
        return (
            pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .mapInArrow(_linked, "a long, b long"))

    def connecting(self, members: DataFrame, turn: int = 0) -> tuple[DataFrame, DataFrame]:
        """Candidate pairs of classes (a, b): all of lists that are not dense, some that connect
        of the dense ones; and the tokens of the dense ones. Long lists are cut into other
        blocks each turn."""
        order = ("n", "node") if not turn else (F.xxhash64("node", F.lit(turn)), "node")
        closest = kept(members.repartition("token").sortWithinPartitions("token", *order)
                       .mapInArrow(_closest, "a long, b long, token long").distinct(), "candidates")
        return (closest.where("token IS NULL").select("a", "b"),
                closest.where("token IS NOT NULL").select("token"))

    def between(self, everywhere: DataFrame, members: DataFrame, labels: DataFrame | None) -> DataFrame:
        """All candidate pairs of classes in some lists, ``members``, that differ in label. A
        member's lists among ``everywhere`` are no more than its prefix and its group."""
        place = ["node", F.coalesce("grp", F.lit(0)).alias("place__")]
        lists = everywhere.select("token", *place).groupBy("node", "place__").agg(F.collect_set("token").alias("lists"))
        members = members.withColumn("place__", F.coalesce("grp", F.lit(0)))
        members = kept(members.join(lists, ["node", "place__"]), "members")
        rows = min(self.list_rows, DENSE_ROWS)
        sizes = members.groupBy("token").count().select(
            "token", F.ceil(F.col("count") / rows).cast("int").alias("slices"))
        dealt = members.join(sizes, "token").withColumn("slice", F.pmod(F.xxhash64("node"), "slices").cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        dealt = dealt.select("token", F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"),
                             "slice", "node", "grp", "n", "bits", "known", "label", "lists")
        among = kept(dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "node")
                     .mapInArrow(_among, "a long, b long, ga long, gb long"), "grouped")
        return among.where("ga IS NULL AND gb IS NULL").select("a", "b").unionAll(
            self._expanded(among.where("ga IS NOT NULL OR gb IS NOT NULL"), labels)).distinct()

    def _expanded(self, grouped: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Pairs of classes of pairs of groups; a side without a group is one class."""
        classes = self.classes.select("node", "n", "bits")
        if labels is None:
            classes = classes.withColumn("label", F.col("node"))
        else:
            classes = classes.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
        of_group = self.groups.select("grp", "node").join(classes.select("node", "n", "bits", "label"), "node")
        for side, group, n, bits, label in (("a", "ga", "n", "x", "p"), ("b", "gb", "m", "y", "q")):
            rest = [c for c in grouped.columns if c not in (side, group)]
            single = grouped.where(F.col(group).isNull()).join(
                classes.select(F.col("node").alias(side), F.col("n").alias(n), F.col("bits").alias(bits),
                               F.col("label").alias(label)), side)
            several = grouped.where(F.col(group).isNotNull()).drop(side).join(
                of_group.select(F.col("grp").alias(group), F.col("node").alias(side), F.col("n").alias(n),
                                F.col("bits").alias(bits), F.col("label").alias(label)), group)
            columns = [*rest, side, n, bits, label]
            grouped = single.select(*columns).unionAll(several.select(*columns))
        return grouped.where("p <> q").select("a", "n", "x", "b", "m", "y").mapInArrow(_fitting, "a long, b long")

    def links(self) -> DataFrame:
        """All linked pairs of classes, each once: a, b."""
        if self._links is None:
            members = kept(self.members().withColumn("label", F.monotonically_increasing_id()), "members")
            found, dense = self.connecting(members)
            open_ = members.join(dense, "token", "left_semi")
            found = found.unionAll(self.between(members, kept(open_, "members"), None)).distinct()
            self._links = kept(self.verified(kept(found, "candidates")), "verified")
        return self._links

    def linked(self) -> DataFrame:
        """The component of each class that has a link: node, component. Dense lists are
        looked at again only as far as their members are not connected yet."""
        everywhere = kept(self.members().withColumn("label", F.monotonically_increasing_id()), "members")
        members, labels, joined, turn, going = everywhere, None, 0, 0, True
        while True:
            if going:
                found, dense = self.connecting(members, turn)
            else:
                found, dense = kept(self.between(everywhere, members, labels), "candidates"), None
            new = kept(self.verified(found), "verified")
            if labels is not None:
                new = new.unionAll(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
            labels = components(new)
            if dense is None or dense.isEmpty():
                return labels
            members = kept(self._apart(members.join(dense, "token", "left_semi"), labels), "members")
            if members.isEmpty():
                return labels
            before, joined = joined, labels.where("node <> component").count()
            going = joined > before and LEAST_LINKED * (joined - before) >= found.count()
            turn += 1

    def _apart(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members with the labels of their components; lists of one component are left out. A
        group in several components is no part of any."""
        of_class = members.where("grp IS NULL").drop("label").join(labels, "node", "left")
        of_class = of_class.withColumn("label", F.coalesce("component", "node")).drop("component")
        of_group = members.where("grp IS NOT NULL").drop("label")
        classes = self.groups.select("grp", "node").join(of_group.select("grp").distinct(), "grp").join(labels, "node", "left")
        label = F.coalesce("component", "node")
        groups = classes.groupBy("grp").agg(F.min(label).alias("least"), F.max(label).alias("most"))
        of_group = of_group.join(groups, "grp").withColumn(
            "label", F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(-1 - F.col("node")))
        members = kept(of_class.unionByName(of_group.drop("least", "most")), "members")
        mixed_up = F.max(F.col("label") < 0)
        lists = members.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most"), mixed_up.alias("mixed"))
        return members.join(lists.where("mixed OR least <> most").select("token"), "token", "left_semi")

    def pairs(self) -> DataFrame:
        """The join's result: all linked pairs of class representatives, the rows least by
        id and text key among those of equal sets: a_id, a_row, b_id, b_row."""
        place = self.classes.select("node", "place.doc_id", "place.row")
        return (
            self.links().join(place.toDF("a", "a_id", "a_row"), "a").join(place.toDF("b", "b_id", "b_row"), "b")
            .select("a_id", "a_row", "b_id", "b_row"))

    def documents(self) -> DataFrame:
        """One row per document: doc_id, row (text key), n_shingles, component_id and
        stays, true for the component's first document by id and text key."""
        labels = self.linked()
        known = self.classes.select("set1", "set2", "node", "place").join(labels, "node", "left")
        known = kept(known.withColumn("component", F.coalesce("component", "node")), "known")
        first = known.groupBy("component").agg(F.min("place").alias("first"))
        known = known.join(first, "component").select("set1", "set2", "first")
        found = self.rows.join(known, ["set1", "set2"], "left")
        lone = F.col("first").isNull()
        here = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))
        return found.select(
            "doc_id", "row", F.col("n").cast("long").alias("n_shingles"),
            F.when(lone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
            (lone | here).alias("stays"))


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without near copies: of each component the row with the least id
    stays; documents without words all stay."""
    found = NearCopies(documents, id_col, text_col, **options).documents().where("stays")
    stays = found.groupBy(F.coalesce("doc_id", F.lit(0)).alias("known__"), F.col("doc_id").isNull().alias("null__"),
                          F.col("row").alias("row__")).agg(F.max("n_shingles").alias("n__"))
    key = F.col(veil_of(documents, id_col)).cast("long")
    keyed = veiled(documents).withColumns({
        "known__": F.coalesce(key, F.lit(0)), "null__": key.isNull(),
        "row__": text_key(F.col(veil_of(documents, text_col)))})
    turn = F.row_number().over(Window.partitionBy("known__", "null__", "row__").orderBy(F.lit(0)))
    chosen = keyed.withColumn("turn__", turn).join(stays, ["known__", "null__", "row__"])
    return chosen.where((F.col("turn__") == 1) | (F.col("n__") == 0)).select(*given(documents))


def op5_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearCopies(table(spark, sf_dir, "documents")).documents().select("doc_id", "n_shingles", "component_id")
