"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs, and decoding.

A vocabulary file of byte-level BPE is read once, on the driver, and sent to the tasks;
its size is bounded by its number of tokens. A text is cut at the vocabulary's added
tokens, then into words by its pattern. A word starts as one token per byte. The leaf at
position i of a segment tree holds the rank of the pair that starts at i, each inner node
the least of its leaves, ranks before positions, so the root is the leftmost pair of the
lowest rank. Merging it changes three leaves, each in logarithmic time, until the root
holds no pair: n log n steps for a word of n bytes, however long it is.

Short words are encoded many at a time, one tree for each in an array, and all trees take
their steps together. Their results are remembered, up to a bound; then the memory starts anew.
Rows are mapped one by one: no shuffle, nothing collected.

Defined results: a NULL or empty text has no tokens and decodes to an empty text; bytes
that are not UTF-8 are read as replacement characters, in encoding and in decoding;
NULL ids and repeated rows stay as they are; ids without a token decode to nothing;
other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.shingles import portions
from jobsignals.llm.tables import table

#: Pairs without a rank.
_NONE = 1 << 62
_POSITION = (1 << 32) - 1
#: Longest word that is remembered, in characters, and most words remembered by a task.
REMEMBERED_LENGTH = 48
REMEMBERED_WORDS = 500_000
#: Words that are encoded together.
TOGETHER = 20_000
#: Tokens that are decoded together, at least one text.
DECODED = 1 << 20
#: Texts of more characters are cut into words one at a time, not into a list.
LIST_CHARS = 1 << 21

# The pattern of byte-level vocabularies ({L}, {N}, {S}: letters, numbers, white space;
# {O}: all others), and the characters that its library does not yet know as letters or numbers
# (they joined Unicode after version 16).
_WORDS = r" ?{L}+| ?{N}+|'(?:s|t|re|ve|m|ll|d)| ?{O}+|{S}+(?![^{s}])|{S}+"
_NEW = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 "
    "10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 "
    "16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 "
    "1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 "
    "1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f")


def _class(ranges: str) -> str:
    ends = [part.split("-") for part in ranges.split()]
    return "[" + "".join(f"\\U{int(e[0], 16):08x}-\\U{int(e[-1], 16):08x}" for e in ends) + "]"


def _pattern(letters: str, numbers: str, others: str, space: str = r"\s") -> str:
    for name, kind in (("{L}", letters), ("{N}", numbers), ("{O}", others), ("{S}", f"[{space}]"), ("{s}", space)):
        pattern = _WORDS if name == "{L}" else pattern
        pattern = pattern.replace(name, kind)
    return pattern


#: Texts of characters below this one are cut by a pattern with plain classes, which is faster.
_LATIN_END = 0x250


def _latin() -> re.Pattern:
    kinds = {name: "".join(f"\\u{i:04x}" for i in range(_LATIN_END) if regex.match(name, chr(i)))
             for name in (r"\p{L}", r"\p{N}", r"\s")}
    letters, numbers, space = kinds.values()
    return re.compile(_pattern(f"[{letters}]", f"[{numbers}]", f"[^{letters}{numbers}{space}]", space))


_LATIN = _latin()
_NOT_LATIN = re.compile(f"[^\\x00-\\u{_LATIN_END - 1:04x}]")
_PLAIN = regex.compile(_pattern(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"), regex.V1)
_HAS_NEW = regex.compile(_class(_NEW))
_EXACT = regex.compile(_pattern(
    rf"[\p{{L}}--{_class(_NEW)}]", rf"[\p{{N}}--{_class(_NEW)}]", rf"[[^\s\p{{L}}\p{{N}}]||{_class(_NEW)}]"), regex.V1)


def _pattern_of(text: str) -> re.Pattern | regex.Pattern:
    if text.isascii() or not _NOT_LATIN.search(text):
        return _LATIN
    return _EXACT if _HAS_NEW.search(text) else _PLAIN


def _characters() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary: itself if it is printable,
    else the next of those from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in printable}
    for b in sorted(set(range(256)) - set(printable)):
        out[chr(0x100 + len(out) - len(printable))] = b
    return out


class _Remembered(dict):
    """Numbers of words, from 0 in the order in which they first come. Words longer than are
    kept have negative ones, from -1, which hold until they are taken with :attr:`long`."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.long: list[str] = []

    def __missing__(self, word: str) -> int:
        if len(word) > REMEMBERED_LENGTH:
            self.long.append(word)
            return -len(self.long)
        self[word] = number = len(self)
        self.new.append(word)
        return number


def _taken(offsets: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The values of some entries, one after another; ``offsets`` has one more than entries."""
    starts = offsets[at]
    ends = np.cumsum(offsets[at + 1] - starts)
    if not len(ends):
        return values[:0]
    begins = np.concatenate(([0], ends[:-1]))
    return values[np.repeat(starts - begins, ends - begins) + np.arange(ends[-1])]


class BytePairs:
    """A byte-level vocabulary: :meth:`encode` and :meth:`decode`."""

    def __init__(self, content: str) -> None:
        whole = json.loads(content)
        model, split = whole["model"], whole.get("pre_tokenizer") or {}
        plain = (
            model["type"] == "BPE" and not any(model.get(k) for k in (
                "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
            and not whole.get("normalizer"))
        added = whole.get("added_tokens", [])
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("not a plain byte-level BPE vocabulary")
        vocabulary, byte_of = model["vocab"], _characters()
        self.single = [vocabulary[c] for c, _ in sorted(byte_of.items(), key=lambda item: item[1])]
        #: Rank of each pair of tokens, in the upper bits of a leaf, and the token that a rank gives.
        self.leaves: dict[int, int] = {}
        self.result: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.leaves[vocabulary[left] << 32 | vocabulary[right]] = rank << 32
            self.result.append(vocabulary[left + right])
        self.added = {t["content"]: t["id"] for t in added}
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocabulary.items()}
        self.bytes_of |= {i: content.encode() for content, i in self.added.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        known = np.array(sorted(self.bytes_of), np.int64)
        #: Bytes of the tokens by id; an empty entry at the end for ids without one.
        self._bytes = pa.array([self.bytes_of.get(i, b"") for i in range(int(known[-1]) + 2)], pa.binary())
        self.words = _Remembered()
        #: Tokens of the words, by number.
        self._offsets, self._tokens = np.zeros(1, np.int64), np.empty(0, np.int32)
        # The same for many words at once: sorted pairs, their leaves, and what ranks give.
        keys = np.array(list(self.leaves), np.int64)
        order = np.argsort(keys)
        self._keys, self._leaves = keys[order], np.array(list(self.leaves.values()), np.int64)[order]
        self._result, self._single = np.array(self.result, np.int64), np.array(self.single, np.int64)

    def merged(self, word: bytes) -> list[int]:
        """Tokens of one word."""
        single, leaf_of, result = self.single, self.leaves.get, self.result
        ids = [single[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length()
        tree = [_NONE] * (2 * size)
        found = False
        for i in range(n - 1):
            leaf = leaf_of(ids[i] << 32 | ids[i + 1])
            if leaf is not None:
                tree[size + i] = leaf | i
                found = True
        if not found:
            return ids
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := tree[1]) != _NONE:
            i = root & _POSITION
            j = after[i]
            ids[i] = result[root >> 32]
            ids[j] = -1
            after[i] = k = after[j]
            changed = [(i, _NONE)]
            if k < n:
                before[k] = i
                leaf = leaf_of(ids[i] << 32 | ids[k])
                changed = [(j, _NONE), (i, _NONE if leaf is None else leaf | i)]
            elif j < n - 1:
                changed.append((j, _NONE))
            if i:
                h = before[i]
                leaf = leaf_of(ids[h] << 32 | ids[i])
                changed.append((h, _NONE if leaf is None else leaf | h))
            for at, value in changed:
                node = size + at
                if tree[node] == value:
                    continue
                tree[node] = value
                while node > 1:
                    other = tree[node ^ 1]
                    if other < value:
                        value = other
                    node >>= 1
                    if tree[node] == value:
                        break
                    tree[node] = value
        return [x for x in ids if x >= 0]

    def _leaf(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Leaves of many pairs; those with a token of -1 have no rank."""
        if not len(self._keys):
            return np.full(len(left), _NONE)
        keys = left << 32 | right & 0xFFFFFFFF
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), self._leaves[at] | place, _NONE)

    def merged_many(self, words: list[bytes], size: int) -> list[list[int]]:
        """Tokens of many words of 2 to ``size`` + 1 bytes, a segment tree of ``size`` (a power
        of two) leaves for each; all trees take a step together."""
        n = np.array([len(w) for w in words])
        padded = np.frombuffer(b"".join(w.ljust(size + 1, b"\0") for w in words), np.uint8).reshape(len(words), size + 1)
        place = np.arange(size + 1)
        ids = np.where(place < n[:, None], self._single[padded], -1)
        tree = np.empty((len(words), 2 * size), np.int64)
        left, right = np.ascontiguousarray(ids[:, :-1]).ravel(), np.ascontiguousarray(ids[:, 1:]).ravel()
        tree[:, size:] = self._leaf(left, right, np.tile(place[:-1], len(words))).reshape(len(words), size)
        width = size // 2
        while width:
            tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
            width //= 2
        after, before = np.tile(place + 1, (len(words), 1)), np.tile(place - 1, (len(words), 1))
        rows = np.arange(len(words))
        while True:
            root = tree[rows, 1]
            rows, root = rows[root != _NONE], root[root != _NONE]
            if not len(rows):
                break
            i = root & _POSITION
            j = after[rows, i]
            k = after[rows, j]
            ids[rows, i], ids[rows, j], after[rows, i] = self._result[root >> 32], -1, k
            more = k < n[rows]
            before[rows[more], k[more]] = i[more]
            following = np.where(more, ids[rows, np.minimum(k, size)], -1)
            h = before[rows, i]
            first = h >= 0
            held = j < size
            changed = [(rows[held], j[held], np.full(int(held.sum()), _NONE)),
                       (rows, i, self._leaf(ids[rows, i], following, i)),
                       (rows[first], h[first], self._leaf(ids[rows[first], h[first]], ids[rows[first], i[first]], h[first]))]
            for at, leaf, value in changed:
                tree[at, size + leaf] = value
            for at, leaf, _ in changed:
                node = size + leaf
                for _ in range(size.bit_length() - 1):
                    node = node >> 1
                    tree[at, node] = np.minimum(tree[at, 2 * node], tree[at, 2 * node + 1])
        kept = ids >= 0
        flat = ids[kept].tolist()
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _learn(self) -> None:
        """Encode the words that are new together."""
        found: list[list[int]] = [[] for _ in self.words.new]
        sizes: dict[int, list[tuple[int, bytes]]] = {}
        for at, word in enumerate(self.words.new):
            data = word.encode("utf-8", "replace")
            if len(data) < 2:
                found[at] = [self.single[b] for b in data]
            else:
                sizes.setdefault(max(1 << (len(data) - 2).bit_length(), 2), []).append((at, data))
        for size, some in sizes.items():
            for begin in range(0, len(some), TOGETHER):
                part = some[begin : begin + TOGETHER]
                for (at, _), ids in zip(part, self.merged_many([d for _, d in part], size)):
                    found[at] = ids
        self._offsets, self._tokens = self._with(found)
        self.words.new = []

    def _with(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words and of some more."""
        if not found:
            return self._offsets, self._tokens
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        tokens = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
        return (np.concatenate((self._offsets, self._offsets[-1] + np.cumsum(lengths))), np.concatenate((self._tokens, tokens)))

    def _numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))

    def _ids(self, numbers: list[np.ndarray]) -> list[np.ndarray]:
        """Tokens of the words with these numbers. Then the memory starts anew if it is full."""
        self._learn()
        offsets, tokens = self._with([self.merged(w.encode("utf-8", "replace")) for w in self.words.long])
        out = [_taken(offsets, tokens, np.where(n < 0, len(self.words) - 1 - n, n)) for n in numbers]
        self.words.long = []
        if len(self.words) > REMEMBERED_WORDS:
            self.words.clear()
            self._offsets, self._tokens = np.zeros(1, np.int64), np.empty(0, np.int32)
        return out

    def _cut(self, text: str) -> list[tuple[str, bool]]:
        """Sections between added tokens, and whether each is such a token."""
        return [(s, at % 2 == 1) for at, s in enumerate(self.cut.split(text) if self.cut else [text]) if s]

    def encode_arrays(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text. New short words of all of them are encoded together."""
        numbers: list[np.ndarray] = []
        parts: list[list[int | np.ndarray]] = []  # by text: a place in numbers, or tokens
        for text in texts:
            mine: list[int | np.ndarray] = []
            for section, added in self._cut(text):
                if added:
                    mine.append(np.array([self.added[section]], np.int32))
                    continue
                pattern = _pattern_of(section)
                if len(section) <= LIST_CHARS:
                    mine.append(len(numbers))
                    numbers.append(self._numbers(pattern.findall(section)))
                    continue
                # What came before has its numbers in the memory that may start anew.
                self._settle(parts, mine, numbers)
                found = (m.group() for m in pattern.finditer(section))
                while some := list(islice(found, 1 << 18)):
                    mine.extend(self._ids([self._numbers(some)]))
            parts.append(mine)
        self._settle(parts, [], numbers)
        return [p[0] if len(p) == 1 else np.concatenate([np.empty(0, np.int32), *p]) for p in parts]

    def _settle(self, parts: list[list], mine: list, numbers: list[np.ndarray]) -> None:
        """Tokens in place of the numbers of words."""
        ids = self._ids(numbers)
        numbers.clear()
        for some in (*parts, mine):
            some[:] = [ids[p] if isinstance(p, int) else p for p in some]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [ids.tolist() for ids in self.encode_arrays(texts)]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode_arrays(self, ids: pa.Array, lengths: np.ndarray) -> pa.Array:
        """The texts of some token ids, which are ``lengths`` to a text."""
        given = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        empty = len(self._bytes) - 1
        data = self._bytes.take(pa.array(np.where((given >= 0) & (given < empty), given, empty), pa.int32()))
        ends = np.concatenate(([0], np.cumsum(lengths)))
        offsets = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1)[ends]
        whole = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), data.buffers()[2]])
        try:
            return whole.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([t.decode("utf-8", "replace") for t in whole.to_pylist()], pa.string())

    def decode(self, ids: Iterable[int]) -> str:
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")


_LOADED: dict[str, BytePairs] = {}


def _loaded(content: str) -> BytePairs:
    """The vocabulary of this Python worker, read once for all its tasks."""
    if content not in _LOADED:
        _LOADED.clear()
        _LOADED[content] = BytePairs(content)
    return _LOADED[content]


def encoded(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token ids of each text under the vocabulary file ``path``: doc_id, ids."""
    content = _sent(documents.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _loaded(content.value)
        for doc_ids, texts in portions(batches, ("doc_id",), "text", limit=4 << 20):
            found = pairs.encode_arrays([t.decode("utf-8", "replace") for t in texts])
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))],
                names=["doc_id", "ids"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The text of each row of token ids: doc_id, ids, text. NULL ids have an empty text."""
    content = _sent(tokens.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _loaded(content.value)
        for batch in batches:
            lengths = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths, dtype=np.int64)
            row = 0
            while row < batch.num_rows:  # some texts at a time: one can be long
                before = ends[row - 1] if row else 0
                stop = max(int(np.searchsorted(ends, before + DECODED, side="right")), row + 1)
                some = batch.slice(row, stop - row)
                ids = some.column("ids")
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), ids, pairs.decode_arrays(ids.flatten(), lengths[row:stop])],
                    names=["doc_id", "ids", "text"])
                row = stop

    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, text string")


def _sent(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def op12_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = decoded(encoded(table(spark, sf_dir, "documents"), path), path)
    return texts.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
