"""Phrase collocations by stripes: each prefix keys an associative next-word counter.

A stripe belongs to a prefix of 0 to 3 words and maps each next word to a count. One
structure gives all that is asked for: an entry is the number of occurrences of prefix
and next word; the empty prefix's stripe counts the words, and its total is n; the
entries of a stripe are the extensions of its phrase to the right, so their maximum says
whether a longer phrase subsumes it, and regrouped by suffix they do so to the left.

1. *Words*: stripes of the empty prefix.
2. *Longer*: stripes of one, two and three words, a pass over the texts for each. A phrase
   is frequent only if its first and its last words, one fewer, are; a filter of bounded
   size, with bits set by hashes of the frequent phrases of the pass before, tells nearly
   all others. What it lets through wrongly is counted and then dropped.

A task builds its stripes over portions of ``PORTION`` bytes of one language, with words
numbered by a dictionary, so counts are exact; stripes travel whole and are merged
elementwise by (prefix, next word) after one shuffle, in blocks of a hash of the prefix. The stripe of a prefix is cut by
hashes of the next word where all its words are frequent (more than ``SPLIT``
occurrences or a 50,000th of all, so at most 50,000 words are known to the tasks), that
of the empty prefix always. Merging goes block by block; no task holds a whole hot stripe.

Defined results: NULL texts are empty, a NULL lang is ``und``; repeated rows count each
time; ids play no part; phrases of one score and count are ordered by their bytes; words
are runs of bytes other than space and tab, of any length; other columns are ignored; no
rows, or no candidates, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsignals.llm.bytehash import mix64
from jobsignals.llm.tables import kept, looked_up, table, text_bytes

LEAST = 30
TOP = 2_000
PORTION = 24 << 20
SPLIT = 200_000
#: Parts of the empty prefix's stripe.
WORD_PARTS = 256
#: Bits of a filter per phrase, and its largest size in bits (8 MB).
BITS, MOST_BITS = 16, 1 << 26

#: Stripes travel in blocks by a hash of the prefix: so many at least, and four per shuffle partition.
BLOCKS = 1024

STRIPES = ("lang string, size int, block int, "
           "stripes array<struct<prefix:string,next:array<string>,counts:array<long>>>")

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_FOLDED = bytes(
    0x0A if b in _SEPARATORS else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Numbers of words in the order they come; 0 is no word, 1 ends a piece."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Portion:
    """Words of one language, as numbers."""

    def __init__(self) -> None:
        self.numbers = _Numbers({b"": 0, b"\n": 1})
        self.parts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, texts: list[bytes]) -> None:
        data = b"\n".join(texts).translate(_FOLDED)
        words = data.replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        self.parts += [ids[ids != 0].astype(np.int32), np.array([1], np.int32)]
        self.bytes += len(data)

    def ids(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.empty(0, np.int32)

    def words(self) -> list[bytes]:
        return list(self.numbers)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Portion]]:
    """Portions of the texts (columns lang, text), by language."""
    open_ones: dict[str, _Portion] = {}
    waiting: dict[str, list[bytes]] = {}
    held, total = 0, 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), text_bytes(batch.column("text"))):
            waiting.setdefault(lang, []).append(text)
            held += len(text)
            if held >= 1 << 21:
                for name, texts in waiting.items():
                    open_ones.setdefault(name, _Portion()).add(texts)
                total, held, waiting = total + held, 0, {}
            if total >= PORTION:
                yield from open_ones.items()
                open_ones, total = {}, 0
    for name, texts in waiting.items():
        open_ones.setdefault(name, _Portion()).add(texts)
    yield from open_ones.items()


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _joined_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix64(first * _STEP + second)


class Filter:
    """Bits that frequent phrases set; a phrase whose bits are not all set is not frequent."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
        mask = np.uint64(size - 1)
        return [mix64(hashes + np.uint64(salt)) & mask for salt in (1, 2)]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for places in self.places(hashes, 64 * len(self.bits)):
            out &= (self.bits[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out

    @classmethod
    def of(cls, phrases: DataFrame) -> Filter:
        """The filter of the phrases (lang, phrase), all of one number of words. Its size
        follows from their number and is bounded; the driver puts its words together."""
        size = 1 << max(12, min(MOST_BITS, BITS * phrases.count() + 1).bit_length() - 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(size // 64, np.uint64)
            for batch in batches:
                for lang in batch.column("lang").unique().to_pylist():
                    some = batch.filter(pc.equal(batch.column("lang"), lang)).column("phrase").to_pylist()
                    parts = [p.encode().split(b" ") for p in some]
                    hashes = _hashes(lang, [p[0] for p in parts])
                    for i in range(1, len(parts[0])):
                        hashes = _joined_hashes(hashes, _hashes(lang, [p[i] for p in parts]))
                    for places in cls.places(hashes, size):
                        np.bitwise_or.at(bits, places >> np.uint64(6), np.uint64(1) << (places & np.uint64(63)))
            at = np.flatnonzero(bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(bits[at].view(np.int64))], names=["at", "bits"])

        found = (phrases.select("lang", "phrase").mapInArrow(run, "at int, bits long")
                 .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
        bits = np.zeros(size // 64, np.uint64)
        bits[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return cls(bits)


def _batches(lang: str, size: int, prefix: pa.Array, first: np.ndarray, part: np.ndarray, hashes: np.ndarray,
             following: pa.Array, counts: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """Stripes from entries: ``first`` is the number of the entry's prefix in ``prefix`` and
    ``hashes``, ``part`` the part of its stripe."""
    block = (mix64(hashes[first] + part.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)
    order = np.lexsort((part, first, block))
    first, part, block, counts = first[order], part[order], block[order], counts[order]
    changes = (first[1:] != first[:-1]) | (part[1:] != part[:-1])
    begins = np.flatnonzero(np.concatenate((np.ones(min(len(first), 1), bool), changes)))
    ends = np.append(begins[1:], len(first))
    rows = np.flatnonzero(np.diff(block[begins], prepend=-1))  # the first stripe of each block
    stops = np.append(rows[1:], len(begins))
    at = 0
    while at < len(rows):  # some blocks at a time, of about 100,000 entries
        to = max(at + 1, int(np.searchsorted(ends[stops - 1], begins[rows[at]] + 100_000)))
        b, e = begins[rows[at] : stops[to - 1]], ends[rows[at] : stops[to - 1]]
        inner = pa.array(np.append(b - b[0], e[-1] - b[0]).astype(np.int32))
        stripes = pa.StructArray.from_arrays([
            prefix.take(pa.array(first[b])),
            pa.ListArray.from_arrays(inner, following.take(pa.array(order[b[0] : e[-1]]))),
            pa.ListArray.from_arrays(inner, pa.array(counts[b[0] : e[-1]])),
        ], names=["prefix", "next", "counts"])
        outer = np.append(rows[at:to], stops[to - 1]) - rows[at]
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * (to - at)), pa.array(np.full(to - at, size, np.int32)),
            pa.array(block[begins[rows[at:to]]].astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(outer.astype(np.int32)), stripes),
        ], names=["lang", "size", "block", "stripes"])
        at = to


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def _word_stripes(blocks: int):
    """Stripes of the empty prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, portion in _portions(batches):
            counts = np.bincount(portion.ids(), minlength=2).astype(np.int64)[2:]
            words = portion.words()[2:]
            part = (_hashes(lang, words) % np.uint64(WORD_PARTS)).astype(np.int64)
            yield from _batches(lang, 0, pa.array([""]), np.zeros(len(words), np.int64), part, np.zeros(1, np.uint64),
                                _strings(words), counts, blocks)

    return run


def _parts_of(lang: str, words: list[bytes], frequent: dict[tuple[str, bytes], int]) -> np.ndarray:
    """Into how many parts the stripe of each word is cut; 1 for all but frequent words."""
    return np.fromiter((frequent.get((lang, w), 1) for w in words), np.int64, len(words))


def _numbered(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and for each value its number among them."""
    return np.unique(codes, return_inverse=True)


def _longer_stripes(size: int, shorter, frequent, blocks: int):
    """Stripes of ``size`` words; the filter holds the frequent phrases of this size, and
    both the prefix and the phrase's last ``size`` words must pass it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes, split = Filter(shorter.value), frequent.value
        for lang, portion in _portions(batches):
            ids, words = portion.ids().astype(np.int64), portion.words()
            if len(ids) <= size:
                continue
            hashes, names = _hashes(lang, words), _strings(words)
            inside, gram = ids > 1, hashes[ids]
            for i in range(1, size):
                gram = _joined_hashes(gram[:-1], hashes[ids[i:]])
                inside = inside[:-1] & (ids[i:] > 1)
            good = inside & passes(gram)
            at = np.flatnonzero(good[:-1] & good[1:])
            if not len(at):
                continue
            # Number the prefixes word by word, then the phrases: exact, whatever the hashes.
            prefixes = ids[at]
            members = [prefixes]
            for i in range(1, size):
                distinct, number = _numbered(prefixes << 32 | ids[at + i])
                members = [m[distinct >> 32] for m in members] if i > 1 else [distinct >> 32]
                members.append(distinct & 0xFFFFFFFF)
                prefixes = number
            if size == 1:
                distinct, prefixes = _numbered(prefixes)
                members = [distinct]
            phrases_found, counts = np.unique(prefixes << 32 | ids[at + size], return_counts=True)
            first, last = phrases_found >> 32, phrases_found & 0xFFFFFFFF
            parts = _parts_of(lang, words, split)
            cut = np.minimum.reduce([parts[m] for m in members])[first]
            joined = hashes[members[0]]
            for m in members[1:]:
                joined = _joined_hashes(joined, hashes[m])
            taken = [names.take(pa.array(m)) for m in members]
            yield from _batches(
                lang, size, taken[0] if size == 1 else pc.binary_join_element_wise(*taken, " "), first,
                (hashes[last] % cut.astype(np.uint64)).astype(np.int64), joined, names.take(pa.array(last)),
                counts.astype(np.int64), blocks)

    return run


#: Entries after which a task merges what it holds.
MERGED = 1 << 21
_ENTRIES = ["lang", "size", "prefix", "next"]


def _entries(batch: pa.RecordBatch) -> pa.Table:
    """The entries of a batch's stripes, and the number of the row each came in."""
    column = batch.column("stripes")
    stripes = column.flatten()
    row = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
    following = stripes.field("next")
    stripe = np.repeat(np.arange(len(stripes)), following.value_lengths().to_numpy())
    row = row[stripe]
    at = pa.array(row)
    return pa.table({
        "lang": batch.column("lang").take(at), "size": batch.column("size").take(at),
        "prefix": stripes.field("prefix").take(pa.array(stripe)), "next": following.flatten(),
        "count": stripes.field("counts").flatten(), "row": at})


def _summed(entries: pa.Table) -> pa.Table:
    out = entries.group_by(_ENTRIES).aggregate([("count", "sum")])
    return out.rename_columns([*_ENTRIES, "count"]).select([*_ENTRIES, "count"])


def _merging(least: int):
    """Stripes of one block after another, merged elementwise; a block that goes on in the next
    batch waits for it, and a long one is merged on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # whole blocks
        last: list[pa.Table] = []  # the block that may go on
        key = None

        def flush() -> Iterator[pa.RecordBatch]:
            found = _summed(pa.concat_tables(held))
            yield from found.filter(pc.greater_equal(found["count"], least)).combine_chunks().to_batches()
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "size", "block"))))
            begin = keys.index(keys[-1])  # rows are sorted: the last block's first row
            entries = _entries(batch)
            cut = int(np.searchsorted(entries["row"].to_numpy(), begin))
            entries = entries.drop_columns(["row"])
            if last and keys[0] != key or begin:
                head = entries.slice(0, cut)
                held += [*last, head] if keys[0] == key or begin else last
                last = []
            last.append(entries.slice(cut))
            key = keys[-1]
            if sum(t.num_rows for t in last) > MERGED:
                last = [_summed(pa.concat_tables(last))]
            if sum(t.num_rows for t in held) > MERGED:
                yield from flush()
        held += last
        if held:
            yield from flush()

    return run


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """Stripes merged elementwise, entries of at least ``least``: lang, size, prefix, next,
    count. One shuffle moves whole stripes."""
    return (stripes.repartition("lang", "size", "block").sortWithinPartitions("lang", "size", "block")
            .mapInArrow(_merging(least), "lang string, size int, prefix string, next string, count long"))


def _phrases(entries: DataFrame) -> DataFrame:
    phrase = F.when(F.col("size") == 0, F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    return entries.select("lang", (F.col("size") + 1).alias("words"), phrase.alias("phrase"), "prefix", "next", "count")


def phrases(documents: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang",
            split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to 4 words with at least ``least`` occurrences (lang, words, phrase,
    prefix, next, count), and the number of words of each language (lang, n)."""
    spark = documents.sparkSession
    texts = documents.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    blocks = max(BLOCKS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = kept(merged(texts.mapInArrow(_word_stripes(blocks), STRIPES), 1), "words")
    totals = kept(words.groupBy("lang").agg(F.sum("count").alias("n")), "totals")
    single = _phrases(words.where(F.col("count") >= least))
    bound = max(split, (totals.agg(F.sum("n")).first()[0] or 0) // 50_000)
    frequent = {
        (r["lang"], r["next"].encode()): min(r["count"] // bound + 1, 0xFFFF)
        for r in words.where(F.col("count") > bound).select("lang", "next", "count").toLocalIterator()}
    send = spark.sparkContext.broadcast
    sent = send(frequent)
    found = last = single
    for size in (1, 2, 3):
        stripes = texts.mapInArrow(_longer_stripes(size, send(Filter.of(last).bits), sent, blocks), STRIPES)
        last = _phrases(kept(merged(stripes, least), f"phrases-{size + 1}"))
        found = found.unionAll(last)
    return found, totals


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, text_col: str = "text",
                 lang_col: str = "lang", split: int = SPLIT) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found, totals = phrases(documents, least, text_col, lang_col, split)
    counts = found.select("lang", "phrase", "count")
    # One more word on either side: the longest extension decides, longer ones hold it.
    longer = found.where("words > 2")
    after = longer.select("lang", F.col("prefix").alias("phrase"), "count")
    before = longer.select("lang", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("phrase"), "count")
    most = after.unionAll(before).groupBy("lang", "phrase").agg(F.max("count").alias("most"))
    candidates = (
        found.where("words > 1").select("lang", "phrase", "words", F.col("count").alias("a"))
        .join(most.hint("merge"), ["lang", "phrase"], "left")  # packed files hide how large it is
        .where("most IS NULL OR 100 * most < 80 * a").drop("most"))
    word = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(word, 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice(word, F.col("k") + 1, F.col("words")), " ").alias("rest"))
    parts = kept(counts, "phrases")
    cuts = looked_up(cuts, parts.toDF("lang", "first", "l"), ["lang", "first"])
    cuts = looked_up(cuts, parts.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div CAST(l + r AS DECIMAL(19,0))")
    best = (
        cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_stripes_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
sized AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS m FROM words),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
  FROM sized WHERE len(w) >= m),
counted AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
frequent AS MATERIALIZED (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM counted WHERE f >= 30),
shorter AS (SELECT *, unnest(range(2, m)) AS t FROM frequent WHERE m > 2),
inner_ones AS (
  SELECT lang, f, unnest(list_transform(range(1, m - t + 2), lambda i: array_to_string(w[i : i + t - 1], ' '))) AS phrase
  FROM shorter),
most AS (SELECT lang, phrase, max(f) AS f FROM inner_ones GROUP BY lang, phrase),
candidates AS (
  SELECT c.lang, c.m, c.phrase, c.w, c.f AS a FROM frequent c LEFT JOIN most x ON x.lang = c.lang AND x.phrase = c.phrase
  WHERE c.m > 1 AND (x.f IS NULL OR 100 * x.f < 80 * c.f)),
places AS (SELECT *, unnest(range(1, m)) AS k FROM candidates),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS x, array_to_string(w[k + 1 : m], ' ') AS y FROM places),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, p.f AS l, q.f AS r, ((2000000::HUGEINT * c.a) // (p.f + q.f))::BIGINT AS score
  FROM cuts c JOIN counted p ON p.lang = c.lang AND p.phrase = c.x JOIN counted q ON q.lang = c.lang AND q.phrase = c.y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT t.lang, rank, phrase, a, l, r, n, score FROM placed p JOIN totals t ON t.lang = p.lang WHERE rank <= 2000
"""
