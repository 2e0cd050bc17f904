"""Text quality from random-indexing word vectors and a small network.

1. *Tokens* are runs of letters, of digits or of other marks, with their case.
2. *Random indexing*: each token has a fixed sparse random vector; a token's context
   vector sums the random vectors of its neighbours (two on each side) over all
   documents. Tokens share ``2 ** BUCKET_BITS`` rows by hash, so the table has a fixed
   size whatever the corpus holds and no token is left out. Tasks add up their texts
   and Spark adds up the tasks.
3. *Pooling*: a document is the weighted mean of its tokens' unit vectors (frequent
   tokens count less), with how alike neighbours are and how long the text is.
4. *Network*: two layers in numpy, trained on a bounded sample of labelled rows
   (``TRAIN_ROWS``); a temperature fitted on rows kept apart calibrates the scores.

The word vectors cover every text; labels, language, source and id are no inputs.

Defined results: a NULL or empty text gets a score too, that of a document without
tokens; rows of one id are scored by their own texts; without labels of both kinds all
scores are the share of label 1 (or 0.5); no rows give no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.bytehash import SEGMENT, RangeHashes, mix64
from jobsignals.llm.labelled import fold_of, training_rows
from jobsignals.llm.shingles import portions
from jobsignals.llm.tables import given, table, text_bytes, veil_of, veiled

BUCKET_BITS = 14
DIMENSIONS = 32
#: Places of a random vector that are +1 or -1.
NONZERO = 6
WINDOW = 2
TRAIN_ROWS = 20_000
HIDDEN = 32
SEED = 5

_SPACE, _LETTER, _DIGIT, _MARK = 0, 1, 2, 3
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = _LETTER

#: Longest run of one kind that is one token; longer ones are several.
_LONGEST = 1 << 16
#: Tokens whose vectors are held at a time.
CHUNK = 1 << 16


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token of some texts, and the text it belongs to."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    kind = _KIND[data]
    change = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
    end = np.append(change[1:], len(data))
    words = kind[change] != _SPACE
    start, end = change[words], end[words]
    if len(start) and (end - start).max() > _LONGEST:
        pieces = -(-(end - start) // _LONGEST)
        inside = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, end = np.repeat(start, pieces) + inside * _LONGEST, np.repeat(end, pieces)
        end = np.minimum(start + _LONGEST, end)
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        stop = int(np.searchsorted(end, start[at] + (1 << 19), side="right"))
        hashes = RangeHashes(data[start[at] : end[stop - 1]])
        out[at:stop] = hashes(start[at:stop] - start[at], end[at:stop] - start[at])
        at = stop
    stops = np.cumsum([len(t) + 1 for t in texts])
    return (out >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.searchsorted(stops, start, side="right")


def random_vectors() -> np.ndarray:
    """The fixed sparse vectors of all buckets, from their numbers alone."""
    rows = np.arange(1 << BUCKET_BITS, dtype=np.uint64)
    out = np.zeros((len(rows), DIMENSIONS), np.int8)
    for i in range(NONZERO):
        drawn = mix64(rows * np.uint64(NONZERO) + np.uint64(i + 1) + np.uint64(SEED << 32))
        place = (drawn % np.uint64(DIMENSIONS)).astype(np.int64)
        out[np.arange(len(rows)), place] += np.where(drawn >> np.uint64(63), 1, -1).astype(np.int8)
    return out


COLUMNS = [f"c{i}" for i in range(DIMENSIONS)]


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: for each bucket its tokens and the sum of their neighbours' vectors."""
    vectors = random_vectors()
    sums = np.zeros((len(vectors), DIMENSIONS), np.int64)
    counts = np.zeros(len(vectors), np.int64)
    for (texts,) in portions(batches, (), "text"):
        every_bucket, every_owner = _tokens(texts)
        for at in range(0, len(every_bucket), CHUNK):
            low, high = max(0, at - WINDOW), min(len(every_bucket), at + CHUNK + WINDOW)
            bucket, owner = every_bucket[low:high], every_owner[low:high]
            context = np.zeros((len(bucket), DIMENSIONS), np.int16)
            for step in range(1, min(WINDOW, len(bucket) - 1) + 1):
                same = (owner[step:] == owner[:-step])[:, None]
                context[step:] += vectors[bucket[:-step]] * same
                context[:-step] += vectors[bucket[step:]] * same
            inside = slice(at - low, min(at + CHUNK, len(every_bucket)) - low)
            bucket, context = bucket[inside], context[inside]
            order = np.argsort(bucket, kind="stable")
            begins = np.flatnonzero(np.concatenate(([True], bucket[order][1:] != bucket[order][:-1])))
            found = bucket[order][begins]
            sums[found] += np.add.reduceat(context[order], begins, axis=0, dtype=np.int64)
            counts[found] += np.diff(np.append(begins, len(order)))
    for at in range(0, len(vectors), 4096):
        rows = at + np.flatnonzero(counts[at : at + 4096])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(counts[rows]), *(pa.array(sums[rows, i]) for i in range(DIMENSIONS))],
            names=["bucket", "n", *COLUMNS])


def word_vectors(documents: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Unit context vectors and weights of all buckets, from all texts. The driver gets
    one row per bucket, whatever the size of the corpus."""
    schema = "bucket long, n long, " + ", ".join(f"{c} long" for c in COLUMNS)
    sums = (
        documents.select(F.col(text_col).alias("text")).mapInArrow(_context_sums, schema)
        .groupBy("bucket").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in COLUMNS)).toArrow())
    vectors, counts = np.zeros((1 << BUCKET_BITS, DIMENSIONS), np.float64), np.zeros(1 << BUCKET_BITS)
    bucket = sums.column("bucket").to_numpy()
    counts[bucket] = sums.column("n").to_numpy()
    for i, name in enumerate(COLUMNS):
        vectors[bucket, i] = sums.column(name).to_numpy()
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    share = counts / max(counts.sum(), 1)
    return vectors.astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32)


def _features(texts: list[bytes], vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pooled vectors of some texts."""
    bucket, owner = _tokens(texts)
    n = np.bincount(owner, minlength=len(texts))
    out = np.zeros((len(texts), DIMENSIONS + 4))
    total = np.zeros(len(texts))
    for at in range(0, len(bucket), CHUNK):
        # One token before the chunk, to compare the first one with.
        low, high = max(0, at - 1), min(len(bucket), at + CHUNK)
        here, whose = bucket[low:high], owner[low:high]
        word, weight = vectors[here], weights[here].astype(np.float64)
        same, again = np.zeros(len(here)), np.zeros(len(here))
        together = whose[1:] == whose[:-1]
        same[1:] = np.einsum("ij,ij->i", word[1:], word[:-1]) * together
        again[1:] = (here[1:] == here[:-1]) & together
        skip = at - low
        word, weight, same, again, whose = (x[skip:] for x in (word, weight, same, again, whose))
        begins = np.flatnonzero(np.concatenate(([True], whose[1:] != whose[:-1])))
        found = whose[begins]
        out[found, :DIMENSIONS] += np.add.reduceat(word * weight[:, None], begins, axis=0)
        out[found, DIMENSIONS] += np.add.reduceat(same, begins)
        out[found, DIMENSIONS + 1] += np.add.reduceat(again, begins)
        total[found] += np.add.reduceat(weight, begins)
    out[:, :DIMENSIONS] /= np.maximum(total, 1e-9)[:, None]
    out[:, DIMENSIONS : DIMENSIONS + 2] /= np.maximum(n, 1)[:, None]
    out[:, DIMENSIONS + 2] = total / np.maximum(n, 1)
    out[:, DIMENSIONS + 3] = np.log1p(n)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Network:
    """Two layers on standardised inputs, trained by Adam; then one temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.constant = None
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        order = rng.permutation(len(y))
        apart, train = order[: len(y) // 5], order[len(y) // 5 :]
        self.w1 = rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden))
        self.b1, self.w2, self.b2 = np.zeros(hidden), rng.normal(0, hidden ** -0.5, hidden), np.zeros(1)
        names = ("w1", "b1", "w2", "b2")
        moments = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in names}
        step = 0
        for _ in range(epochs):
            rng.shuffle(train)
            for at in range(0, len(train), 256):
                rows = train[at : at + 256]
                inner = np.tanh(x[rows] @ self.w1 + self.b1)
                error = (_sigmoid(inner @ self.w2 + self.b2) - y[rows]) / len(rows)
                back = np.outer(error, self.w2) * (1 - inner ** 2)
                slopes = {"w1": x[rows].T @ back, "b1": back.sum(0), "w2": inner.T @ error, "b2": error.sum(keepdims=True)}
                step += 1
                for n in names:
                    slope = slopes[n] + 1e-4 * getattr(self, n)
                    m, v = moments[n]
                    m += 0.1 * (slope - m)
                    v += 0.001 * (slope ** 2 - v)
                    setattr(self, n, getattr(self, n) - 0.01 * (m / (1 - 0.9 ** step))
                            / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8))
        self.temperature = 1.0
        if len(apart):
            logits, wanted = self._logits(x[apart]), y[apart]
            tried = np.geomspace(0.25, 8, 61)
            loss = [np.logaddexp(0, np.where(wanted == 1, -1, 1) * logits / t).mean() for t in tried]
            self.temperature = float(tried[int(np.argmin(loss))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self._logits((x - self.mean) / self.scale) / self.temperature)


def fitted(documents: DataFrame, labels: DataFrame, used: Column, label: str = "quality",
           train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text"):
    """A function from texts (bytes) to scores, learned from the labelled rows that
    ``used`` (a condition on doc_id) accepts and from the words of all documents."""
    vectors, weights = word_vectors(documents, text_col)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given, texts in portions(batches, ("label",), "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(given, pa.int32()), pa.array(list(_features(texts, vectors, weights)))],
                names=["label", "x"])

    rows = training_rows(documents, labels, label, used, train_rows, id_col, text_col)
    found = rows.select("label", "text").mapInArrow(pooled, "label int, x array<double>").toArrow()
    x = np.array(found.column("x").to_pylist(), dtype=np.float64).reshape(found.num_rows, DIMENSIONS + 4)
    # The order of rows depends on the cluster; the model should not.
    order = np.lexsort((*x.T, found.column("label").to_numpy()))
    network = Network(x[order], found.column("label").to_numpy()[order].astype(np.float64))
    return lambda texts: network(_features(texts, vectors, weights))


def scored(documents: DataFrame, score, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in portions(batches, ("doc_id",), "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(score(texts), pa.float64())], names=["doc_id", "score"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def with_score(documents: DataFrame, score, text_col: str = "text", name: str = "_score") -> DataFrame:
    """All columns of the documents and the score of each text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema) + f", `{name}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(t) for t in text_bytes(batch.column(text_col))])
            # Parts of about SEGMENT bytes of text, or of one longer text.
            part_of = (np.cumsum(sizes) - sizes) // SEGMENT
            cuts = np.flatnonzero(np.concatenate(([True], part_of[1:] != part_of[:-1]))) if len(sizes) else []
            for at, end in zip(cuts, [*cuts[1:], batch.num_rows]):
                part = batch.slice(at, end - at)
                scores = score(list(text_bytes(part.column(text_col))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())],
                                                 names=[*part.schema.names, name])

    return documents.mapInArrow(run, schema)


def good(documents: DataFrame, score, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents with a score of ``least`` or more, their columns as they are."""
    found = with_score(veiled(documents), score, veil_of(documents, text_col), "score__")
    return found.where(F.col("score__") >= least).select(*given(documents))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = lambda c: fold_of(c, 3) == 1
    score = fitted(documents, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return scored(documents, score).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
