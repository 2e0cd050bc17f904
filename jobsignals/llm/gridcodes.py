"""Vector code compression: parts of vectors against codebooks, by memoised grid cells.

Components become integers; a vector is cut into parts, and each part gets the index of
the nearest entry of its position's codebook, which is learned in a fixed number of
rounds. All arithmetic is in integers.

A part lies in a cell of a grid (components shifted right by ``cell_bits``). For a cell's
box each entry has a least and a greatest distance; an entry whose least distance lies
above the smallest greatest one is dominated: no point of the box is nearest to it. Each
task remembers, by the cell's coordinates, which entries are not dominated, and evaluates
exactly those only. Distances to a box are sums over components of terms that depend on
the component's coordinate alone, so they are looked up. Parts of copies, and of
neighbours in dense regions, meet a remembered cell; elsewhere the bounds save exact
distances. The width of cells changes the cost, never the result.

Each round is one map over the integers, kept as a table, with sums per entry combined in
tasks before a shuffle; a codebook (entries x length numbers) is all the driver holds.

Defined results: vectors that are NULL or hold NULL or non-finite components are dropped.
The kept row with the least id decides the length; rows of another length, and all if
there is no such row, have NULL for code and error and take no part. Parts of a length
that does not divide are cut at floor(p * length / parts). Components beyond +-131072 count as
that. NULL ids come last in the order and their rows are kept; rows of one id are ordered
by their components. Fewer rows than entries make a smaller codebook. NULL labels are one
label; a label without coded rows has no error. No rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.tables import kept, looked_up, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Cells are 2 ** CELL_BITS wide in every component.
CELL_BITS = 6
#: Cells that a task remembers for each part; then it starts anew (32 bytes and a key each).
REMEMBERED = 50_000
#: Largest magnitude of a component.
LARGEST = 131_072
#: Cells and parts that are worked on at a time.
BLOCK = 1024


@dataclass(frozen=True)
class Codebooks:
    """Integer entries of each part: arrays of shape (entries, length of the part)."""

    parts: tuple[np.ndarray, ...]

    def bounds(self) -> list[tuple[int, int]]:
        ends = np.cumsum([p.shape[1] for p in self.parts]).tolist()
        return list(zip([0, *ends[:-1]], ends))

    def sha256(self) -> str:
        numbers = ",".join(str(int(x)) for part in self.parts for x in part.reshape(-1))
        return hashlib.sha256(numbers.encode()).hexdigest()


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             scale: int = SCALE) -> DataFrame:
    """Kept vectors as integers: vec_id, label, length, numbers (int32, little-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            column = column.filter(column.is_valid())
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            wrong = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            good = wrong[ends] == wrong[ends - lengths]
            inside = np.clip(np.nan_to_num(values), -LARGEST, LARGEST)
            numbers = np.floor(inside * scale).astype("<i4").tobytes()
            rows = np.flatnonzero(batch.column("vector").is_valid().to_numpy(zero_copy_only=False))[good]
            spans = zip((4 * (ends - lengths)[good]).tolist(), (4 * ends[good]).tolist())
            chosen = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([
                chosen.column("vec_id"), chosen.column("label"), pa.array(lengths[good].astype(np.int32)),
                pa.array([numbers[a:b] for a, b in spans], pa.binary()),
            ], names=["vec_id", "label", "length", "numbers"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).alias("vector"))
    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, label {label}, length int, numbers binary")


class _Cells:
    """Nearest entries of one part's codebook."""

    def __init__(self, codebook: np.ndarray, cell_bits: int) -> None:
        self.codebook, self.bits = codebook.astype(np.int64), cell_bits
        self.known: dict[bytes, np.ndarray] = {}

    def _survivors(self, cells: np.ndarray) -> np.ndarray:
        """Entries that are not dominated in each cell, as packed bits."""
        least = np.zeros((len(cells), len(self.codebook)), np.int64)
        most = np.zeros_like(least)
        for i in range(cells.shape[1]):
            coordinate, back = np.unique(cells[:, i], return_inverse=True)
            low = (coordinate << self.bits)[:, None] - self.codebook[:, i]
            high = low + (1 << self.bits) - 1
            least += (np.maximum(np.maximum(low, -high), 0) ** 2)[back]
            most += (np.maximum(-low, high) ** 2)[back]
        return np.packbits(least <= most.min(axis=1, keepdims=True), axis=1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each part (the lower of equals), and the distance."""
        index, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for at in range(0, len(parts), BLOCK):
            some = parts[at : at + BLOCK]
            index[at : at + BLOCK], distance[at : at + BLOCK] = self._block(some)
        return index, distance

    def _block(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not parts.shape[1]:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        cells = np.ascontiguousarray(parts >> self.bits)
        keys = [row.tobytes() for row in cells]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        fresh = {key: row for row, key in enumerate(keys) if key not in known}
        if fresh:
            found = self._survivors(cells[list(fresh.values())])
            known.update(zip(fresh, found))
        bits = np.unpackbits(np.stack([known[key] for key in keys]), axis=1, count=len(self.codebook))
        row, entry = np.nonzero(bits)
        away = parts[row] - self.codebook[entry]
        exact = np.einsum("ij,ij->i", away, away)
        starts = np.searchsorted(row, np.arange(len(parts)))
        best = np.minimum.reduceat(exact, starts)
        first = np.flatnonzero(exact == best[row])  # entries ascend within a row
        chosen = entry[first[np.searchsorted(row[first], np.arange(len(parts)))]]
        return chosen, best


def _matrix(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have the length, and their integers."""
    fits = batch.column("length").to_numpy() == length
    rows = batch.column("numbers").filter(pa.array(fits)).to_pylist()
    return fits, np.frombuffer(b"".join(rows), "<i4").reshape(len(rows), length).astype(np.int64)


def _assigned(cells: list[_Cells], books: Codebooks, numbers: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [c.nearest(numbers[:, a:b]) for c, (a, b) in zip(cells, books.bounds())]


def _round(rows: DataFrame, books: Codebooks, cell_bits: int) -> Codebooks:
    """Entries replaced by the floors of the means of their parts."""
    bounds = books.bounds()
    length, width = bounds[-1][1], max(b - a for a, b in bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [_Cells(p, cell_bits) for p in books.parts]
        sums = [np.zeros(p.shape, np.int64) for p in books.parts]
        counts = [np.zeros(len(p), np.int64) for p in books.parts]
        for batch in batches:
            _, numbers = _matrix(batch, length)
            for (a, b), total, count, (index, _) in zip(bounds, sums, counts, _assigned(cells, books, numbers)):
                np.add.at(total, index, numbers[:, a:b])
                count += np.bincount(index, minlength=len(count))
        for part, (total, count) in enumerate(zip(sums, counts)):
            used = np.flatnonzero(count)
            total = np.pad(total[used], ((0, 0), (0, width - total.shape[1])))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(used), part, np.int32)), pa.array(used.astype(np.int32)), pa.array(count[used]),
                *[pa.array(np.ascontiguousarray(total[:, i])) for i in range(width)],
            ], names=["part", "entry", "n", *[f"s{i}" for i in range(width)]])

    columns = ", ".join(["part int, entry int, n long", *[f"s{i} long" for i in range(width)]])
    found = rows.mapInArrow(run, columns).groupBy("part", "entry").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", *[f"s{i}" for i in range(width)])])
    parts = [p.copy() for p in books.parts]
    for row in found.toArrow().to_pylist():
        book, n = parts[row["part"]], int(row["n"])
        book[row["entry"]] = [int(row[f"s{i}"]) // n for i in range(book.shape[1])]
    return Codebooks(tuple(parts))


def fitted(rows: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, parts: int = PARTS,
           cell_bits: int = CELL_BITS) -> Codebooks | None:
    """Codebooks of :func:`integers`; None without rows."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("numbers")]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return None
    length = first[0]["length"]
    seeds = rows.where(F.col("length") == length).orderBy(*order).limit(entries).select("numbers").collect()
    numbers = np.array([np.frombuffer(bytes(r["numbers"]), "<i4") for r in seeds], np.int64).reshape(len(seeds), length)
    cuts = [p * length // parts for p in range(parts + 1)]
    books = Codebooks(tuple(numbers[:, a:b].copy() for a, b in zip(cuts[:-1], cuts[1:])))
    for _ in range(rounds):
        books = _round(rows, books, cell_bits)
    return books


def encoded(rows: DataFrame, books: Codebooks | None, cell_bits: int = CELL_BITS) -> DataFrame:
    """Code (two hex digits per part, for up to 256 entries) and error of each row of
    :func:`integers`: vec_id, label, code, error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [_Cells(p, cell_bits) for p in books.parts]
        for batch in batches:
            fits, numbers = _matrix(batch, books.bounds()[-1][1])
            found = _assigned(cells, books, numbers)
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            code, error = np.full(len(fits), None, object), np.zeros(len(fits), np.int64)
            code[fits] = [row.tobytes().hex() for row in codes]
            error[fits] = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, mask=~fits)],
                names=["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    if books is None:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return rows.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          entries: int = ENTRIES, rounds: int = ROUNDS, cell_bits: int = CELL_BITS) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of each kept vector."""
    rows = kept(integers(vectors, id_col, vector_col, label_col), "integers")
    books = fitted(rows, entries, rounds, cell_bits=cell_bits)
    coded = kept(encoded(rows, books, cell_bits), "codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return looked_up(coded, totals, ["label"]).withColumn(
        "codebooks_sha256", F.lit(books.sha256() if books else None).cast("string"))


def op11_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def _op11_sql() -> str:
    """One step of SQL per round, from the same text."""
    steps = ["""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT row, p, q[p * (len(q) // 4) + 1 : (p + 1) * (len(q) // 4)] AS v FROM (SELECT *, unnest([0, 1, 2, 3]) AS p FROM kept)),
sized AS MATERIALIZED (SELECT row, p, v, v::DOUBLE[] AS d, list_dot_product(v::DOUBLE[], v::DOUBLE[]) AS vv FROM parts),
book0 AS MATERIALIZED (SELECT p, row - 1 AS e, v AS c FROM parts WHERE row <= 256)"""]
    for k in range(5):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT row, s.p, min((vv + list_dot_product(c::DOUBLE[], c::DOUBLE[]) - 2 * list_dot_product(d, c::DOUBLE[]))::BIGINT * 256 + e) AS best
  FROM sized s JOIN book{k} b ON b.p = s.p GROUP BY row, s.p)""")
        if k < 4:
            steps.append(f"""
means{k} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT n.p, best % 256 AS e, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM near{k} n JOIN (SELECT row, p, v, unnest(range(1, len(v) + 1)) AS i FROM parts) x ON x.row = n.row AND x.p = n.p
    GROUP BY n.p, best % 256, i) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c)::BIGINT[] AS c FROM book{k} b LEFT JOIN means{k} m ON m.p = b.p AND m.e = b.e)""")
    return ",".join(steps) + """,
coded AS (
  SELECT row, string_agg(lpad(lower(to_hex(best % 256)), 2, '0'), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error
  FROM near4 GROUP BY row)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book4) AS codebooks_sha256
FROM kept k JOIN coded c ON c.row = k.row
"""


OP11_SQL = _op11_sql()
