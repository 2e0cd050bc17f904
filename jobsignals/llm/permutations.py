"""Nearest neighbours by a permutation index.

A bounded sample of the different vectors serves as pivots, however often each occurs. Each vector is represented by its
``prefix`` nearest pivots in their order; this is written for every row. A slice of the
index turns them into lists, one per pivot with the place that each row has it at. A query adds
up, over the lists of its own nearest pivots, how much less than the worst the places
differ; that is the footrule distance, with pivots outside a prefix at place ``prefix``.
The nearest share of each slice by footrule is ranked again by the exact inner
product in double precision, and the best of all slices are the answer.

For inner products of vectors of any length, index vectors get one more coordinate that
brings all to the same length, queries get zero there; nearest by angle is then largest
by inner product. Slices and query blocks have a fixed number of rows, dealt out by
row number, so equal vectors fill no task.

Recall against brute force at the default settings is about 0.96 or more on the tables
it was measured on (README, tests). The share that is ranked again is what vectors of 64
dimensions with little structure need.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components
take no part, nor do those of another length than most; each row is a candidate for all
queries but itself, repeated rows too; ties go to the smaller id; with fewer candidates
all are returned; queries that find none give no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsignals.llm.tables import kept, table

PIVOTS = 512
PREFIX = 96
SHARE = 0.35
SLICE = 16_384
BLOCK = 1024
SEED = 42

INDEXED = "uid long, vec_id long, vector binary, places binary, query binary"
FOUND = "uid long, query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _pivots(vectors: DataFrame, pivots: int) -> np.ndarray:
    """Up to ``pivots`` different vectors, those with the least hashes of their content.
    However many copies a vector has, it counts once."""
    content = vectors.select(F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))  # -0.0 is 0.0
    least = content.select(F.xxhash64("vector", F.lit(SEED)).alias("key")).distinct().orderBy("key").limit(pivots)
    keyed = content.withColumn("key", F.xxhash64("vector", F.lit(SEED))).join(F.broadcast(least), "key")
    found = keyed.groupBy("key").agg(F.min("vector").alias("vector")).orderBy("key").collect()
    return np.array([r["vector"] for r in found], dtype=np.float64)


def _indexed(pivots: np.ndarray, longest: float, prefix: int, is_query):
    """Each vector's nearest pivots in order, and for queries those of the query."""
    rest = np.sqrt(np.maximum(longest ** 2 - (pivots ** 2).sum(axis=1), 0))

    def nearest(scores: np.ndarray) -> np.ndarray:
        best = np.argpartition(-scores, prefix - 1, axis=1)[:, :prefix]
        # Equal scores in the order of the pivots, in every task alike.
        best.sort(axis=1)
        order = np.argsort(-np.take_along_axis(scores, best, axis=1), axis=1, kind="stable")
        return np.take_along_axis(best, order, axis=1).astype(np.uint16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
                x = np.array(batch.column("vector").to_pylist(), dtype=np.float64)
                own = np.sqrt(np.maximum(longest ** 2 - (x ** 2).sum(axis=1), 0))
                scores = x @ pivots.T
                places = nearest(scores + own[:, None] * rest[None, :])
                queries = nearest(scores)
                known = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    batch.column("uid"), batch.column("vec_id"),
                    pa.array([v.tobytes() for v in x], pa.binary()),
                    pa.array([p.tobytes() for p in places], pa.binary()),
                    pa.array([q.tobytes() if k and is_query(int(i)) else None
                              for k, i, q in zip(known, np.where(known, ids, 0), queries)], pa.binary()),
                ], names=["uid", "vec_id", "vector", "places", "query"])

    return run


def _searched(pivots: int, prefix: int, share: float, k: int):
    """Answers of one block of queries from one slice of the index."""

    def rows(table: pa.Table, name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(table.num_rows, -1)

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if index.num_rows and queries.num_rows:
            n = index.num_rows
            vectors, places = rows(index, "vector", np.float64), rows(index, "places", np.uint16)
            uid = index.column("uid").to_numpy()
            ids = index.column("vec_id").to_pandas().astype("Int64")
            order_of_id = np.argsort(np.argsort(ids.fillna(np.iinfo(np.int64).max).to_numpy(np.int64), kind="stable"))
            ids = np.array(index.column("vec_id").to_pylist(), dtype=object)
            # For each pivot a list of how near it is to the rows: 1 for the last place in a
            # prefix, ``prefix`` for the first, 0 outside. Sums of them fit the smaller kind.
            kind = np.int16 if prefix <= 128 else np.int32
            nearness = np.zeros((pivots, n), kind)
            nearness[places.ravel(), np.repeat(np.arange(n), prefix)] = np.tile(prefix - np.arange(prefix), n)
            count = min(n, max(20 * k, int(np.ceil(share * n))))
            own, own_ids = queries.column("uid").to_numpy(), queries.column("vec_id").to_pylist()
            asked, q_vectors = rows(queries, "query", np.uint16), rows(queries, "vector", np.float64)
            longest, lengths_of = np.sqrt((vectors ** 2).sum(axis=1).max()), np.sqrt((q_vectors ** 2).sum(axis=1))
            for q in range(queries.num_rows):
                footrule = np.zeros(n, kind)
                for rank, p in enumerate(asked[q].tolist()):
                    # Places that differ least save most against a pivot outside the prefix:
                    # prefix - rank - |rank - place|, and nothing for rows with the pivot outside.
                    footrule -= np.minimum(nearness[p], 2 * (prefix - rank) - nearness[p])
                # Of rows at the cut's distance those of the smallest ids stay.
                cut = np.partition(footrule, count - 1)[count - 1]
                tied = np.flatnonzero(footrule == cut)
                closer = np.flatnonzero(footrule < cut)
                tied = tied[np.argsort(order_of_id[tied], kind="stable")][: count - len(closer)]
                near = np.concatenate((closer, tied))
                near = near[uid[near] != own[q]]
                # A first look by a product whose order of summing may differ from row to row; what
                # it puts within its error of the k-th nearest, or has no number for, is summed again.
                rough = vectors[near] @ q_vectors[q]
                if len(near) > k:
                    error = 4 * len(q_vectors[q]) * np.finfo(np.float64).eps * longest * lengths_of[q]
                    least = np.partition(rough, len(near) - k)[len(near) - k]
                    near = near[~(rough < least - 2 * error)]
                # Summed row by row in one order, so that equal vectors have equal scores.
                score = (vectors[near] * q_vectors[q]).sum(axis=1)
                best = np.lexsort((order_of_id[near], -score))[:k]
                out.append((np.full(len(best), own[q]), [own_ids[q]] * len(best), ids[near[best]].tolist(), score[best]))
        return pa.table({
            "uid": pa.array(np.concatenate([o[0] for o in out]) if out else [], pa.int64()),
            "query_id": pa.array([x for o in out for x in o[1]], pa.int64()),
            "vec_id": pa.array([x for o in out for x in o[2]], pa.int64()),
            "score": pa.array(np.concatenate([o[3] for o in out]) if out else [], pa.float64()),
        })

    return run


def nearest(embeddings: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, slice_rows: int = SLICE,
            block_rows: int = BLOCK) -> DataFrame:
    """The ``k`` nearest rows of each row whose id ``is_query`` accepts: query_id, rank
    (from 1), vec_id, score."""
    spark = embeddings.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    vectors = kept(
        embeddings.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
        .where(usable(F.col("vector"))), "vectors")
    lengths = vectors.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension, rows = lengths[0]["d"], lengths[0]["count"]
    vectors = vectors.where(F.size("vector") == dimension).withColumn("uid", F.monotonically_increasing_id())
    squared = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    longest = vectors.agg(F.max(F.sqrt(squared))).first()[0]
    chosen = _pivots(vectors, pivots)
    prefix = min(prefix, len(chosen))
    index = kept(vectors.mapInArrow(_indexed(chosen, longest, prefix, is_query), INDEXED), "permutations")

    slices = -(-rows // slice_rows)
    asked = index.where(F.col("query").isNotNull()).select("uid", "vec_id", "vector", "query")
    blocks = max(1, -(-asked.count() // block_rows))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = index.select("uid", "vec_id", "vector", "places", F.pmod(F.xxhash64("uid"), F.lit(slices)).cast("int").alias("slice"),
                         each(blocks).alias("block"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int")).withColumn("slice", each(slices))
    found = index.groupBy("slice", "block").cogroup(asked.groupBy("slice", "block")).applyInArrow(
        _searched(len(chosen), prefix, share, k), FOUND)
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
