"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """The same rows, written to the shared folder and read from there: later
    stages start from the files, whichever executors are lost meanwhile."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def veiled(documents: DataFrame) -> DataFrame:
    """The same rows with columns given__0, given__1 and so on, so that whatever a step adds
    cannot meet a name of the caller's."""
    return documents.select(*[F.col(quoted(c)).alias(f"given__{i}") for i, c in enumerate(documents.columns)])


def veil_of(documents: DataFrame, column: str) -> str:
    """The name that a column has in :func:`veiled`."""
    return f"given__{documents.columns.index(column)}"


def given(documents: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    """The caller's columns of a veiled table, under their own names."""
    return [F.col(f"given__{i}").alias(c) for i, c in enumerate(documents.columns) if c not in without]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Rows up to which a table that is looked up is sent to all tasks, and into how many
#: parts a key is dealt otherwise.
FEW, DEALT = 50_000, 16


def looked_up(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row for each key; NULL keys
    meet. A few facts, which are counted, are broadcast; else each fact is repeated
    ``DEALT`` times and the rows of a key, hot ones too, go to that many tasks. These are
    never broadcast: Spark sizes them by the files and does not see that they are repeated."""
    held = facts.select(*[F.col(k).alias(f"{k}__key") for k in keys], *[c for c in facts.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"{k}__key")) for k in keys]
    if held.limit(FEW + 1).count() <= FEW:
        joined = rows.join(F.broadcast(held), same)
    else:
        dealt = held.withColumn("part__key", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(DEALT)).cast("int")
        joined = rows.withColumn("part__row", part).join(dealt.hint("merge"), [*same, F.col("part__row") == F.col("part__key")])
        joined = joined.drop("part__row", "part__key")
    return joined.drop(*[f"{k}__key" for k in keys])


def text_key(text: Column) -> Column:
    """32 bits of a text's hash; tells rows of one id apart."""
    return F.coalesce(F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0))


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string or binary column; NULL gives none."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def packed_texts(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns doc_id, row (:func:`text_key`) and the text under zstd, for joins
    that have to shuffle whole texts."""
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("row"),
        F.col(text_col).alias("packed"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            small = [squeeze.compress(text) for text in text_bytes(batch.column("packed"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(small, pa.binary())],
                names=["doc_id", "row", "packed"])

    return rows.mapInArrow(pack, "doc_id long, row long, packed binary")


def unpacked(column: pa.Array) -> Iterator[bytes]:
    expand = zstandard.ZstdDecompressor()
    for value in column:
        yield expand.decompress(value.as_py())


def long_array(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def as_long(values: np.ndarray) -> pa.Array:
    """64-bit values of any kind as a long column."""
    return pa.array(np.ascontiguousarray(values).astype(np.uint64).view(np.int64))
