"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a NULL id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def training_rows(documents: DataFrame, labels: DataFrame, label: str, used: Column, limit: int,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts and labels (0 or 1) of up to ``limit`` labelled rows whose id ``used``
    accepts. The rows are those with the least hash of the id, so the same table gives
    the same rows; the limit bounds what is broadcast and what the driver trains on."""
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & used)
        .groupBy("doc_id").agg(F.max("label").alias("label"), F.min("label").alias("other"))
        .where("label = other").drop("other")  # contradictory labels teach nothing
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
