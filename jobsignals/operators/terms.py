"""Reports over extracted term lists."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobsignals.functions.binding import with_columns_once
from jobsignals.functions.vocabulary import KNOWLEDGE_LABELS


def count_terms(extracted: DataFrame, column: str = "knowledges", name: str = "Knowledge") -> DataFrame:
    """``(name, count)``: occurrences of each list element, most frequent first.

    Counts are combined before the shuffle, so a term that holds most rows
    costs one row per task. Equal counts are ordered by the element.
    """
    # From explode() Spark infers filters on the list and pushes them down to the
    # scan, where a computed list would be computed once more for each of them.
    lists = with_columns_once(extracted.select(column), {"elements": F.col(column)})
    return (
        lists.select(F.explode("elements").alias(name))
        .groupBy(name)
        .count()
        .orderBy(F.desc("count"), name)
    )


def label_table(spark: SparkSession) -> DataFrame:
    """``(Knowledge, Category)``: the built-in labels."""
    columns = {"Knowledge": list(KNOWLEDGE_LABELS), "Category": list(KNOWLEDGE_LABELS.values())}
    return spark.createDataFrame(pa.table(columns))


def label_terms(counts: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Counts with the category of each term, NULL where it has none.

    The built-in table (39 rows) is broadcast. A caller's table is joined by
    whatever strategy its size suggests to Spark.
    """
    if labels is None:
        labels = F.broadcast(label_table(counts.sparkSession))
    return counts.join(labels, "Knowledge", "left")


def count_categories(counts: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``(Category, count)``: summed counts; terms without a category are left out."""
    return (
        label_terms(counts, labels)
        .filter("Category != 'null'")
        .groupBy("Category")
        .agg(F.sum("count").alias("count"))
    )
