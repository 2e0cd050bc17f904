"""From raw documents to training shards, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm import decontaminate, mixing, nearcopies, quality, shards
from jobsignals.llm.labelled import fold_of
from jobsignals.llm.tables import kept, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more; labels of one fold stay unseen."""
    score = quality.fitted(docs, table(spark, sf_dir, "labels"), fold_of(F.col("doc_id"), 3) != 1)
    return quality.good(docs, score)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies."""
    return nearcopies.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within the edit budget."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture of their sources; the next stage deals
    them out in it."""
    return mixing.in_mixed_order(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot, interleaved by turns of the mixture: each
    shard, read by slots, has the target weights until a source runs out."""
    return shards.dealt(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near_copies", one_of_each),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: A model, edit distances and a schedule have no SQL form; tests/llm compares every
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = kept(docs, f"stage-{name}")
    return docs
