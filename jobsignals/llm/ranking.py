"""Ranks over large groups without a task that holds a whole group.

A window over one group would sort all its rows in one task. Here the rows of a
group are first cut into blocks by a number in [0, 1) that grows with the order,
blocks are counted, and only the rows of one block are sorted together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows up to which a table of counts is sent to all tasks.
SMALL = 100_000


def small(counts: DataFrame) -> DataFrame:
    """Counts marked for a broadcast if their number, which is checked, allows it."""
    return F.broadcast(counts) if counts.limit(SMALL + 1).count() <= SMALL else counts


def ranked(rows: DataFrame, group: str, place: str, order: list[str], rank: str, size: str) -> DataFrame:
    """``rows`` with their rank in the group (from 1) and the group's size.

    ``place`` is a double in [0, 1) that does not fall along ``order``; its values
    should be about evenly spread. ``group`` holds no NULLs. ``rows`` is read three
    times, so it should be a narrow table that has been written.
    """
    spark = rows.sparkSession
    total = rows.count()
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy(group).agg(F.count("*").alias(size))
    share = F.ceil(F.col(size) * F.lit(float(blocks) / max(total, 1)))
    placed = rows.join(small(sizes), group).withColumn(
        "_block", F.floor(F.col(place) * share))
    counts = placed.groupBy(group, "_block").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(
        Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(group, "_block", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(group, "_block").orderBy(*order))
    return (
        placed.withColumn("_inside", inside).join(small(starts), [group, "_block"])
        .withColumn(rank, F.col("_inside") + F.col("_before")).drop("_block", "_inside", "_before")
    )


def shuffled_place(*columns: str, seed: int) -> F.Column:
    """A number in [0, 1) that looks random and follows from the columns and the seed
    alone: the first 52 bits of an MD5 sum."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_texts(documents: DataFrame, places: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All columns of ``documents`` with the columns that ``places`` gives to a row.

    ``places`` has doc_id, row (text key) and further columns, one row for each
    document. Rows with equal id and text take their places in turn.
    """
    from jobsignals.llm.tables import given, text_key, veil_of, veiled

    new = tuple(c for c in places.columns if c not in ("doc_id", "row"))
    dealt = places.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct(*new))).alias("places__"))
    dealt = dealt.select(F.coalesce("doc_id", F.lit(0)).alias("known__"), F.col("doc_id").isNull().alias("null__"),
                         F.col("row").alias("row__"), "places__")
    key = F.col(veil_of(documents, id_col)).cast("long")
    keyed = veiled(documents).withColumns({
        "known__": F.coalesce(key, F.lit(0)), "null__": key.isNull(),
        "row__": text_key(F.col(veil_of(documents, text_col)))})
    turn = F.row_number().over(Window.partitionBy("known__", "null__", "row__").orderBy(F.lit(0)))
    chosen = keyed.withColumn("turn__", turn).join(dealt, ["known__", "null__", "row__"])
    return chosen.select(*given(documents, new), *[F.element_at("places__", F.col("turn__"))[c].alias(c) for c in new])
