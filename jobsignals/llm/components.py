"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.ranking import SMALL
from jobsignals.llm.tables import kept


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


#: Nodes that a task of :func:`forest` knows; then it starts anew and leaves out less.
KNOWN = 1_000_000
#: Links per task of its second look.
TOGETHER = 500_000


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (above := root.setdefault(top, top)) != top:
            top = above
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        keep = []
        for row, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
                keep.append(row)
        yield batch.take(pa.array(keep, pa.int64()))
        if len(root) > KNOWN:
            root.clear()


def forest(links: DataFrame) -> DataFrame:
    """Some of the links (columns a, b) that connect what all of them connect: each task leaves
    out links between nodes that others of its links connect, first where the links lie,
    then dealt out anew. A dense group keeps about a link per node and task."""
    some = kept(links.select("a", "b").mapInArrow(_spanning, "a long, b long"), "forest")
    tasks = max(4, -(-some.count() // TOGETHER))
    return some.repartition(tasks).mapInArrow(_spanning, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """For each node of the links (columns a, b; longs) the least node it is connected
    with: node, component. Every step is a grouping and a join; its rows are written,
    and the driver sees a count and a checksum. The minima of a step have at most two
    rows per link and are broadcast while that number, which is checked, is small."""
    edges = kept(forest(links).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), "links")
    state = _state(edges)
    while state[0]:
        sent = F.broadcast if 2 * state[0] <= SMALL else lambda minima: minima
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(sent(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(sent(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = kept(small.where("a <> b").unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return kept(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct(), "components")
