"""Sources mixed to target weights by Pfair scheduling.

Each source's rows, in a seeded random order, form blocks. The target is a steady flow:
every source that is not used up gets slots in proportion to its weight w, so that after
a time x sources have min(w x, n) of their n blocks and t(x), the sum of these, slots are
gone. A source's k-th block gets its slot inside the window from floor(t((k - 1) / w)),
the release, to ceil(t(k / w)), the deadline. In each slot the released block with the
earliest deadline comes next (ties: first source by name). No window is missed, since any
stretch holds at most as many whole windows as slots: each source is less than one block
off its target at every slot, from the first to the last, also where others run out.

Windows are computed in whole numbers from the decimal digits of the weights, so nothing
is rounded and nothing adds up. One task runs the schedule and writes it as a table, a
row per block; it holds a few numbers per source, whatever the number of rows. Rows find
their block's slot by a join. Within a source rows are ranked in blocks
(:mod:`jobsignals.llm.ranking`), so a hot source fills no task.

Defined results: rows without a source form a source of their own; rows of sources
without a positive weight follow last, in the same way with weights by their numbers
of blocks; all rows get a place, repeated rows and empty texts too; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import chain, islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.ranking import ranked, shuffled_place, small, with_texts
from jobsignals.llm.tables import given, kept, table, text_key, veil_of, veiled

SEED = 11
BLOCK_ROWS = 64
#: Slots of the schedule that its task gives out at a time.
PERIOD = 10_000
#: Exponent of the default target weights: shares go with rows ** TEMPERATURE.
TEMPERATURE = 0.5


def schedule(blocks: Mapping[str, int], weights: Mapping[str, float]) -> Iterator[tuple[str, int]]:
    """Source and number (from 0) of the block in each slot, for positive weights."""
    exact = {s: Fraction(repr(float(weights[s]))) for s, n in blocks.items() if n > 0}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    share = {s: int(w * scale) for s, w in exact.items()}
    # Where sources run out in the steady flow: blocks gone by then, shares that go on.
    ends = sorted(exact, key=lambda s: Fraction(blocks[s], share[s]))
    gone, going = [0], [sum(share.values())]
    for s in ends:
        gone.append(gone[-1] + blocks[s])
        going.append(going[-1] - share[s])
    stretch = dict.fromkeys(exact, 0)

    def time(source: str, block: int) -> tuple[int, int]:
        """When the flow has given ``block`` blocks: whole slots, and 1 if a part follows."""
        w, at = share[source], stretch[source]
        if at < len(ends) and block * share[ends[at]] >= blocks[ends[at]] * w:
            at = bisect_right(ends, 0, at + 1, key=lambda s: blocks[s] * w - block * share[s] > 0)
            stretch[source] = at
        whole, rest = divmod(going[at] * block, w)
        return gone[at] + whole, int(rest > 0)

    begins = dict.fromkeys(exact, 0)
    released = [(0, s) for s in sorted(exact)]
    ready: list[tuple[int, str]] = []
    done = dict.fromkeys(exact, 0)
    for slot in range(sum(blocks[s] for s in exact)):
        while released and released[0][0] <= slot:
            _, source = heapq.heappop(released)
            begins[source], part = time(source, done[source] + 1)
            heapq.heappush(ready, (begins[source] + part, source))
        _, source = heapq.heappop(ready)
        yield source, done[source]
        done[source] += 1
        if done[source] < blocks[source]:
            heapq.heappush(released, (begins[source], source))


def _scheduled(weights: Mapping[str, float] | None, block_rows: int, period: int):
    """The schedule of all sources from their numbers of rows: key, block, slot and start,
    the position of the block's first row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = {key: int(n) for pdf in batches for key, n in zip(pdf["key"], pdf["rows"])}
        blocks = {s: -(-n // block_rows) for s, n in rows.items()}
        if weights is None:
            target = {s: n ** TEMPERATURE for s, n in rows.items()}
        else:
            target = {s: weights.get(s[1:] if s else None, 0) for s in rows}
        wanted = {s: n for s, n in blocks.items() if target[s] > 0}
        rest = {s: n for s, n in blocks.items() if s not in wanted}
        slots = chain(schedule(wanted, target), schedule(rest, rest))
        slot = start = 0
        while some := list(islice(slots, period)):
            out = []
            for key, block in some:
                out.append((key, block, slot, start))
                slot += 1
                start += min(block_rows, rows[key] - block * block_rows)
            yield pd.DataFrame(out, columns=["key", "block", "slot", "start"])

    return run


def mixed(documents: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS,
          period: int = PERIOD, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, row (text key), source, block (from 0), slot and
    position, the row's place in the mixture (from 0, without gaps).

    ``weights`` maps sources to target weights; without it they go with the square
    root of a source's rows.
    """
    slim = kept(documents.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("key"),
    ).withColumn("place", shuffled_place("doc_id", "row", seed=seed)), "mix-rows")
    counts = slim.groupBy("key").agg(F.count("*").alias("rows")).repartition(1)
    slots = kept(counts.mapInPandas(_scheduled(weights, block_rows, period),
                                    "key string, block long, slot long, start long"), "mix-schedule")
    ranks = ranked(slim, "key", "place", ["place", "doc_id", "row"], "rank", "rows")
    placed = ranks.select("doc_id", "row", "key", F.expr(f"(rank - 1) DIV {block_rows}").alias("block"),
                          F.expr(f"(rank - 1) % {block_rows}").alias("inside")).join(small(slots), ["key", "block"])
    return placed.select("doc_id", "row", F.expr("substr(nullif(key, ''), 2)").alias("source"),
                         "block", "slot", (F.col("start") + F.col("inside")).alias("position"))


def in_mixed_order(documents: DataFrame, weights: Mapping[str, float] | None = None, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """All columns of the documents, rows in the order of the mixture: written out, the
    files follow each other in it."""
    places = mixed(documents, weights, id_col=id_col, text_col=text_col, **options)
    placed = with_texts(veiled(documents), places.select("doc_id", "row", F.col("position").alias("position__")),
                        veil_of(documents, id_col), veil_of(documents, text_col))
    return placed.orderBy("position__").select(*given(documents))


def op6_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).drop("row")
