"""Training shards by proportional stratified interleaving, in DataFrame functions only.

Each source's rows are put into a seeded random order; a row's fractional rank is
(2 rank - 1) / (2 rows of its source). In the order of fractional ranks any stretch
holds all sources in their proportions, so equal cuts give shards that match the
mixture. The law is ``rows``: the numbers of rows in two shards differ by one at most.

Rows that come in an order of their own, such as a mixture's (:func:`dealt`), go through the
same ranks and cuts. A row's place is found from the files, and the strata are turns: as many
rows as there are shards, one after another. A turn has a row for each shard, so each shard
follows the order; the rows of a last, shorter turn go to shards at even distances.

A hot source is ranked in blocks (:mod:`jobsignals.llm.ranking`), never in one task;
ranks are computed on ids and sizes, texts are not shuffled for them.

Defined results: rows without a source form a source of their own; a NULL text has
size 1 and the checksum 0 of no bytes; repeated rows each get a slot; equal texts are
not kept together, which the law rules out for large groups; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsignals.llm.ranking import SMALL, ranked, shuffled_place, small, with_texts
from jobsignals.llm.tables import given, kept, quoted, table, text_key, veiled

SHARDS = 8
SEED = 7


def _cut(slim: DataFrame, order: list[str], fraction: Column, spread: Column, shards: int) -> DataFrame:
    """Narrow rows (a stratum, a place in it as :func:`ranked` takes it, and more) with shard and
    slot: ranked in their strata along ``order``, then put in the order of the ``fraction`` that
    follows from rank and stratum_rows, and cut equally. ``spread`` is the place in that order."""
    by_stratum = ranked(slim, "stratum", "place", order, "rank", "stratum_rows")
    rest = [c for c in slim.columns if c not in ("stratum", "place")]
    mixed = kept(by_stratum.withColumn("fraction", fraction).select(
        *rest, "stratum", "rank", "fraction", spread.alias("spread"), F.lit(0).alias("all")), "shard-ranks")
    whole = ranked(mixed, "all", "spread", ["fraction", "stratum", "rank"], "position", "rows")
    return whole.withColumn("shard", F.expr(f"((position - 1) * {shards}) DIV rows")).select(
        *rest, F.col("shard").cast("int").alias("shard"),
        F.expr(f"position - 1 - (shard * rows + {shards - 1}) DIV {shards}").alias("slot"))


def interleaved(documents: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, row (text key), size, text_crc32, law, shard, slot."""
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    slim = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    )
    slim = kept(slim.withColumn("place", shuffled_place("doc_id", "text_crc32", seed=seed)), "shard-rows")
    order = ["place", "doc_id", "text_crc32", "size", "row"]
    fraction = (2 * F.col("rank") - 1) / (2 * F.col("stratum_rows"))
    return _cut(slim, order, fraction, F.col("fraction"), shards).select(
        "doc_id", "row", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot")


def sharded(documents: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
            text_col: str = "text", source_col: str = "source") -> DataFrame:
    """All columns of the documents with shard and slot; columns of these names are replaced."""
    places = interleaved(documents, shards, seed, id_col, text_col, source_col)
    return with_texts(documents, places.select("doc_id", "row", "shard", "slot"), id_col, text_col)


def _with_files(documents: DataFrame) -> DataFrame:
    """All columns veiled, with file__ and at__, the row's file and place in it. Rows that are
    not plainly those of Parquet files are written first, which keeps their order."""
    file = [F.col("_metadata.file_path").alias("file__"), F.col("_metadata.row_index").alias("at__")]
    if documents._jdf.queryExecution().analyzed().children().isEmpty():
        try:
            names = [F.col(quoted(c)).alias(f"given__{i}") for i, c in enumerate(documents.columns)]
            return documents.select(*names, *file)
        except AnalysisException:  # no files, or of another format
            pass
    return kept(veiled(documents), "shard-order").select("*", *file)


def dealt(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All columns of the documents with shard and slot, interleaved by turns of their
    order: that of the files by task number and of the rows in them, or else the order
    in which they would be written. Columns of these names are replaced."""
    placed = _with_files(documents)
    files = kept(placed.groupBy("file__").agg(F.count("*").alias("rows__")), "shard-files")
    order = [F.regexp_extract("file__", "part-([0-9]+)[^/]*$", 1).try_cast("long"), F.col("file__")]
    before = F.sum("rows__").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    starts = files.select("file__", F.coalesce(before, F.lit(0)).alias("before__"))
    placed = placed.join(small(starts), "file__").withColumn("order__", F.col("before__") + F.col("at__"))
    slim = kept(placed.select("order__", F.expr(f"order__ DIV {shards}").alias("stratum"),
                              ((F.col("order__") % shards) / shards).alias("place")), "shard-rows")
    fraction = (F.col("rank") - 1) / F.col("stratum_rows")
    # Of equal fractions the earlier turn comes first.
    turns = max(1, -(-slim.count() // shards))
    spread = (F.floor(F.col("fraction") * shards) + F.col("stratum") / turns) / shards
    places = kept(_cut(slim, ["order__"], fraction, spread, shards), "shard-places")
    few = places.limit(SMALL + 1).count() <= SMALL
    return placed.join(places.hint("broadcast" if few else "merge"), "order__").select(
        *given(documents, ("shard", "slot")), "shard", "slot")


def op7_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP7_SQL = f"""
WITH bytes AS (
  SELECT doc_id, source, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS b FROM documents),
steps AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
sums AS (
  SELECT doc_id, coalesce('=' || source, '') AS stratum, len(b) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(b, lambda x: ('0x' || x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, steps),
placed AS (
  SELECT *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32::VARCHAR), 1, 13))
    ::BIGINT AS place FROM sums),
ranks AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY place, doc_id, text_crc32, size) AS r,
    count(*) OVER (PARTITION BY stratum) AS n FROM placed),
mixed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r - 1)::DOUBLE / (2 * n)::DOUBLE, stratum, r) - 1 AS p,
    count(*) OVER () AS rows FROM ranks)
SELECT doc_id, size, text_crc32, 'rows' AS law, ((p * {SHARDS}) // rows)::INTEGER AS shard,
  p - (((p * {SHARDS}) // rows) * rows + {SHARDS - 1}) // {SHARDS} AS slot, NULL::INTEGER AS grown_shard
FROM mixed
"""
