"""Lines that stand on a large share of a site's pages, in DataFrame functions only.

A page's lines are the pieces between tags and line ends, without white space around
them. For each host the pages that hold a line are counted and divided by the host's
pages; lines above the ratio are boilerplate and leave every page of the host.

Scale: line hashes are counted with partial sums, so a line on all pages of a hot host
is one row per task. A host has at most (mean distinct lines of a page / ratio)
boilerplate lines, since each takes that share of its pages; they travel as one array
per host. Texts are not shuffled while all those lines are few enough to send to all
tasks, which is checked; beyond that hosts are joined, large ones in slices.

A line that no second page of its host holds is no boilerplate, so a host of one page
loses nothing; from two pages on the ratio alone decides, at every size of a host.

Defined results: a host is what stands between ``//`` and the next ``/``, ``?`` or ``#``, in
lower case, with a port or user name if there is one; a NULL or empty page has no lines and an empty text; pages without a
readable address share the host ''; a line that repeats inside a page counts once but
all its copies leave; each row counts as a page, repeated rows too; an empty table
gives no rows. Lines are compared by 64-bit hashes within a host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.tables import kept, table

RATIO = 0.1
#: A line repeats if two pages hold it.
MIN_PAGES = 2
#: Boilerplate lines, of 8 bytes each, that are sent to all tasks.
BROADCAST_LINES = 1_000_000
#: Pages of one host that one task joins where hosts are too many to broadcast.
SLICE = 100_000
HOST = r"^[a-z][a-z0-9+.-]*://([^/?#]*)"
BREAK = r"<[^<>]*>|[\n\r]"
EDGES = r"^[ \t\f]+|[ \t\f]+$"


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


def lines_of(text: Column) -> Column:
    pieces = F.split(F.coalesce(text, F.lit("")), BREAK, -1)
    trimmed = F.transform(pieces, lambda x: F.regexp_replace(x, EDGES, ""))
    return F.filter(trimmed, lambda x: x != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                url_col: str = "url", text_col: str = "html") -> DataFrame:
    """One row per host with boilerplate: host, pages, lines (their hashes)."""
    slim = pages.select(
        host_of(F.col(url_col)).alias("host"),
        F.array_distinct(F.transform(lines_of(F.col(text_col)), lambda x: F.xxhash64(x))).alias("hashes"))
    # One pass: the host's pages are counted as one more "line", NULL.
    counted = slim.select("host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "hashes")).alias("line"))
    counts = kept(counted.groupBy("host", "line").agg(F.count("*").alias("pages")), "line-counts")
    totals = counts.where(F.col("line").isNull()).select("host", F.col("pages").alias("all_pages"))
    frequent = counts.where(F.col("line").isNotNull() & (F.col("pages") >= min_pages)).join(totals, "host")
    return kept(
        frequent.where(F.col("pages") > ratio * F.col("all_pages"))
        .groupBy("host").agg(F.max("all_pages").alias("pages"), F.collect_list("line").alias("lines")),
        "boilerplate")


def without_boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                        id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
                        broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """One row per page: page_id, host, n_lines, n_dropped and the remaining text."""
    hosts = boilerplate(pages, ratio, min_pages, url_col, text_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                        F.col(text_col).alias("_text"))
    # A host's name counts as the lines it takes the room of.
    lines = hosts.agg(F.sum(F.size("lines") + F.ceil(F.octet_length("host") / 8))).first()[0] or 0
    if lines <= broadcast_lines:
        joined = rows.join(F.broadcast(hosts.select("host", "lines")), "host", "left")
    else:
        slices = F.ceil(F.col("pages") / SLICE).cast("int")
        sliced = hosts.withColumn("slices", slices)
        numbers = sliced.select("host", "lines", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
        # A row picks its slice from the host's number of slices, a narrow join first.
        rows = rows.join(sliced.select("host", "slices"), "host", "left").withColumn(
            "slice", F.pmod(F.xxhash64("page_id", "_text"), F.coalesce("slices", F.lit(1))).cast("int"))
        joined = rows.join(numbers, ["host", "slice"], "left")
    known = F.coalesce("lines", F.array().cast("array<bigint>"))
    parts = joined.withColumn("_lines", lines_of(F.col("_text"))).withColumn(
        "_rest", F.filter("_lines", lambda x: ~F.array_contains(known, F.xxhash64(x))))
    return parts.select(
        "page_id", "host", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_rest")).cast("long").alias("n_dropped"),
        F.array_join("_rest", "\n").alias("text"))


def op2_site_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_boilerplate(table(spark, sf_dir, "pages"))


OP2_SQL = f"""
WITH pages_lines AS (
  SELECT page_id, url, html, coalesce(regexp_extract(lower(url), '{HOST}', 1), '') AS host,
    list_filter(list_transform(string_split_regex(coalesce(html, ''), '{BREAK}'),
      lambda x: regexp_replace(x, '{EDGES}', '', 'g')), lambda x: x <> '') AS lines
  FROM pages),
hosts AS (SELECT host, count(*) AS n FROM pages_lines GROUP BY host),
counts AS (
  SELECT host, line, count(*) AS k
  FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM pages_lines) GROUP BY host, line),
known AS (
  SELECT host, list(line) AS lines FROM counts JOIN hosts USING (host)
  WHERE k > {RATIO} * n AND k >= {MIN_PAGES} GROUP BY host),
done AS (
  SELECT page_id, host, p.lines AS lines,
    list_filter(p.lines, lambda x: NOT list_contains(coalesce(k.lines, []), x)) AS rest
  FROM pages_lines p LEFT JOIN known k USING (host))
SELECT page_id, host, len(lines) AS n_lines, len(lines) - len(rest) AS n_dropped,
  coalesce(array_to_string(rest, chr(10)), '') AS text
FROM done
"""
