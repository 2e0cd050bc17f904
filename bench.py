"""Time the headline queries on BENCH_SF_DIR with local[BENCH_CPUS]; prints one JSON line.

The tables are first copied into as many files as a large table has tasks for, so that the
plans are those of a large scan; the copy is not timed.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from jobsignals.plans.catalog import QUERIES
from jobsignals.plans.inputs import table

HEADLINE = [
    "knowledge_counts", "knowledge_by_category", "language_matches", "extract_postings",
    "salary_candidates", "salary_bins", "clean_text", "parse_messages", "split_sections",
    "page_links", "page_fields", "page_postings", "crawl_to_extract", "publish_roundtrip",
    "stream_landing", "stream_extract", "upsert_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()  # start-up is not part of any query
    copy = tempfile.mkdtemp(prefix="bench-")  # local mode: driver and executors are one process
    for name in ("documents", "pages", "events"):
        table(spark, sf_dir, name).repartition(2 * int(cpus)).write.parquet(f"{copy}/{name}.parquet")
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, copy).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
