"""The jobs by name, for spark-submit with run_job.py or for ``python -m jobsignals``:

    clean   --input '/data/raw/*.json' --output /data/cleaned
    extract --input '/data/raw/*.json' --format parquet --output /data/index
    land    --servers broker:9092 --output /data/raw --checkpoint /data/checkpoints/land
    store   --servers broker:9092 --output /data/store --checkpoint /data/checkpoints/store
    links   --input /data/listings.parquet --output /data/links
    publish --input /data/pages.parquet --servers broker:9092
    compact --output /data/store
    vacuum  --output /data/store
    refresh --input /data/store --output /data/counts
    report  --input /data/index --format parquet --output /data/report

Topics are read from and written to Kafka when ``--servers`` is given, otherwise
text files under ``--topic`` stand in for them. ``--source-option`` bounds and secures
the reading: ``maxOffsetsPerTrigger=100000``, ``failOnDataLoss=false``, ``kafka.security.protocol=SSL``.
``links --pages 1-22`` alone writes the addresses of the listing pages; with ``--input``, a table of
fetched pages (``url``, ``html``), it writes the links of their entries.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from jobsignals import schemas
from jobsignals.operators import pages, postings, terms
from jobsignals.session import get_spark
from jobsignals.sources import tables, topics
from jobsignals.streaming import counts, jobs, store as store_files


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    """Postings without tags, as JSON; prints how many. The rows are counted while
    they are written, so nothing is computed twice or cached."""
    rows = Observation("rows")
    cleaned = postings.clean_postings(tables.read_postings(spark, args.input))
    tables.write_json(cleaned.observe(rows, F.count(F.lit(1)).alias("n")), args.output, args.files, args.file_mb)
    print(rows.get["n"])


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """Postings to a document index."""
    source = tables.read_postings(spark, args.input, schemas.POSTING_BATCH)
    documents = postings.index_documents(postings.extract(source))
    tables.write_index(documents, args.format, dict(args.option), args.output)


def _messages(spark: SparkSession, args: argparse.Namespace, starting: str | None) -> DataFrame:
    given = dict(args.source_option)
    if args.servers:
        return topics.read_stream(spark, topics.kafka_options(args.servers, args.topic, starting) | given)
    return topics.read_stream(spark, given, "text", path=args.topic)


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    """Messages from the earliest on to JSON files, and the first rows of each batch to the console."""
    jobs.await_all(jobs.land_and_echo(
        _messages(spark, args, "earliest"), args.output, args.checkpoint, once=args.once))


def store(spark: SparkSession, args: argparse.Namespace) -> None:
    """Extracted rows of complete messages to a keyed store, or to the sink of a connector."""
    messages = _messages(spark, args, None)
    # A keyed store compares places in the topic; other sinks get the extracted rows alone.
    rows = jobs.extract_stream(messages, keep=[] if args.format else jobs.positions(messages))
    if args.format:
        query = jobs.append_stream(
            rows, args.checkpoint, args.output, args.format, dict(args.option), once=args.once
        )
    else:
        query = jobs.upsert_stream(rows, args.checkpoint, args.output, once=args.once)
    query.awaitTermination()


def links(spark: SparkSession, args: argparse.Namespace) -> None:
    """Addresses of listing pages, or the links in fetched listing pages, as JSON."""
    if args.input:
        found = pages.page_links(spark.read.parquet(args.input))
    else:
        first, last = (int(n) for n in args.pages.split("-"))
        found = pages.listing_urls(spark, first, last)
    tables.write_json(found, args.output, args.files, args.file_mb)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rewrite a keyed store to the last write of each key."""
    store_files.compact(spark, args.output, schemas.EXTRACTED)


def vacuum(spark: SparkSession, args: argparse.Namespace) -> None:
    """Delete files of a keyed store that no version of the last week uses."""
    print(store_files.vacuum(spark, args.output))


def refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bring the counts of knowledge terms up to a keyed store's last version."""
    counts.refresh_counts(spark, args.output, args.input, schemas.EXTRACTED, "knowledges", "Knowledge")


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Posting records of crawled pages (``url``, ``html``) to a topic."""
    messages = postings.to_messages(pages.page_postings(spark.read.parquet(args.input)))
    if args.servers:
        topics.publish(messages, topics.kafka_sink_options(args.servers, args.topic))
    else:
        topics.publish(messages, {}, "text", args.topic)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Knowledge terms and categories by frequency, as JSON."""
    source = spark.read.format(args.format).options(**dict(args.option)).load(args.input)
    # Counted once; the categories are summed from the small table written.
    found = terms.count_terms(source, "knowledges")
    tables.write_json(found, f"{args.output}/knowledge")
    written = spark.read.schema(found.schema).json(f"{args.output}/knowledge")
    tables.write_json(terms.count_categories(written), f"{args.output}/category")


JOBS = {f.__name__: f for f in (links, publish, land, clean, extract, store, compact, vacuum, refresh, report)}


def _pair(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobsignals", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--input")
    parser.add_argument("--output")
    parser.add_argument("--checkpoint")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic", default=topics.TOPIC)
    parser.add_argument("--format", help="format of an index, or of a connector's sink")
    parser.add_argument("--option", action="append", type=_pair, default=[], metavar="KEY=VALUE")
    parser.add_argument("--source-option", action="append", type=_pair, default=[], metavar="KEY=VALUE",
                        help="option of the topic's reader")
    parser.add_argument("--pages", default="1-1", metavar="FIRST-LAST", help="listing pages, for links")
    parser.add_argument("--files", type=int, help="number of output files, for small results")
    parser.add_argument("--file-mb", type=int, help="size of output files, about")
    parser.add_argument("--once", action="store_true", help="end when the topic is read")
    args = parser.parse_args(argv)
    JOBS[args.job](get_spark(f"jobsignals-{args.job}"), args)


if __name__ == "__main__":
    main()
