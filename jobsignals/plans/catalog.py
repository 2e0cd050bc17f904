"""Every operator as a query over the test tables."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from jobsignals import schemas
from jobsignals.functions import extractors as ex
from jobsignals.functions import html as h
from jobsignals.functions import matching as m
from jobsignals.functions import text as t
from jobsignals.functions.salary import (
    candidate_bins, salary_bins, salary_candidates, usd_amount, vnd_millions,
)
from jobsignals.operators import pages as pg
from jobsignals.operators import postings as po
from jobsignals.operators import terms as tm
from jobsignals.operators import vocabularies as vb
from jobsignals.plans.inputs import (
    SECTIONED, as_postings, job_pages, postings, table, table_stream,
)
from jobsignals.session import shared_folder
from jobsignals.sources import tables, topics
from jobsignals.sources.files import Folder
from jobsignals.streaming import jobs
from jobsignals.streaming.counts import read_counts, refresh_counts
from jobsignals.streaming.store import compact, latest_per_key, read_store, upsert_batch

Query = Callable[[SparkSession, str], DataFrame]

NAV = pg.Selectors(listing="nav", company="li", description="article", specialty="h1")
# Streams here read files that are all present, and end when they are read.
ONCE = True


def flat(extracted: DataFrame) -> DataFrame:
    """Lists as text, so that any engine compares them alike."""
    return extracted.select(
        *[
            F.array_join(F.col(f.name).cast("array<string>"), ";").alias(f.name)
            if f.dataType.typeName() == "array" else F.col(f.name)
            for f in extracted.schema
        ]
    )


def _matches(vocabulary: m.Vocabulary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = m.match_terms(po.posting_text(), vocabulary)
        return postings(spark, sf_dir).select("id", F.posexplode(found).alias("nth", "term"))

    return query


def _counts(vocabulary: m.Vocabulary, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = m.match_terms(po.posting_text(), vocabulary).alias(vocabulary.name)
        return tm.count_terms(postings(spark, sf_dir).select(found), vocabulary.name, name)

    return query


knowledge_counts = _counts(m.KNOWLEDGES, "Knowledge")


def knowledge_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.label_terms(knowledge_counts(spark, sf_dir))


def knowledge_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.count_categories(knowledge_counts(spark, sf_dir))


def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term found in every posting, with its category."""
    terms = ex.extract_knowledge("mo_ta_cong_viec", "yeu_cau_cong_viec")
    rows = postings(spark, sf_dir).select("id", F.explode(terms).alias("term"))
    return rows.withColumn("category", ex.labeling_knowledge("term"))


def salary_bin_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = postings(spark, sf_dir).select(salary_bins(F.col("quyen_loi")).alias("salaries"))
    return tm.count_terms(bins, "salaries", "Salary")


def extract_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(po.extract(po.drop_incomplete(postings(spark, sf_dir))))


def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "index")
    source = postings(spark, sf_dir).select(*schemas.POSTING_BATCH.fieldNames())
    documents = po.index_documents(po.extract(source))
    tables.write_index(documents, "json", {}, path)
    return flat(spark.read.schema(documents.schema).json(path))


def stored_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "extracted")
    name = "extracted_" + path[-8:]
    tables.ensure_table(spark, name, location=path)
    po.extract(postings(spark, sf_dir)).write.insertInto(name)
    stored = flat(spark.read.parquet(path).select("company_name", "framework_platforms"))
    spark.sql(f"DROP TABLE `{name}`")  # its files stay; they lie outside the warehouse
    return stored


def salary_candidate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = salary_candidates(F.col("quyen_loi"))
    return postings(spark, sf_dir).select("id", F.posexplode(found).alias("nth", "candidate"))


def salary_bin_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = salary_bins(F.col("quyen_loi")).alias("salaries")
    return flat(postings(spark, sf_dir).select("id", bins))


def salary_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read in each money amount: dollars, millions of its first part, bins."""
    found = salary_candidates(F.col("quyen_loi"))
    rows = postings(spark, sf_dir).select("id", F.posexplode(found).alias("nth", "candidate"))
    amount = F.col("candidate")
    parts = F.split(F.btrim(t.strip(amount), F.lit("-")), "-", -1)
    return flat(rows.select(
        "id", "nth", usd_amount(amount).cast("string").alias("dollars"),
        vnd_millions(F.get(parts, F.lit(0))).cast("string").alias("millions"),
        candidate_bins(amount).alias("bins"),
    ))


def nfkc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).select("id", t.nfkc(F.col("quyen_loi")).alias("benefits"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", t.clean(F.col("html")).alias("text"))


def clean_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return po.clean_postings(postings(spark, sf_dir))


def clean_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_postings(spark, sf_dir).agg(F.count("*").alias("n"))


def clean_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "clean")
    cleaned = clean_postings(spark, sf_dir)
    tables.write_json(cleaned, path)
    return tables.read_postings(spark, path, cleaned.schema)


def parse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return po.parse_postings(po.to_messages(postings(spark, sf_dir)))


def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k long").alias("data")
    return table(spark, sf_dir, "events").select("event_id", props).select("event_id", "data.*")


def numeric_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose id is a clock time written as a JSON number."""
    clock = F.expr("CAST(1704067200 + event_id AS DECIMAL(20,2)) + CAST(value AS DECIMAL(20,2))")
    messages = table(spark, sf_dir, "events").select(
        F.to_json(F.struct(clock.alias("id"), F.col("event_type").alias("name"))).alias("value")
    )
    return po.parse_postings(messages).select("id", "name")


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return po.drop_incomplete(postings(spark, sf_dir))


def na_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return po.fill_missing(postings(spark, sf_dir))


def union_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English postings, joined by those of a site that has no specialties."""
    known = F.when(F.expr("CAST(id AS BIGINT) % 7 <> 3"), F.col("dia_diem_lam_viec"))
    both = postings(spark, sf_dir).withColumn("dia_diem_lam_viec", known)
    second = both.filter("NOT (dia_diem_lam_viec <=> 'en')").drop("chuyen_mon")
    return po.union_sites(both.filter("dia_diem_lam_viec = 'en'"), second)


def complete_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return po.drop_incomplete(union_sites(spark, sf_dir), ["id", "yeu_cau_cong_viec"])


def split_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{SECTIONED} AS body")
    parts = texts.select("doc_id", t.sections(F.col("body")).alias("parts"))
    names = [f"part_{i}" for i in range(1, len(t.SECTION_HEADERS) + 1)]
    return parts.select(
        "doc_id",
        *[t.section(F.col("parts"), s).alias(n) for s, n in zip(t.SECTION_HEADERS, names)],
    )


def specialty_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).select("id", t.specialty(F.col("chuyen_mon")).alias("specialty"))


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        pg.listing_url(F.col("page_id")).alias("first_site"),
        pg.listing_url(F.col("page_id"), pg.LISTING_URL_SECOND).alias("second_site"),
    )


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.page_links(table(spark, sf_dir, "pages"), NAV)


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.page_fields(table(spark, sf_dir, "pages"), NAV)


def page_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements by selectors with children, places and attributes, on pages with open elements."""
    found = pg.select_elements(table(spark, sf_dir, "pages"), {
        "second": "nav > ul > li:nth-child(2) > a[href^='/']", "paragraph": "article p", "ad": "body div.ad"})
    return found.select("url", "name", "nth", "tag", F.col("attributes")["href"].alias("href"), "html")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", h.visible_text(h.visible_markup(F.col("html"))).alias("text")
    )


def job_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.page_links(job_pages(spark, sf_dir))


def page_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.page_postings(job_pages(spark, sf_dir))


def page_postings_second_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.page_postings(job_pages(spark, sf_dir), pg.Selectors(specialty=None))


def crawl_to_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages -> posting records -> messages -> extracted rows, in one plan."""
    return flat(jobs.extract_stream(po.to_messages(page_postings(spark, sf_dir))))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "json")
    tables.write_json(postings(spark, sf_dir), path)
    return tables.read_postings(spark, f"{path}/*.json")


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "topic")
    topics.publish(po.to_messages(page_postings(spark, sf_dir)), {}, "text", path)
    return po.parse_postings(topics.replay(spark, {}, "text", path))


def _messages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return po.to_messages(as_postings(table_stream(spark, sf_dir, "documents")))


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "landing")
    messages = _messages_stream(spark, sf_dir)
    jobs.land(messages, f"{folder}/data", f"{folder}/checkpoint", once=ONCE).awaitTermination()
    return tables.read_postings(spark, f"{folder}/data")


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "fanout")
    messages = _messages_stream(spark, sf_dir)
    queries = jobs.land_and_echo(
        messages, f"{folder}/data", f"{folder}/checkpoint", once=ONCE, out=sys.stderr
    )
    jobs.await_all(queries)
    return tables.read_postings(spark, f"{folder}/data")


def stream_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "extract")
    rows = jobs.extract_stream(_messages_stream(spark, sf_dir))
    query = jobs.append_stream(rows, f"{folder}/checkpoint", f"{folder}/data", once=ONCE)
    query.awaitTermination()
    return flat(spark.read.schema(schemas.EXTRACTED).json(f"{folder}/data"))


def _topic(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The postings as a topic of several text files, in the order of their parts: half of
    them first with another name, then all with their own. The rows are written where they are
    read, packed, since a message holds its text twice; only those of a single split are dealt
    out, to two files."""
    rows = postings(spark, sf_dir)
    several = rows.rdd.getNumPartitions() > 1
    old = rows.where(_half("id") == 0).withColumn("name", F.lit("before"))
    for part, frame in enumerate((old, rows)):
        frame = frame if several else frame.repartition(2, "id")
        topics.publish(po.to_messages(frame), {"compression": "gzip"}, "text", f"{folder}/part={part}")
    return folder


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """The topic's files as a stream of some four batches, with a place for each message as a
    broker gives one."""
    files = sum(n.startswith("part-") for part in (0, 1) for n in Folder(spark, f"{folder}/part={part}").names())
    lines = spark.readStream.schema("value string, part int").option("maxFilesPerTrigger", max(1, files // 4)).text(folder)
    return lines.selectExpr("value", "0 AS partition", "CAST(part AS BIGINT) AS offset",
                            "timestamp_seconds(part) AS timestamp")


def stream_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys recur over the batches; a message's place in the topic decides."""
    folder = shared_folder(spark, "store")
    messages = _placed(spark, _topic(spark, sf_dir, f"{folder}/topic"))
    rows = jobs.extract_stream(messages, keep=jobs.positions(messages))
    jobs.upsert_stream(rows, f"{folder}/checkpoint", f"{folder}/data", once=ONCE).awaitTermination()
    return flat(read_store(spark, f"{folder}/data", schemas.EXTRACTED))


def stream_raw_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "raw")
    messages = _placed(spark, _topic(spark, sf_dir, f"{folder}/topic"))
    jobs.store_raw(messages, f"{folder}/data", f"{folder}/checkpoint", once=ONCE).awaitTermination()
    return read_store(spark, f"{folder}/data", schemas.POSTING_RAW_STORE)


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = [F.desc("ts"), F.desc("event_id")]
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], newest)


def _half(name: str) -> Column:
    """0 or 1 for any value of a column, NULL included."""
    return F.pmod(F.coalesce(F.hash(F.col(name).cast("string")), F.lit(0)), F.lit(2))


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in several files, two streams on one store at the same time, which is
    compacted meanwhile."""
    folder = shared_folder(spark, "upsert")
    events = table(spark, sf_dir, "events")
    queries = []
    for half in (0, 1):
        part = f"{folder}/events/half={half}"
        events.where(_half("event_id") == half).repartition(3, "event_id").write.parquet(part)
    for half in (0, 1):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events/half={half}")
        queries.append(jobs.upsert_stream(stream, f"{folder}/checkpoint-{half}", f"{folder}/data", key="user_id",
                                          newest=["ts", "event_id"], once=ONCE))
    while any(q.isActive for q in queries):
        compact(spark, f"{folder}/data", events.schema, "user_id")
    jobs.await_all(queries)
    return read_store(spark, f"{folder}/data", events.schema, "user_id")


def term_table(documents: DataFrame) -> DataFrame:
    """A vocabulary that grows with the documents: the first long word of each, its first two
    words, and its first three characters, in upper case for every other document."""
    words = F.split("text", "[ \n]+", 3)
    given = F.array(F.regexp_extract("text", "([^ \n.,]{7,})", 1), F.concat_ws(" ", F.get(words, F.lit(0)), F.get(words, F.lit(1))),
                    F.substring("text", 1, 3))
    given = F.when(F.col("doc_id") % 2 == 0, given).otherwise(F.transform(given, t.upper))
    return documents.select(F.explode(given).alias("term"))


def table_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of a table in the texts of all documents."""
    documents = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "terms")
    vb.term_index(term_table(documents)).write.parquet(folder)
    return vb.match_table(documents, spark.read.parquet(folder), keep=["doc_id"])


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts kept up to date over three batches of a store: half of the postings under
    another text, all of them as they are, and half of them once more. What was extracted
    is written, so that a posting that comes again is not read again."""
    folder = shared_folder(spark, "counts")
    rows = postings(spark, sf_dir)
    other = rows.where(_half("id") == 0).withColumn("mo_ta_cong_viec", F.lit("Docker, SQL và Java"))
    po.extract(rows).write.parquet(f"{folder}/extracted")
    extracted = spark.read.schema(schemas.EXTRACTED).parquet(f"{folder}/extracted")
    write = upsert_batch(f"{folder}/store")
    for number, batch in enumerate((po.extract(other), extracted, extracted.where(_half("id") == 0))):
        write(batch, number)
        refresh_counts(spark, f"{folder}/counts", f"{folder}/store", schemas.EXTRACTED, "knowledges", "Knowledge")
    return read_counts(spark, f"{folder}/counts", "Knowledge")


def stream_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published messages, read as a stream from the earliest on, landed and read."""
    folder = shared_folder(spark, "topic")
    topics.publish(po.to_messages(postings(spark, sf_dir)), {}, "text", f"{folder}/topic")
    messages = topics.read_stream(spark, {"maxFilesPerTrigger": "2"}, "text", path=f"{folder}/topic")
    jobs.land(messages, f"{folder}/data", f"{folder}/checkpoint", once=ONCE).awaitTermination()
    return tables.read_postings(spark, f"{folder}/data")


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint, with messages added in between."""
    folder = shared_folder(spark, "resume")
    rows = postings(spark, sf_dir)
    for part in (0, 1):
        messages = po.to_messages(rows.where(_half("id") == part))
        topics.publish(messages, {}, "text", f"{folder}/topic")
        stream = topics.read_stream(spark, {}, "text", path=f"{folder}/topic")
        jobs.land(stream, f"{folder}/data", f"{folder}/checkpoint", once=ONCE).awaitTermination()
    return tables.read_postings(spark, f"{folder}/data")


def listing_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = table(spark, sf_dir, "pages").agg(F.min("page_id"), F.max("page_id")).first()
    return pg.listing_urls(spark, first, last)


def knowledge_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts with their place in the order of the report. A few hundred rows at most,
    one per term of the vocabulary."""
    place = F.row_number().over(Window.orderBy(F.desc("count"), "Knowledge"))
    return knowledge_counts(spark, sf_dir).withColumn("place", place)


QUERIES: dict[str, Query] = {
    "knowledge_counts": knowledge_counts,
    "knowledge_labels": knowledge_labels,
    "knowledge_by_category": knowledge_by_category,
    "label_lookup": label_lookup,
    "framework_counts": _counts(m.FRAMEWORKS, "Framework"),
    "language_counts": _counts(m.LANGUAGES, "Language"),
    "design_pattern_counts": _counts(m.DESIGN_PATTERNS, "DesignPattern"),
    "salary_bin_counts": salary_bin_counts,
    "framework_matches": _matches(m.FRAMEWORKS),
    "language_matches": _matches(m.LANGUAGES),
    "design_pattern_matches": _matches(m.DESIGN_PATTERNS),
    "knowledge_matches": _matches(m.KNOWLEDGES),
    "table_matches": table_matches,
    "extract_postings": extract_postings,
    "index_documents": index_documents,
    "stored_projection": stored_projection,
    "salary_candidates": salary_candidate_rows,
    "salary_bins": salary_bin_rows,
    "salary_amounts": salary_amounts,
    "nfkc_text": nfkc_text,
    "clean_text": clean_text,
    "clean_postings": clean_postings,
    "clean_count": clean_count,
    "clean_roundtrip": clean_roundtrip,
    "parse_messages": parse_messages,
    "parse_props": parse_props,
    "numeric_ids": numeric_ids,
    "drop_incomplete": drop_incomplete,
    "na_defaults": na_defaults,
    "union_sites": union_sites,
    "complete_sites": complete_sites,
    "split_sections": split_sections,
    "specialty_label": specialty_label,
    "page_urls": page_urls,
    "page_links": page_links,
    "page_fields": page_fields,
    "page_select": page_select,
    "page_text": page_text,
    "job_links": job_links,
    "page_postings": page_postings,
    "page_postings_second_site": page_postings_second_site,
    "crawl_to_extract": crawl_to_extract,
    "json_roundtrip": json_roundtrip,
    "publish_roundtrip": publish_roundtrip,
    "stream_landing": stream_landing,
    "stream_fanout": stream_fanout,
    "stream_extract": stream_extract,
    "stream_store": stream_store,
    "stream_raw_store": stream_raw_store,
    "upsert_latest": upsert_latest,
    "stream_upsert": stream_upsert,
    "stream_counts": stream_counts,
    "stream_topic": stream_topic,
    "stream_resume": stream_resume,
    "listing_urls": listing_urls,
    "knowledge_ranking": knowledge_ranking,
}
