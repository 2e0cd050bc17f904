"""From crawled pages to posting records."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobsignals.functions import html as h
from jobsignals.functions import selectors as sel
from jobsignals.functions import text as t
from jobsignals.functions.binding import with_columns_once

# --- Fixed values: addresses of the listing pages of the two job sites
LISTING_URL = (
    "https://www.topcv.vn/tim-viec-lam-cong-nghe-thong-tin-cr257"
    "?sort=up_top&type_keyword=0&page=%s&category_family=r257&sba="
)
LISTING_URL_SECOND = "https://www.vietnamworks.com/viec-lam?q=it-phan-mem&l=24&page=%s&sorting=relevant"
# --- End of fixed values


@dataclass(frozen=True)
class Selectors:
    """Where a site keeps the parts of a posting. ``specialty`` is None for
    sites without one."""

    # --- Fixed values: the selectors of the job sites
    listing: str = "h3.title"
    company: str = "div.company-name-label"
    description: str = "div.job-description"
    specialty: str | None = "a.item.search-from-tag.link"
    # --- End of fixed values


def listing_url(page_number: Column, template: str = LISTING_URL) -> Column:
    """Address of one listing page."""
    return F.replace(F.lit(template), F.lit("%s"), page_number.cast("string"))


def listing_urls(spark: SparkSession, first: int, last: int, template: str = LISTING_URL) -> DataFrame:
    """Addresses of the listing pages ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).select(
        F.col("id").alias("page"), listing_url(F.col("id"), template).alias("url")
    )


#: Characters of markup in one batch of selected elements.
SELECTED_CHARS = 8 << 20


def select_elements(pages: DataFrame, selectors: Mapping[str, str], keep: Sequence[str] = ("url",),
                    html_col: str = "html") -> DataFrame:
    """One row per element that a selector finds in a page: the columns ``keep``, ``name`` of
    the selector, ``nth`` (from 1, by name and page), ``tag``, ``attributes`` and ``html``, the markup inside.

    For what the columns of ``functions.html`` do not express: steps of any depth, children,
    attributes, places. Each page is read once for all selectors; pages are mapped where they
    lie. A NULL page has no elements.
    """
    names, texts = list(selectors), tuple(selectors.values())
    for text in texts:
        sel.steps(text)  # a wrong selector fails here and not in a task
    kept = list(keep)
    rows = pages.select(*[F.col(c) for c in kept], F.col(html_col).cast("string").alias("page__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row in range(batch.num_rows):
                page = batch.column(len(kept))[row].as_py() or ""
                counts = [0] * len(names)
                for e in sel.elements(page, texts):
                    counts[e.selector] += 1
                    held.append((row, names[e.selector], counts[e.selector], e.tag, list(e.attributes.items()), page[e.start:e.end]))
                    size += e.end - e.start
                    if size > SELECTED_CHARS:
                        yield packed(batch, held)
                        held, size = [], 0
            if held:
                yield packed(batch, held)

    def packed(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
        row, name, nth, tag, attributes, html = zip(*held)
        same = [batch.column(i).take(pa.array(row)) for i in range(len(kept))]
        return pa.RecordBatch.from_arrays(
            [*same, pa.array(name), pa.array(nth, pa.int32()), pa.array(tag),
             pa.array(attributes, pa.map_(pa.string(), pa.string())), pa.array(html)],
            names=[*kept, "name", "nth", "tag", "attributes", "html"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(kept)])
    return rows.mapInArrow(run, f"{fields}, name string, nth int, tag string, attributes map<string,string>, html string")


def page_links(pages: DataFrame, selectors: Selectors = Selectors()) -> DataFrame:
    """``(url, link)``: one row per link inside a listing entry, in full form."""
    entries = h.all_inner(h.visible_markup(F.col("html")), selectors.listing)
    links = F.flatten(F.transform(entries, lambda e: h.attributes(e, "a", "href")))
    return pages.select("url", F.explode(links).alias("href")).select(
        "url", h.absolute(F.col("href"), F.col("url")).alias("link")
    )


def page_fields(pages: DataFrame, selectors: Selectors = Selectors()) -> DataFrame:
    """``(url, name, chuyen_mon, description)`` of each page; NULL where missing."""
    markup = h.visible_markup(F.col("html"))
    seen = with_columns_once(pages.select("url", "html"), {"markup": markup})
    page = F.col("markup")
    # The first link of the first such element that has one.
    links = F.transform(h.all_inner(page, selectors.company), lambda block: h.first_inner(block, "a"))
    company = F.get(F.filter(links, lambda link: link.isNotNull()), F.lit(0))
    specialty = (
        F.lit(None).cast("string") if selectors.specialty is None
        else h.first_inner(page, selectors.specialty)
    )
    blocks = F.array(company, specialty, h.first_inner(page, selectors.description))
    read = with_columns_once(seen, {"texts": F.transform(blocks, h.visible_text)})
    name, label, description = (F.get(F.col("texts"), F.lit(i)) for i in range(3))
    return read.select(
        "url",
        name.alias("name"),
        t.specialty(label).alias("chuyen_mon"),
        description.alias("description"),
    )


def page_postings(pages: DataFrame, selectors: Selectors = Selectors()) -> DataFrame:
    """Posting records of the pages, one per row, in the message layout.

    The id is a hash of the address, so a page crawled twice keeps its id.
    Missing parts read ``N/A``; a site without specialties gets no such column.
    """
    fields = page_fields(pages, selectors)
    split = with_columns_once(fields, {"sections": t.sections(F.col("description"))})
    columns = [
        F.sha2("url", 256).alias("id"),
        t.or_missing(F.col("name")).alias("name"),
        t.or_missing(F.col("chuyen_mon")).alias("chuyen_mon"),
    ]
    if selectors.specialty is None:
        columns.pop()
    names = [
        "mo_ta_cong_viec", "yeu_cau_cong_viec", "quyen_loi", "dia_diem_lam_viec",
        "thoi_gian_lam_viec", "cach_thuc_ung_tuyen",
    ]
    for header, name in zip(t.SECTION_HEADERS, names):
        columns.append(t.section(F.col("sections"), header).alias(name))
    return split.select(*columns)
