"""Posting messages: parse, complete, clean and extract. Batch and stream share these."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from jobsignals import schemas
from jobsignals.functions import matching as m
from jobsignals.functions import text as t
from jobsignals.functions.binding import with_columns_once
from jobsignals.functions.salary import salary_bins


def plain_number_id(c: Column) -> Column:
    """An id that was a JSON number, in plain notation.

    The JSON functions write large fractions as ``1.73E9`` where the JSON file
    reader keeps the digits; only that notation is rewritten.
    """
    number = c.try_cast("decimal(38,9)").cast("string")
    digits = F.rtrim(number, F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(c.rlike(r"^-?\d\.\d+E\d+$"), F.coalesce(plain, c)).otherwise(c)


def parse_postings(messages: DataFrame, schema: StructType = schemas.POSTING,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Columns of ``schema`` from JSON messages in the (binary or text) column ``value``,
    and the columns ``keep`` of the messages, such as their place in the topic.

    A missing field is NULL, a malformed message gives a row of NULLs.
    """
    data = F.from_json(F.col("value").cast("string"), schema)
    # As a generator the parse runs once per message; as a projection it would
    # run once more for every NULL check that drop_incomplete() adds.
    flat = messages.select(*keep, F.inline(F.array(data)))
    return flat.withColumn("id", plain_number_id(F.col("id"))) if "id" in flat.columns else flat


def to_messages(postings: DataFrame) -> DataFrame:
    """One JSON message per row, in the binary column ``value``; NULL fields are left out."""
    return postings.select(F.to_json(F.struct("*")).cast("binary").alias("value"))


def drop_incomplete(postings: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL in the required columns (by default: in any)."""
    return postings.dropna("any", subset=None if required is None else list(required))


def fill_missing(postings: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL texts become the default text."""
    return postings.fillna(t.MISSING, subset=None if columns is None else list(columns))


def union_sites(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Postings of several sites by column name; a column a site lacks is NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def clean_postings(postings: DataFrame) -> DataFrame:
    """Description and specialty without tags and outer spaces."""
    return postings.select(
        *[t.clean(F.col(c)).alias(c) for c in ("mo_ta_cong_viec", "chuyen_mon")]
    )


def posting_text(a: str = "mo_ta_cong_viec", b: str = "yeu_cau_cong_viec") -> Column:
    """The text that vocabularies are matched against."""
    return t.join_texts(F.col(a), F.col(b))


def extract(postings: DataFrame, vocabularies: Sequence[m.Vocabulary] = m.ALL,
            keep: Sequence[str] = ()) -> DataFrame:
    """One row per posting: id, company, the terms of each vocabulary, salary bins, and
    the columns ``keep``.

    The text is scanned once for all vocabularies.
    """
    positions = m.term_positions(posting_text(), vocabularies)
    found = with_columns_once(postings, {"positions": positions})
    lists = [m.terms_at(F.col("positions"), vocabularies, v).alias(v.name) for v in vocabularies]
    return found.select(
        "id", F.col("name").alias("company_name"), *lists,
        salary_bins(F.col("quyen_loi")).alias("salaries"), *keep,
    )


def index_documents(extracted: DataFrame) -> DataFrame:
    """The extracted table under the names of the document index, without id."""
    return extracted.select(*[F.col(c).alias(n) for c, n in schemas.INDEX_NAMES.items()])
