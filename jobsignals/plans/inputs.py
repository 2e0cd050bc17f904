"""Posting tables and pages derived from the test tables.

The test documents are invented prose. Each one becomes a posting: its whole
text serves as description and as benefits, with a job-like phrase appended
that its id selects. The same SQL text runs in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Phrases appended to the documents.
SKILLS = [
    "Docker, Kubernetes and Java services", "Lập trình C++ / PHP , MVC",
    "Phân tích cấu trúc dữ liệu, thuật toán", "Machine Learning, AI and SQL Server",
    "LẮP ĐẶT router, phần cứng", "Digital marketing, Word, Excel", "Git, CI/CD, Linux",
]
REQUIREMENTS = [
    "Reactjs, TypeScript", "kiểm thử, Unit Test", "Solidity, NFT", "ASP.NET and C#", None,
]
BENEFITS = [
    "10-15 triệu", "Lương từ 10 - 15 triệu", "lương từ 10.000.000", "1000 USD", "$1000",
    "150 triệu", "15.5 triệu đồng", "Thỏa thuận", "20,000,000 VND", "Thu nhập 9 triệu", None,
    "Từ １５ triệu", "10.000.000 - 15.000.000 đồng", "2-10-15 triệu; 30M", "2000$, 1.000 usd",
]
SPECIALTIES = ["Chuyên môn Software Engineer", "Chuyên môn Tester", "DevOps"]


def quoted(text: str | None) -> str:
    return "CAST(NULL AS STRING)" if text is None else "'" + text.replace("'", "''") + "'"


def pick(phrases: list[str | None], key: str = "doc_id") -> str:
    """SQL for the phrase that ``key`` selects."""
    cases = " ".join(f"WHEN {i} THEN {quoted(p)}" for i, p in enumerate(phrases))
    return f"CASE {key} % {len(phrases)} {cases} END"


POSTING_COLUMNS = {
    "id": "CAST(doc_id AS STRING)",
    "name": "source",
    "chuyen_mon": pick(SPECIALTIES),
    "mo_ta_cong_viec": f"text || ' ' || {pick(SKILLS)}",
    "yeu_cau_cong_viec": pick(REQUIREMENTS),
    "quyen_loi": f"text || ' ' || {pick(BENEFITS)}",
    "dia_diem_lam_viec": "lang",
    "thoi_gian_lam_viec": "'08:00-17:00'",
    "cach_thuc_ung_tuyen": "'online'",
}
POSTINGS_SQL = (
    "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in POSTING_COLUMNS.items())
    + " FROM documents"
)

# A posting's text with its section titles: one title is missing in some texts
# and one is repeated in others.
SECTIONED = (
    "'Tin tuyển dụng Mô tả công việc' || chr(10) || text || ' ' || " + pick(SKILLS)
    + " || CASE WHEN doc_id % 5 = 4 THEN '' ELSE ' Yêu cầu ứng viên ' || lang || chr(9) END"
    + " || ' Quyền lợi' || chr(10) || " + pick([b or "" for b in BENEFITS])
    + " || CASE WHEN doc_id % 3 = 0 THEN ' Mô tả công việc ' || source ELSE '' END"
    + " || ' Thời gian làm việc 08:00-17:00 '"
)

ESCAPED_TEXT = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

# A posting page: nested blocks and items, mixed quoting, tags whose values hold other marks,
# character references, a script that looks like markup.
JOB_PAGE_COLUMNS = {
    "url": "'https://jobs.example.com/j/' || CAST(doc_id AS STRING)",
    "html": (
        "'<!DOCTYPE html><html><head><script>var s = \"<div class=\\'job-description\\'>\";</script>'"
        " || '</head><body><h3 title=\"a>b\" class=\"title\"><a data-x=\" href=/no\" href=\"/j/it\\'s here/' || CAST(doc_id + 1 AS STRING)"
        " || '?a=1&amp;b=2\">Tin</a></h3><!-- <h3 class=\"title\"><a href=\"/no\">x</a></h3> -->'"
        " || CASE WHEN doc_id % 6 = 5 THEN '' ELSE"
        " '<DIV class=\"box company-name-label\"><a href=\"/c\"> ' || upper(source) || ' </a></DIV>' END"
        " || '<div id=\"d\" data-x=\"1 > 0\" class=\"job-description wide\"><div><h4>Mô tả công việc</h4><p>' || "
        + ESCAPED_TEXT
        + " || '</p></div><div><h4>Y&ecirc;u c&#x000000001EA7;u ứng vi&ecirc;n</h4><div>' || coalesce(" + pick(REQUIREMENTS)
        + ", '') || '</div></div><h4>Quy&#7873;n lợi</h4><ul><li><ul><li> </li></ul>' || coalesce(" + pick(BENEFITS)
        + ", '') || '</li></ul></div><div>Quyền lợi khác</div>'"
        " || CASE WHEN doc_id % 4 = 3 THEN '' ELSE"
        " '<a class=\"link search-from-tag item\" href=\"/t\"><b>' || " + pick(SPECIALTIES)
        + " || '</b></a><a class=\"item search-from-tag link\">khác</a>' END || '</body></html>'"
    ).replace("\\'", "''"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_postings(table(spark, sf_dir, "documents"))


def as_postings(documents: DataFrame) -> DataFrame:
    return documents.selectExpr(*[f"{sql} AS {name}" for name, sql in POSTING_COLUMNS.items()])


def job_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        *[f"{sql} AS {name}" for name, sql in JOB_PAGE_COLUMNS.items()]
    )


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of its files."""
    # A stream of files starts from a folder or a pattern, not from a single file; the
    # brackets make the name a pattern that matches it alone.
    path = f"{sf_dir}/{name}.parque[t]"
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(path)
