"""The queries of the catalog as plain SQL for DuckDB, written independently of them.

Only the vocabularies and the texts that make up the inputs are shared.
"""

from __future__ import annotations

from jobsignals.functions import matching as m
from jobsignals.functions import vocabulary as voc
from jobsignals.plans.inputs import (
    BENEFITS, POSTING_COLUMNS, POSTINGS_SQL, REQUIREMENTS, SECTIONED,
    SPECIALTIES, pick, quoted,
)

# --- Fixed values: section titles, default text, label and listing addresses
SECTION_HEADERS = [
    "Mô tả công việc", "Yêu cầu ứng viên", "Quyền lợi", "Địa điểm làm việc", "Thời gian làm việc",
    "Cách thức ứng tuyển",
]
MISSING = "N/A"
SPECIALTY_LABEL = "Chuyên môn "
FIRST_LISTING = (
    "https://www.topcv.vn/tim-viec-lam-cong-nghe-thong-tin-cr257"
    "?sort=up_top&type_keyword=0&page=%s&category_family=r257&sba="
)
SECOND_LISTING = "https://www.vietnamworks.com/viec-lam?q=it-phan-mem&l=24&page=%s&sorting=relevant"
# --- End of fixed values
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B))


def _pattern(v: m.Vocabulary, term: str) -> str:
    for mark in v.escape:
        term = term.replace(mark, f"[{mark}]")
    return term


POSTING_NAMES = ", ".join(POSTING_COLUMNS)
ALL_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in POSTING_COLUMNS)


def _values(rows: list[tuple], columns: str) -> str:
    body = ", ".join(
        "(" + ", ".join(quoted(x) if isinstance(x, str) else str(x) for x in row) + ")" for row in rows
    )
    return f"(SELECT * FROM (VALUES {body}) AS v({columns}))"


def _with(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts) + "\n"


POSTINGS = ("postings", POSTINGS_SQL)


# --- vocabulary -------------------------------------------------------------

def _vocabulary(v: m.Vocabulary) -> tuple[str, str]:
    rows = [(i, t, _pattern(v, t)) for i, t in enumerate(v.terms)]
    return "vocab", f"SELECT * FROM {_values(rows, 'pos, term, pattern')}"


FOUND = (
    "found",
    "SELECT p.id, v.pos, v.term FROM postings p JOIN vocab v"
    " ON regexp_matches(p.mo_ta_cong_viec || ' ' || p.yeu_cau_cong_viec, v.pattern, 'i')",
)


def _matches(v: m.Vocabulary) -> str:
    return _with(POSTINGS, _vocabulary(v), FOUND) + (
        "SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS INT) AS nth, term"
        " FROM found"
    )


def _counts(v: m.Vocabulary, name: str) -> str:
    return _with(POSTINGS, _vocabulary(v), FOUND) + (
        f'SELECT term AS "{name}", count(*) AS count FROM found GROUP BY term'
    )


def _labelled(select: str) -> str:
    labels = f"SELECT * FROM {_values(list(voc.KNOWLEDGE_LABELS.items()), 'term, category')}"
    return _with(
        POSTINGS, _vocabulary(m.KNOWLEDGES), FOUND, ("labels", labels),
        ("counts", "SELECT term, count(*) AS n FROM found GROUP BY term"),
        ("labelled", "SELECT c.term, c.n, l.category FROM counts c LEFT JOIN labels l USING (term)"),
    ) + select


# --- salary -----------------------------------------------------------------
# RE2 has no exponential cases, so the amounts are written in their plain form.
# --- Fixed values: the money amounts
AMOUNTS = [
    (r"lương(?:từ| )+ ([\d.]+)", 1), (r"([\d.\- ]+(?:triệu| )+)đồng", 1), (r"[\d.,]+.000.000", 0),
    (r"[\d \-]+\d *(?:triệu|m)", 0), (r"\$(?:\d+|\.)", 0), (r"[\d.]+ *(?:USD|\$)+", 0),
    (r"[\d.,]+,000,000", 0),
]
# --- End of fixed values


# NFKC touches only the full-width digits of these texts.
NFKC_BENEFITS = "translate(quyen_loi, '０１２３４５６７８９', '0123456789')"


def _number(expression: str) -> str:
    text = f"trim({expression}, {quoted(WHITESPACE)})"
    digits = f"ltrim(replace(replace({text}, '_', ''), '+', ''), '0')"
    return (
        f"CASE WHEN regexp_matches({text}, '^\\+?[0-9]+(_[0-9]+)*$') THEN"
        f" CASE WHEN {digits} = '' THEN 0::HUGEINT ELSE TRY_CAST({digits} AS HUGEINT) END END"
    )


def _millions(expression: str) -> str:
    zeros = f"regexp_replace({expression}, 'triệu|Triệu|TRIỆU|m|M', '000000', 'g')"
    bare = f"replace(replace(replace({zeros}, '.', ''), ' ', ''), ',', '')"
    return f"({_number(bare)}) // 1000000"


def _salary(select: str, source: str = POSTINGS_SQL) -> str:
    lists = " || ".join(f"regexp_extract_all(t, {quoted(p)}, {g}, 'i')" for p, g in AMOUNTS)
    usd = (
        "CASE WHEN contains(c, '$') THEN CASE WHEN starts_with(c, '$') THEN substr(c, 2)"
        " ELSE left(c, length(c) - 1) END WHEN contains(c, 'USD') THEN replace(c, 'USD', '')"
        " WHEN contains(c, 'usd') THEN replace(c, 'usd', '') END"
    )
    bare_usd = f"replace({usd}, '.', '')"
    trimmed = f"trim(trim(c, {quoted(WHITESPACE)}), '-')"
    first = f"replace(replace(trim(parts[1], {quoted(WHITESPACE)}), '.', ''), ',', '')"
    return _with(
        ("postings", source),
        ("texts", f"SELECT id, {NFKC_BENEFITS} AS t FROM postings"),
        ("lists", f"SELECT id, {lists} AS cs FROM texts WHERE t IS NOT NULL"),
        ("candidates", "SELECT id, unnest(cs) AS c, generate_subscripts(cs, 1) - 1 AS nth FROM lists"),
        ("read1", f"SELECT *, {_number(bare_usd)} AS dollars,"
                  f" string_split({trimmed}, '-') AS parts FROM candidates"),
        ("read2", f"SELECT *, {_millions('parts[1]')} AS single, {_number(first)} AS low,"
                  f" {_millions('parts[2]')} AS high FROM read1"),
        ("read3", "SELECT id, c, nth, CASE"
                  " WHEN dollars IS NOT NULL THEN [CAST(least((dollars * 23 // 1000) // 5 * 5, 100) AS BIGINT)]"
                  " WHEN len(parts) = 1 THEN CASE WHEN single IS NOT NULL THEN [CAST(least(single // 5 * 5, 100) AS BIGINT)] END"
                  " WHEN low IS NULL OR high IS NULL OR low // 5 > least(high // 5, 20) THEN NULL"
                  " ELSE list_transform(generate_series(CAST(low // 5 AS BIGINT), CAST(least(high // 5, 20) AS BIGINT)), lambda i: i * 5) END AS bins"
                  " FROM read2"),
        ("bins", "SELECT DISTINCT id, unnest(bins) AS bin FROM read3"),
    ) + select


JOINED_BINS = (
    "SELECT p.id, coalesce(s.salaries, '') AS salaries FROM postings p LEFT JOIN"
    " (SELECT id, string_agg(CAST(bin AS VARCHAR), ';' ORDER BY bin) AS salaries FROM bins GROUP BY id) s USING (id)"
)


# --- whole extraction -------------------------------------------------------

def _extracted(source: str, select: str) -> str:
    rows = [
        (v.name, i, t, _pattern(v, t)) for v in m.ALL for i, t in enumerate(v.terms)
    ]
    lists = ", ".join(
        f"coalesce(string_agg(term, ';' ORDER BY pos) FILTER (kind = '{v.name}'), '') AS {v.name}"
        for v in m.ALL
    )
    salary = _salary("", source)
    return salary.rstrip() + ",\n" + ",\n".join(
        f"{name} AS ({sql})" for name, sql in [
            ("salaries", JOINED_BINS),
            ("vocab", f"SELECT * FROM {_values(rows, 'kind, pos, term, pattern')}"),
            ("hits", "SELECT p.id, v.kind, v.pos, v.term FROM postings p JOIN vocab v ON"
                     " regexp_matches(p.mo_ta_cong_viec || ' ' || p.yeu_cau_cong_viec, v.pattern, 'i')"),
            ("extracted", "SELECT p.id, any_value(p.name) AS company_name, " + lists
             + ", any_value(s.salaries) AS salaries FROM postings p LEFT JOIN hits h USING (id)"
               " JOIN salaries s USING (id) GROUP BY p.id"),
        ]
    ) + "\n" + select


STREAM_COLUMNS = [
    "id", "name", "chuyen_mon", "mo_ta_cong_viec", "yeu_cau_cong_viec", "quyen_loi",
    "cach_thuc_ung_tuyen",
]
COMPLETE = f"SELECT * FROM ({POSTINGS_SQL}) WHERE {ALL_PRESENT}"
EXTRACT_ALL = "SELECT * FROM extracted"


# --- pages ------------------------------------------------------------------

BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header"
    "|hr|html|li|main|nav|ol|p|pre|section|table|td|th|tr|ul"
)


def _shown(html: str) -> str:
    return (
        f"regexp_replace({html}, '(?is)<!--.*?(-->|\\z)|<script[\\s/>].*?(</script[^>]*>|\\z)"
        "|<style[\\s/>].*?(</style[^>]*>|\\z)', '', 'g')"
    )


def _decoded(x: str) -> str:
    # The references that occur in the test pages.
    for name, ch in (("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{ch}')"
    return x


def _text(markup: str) -> str:
    lines = (
        f"regexp_replace(regexp_replace({markup}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'),"
        f" '(?i)</?({BLOCKS})([\\s/][^<>]*)?>', chr(10), 'g')"
    )
    single = f"regexp_replace(regexp_replace({lines}, '<[^>]*>', '', 'g'), ' +', ' ', 'g')"
    joined = f"regexp_replace({single}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"trim({_decoded(joined)}, {quoted(WHITESPACE)})"


def _absolute(link: str) -> str:
    origin = "regexp_extract(url, '^([^:/?#]+://[^/?#]*)', 1)"
    folder = "regexp_extract(url, '^([^:/?#]+://[^/?#]*/(?:[^?#]*/)?)', 1)"
    return (
        f"CASE WHEN regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN {link}"
        f" WHEN starts_with({link}, '//') THEN regexp_extract(url, '^([^:/?#]+:)', 1) || {link}"
        f" WHEN starts_with({link}, '/') THEN {origin} || {link}"
        f" WHEN starts_with({link}, '#') THEN split_part(url, '#', 1) || {link}"
        f" WHEN starts_with({link}, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || {link}"
        f" WHEN {link} = '' THEN split_part(url, '#', 1)"
        f" ELSE CASE WHEN {folder} <> '' THEN {folder} ELSE {origin} || '/' END || {link} END"
    )


PAGE_LINKS = _with(
    ("seen", f"SELECT url, {_shown('html')} AS html FROM pages"),
    ("navs", "SELECT url, unnest(regexp_extract_all(html, '(?is)<nav(?:\\s[^>]*)?>(.*?)(?:</nav|\\z)', 1)) AS nav FROM seen"),
    ("hrefs", "SELECT url, unnest(regexp_extract_all(nav, '(?i)<a\\s+href=\"([^\"]*)\"', 1)) AS href FROM navs"),
    ("links", f"SELECT url, {_decoded('href')} AS href FROM hrefs"),
) + f"SELECT url, {_absolute('href')} AS link FROM links"

PAGE_FIELDS = _with(
    ("seen", f"SELECT url, {_shown('html')} AS html FROM pages"),
    ("blocks", "SELECT url,"
               " regexp_extract(html, '(?is)<li(?:\\s[^>]*)?>(?:[^<]|<[^/a])*?<a(?:\\s[^>]*)?>(.*?)(?:</a|\\z)', 1) AS li,"
               " regexp_matches(html, '(?is)<li(?:\\s[^>]*)?>') AS has_li,"
               " regexp_extract(html, '(?is)<article(?:\\s[^>]*)?>(.*?)(?:</article|\\z)', 1) AS art,"
               " regexp_matches(html, '(?is)<article(?:\\s[^>]*)?>') AS has_art,"
               " regexp_extract(html, '(?is)<h1(?:\\s[^>]*)?>(.*?)(?:</h1|\\z)', 1) AS h1,"
               " regexp_matches(html, '(?is)<h1(?:\\s[^>]*)?>') AS has_h1 FROM seen"),
) + (
    f"SELECT url, CASE WHEN has_li THEN {_text('li')} END AS name,"
    f" CASE WHEN has_h1 THEN replace({_text('h1')}, '{SPECIALTY_LABEL}', '') END AS chuyen_mon,"
    f" CASE WHEN has_art THEN {_text('art')} END AS description FROM blocks"
)

PAGE_SELECT = _with(
    ("seen", f"SELECT url, {_shown('html')} AS html FROM pages"),
    ("cut", "SELECT url, regexp_extract_all(regexp_extract(html, '(?is)<nav>(.*?)</nav>', 1), '(?is)<li>(.*?)</li>', 1)[2] AS item,"
            " regexp_extract_all(html, '(?is)<div class=\"ad\">(.*?)</div>', 1) AS ads,"
            " string_split_regex(regexp_extract(html, '(?is)<article>(.*?)</article>', 1), '<p>')[2:] AS parts FROM seen"),
    ("numbered", "SELECT *, unnest(range(1, 1 + greatest(len(ads), len(parts)))) AS i FROM cut"),
) + (
    "SELECT url, 'second' AS name, 1::INTEGER AS nth, 'a' AS tag, regexp_extract(item, 'href=\"([^\"]*)\"', 1) AS href,"
    " regexp_extract(item, '(?is)<a[^>]*>(.*?)</a>', 1) AS html FROM cut WHERE item IS NOT NULL"
    " UNION ALL SELECT url, 'ad', i::INTEGER, 'div', NULL, ads[i] FROM numbered WHERE i <= len(ads)"
    " UNION ALL SELECT url, 'paragraph', i::INTEGER, 'p', NULL, regexp_extract(parts[i], '(?s)^(.*?)(?:</p>|\\z)', 1)"
    " FROM numbered WHERE i <= len(parts)"
)

# The pages are built from known parts, so the expected records are too.
SINGLE_SPACED = "trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), " + quoted(WHITESPACE) + ")"
JOB_POSTINGS = (
    "SELECT sha256('https://jobs.example.com/j/' || CAST(doc_id AS STRING)) AS id,"
    f" CASE WHEN doc_id % 6 = 5 THEN '{MISSING}' ELSE upper(source) END AS name,"
    f" CASE WHEN doc_id % 4 = 3 THEN '{MISSING}' ELSE replace({pick(SPECIALTIES)}, '{SPECIALTY_LABEL}', '') END AS chuyen_mon,"
    f" {SINGLE_SPACED} AS mo_ta_cong_viec, coalesce({pick(REQUIREMENTS)}, '') AS yeu_cau_cong_viec,"
    f" coalesce({pick(BENEFITS)}, '') AS quyen_loi, '{MISSING}' AS dia_diem_lam_viec,"
    f" '{MISSING}' AS thoi_gian_lam_viec, '{MISSING}' AS cach_thuc_ung_tuyen FROM documents"
)


# --- sections ---------------------------------------------------------------

def _sections() -> str:
    any_header = "|".join(SECTION_HEADERS)
    columns = ", ".join(
        f"coalesce(trim(bodies[list_position(heads, '{h}')], {quoted(WHITESPACE)}), '{MISSING}') AS part_{i}"
        for i, h in enumerate(SECTION_HEADERS, 1)
    )
    return _with(
        ("texts", f"SELECT doc_id, {SECTIONED} AS body FROM documents"),
        ("cut", f"SELECT doc_id, list_reverse(regexp_extract_all(body, '{any_header}')) AS heads,"
                f" list_reverse(regexp_split_to_array(body, '{any_header}')) AS bodies FROM texts"),
    ) + f"SELECT doc_id, {columns} FROM cut"


def _cleaned(c: str) -> str:
    return f"trim(regexp_replace({c}, '<[^>]*>', '', 'g'), ' ')"


def _listing(template: str) -> str:
    before, after = template.split("%s")
    return f"'{before}' || CAST(page_id AS STRING) || '{after}'"


CLEAN_POSTINGS = _with(POSTINGS) + (
    f"SELECT {_cleaned('mo_ta_cong_viec')} AS mo_ta_cong_viec, {_cleaned('chuyen_mon')} AS chuyen_mon FROM postings"
)
ALL_POSTINGS = _with(POSTINGS) + f"SELECT {POSTING_NAMES} FROM postings"
SITES = _with(POSTINGS) + (
    "SELECT "
    + ", ".join(
        "CASE WHEN dia_diem_lam_viec = 'en' THEN chuyen_mon END AS chuyen_mon" if c == "chuyen_mon" else c
        for c in POSTING_COLUMNS
    )
    + " FROM (SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 7 <> 3 THEN dia_diem_lam_viec END AS dia_diem_lam_viec)"
      " FROM postings)"
)
LATEST = (
    "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER"
    " (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"
)
CLOCK = "CAST(CAST(1704067200 + event_id AS DECIMAL(20,2)) + CAST(value AS DECIMAL(20,2)) AS VARCHAR)"
STREAM_COMPLETE = (
    f"SELECT * FROM ({POSTINGS_SQL}) WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in STREAM_COLUMNS)
)

TABLE_MATCHES = """
WITH given AS (
  SELECT doc_id, unnest([regexp_extract(text, '([^ \\n.,]{7,})', 1),
    concat_ws(' ', string_split_regex(text, '[ \\n]+')[1], string_split_regex(text, '[ \\n]+')[2]), substring(text, 1, 3)]) AS term
  FROM documents),
terms AS (SELECT DISTINCT CASE WHEN doc_id % 2 = 0 THEN term ELSE upper(term) END AS term FROM given WHERE term <> '')
SELECT doc_id, term FROM documents JOIN terms ON contains(lower(text), lower(term))
"""

ORACLES: dict[str, str] = {
    "knowledge_counts": _counts(m.KNOWLEDGES, "Knowledge"),
    "knowledge_labels": _labelled(
        'SELECT term AS "Knowledge", n AS count, category AS "Category" FROM labelled'
    ),
    "knowledge_by_category": _labelled(
        'SELECT category AS "Category", CAST(sum(n) AS BIGINT) AS count FROM labelled'
        " WHERE category IS NOT NULL GROUP BY category"
    ),
    "label_lookup": _labelled(
        "SELECT f.id, f.term, l.category FROM found f LEFT JOIN labels l USING (term)"
    ),
    "framework_counts": _counts(m.FRAMEWORKS, "Framework"),
    "language_counts": _counts(m.LANGUAGES, "Language"),
    "design_pattern_counts": _counts(m.DESIGN_PATTERNS, "DesignPattern"),
    "salary_bin_counts": _salary(
        'SELECT CAST(bin AS INT) AS "Salary", count(*) AS count FROM bins WHERE bin IS NOT NULL GROUP BY bin'
    ),
    "framework_matches": _matches(m.FRAMEWORKS),
    "language_matches": _matches(m.LANGUAGES),
    "design_pattern_matches": _matches(m.DESIGN_PATTERNS),
    "knowledge_matches": _matches(m.KNOWLEDGES),
    "table_matches": TABLE_MATCHES,
    "extract_postings": _extracted(COMPLETE, EXTRACT_ALL),
    "index_documents": _extracted(
        POSTINGS_SQL,
        'SELECT company_name AS "CompanyName", framework_platforms AS "FrameworkPlattforms",'
        ' languages AS "Languages", design_patterns AS "DesignPatterns", knowledges AS "Knowledges",'
        ' salaries AS "Salaries" FROM extracted',
    ),
    "stored_projection": _extracted(
        POSTINGS_SQL, "SELECT company_name, framework_platforms FROM extracted"
    ),
    "salary_candidates": _salary("SELECT id, CAST(nth AS INT) AS nth, c AS candidate FROM candidates"),
    "salary_bins": _salary(JOINED_BINS),
    "salary_amounts": _salary(
        "SELECT r.id, CAST(r.nth AS INT) AS nth, r.dollars::VARCHAR AS dollars, r.single::VARCHAR AS millions,"
        " array_to_string(b.bins, ';') AS bins FROM read2 r JOIN read3 b USING (id, nth)"
    ),
    "nfkc_text": _with(POSTINGS) + f"SELECT id, {NFKC_BENEFITS} AS benefits FROM postings",
    "clean_text": f"SELECT page_id, {_cleaned('html')} AS text FROM pages",
    "clean_postings": CLEAN_POSTINGS,
    "clean_count": "SELECT count(*) AS n FROM documents",
    "clean_roundtrip": CLEAN_POSTINGS,
    "parse_messages": ALL_POSTINGS,
    "parse_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "numeric_ids": f"SELECT regexp_replace(regexp_replace({CLOCK}, '0+$', ''), '\\.$', '.0') AS id,"
                   " event_type AS name FROM events",
    "drop_incomplete": _with(POSTINGS) + f"SELECT {POSTING_NAMES} FROM postings WHERE {ALL_PRESENT}",
    "na_defaults": _with(POSTINGS) + "SELECT "
    + ", ".join(f"coalesce({c}, '{MISSING}') AS {c}" for c in POSTING_COLUMNS) + " FROM postings",
    "union_sites": SITES,
    "complete_sites": SITES + " WHERE id IS NOT NULL AND yeu_cau_cong_viec IS NOT NULL",
    "split_sections": _sections(),
    "specialty_label": f"SELECT CAST(doc_id AS STRING) AS id,"
                       f" replace({pick(SPECIALTIES)}, '{SPECIALTY_LABEL}', '') AS specialty FROM documents",
    "page_urls": f"SELECT page_id, {_listing(FIRST_LISTING)} AS first_site,"
                 f" {_listing(SECOND_LISTING)} AS second_site FROM pages",
    "page_links": PAGE_LINKS,
    "page_fields": PAGE_FIELDS,
    "page_select": PAGE_SELECT,
    "page_text": f"SELECT page_id, {_text(_shown('html'))} AS text FROM pages",
    "job_links": "SELECT 'https://jobs.example.com/j/' || CAST(doc_id AS STRING) AS url,"
                 " 'https://jobs.example.com/j/it''s here/' || CAST(doc_id + 1 AS STRING) || '?a=1&b=2' AS link FROM documents",
    "page_postings": JOB_POSTINGS,
    "page_postings_second_site": f"SELECT * EXCLUDE (chuyen_mon) FROM ({JOB_POSTINGS})",
    "crawl_to_extract": _extracted(JOB_POSTINGS, EXTRACT_ALL),
    "json_roundtrip": ALL_POSTINGS,
    "publish_roundtrip": JOB_POSTINGS,
    "stream_landing": ALL_POSTINGS,
    "stream_fanout": ALL_POSTINGS,
    "stream_extract": _extracted(STREAM_COMPLETE, EXTRACT_ALL),
    "stream_store": _extracted(STREAM_COMPLETE, EXTRACT_ALL),
    "stream_raw_store": _with(POSTINGS) + "SELECT id, name, mo_ta_cong_viec, yeu_cau_cong_viec,"
                                          " quyen_loi, cach_thuc_ung_tuyen FROM postings",
    "upsert_latest": LATEST,
    "stream_upsert": LATEST,
    "stream_counts": _counts(m.KNOWLEDGES, "Knowledge"),
    "stream_topic": ALL_POSTINGS,
    "stream_resume": ALL_POSTINGS,
    "listing_urls": f"SELECT page_id AS page, {_listing(FIRST_LISTING)} AS url FROM (SELECT"
                    " unnest(generate_series((SELECT min(page_id) FROM pages), (SELECT max(page_id) FROM pages)))"
                    " AS page_id)",
    "knowledge_ranking": _labelled(
        'SELECT term AS "Knowledge", n AS count, row_number() OVER (ORDER BY n DESC, encode(term)) AS place'
        " FROM labelled"
    ),
}
