import re
import sys
import unicodedata

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobsignals.functions import text as t


def test_nfkc_of_every_character(evaluate):
    chars = [
        chr(c) for c in range(1, sys.maxunicode + 1)
        if unicodedata.category(chr(c)) not in ("Cs", "Cn")
    ]
    texts = ["".join(ch + "a" + ch + "̣́" for ch in chars[i:i + 50]) for i in range(0, len(chars), 50)]
    # every character by itself too: only then is the test for stable texts at work
    texts += ["".join(chars[i:i + 1]) for i in range(0, 30_000)]
    texts += [None]
    got = evaluate(t.nfkc, texts)
    assert got == [s and unicodedata.normalize("NFKC", s) for s in texts]


def test_strip_removes_what_python_strips(evaluate):
    texts = [t.WHITESPACE + "a b" + t.WHITESPACE, "\x1c x\x85", "", "   ", None, "​x​"]
    assert evaluate(t.strip, texts) == [s if s is None else s.strip() for s in texts]


def test_tags(evaluate):
    texts = ["<p>a</p> b", "a < b", "a <b\nc> d", "<<<<a> b <", "> <a", "", None, "&lt;b&gt;", "x" + "<" * 100_000]
    assert evaluate(t.strip_tags, texts) == [s if s is None else re.sub("<[^>]*>", "", s) for s in texts]


def test_tags_random(evaluate):
    texts = []

    @settings(max_examples=500, database=None, deadline=None, derandomize=True)
    @given(st.text(alphabet="<>ab \n", max_size=20))
    def gather(s):
        texts.append(s)

    gather()
    assert evaluate(t.strip_tags, texts) == [re.sub("<[^>]*>", "", s) for s in texts]


def test_clean_trims_spaces_only(evaluate):
    assert evaluate(t.clean, ["  <b> x\n </b> ", "\t<i>y</i> "]) == ["x\n", "\ty"]


def py_sections(text):
    parts = re.split("(" + "|".join(map(re.escape, t.SECTION_HEADERS)) + ")", text)
    return {parts[i].strip(): parts[i + 1].strip() for i in range(1, len(parts) - 1, 2)}


def test_sections(evaluate):
    texts = [
        "intro Mô tả công việc\n viết code Yêu cầu ứng viên biết Java Quyền lợi\n 10 triệu Mô tả công việc lần hai",
        "Mô tả công việc", "", "nothing", "Quyền lợiQuyền lợi x", "mô tả công việc x", "Quyền lợi   a \x1c",
    ]
    got = evaluate(t.sections, texts + [None])
    assert got[:-1] == [py_sections(s) for s in texts] and got[-1] is None
    assert got[0] == {"Mô tả công việc": "lần hai", "Yêu cầu ứng viên": "biết Java", "Quyền lợi": "10 triệu"}


def test_section_default(evaluate):
    got = evaluate(lambda c: t.section(t.sections(c), "Quyền lợi"), ["Quyền lợi a", "b", None, "Quyền lợi"])
    assert got == ["a", "N/A", "N/A", ""]


def test_sections_random(evaluate):
    texts = []

    @settings(max_examples=300, database=None, deadline=None, derandomize=True)
    @given(st.lists(st.sampled_from(t.SECTION_HEADERS + [" ", "\n", "a", "b "]), max_size=10).map("".join))
    def gather(s):
        texts.append(s)

    gather()
    assert evaluate(t.sections, texts) == [py_sections(s) for s in texts]


def test_specialty_label(evaluate):
    texts = ["Chuyên môn Tester", "a Chuyên môn b Chuyên môn c", "Chuyên môn", None]
    assert evaluate(t.specialty, texts) == ["Tester", "a b c", "Chuyên môn", None]


def test_join_texts(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b")], "a string, b string")
    assert [r[0] for r in df.select(t.join_texts(F.col("a"), F.col("b"))).collect()] == ["a b", None]


def test_upper_case_letter_by_letter(evaluate):
    texts = ["Maß", "straße Ǆ ŉ ﬁ ᾳ", "été", "", None]
    assert evaluate(t.upper, texts) == ["MAẞ", "STRAẞE Ǆ ŉ ﬁ ᾼ", "ÉTÉ", "", None]
