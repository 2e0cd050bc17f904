"""Salary bins against worked-out rows and against plain Python readings of the rules."""

import math
import re
import unicodedata

import pytest
from hypothesis import given, settings, strategies as st

from jobsignals.functions.salary import salary_bins, salary_candidates

GOLDEN = [
    ("", []), ("Thỏa thuận", []), ("Lương từ 10 - 15 triệu", [0, 10, 15]), ("lương 15 triệu", [15]),
    ("lương từ 10.000.000", [10]), ("10.000.000 - 15.000.000 đồng", [10, 15]),
    ("10-15 triệu đồng", [10, 15]), ("9 triệu", []), ("Thu nhập 9 triệu", [5]),
    ("15.5 triệu đồng", [100]), ("1,5 triệu", []), ("20,000,000 VND", [20]), ("100.000.000", [100]),
    ("150 triệu", [100]), ("120-150 triệu", []), ("15-10 triệu", []), ("$1000", [20]), ("$1.000", [0]),
    ("$1,000", [0]), ("1000 USD", [20]), ("1.000 usd", [20]), ("1000 Usd", []), ("1,000 USD", [0]),
    ("1000-2000 USD", [45]), ("2000$", [45]), ("2000$$", []), ("Bảo hiểm 12 months", [10]),
    ("10M - 20M", [10, 20]), ("10 - 20M", [10, 15, 20]), ("5--10 triệu", []), ("- 10 triệu", [10]),
    ("2-10-15 triệu", [0]), ("１０ triệu", [10]), ("10 triệu", [10]), ("25 TRIỆU", [25]),
    ("25 tRiệu", []), ("10-000-000", []),
    ("Lương từ 20 triệu đến 30 triệu + thưởng 1000 USD", [0, 20, 30]), ("0 triệu", []),
    ("Từ 8 triệu; $500; 30.000.000", [5, 10, 30]), ("lương  10", [0]),
    ("LƯƠNG TỪ 30.000.000 đồng", [30]), ("10 triệu", [10]), (None, []),
    # '.' stands for any character between groups of three zeros
    ("10_000_000", [10]), ("10 000 0005 000 000", [5, 10]), (".+000.000", [0]), (".\t000-000", [0]),
    # amounts too long for any number type are still amounts
    ("9" * 60 + ".000.000", [100]), ("0" * 40 + "10.000.000", [10]), ("$" + "9" * 50, [100]),
    # digits of another script count as digits
    ("١٢ triệu", [10]),
]


def test_golden_rows(evaluate):
    got = evaluate(salary_bins, [t for t, _ in GOLDEN])
    assert list(zip([t for t, _ in GOLDEN], got)) == GOLDEN


# An independent reading of the rules, in plain Python, for small random texts.
PATTERNS = [
    r"lương(?:từ| )+ ([\d.]+)", r"([\d.\- ]+(?:triệu| )+)đồng", r"[\d.,]+.000.000",
    r"[\d \-]+\d *(?:triệu|m)", r"\$(?:\d+|\.)", r"[\d.]+ *(?:USD|\$)+", r"[\d.,]+,000,000",
]


def py_candidates(text):
    text = unicodedata.normalize("NFKC", text)
    return [m for p in PATTERNS for m in re.findall(p, text, re.IGNORECASE)]


def as_int(text):
    try:
        return int(text)
    except ValueError:
        return None


def py_bins(text):
    def millions(t):
        n = as_int(re.sub("[ .,]", "", re.sub("triệu|Triệu|TRIỆU|m|M", "000000", t)))
        return None if n is None else n // 10**6

    def one(m):
        return [min(m // 5 * 5, 100)]

    def read(c):
        usd = None
        if "$" in c:
            usd = c[1:] if c[0] == "$" else c[:-1]
        elif "USD" in c or "usd" in c:
            usd = c.replace("USD" if "USD" in c else "usd", "")
        n = None if usd is None else as_int(usd.replace(".", ""))
        if n is not None:
            return one(math.floor(n * 23 / 1000))
        parts = c.strip().strip("-").split("-")
        if len(parts) == 1:
            m = millions(parts[0])
            return [] if m is None else one(m)
        start = as_int(re.sub("[.,]", "", parts[0].strip()))
        end = millions(parts[1])
        if start is None or end is None:
            return []
        return [5 * i for i in range(start // 5, min(end // 5, 20) + 1)]

    return sorted({b for c in py_candidates(text) for b in read(c)})


PIECES = st.sampled_from(
    list("0123456789") + ["10", "15", "000", "000", ".000", ",000", " ", " ", "-", ".", ",", "$", "USD",
     "usd", "Usd", "triệu", "Triệu", "TRIỆU", "tRiỆu", "trıệu", "đồng", "ĐỒNG", "lương", "Lương ",
     "từ", "từ ", "m", "M", "\n", "\t", "_", "+", "x", " ", "１", "٣", "đến", "ươ", "é"]
)


@pytest.mark.parametrize("seed", range(2))
def test_random_texts_agree_with_plain_reading(evaluate, seed):
    texts = []

    @settings(max_examples=1500, database=None, deadline=None, derandomize=bool(seed))
    @given(st.lists(PIECES, max_size=14).map("".join))
    def gather(t):
        texts.append(t)

    gather()
    for t, got in zip(texts, evaluate(salary_candidates, texts)):
        assert got == py_candidates(t), repr(t)
    for t, got in zip(texts, evaluate(salary_bins, texts)):
        assert got == py_bins(t), repr(t)
        assert set(got) <= set(range(0, 101, 5)) and got == sorted(set(got))


@pytest.mark.parametrize(
    "text",
    ["1" * 200_000, "1 " * 100_000, " " * 200_000 + "đồng", "lương" + " " * 200_000, "1." * 100_000,
     "1 " + "triệu " * 50_000, "$" * 200_000, "1,000" * 40_000, "lươngtừ" * 30_000, "1USD" * 50_000],
)
def test_long_runs_are_linear(evaluate, text):
    """Neither quadratic time nor a stack overflow on long runs."""
    evaluate(salary_bins, [text])


def test_long_run_followed_by_unit(evaluate):
    assert evaluate(salary_bins, [" " * 100_000 + "12 triệu", "12" + " " * 100_000 + "triệu"]) == [[10], [10]]


def test_rate_is_a_parameter(evaluate):
    assert evaluate(lambda c: salary_bins(c, usd_rate=26), ["1000 USD"]) == [[25]]


def test_range_from_a_number_of_the_largest_length(evaluate):
    digits = "19999999999999999999999999999999999999"
    texts = [f"{digits} - 20 triệu", f"{digits}0 - 20 triệu", "7 - " + digits + " triệu"]
    assert evaluate(salary_bins, texts) == [[], [], list(range(5, 101, 5))]
