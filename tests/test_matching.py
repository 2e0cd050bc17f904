"""Vocabulary match against Python's own regular expressions."""

import re

import pytest
from hypothesis import given, settings, strategies as st

from jobsignals.functions import matching as m


def py_match(text, vocab):
    if text is None:
        return []
    return [t for t in vocab.terms if re.search(vocab.pattern(t), text, re.IGNORECASE)]


GOLDEN = [
    ("Kubernetes cluster x", ".NET", True),  # the dot stands for any character
    ("x\nnet x", ".NET", False),  # except a line feed
    ("x\rnet x", ".NET", True),
    ("LẮP ĐẶT máy x", "lắp đặt", True),
    ("digital x", "Git", True),
    ("lập trình C và Java", " C ", True),
    ("C, Java x", " C ", False),
    ("javascript", "Java", True),
    ("Proc", "Pro*C", True),
    ("Proooc", "Pro*C", True),
    ("PrC", "Pro*C", True),
    ("Pro*C", "Pro*C", False),
    (" a+ ", " A+ ", True),
    (None, "Java", False),
]


def test_golden_rows(evaluate):
    for vocab in m.ALL:
        got = evaluate(lambda c: m.match_terms(c, vocab), [t for t, _, _ in GOLDEN])
        for (text, term, hit), found in zip(GOLDEN, got):
            if term in vocab.terms:
                assert (term in found) == hit, (text, term)
            assert found == py_match(text, vocab)


def test_every_term_alone_doubled_and_in_other_case(evaluate):
    words = [t for v in m.ALL for t in v.terms]
    texts = words + [w.upper() for w in words] + [w + w for w in words] + [
        a + b for a, b in zip(words, words[1:])]
    for vocab in m.ALL:
        got = evaluate(lambda c: m.match_terms(c, vocab), texts)
        assert got == [py_match(t, vocab) for t in texts]


def test_letters_that_fold_to_ascii(evaluate):
    texts = ["Gıt", "GİT", "\u212aotlin", "ſale", "Jira", "Kotlin", "lİnux", "i̇os", "ΣΑΣ SAS", "ẞ css", "DELPHİ"]
    for vocab in m.ALL:
        got = evaluate(lambda c: m.match_terms(c, vocab), texts)
        assert got == [py_match(t, vocab) for t in texts]


PIECES = st.sampled_from(
    [t for v in m.ALL for t in v.terms]
    + [t.lower()[:4] for v in m.ALL for t in v.terms]
    + [" ", "\n", "\r", ".", "x", "İ", "ı", "ſ", "Đ", "𝒳"]
)


def test_random_texts(evaluate):
    texts = []

    @settings(max_examples=1200, database=None, deadline=None, derandomize=True)
    @given(st.lists(PIECES, max_size=8).map("".join))
    def gather(t):
        texts.append(t)

    gather()
    for vocab in m.ALL:
        got = evaluate(lambda c: m.match_terms(c, vocab), texts)
        for t, found in zip(texts, got):
            assert found == py_match(t, vocab), repr(t)
    together = evaluate(lambda c: m.term_positions(c, m.ALL), texts)
    offsets = [sum(len(v.terms) for v in m.ALL[:k]) for k in range(len(m.ALL))]
    for t, found in zip(texts, together):
        assert found == [
            offset + v.terms.index(x) for v, offset in zip(m.ALL, offsets) for x in py_match(t, v)
        ]


def test_own_vocabulary(evaluate):
    vocab = m.Vocabulary("own", ("a", "ab", "abc", "b.d", "x|y", "[0-9]+z", "a*b"))
    texts = ["abc", "ab", "b", "bcd", "b\nd", "Y", "12z", "", "aaab"]
    assert evaluate(lambda c: m.match_terms(c, vocab), texts) == [py_match(t, vocab) for t in texts]


@pytest.mark.parametrize("text", ["java " * 60_000, "." * 300_000, "ư" * 200_000])
def test_long_texts(evaluate, text):
    assert evaluate(lambda c: m.match_terms(c, m.LANGUAGES), [text])[0] == py_match(text[:100], m.LANGUAGES)
