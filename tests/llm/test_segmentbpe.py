"""Byte-pair encoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from jobsignals.llm import segmentbpe
from jobsignals.llm.segmentbpe import BytePairs, decoded, encoded, op12_segment_tree_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def pairs():
    with open(PATH, encoding="utf-8") as file:
        return BytePairs(file.read())


def random_texts(n):
    rng = random.Random(6)
    kinds = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0x250), lambda: rng.randrange(0x3000), lambda: rng.randrange(0x110000),
             lambda: rng.choice([0x20, 0x0A, 0x27, 0x73, 0x74, 0x85, 0xA0, 0x1C, 0x2028, 0x558, 0x323B0])]
    return ["".join(chr(rng.choice(kinds)()) for _ in range(rng.randrange(40))).encode("utf-8", "ignore").decode() for _ in range(n)]


ODD = ["", " ", "\n \t\n", "it's we'll I'M 'sx", "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endoftext", "a" * 3000, " " * 500 + "x", "ab" * 900,
       "é" * 200, "あ" * 300, "1234567890" * 60, "é", "\r\n", "x" * 48, "x" * 49, "\U0001F600" * 40]


def test_ids_and_texts(library, pairs):
    texts = ODD + random_texts(4000)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert pairs.encode_all(texts) == want
    for text, ids in zip(texts, want):
        assert pairs.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
    fresh = BytePairs(open(PATH, encoding="utf-8").read())
    assert [fresh.encode(t) for t in texts[:60]] == want[:60]
    for text in texts[:300]:  # one tree at a time gives what many at once give
        for word in segmentbpe._pattern_of(text).findall(text):
            data = word.encode()
            size = max(1 << max(len(data) - 2, 0).bit_length(), 2)
            assert len(data) < 2 or fresh.merged(data) == fresh.merged_many([data], size)[0]


def test_any_ids_decode_as_the_library_does(library, pairs):
    rng = random.Random(7)
    for _ in range(2000):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert pairs.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_small_memory_and_long_texts(library, monkeypatch):
    monkeypatch.setattr(segmentbpe, "REMEMBERED_WORDS", 5)
    monkeypatch.setattr(segmentbpe, "LIST_CHARS", 50)
    monkeypatch.setattr(segmentbpe, "TOGETHER", 3)
    pairs = BytePairs(open(PATH, encoding="utf-8").read())
    for text in ["some words, and more words than fit: " * 20, *ODD, *random_texts(100)]:
        assert pairs.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_arrays_of_many_texts(library, monkeypatch):
    monkeypatch.setattr(segmentbpe, "REMEMBERED_WORDS", 40)
    monkeypatch.setattr(segmentbpe, "LIST_CHARS", 400)
    pairs = BytePairs(open(PATH, encoding="utf-8").read())
    texts = [*ODD, "short before " + "<|endoftext|>" + "a long section " * 60, "y" * 49 + " " + "y" * 49, *random_texts(300)]
    for some in (texts, texts[::-1], texts * 2):
        want = [library.encode(t, add_special_tokens=False).ids for t in some]
        got = pairs.encode_arrays(some)
        assert [ids.tolist() for ids in got] == want
        lengths = np.array([len(ids) for ids in got])
        assert pairs.decode_arrays(pa.array(np.concatenate(got)), lengths).to_pylist() == some
    # Ids without a token, NULL ids, texts without ids, and bytes that are not UTF-8 by themselves.
    half = library.encode("\U0001F600", add_special_tokens=False).ids[:1]
    odd = pa.array([None, -1, 10 ** 6, *half, *half], pa.int32())
    assert pairs.decode_arrays(odd, np.array([0, 3, 1, 0, 1])).to_pylist() == [
        "", "", *[library.decode(half, skip_special_tokens=False), ""], library.decode(half, skip_special_tokens=False)]
    assert pairs.decode_arrays(odd[:0], np.array([0, 0])).to_pylist() == ["", ""]


def test_rows(spark, documents, library):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (None, "x"), (3, ""), (4, "ü" * 100_000)]
    tokens = encoded(documents(rows), PATH)
    got = sorted(((r.doc_id, r.ids, r.text) for r in decoded(tokens, PATH).collect()), key=str)
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows), key=str)
    assert got == want
    assert decoded(encoded(documents(rows).limit(0), PATH), PATH).collect() == []
    assert decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first().text == ""


def test_bytes_that_are_not_utf8(spark, library):
    rows = spark.sql("SELECT 1L AS doc_id, X'61FF62' AS text")
    assert decoded(encoded(rows, PATH), PATH).first().text == "a�b"


def test_query(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op12_segment_tree_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        again = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(again.encode()).hexdigest())


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        BytePairs(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
