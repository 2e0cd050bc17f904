"""Terms of a table in texts, against a plain search."""

import random

import pytest
from pyspark.sql import functions as F

from jobsignals.operators.vocabularies import match_table, term_index
from jobsignals.plans.catalog import term_table


def low(text):
    return text.translate(str.maketrans("İıſ", "iis")).lower()


def brute(texts, terms):
    known = [(t, low(t)) for t in set(terms) if t]
    lows = [(i, low(text)) for i, text in texts if text is not None]
    return sorted((i, t) for i, text in lows for t, short in known if short in text)


def matched(spark, texts, terms, tmp_path, **options):
    index = term_index(spark.createDataFrame([(t,) for t in terms], "term string"))
    index.write.mode("overwrite").parquet(f"{tmp_path}/index")
    rows = spark.createDataFrame(texts, "id int, text string")
    return match_table(rows, spark.read.parquet(f"{tmp_path}/index"), **options)


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_random_terms_and_texts(spark, tmp_path, most):
    rng = random.Random(2)
    letters = "abcAB éß.+*(\n"

    def word(n):
        return "".join(rng.choice(letters) for _ in range(n))

    terms = [word(rng.randrange(1, 13)) for _ in range(400)] + ["", None, "😀b", "İa", "ABA", "aba"]
    texts = [(i, word(rng.randrange(0, 200))) for i in range(60)] + [(60, None), (61, ""), (62, "x😀B y"), (7, "iA " * 3)]
    texts += texts[:5]  # repeated rows have their own finds
    got = sorted(tuple(r) for r in matched(spark, texts, terms, tmp_path, broadcast_terms=most).collect())
    assert got == brute(texts, [t for t in terms if t]) and len(got) > 500


def test_many_terms_over_documents(spark, tmp_path):
    """100,000 terms; texts are mapped, with nothing but built-in functions."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = documents.select(F.explode(F.split("text", "[ \n]+")).alias("w")).distinct()
    terms = words.union(words.select(F.reverse("w"))).union(words.select(F.concat("w", F.lit(" "), "w"))).toDF("term")
    term_index(terms.where("length(term) > 2").distinct().limit(100_000)).write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    assert index.count() == 100_000
    few = documents.where("doc_id < 25")
    found = match_table(few, index, keep=["doc_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    got = sorted(tuple(r) for r in found.collect())
    assert got == brute([(r.doc_id, r.text) for r in few.collect()], [r.term for r in index.collect()])


def test_names_of_the_caller_stay(spark, tmp_path):
    index = term_index(spark.createDataFrame([("java", 1)], "word string, gram int"), "word")
    rows = spark.createDataFrame([(1, "JavaScript", "g", "l")], "id int, body string, gram string, low string")
    got = match_table(rows, index, "body", keep=["gram", "low", "id"]).collect()
    assert [r.asDict() for r in got] == [{"gram": "g", "low": "l", "id": 1, "term": "java"}]
    assert match_table(rows, index.limit(0), "body").collect() == [] and match_table(rows.limit(0), index, "body").collect() == []


def test_upper_terms_of_the_query_are_found_again(spark):
    documents = spark.createDataFrame([(1, "Putzß steht hier"), (2, "ganz andere Putzß")], "doc_id long, text string")
    terms = {r.term for r in term_table(documents).collect()}
    assert "PUTZẞ STEHT" in terms and not any("SS" in x for x in terms)
    index = term_index(term_table(documents))
    assert (1, "PUTZẞ STEHT") in {tuple(r) for r in match_table(documents, index, keep=["doc_id"]).collect()}


def test_texts_are_scanned_once(spark, tmp_path):
    words = ["a", "two", "four", "sixsix", "seventy", "eighteen", "nineteen9", "😀 smile", "?b"]
    term_index(spark.createDataFrame([(w,) for w in words], "term string")).write.parquet(f"{tmp_path}/index")
    texts = spark.createDataFrame([(1, "Four 😀 SMILES"), (2, "😀b"), (3, "x?B eighteen")], "id int, text string")
    found = match_table(texts, spark.read.parquet(f"{tmp_path}/index"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert sorted(tuple(r) for r in found.collect()) == [(1, "four"), (1, "😀 smile"), (3, "?b"), (3, "eighteen")]
