"""Quality and toxicity: held-out accuracy, rows without labels, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsignals.llm import quality, toxicity

SF_DIR = "/root/testdata/sf0.1"


# About one in twenty texts with the label toxic holds no toxic word in these tables.
@pytest.mark.parametrize("query,label,least", [
    (quality.op8_quality, "quality", 0.97), (toxicity.op9_toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    got = query(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rows = got.join(labels, "doc_id", "left").select("held_out", "score", "predicted", label).toPandas()
    assert len(rows) == n and rows.score.between(0, 1).all()
    assert ((rows.score >= 0.5).astype(int) == rows.predicted).all()
    apart = rows[rows.held_out & rows[label].notna()]
    for kind in (0, 1):
        part = apart[apart[label] == kind]
        assert len(part) > 20 and (part.predicted == kind).mean() >= least


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, documents, module):
    rows = [(i, ("bad word " if i % 2 else "good text ") * (i % 9 + 1)) for i in range(80)]
    rows += [(90, None), (91, ""), (None, "no id"), (92, "x" * 300_000), (93, "word " * 200_000), (1, "bad"), (1, "bad")]
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(80)] + [(None, 1, "x"), (90, None, "x"), (3, 0, "x")],
                                   "doc_id long, mark int, text string")
    table = documents(rows)
    score = module.fitted(table, labels, F.col("doc_id") % 5 != 0, "mark")
    got = quality.scored(table, score).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in got if r.doc_id is not None and 1 < r.doc_id < 80)
    assert quality.scored(documents([]), score).collect() == []
    none = module.fitted(table, labels.where("mark = 1"), F.lit(True), "mark")
    assert all(r.score > 0.9 for r in quality.scored(table, none).collect())
    module.fitted(documents([]), labels.limit(0), F.lit(True), "mark")


def test_folding_and_exceptions():
    model = np.array([-5.0, 4.0, 1.0, 0.0, 0.0])
    lexicon = toxicity.Lexicon({"moron": 6.0, "clown ": 5.0}, {"clown fish"}, model)
    scores = lexicon(["you ｍ0ron!".encode(), "you mоrоnic one".encode(), b"oxymoron", b"a clown fish swims",
                      b"a clown", b"clowns", b""])
    assert [s > 0.5 for s in scores] == [True, True, False, False, True, False, False]


def test_tokens_of_long_runs():
    bucket, owner = quality._tokens([b"", b"Abc 12!! " + b"z" * 200_000, b"  ", b"Abc"])
    assert owner.tolist() == [1, 1, 1, 1, 1, 1, 1, 3] and bucket[0] == bucket[-1]


def _plainly_chosen(held, weights, least):
    """The same choice, every term weighed anew at each step."""
    need, chosen, alive = [toxicity.COVER] * len(held), [], set(weights)
    while True:
        gain = {t: sum(n > 0 and t in terms for n, terms in zip(need, held)) for t in alive}
        alive = {t for t in alive if gain[t] >= least}
        if not alive:
            return chosen
        best = max(alive, key=lambda t: (gain[t] * (weights[t] - toxicity.LEAST_WEIGHT / 2), len(t), t))
        chosen.append(best)
        need = [n - (best in terms) for n, terms in zip(need, held)]
        stem = best.rstrip()
        alive = {t for t in alive if not t.startswith(stem) and not stem.startswith(t.rstrip())}


def test_lexicon_is_the_plain_choice():
    rng = np.random.default_rng(5)
    for size in (5, 40, 120):
        words = ["".join(rng.choice(list("abc"), rng.integers(3, 13))) for _ in range(60)]
        texts = [toxicity._terms(list(rng.choice(words, 4))) for _ in range(size)]
        clean = [toxicity._terms(list(rng.choice(words, 4))) for _ in range(size)]
        counts = {t: (sum(t in x for x in texts), sum(t in x for x in clean)) for x in texts for t in x}
        weights = {t: 2 + 3 * a / (a + b) for t, (a, b) in counts.items()}
        terms = toxicity._distinct(counts)
        assert len(terms) < len(counts)
        held = [[terms.index(t) for t in x if t in terms] for x in texts]
        assert toxicity._covering(held, terms, weights, 3) == _plainly_chosen(texts, weights, 3)


def test_rare_toxic_words_are_learned(spark, documents):
    """6,000 toxic words, none of them in more than three texts."""
    letters = "abcdefghijklmnopqrst"
    word = lambda i: "q" + "".join(letters[i // 20 ** k % 20] for k in range(4))[::-1]
    rows = [(i, f"some quiet words and {word(i // 3)} here") for i in range(6000)]
    rows += [(6000 + i, "some quiet words and nothing here") for i in range(6000)]
    labels = spark.createDataFrame([(i, int(i < 6000)) for i in range(12_000)], "doc_id long, toxic int")
    lexicon = toxicity.fitted(documents(rows), labels, F.lit(True))
    scores = lexicon([f"here and {word(i)}".encode() for i in range(0, 2000, 50)] + [b"some quiet words"])
    assert (scores[:-1] > 0.5).all() and scores[-1] < 0.5
