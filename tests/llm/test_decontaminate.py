"""Edit matches of benchmark items against a plain distance table."""

import random

import pytest

from jobsignals.llm.decontaminate import (
    RATE, contaminated, decontaminated, edged, myers, normal, op1_pigeonhole_decontamination, pieces,
)


def least_edits(item, text):
    row = list(range(len(item) + 1))
    best = (row[-1], 0)
    for at, c in enumerate(text, 1):
        new = [0]
        for i, d in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != d)))
        row = new
        best = min(best, (row[-1], at))
    return best


def by_force(docs, items, rate):
    out = []
    for doc, text in docs:
        for item, benchmark in items:
            b, t = normal(benchmark or ""), normal(text or "")
            if b and t:
                edits = least_edits(edged(b), edged(t))[0]
                if edits <= int(rate * len(b)):
                    out.append((doc, item, edits, len(b)))
    return sorted(out, key=str)


def test_bit_parallel_distance():
    rng = random.Random(4)
    for _ in range(300):
        item = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        edits, end = least_edits(item, text)
        got = myers(item, text, len(item))
        assert (got or (len(item), 0)) == (edits, end)
        assert "".join(p for _, p in pieces(item, 7)) == item


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("aeioulmnst", k=rng.randint(1, 7))) for _ in range(80)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(12)]
    items += [(50, items[0][1]), (51, None), (52, ""), (53, "?!"), (None, "Zum Beispiel: zehn Fragen")]
    docs = []
    for d in range(60):
        text = " ".join(rng.choices(words, k=rng.randint(0, 60)))
        if d % 2:
            text += "\n" + rng.choice(items[:12])[1].upper().replace(" ", ", ") + " " + text
            for _ in range(rng.randint(0, 9)):
                at = rng.randrange(len(text))
                text = text[:at] + rng.choice(["", "x", "yy", text[at]]) + text[at + 1 :]
        docs.append((d, text))
    docs += [(100, None), (101, ""), (None, "zum BEISPIEL -- zehn fragen"), (102, items[3][1]), (102, items[3][1]),
             (103, "İ" * 40_000 + " " + items[4][1] + " " + "tail " * 40_000)]
    return docs, items


@pytest.mark.parametrize("rate,block", [(0.05, 2_000_000), (0.15, 300)])
def test_equals_distance_tables(spark, documents, cases, rate, block):
    docs, items = cases
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    short = [d for d in docs if len(d[1] or "") < 5000]
    got = contaminated(documents(short).repartition(3), benchmark, rate, block_chars=block).collect()
    assert sorted(((r.doc_id, r.item_id, r.edits, r.item_chars) for r in got), key=str) == by_force(short, items, rate)
    texts = dict(docs)
    for r in got:
        if r.edits == 0:
            held = normal(texts[r.doc_id][r.start : r.end])
            assert normal(dict(items)[r.item_id]) in held and len(held) < r.item_chars + 20
    kept = decontaminated(documents(docs), benchmark, rate, block_chars=block).collect()
    bad = {r.doc_id for r in got} | {103}
    assert sorted((r.doc_id for r in kept), key=str) == sorted((d for d, _ in docs if d not in bad), key=str)


def test_nothing_to_search(spark, documents):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(documents([(1, "a")]), benchmark).collect() == []
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contaminated(documents([]), some).collect() == []
    assert decontaminated(documents([(1, "a b c")]), benchmark).count() == 1


def test_query_finds_what_exact_search_finds(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    exact = {(d.doc_id, b.item_id) for b in items for d in docs if edged(normal(b.text)) in edged(normal(d.text or ""))}
    got = op1_pigeonhole_decontamination(spark, sf_dir).collect()
    assert exact and exact == {(r.doc_id, r.item_id) for r in got if r.edits == 0}


def test_query_finds_what_all_pairs_find(spark, documents):
    """The query's tables with edits put into some texts; every item against every text."""
    sf_dir = "/root/testdata/sf0.001"
    rng = random.Random(3)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r.item_id, normal(r.text)) for r in benchmark.collect()][:60]
    docs = []
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()[:60]:
        text = d.text or ""
        if d.doc_id % 3 == 0:
            item = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, int(RATE * len(item)) + 1)):
                item[rng.randrange(len(item))] = rng.choice(["", "x", "yy"])
            text = f"{text[:200]} {''.join(item)} {text[200:]}"
        docs.append((d.doc_id, text))
    want = set()
    for doc, text in docs:
        for item_id, item in items:
            found = myers(edged(item), edged(normal(text)), int(RATE * len(item))) if item else None
            if found:
                want.add((doc, item_id, found[0]))
    got = contaminated(documents(docs), benchmark.where(benchmark.item_id.isin([i for i, _ in items])))
    assert {(r.doc_id, r.item_id, r.edits) for r in got.collect()} == want and any(e for *_, e in want)


def test_short_items_end_where_words_end(spark, documents):
    benchmark = spark.createDataFrame([(1, "cat"), (2, "Yes!")], "item_id long, text string")
    docs = [(1, "concatenate the eyesight"), (2, "a CAT."), (3, "yes"), (4, "cats"), (5, "tom,cat;yes")]
    got = contaminated(documents(docs), benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.end) for r in got) == [
        (2, 1, 2, 5), (3, 2, 0, 3), (5, 1, 4, 7), (5, 2, 8, 11)]
