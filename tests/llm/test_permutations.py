"""The permutation index against brute force."""

import math

import numpy as np

from jobsignals.llm.permutations import nearest, op3_permutation_index


def brute(rows, k):
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for at, (i, v) in enumerate(good):
        if i is not None and i % 20 == 0:
            scores = [(-float(np.dot(v, w)), j) for b, (j, w) in enumerate(good) if b != at]
            out.setdefault(i, []).append(sorted(scores)[:k])
    return out


def test_recall_on_the_embeddings(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, 20)
    got = {}
    for r in op3_permutation_index(spark, sf_dir).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(want)
    vectors = dict(rows)
    hits = 0
    for query, found in got.items():
        assert [r["rank"] for r in found] == list(range(1, 21))
        for r in found:
            assert abs(r.score - float(np.dot(vectors[query], vectors[r.vec_id]))) < 1e-9
        hits += len({r.vec_id for r in found} & {j for _, j in want[query][0]})
    assert hits / (20 * len(got)) >= 0.9


def test_recall_on_unstructured_vectors_in_slices(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 64)) * rng.uniform(0.8, 1.2, size=(3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    want = brute(rows, 20)
    found = nearest(table, lambda i: i % 20 == 0, slice_rows=1000, block_rows=40).collect()
    hits = sum((r.vec_id in {j for _, j in want[r.query_id][0]}) for r in found)
    assert hits / (20 * len(want)) >= 0.9


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 0.0, 0.0]), (9, [2.0, 0.0]),
            (8, [2.0, 0.0]), (20, [0.0, -5.0]), (None, [0.5, 0.5])]
    table = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows],
                                  "vec_id long, embedding array<double>, score double, rank int")
    got = nearest(table, lambda i: i % 20 == 0, k=3).collect()
    first = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == 0)
    assert first == [(1, 8, 2.0), (1, 8, 2.0), (2, 9, 2.0), (2, 9, 2.0), (3, 0, 1.0), (3, 0, 1.0)]
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 20), key=lambda r: r["rank"])] == [0, 0, 8]
    assert nearest(table.where("vec_id = 1"), lambda i: True).collect() == []
    assert nearest(table.limit(0), lambda i: True).collect() == []


def copies(n, distinct):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(distinct, 16)) * rng.uniform(0.8, 1.2, size=(distinct, 1))
    # One vector's copies fill all rows but those of the others.
    return [(i, x[i if i < distinct else 0].tolist()) for i in range(n)], x


def test_recall_on_copies_in_whole_slices(spark):
    rows, x = copies(40_000, 4000)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    asked = set(range(0, 2000, 20))
    found = {}
    for r in nearest(table, lambda i: i in asked).collect():
        found.setdefault(r.query_id, []).append(r.score)
    hits = 0
    for q in asked:
        scores = x @ x[q]
        every = np.sort(np.concatenate((np.delete(scores, q), np.repeat(scores[0], 36_000))))[::-1][:20]
        hits += sum(s >= every[-1] - 1e-9 for s in found[q])
    assert hits / (20 * len(asked)) >= 0.9


def test_one_vector_over_and_over(spark):
    for first in (0.25, 0.75, 3.0):
        table = spark.range(50_000).selectExpr("id AS vec_id", f"array({first}D, 2.0D) AS embedding")
        got = nearest(table, lambda i: i == 40, k=3).collect()
        assert sorted((r["rank"], r.score) for r in got) == [(n, first ** 2 + 4) for n in (1, 2, 3)]


def test_equal_vectors_are_ordered_by_id(spark):
    """Scores of equal vectors are equal to the last bit, and ties go to smaller ids at every size."""
    import pyarrow as pa

    from jobsignals.llm.permutations import _searched

    rng = np.random.default_rng(8)
    for n in [*range(21, 72), 203, 1303]:
        x = rng.normal(size=128)
        ids = rng.permutation(n) + 1
        index = pa.table({"uid": np.arange(n), "vec_id": ids, "vector": [x.tobytes()] * n,
                          "places": [np.arange(4, dtype=np.uint16).tobytes()] * n})
        asked = pa.table({"uid": [n + 5], "vec_id": [0], "query": [np.arange(4, dtype=np.uint16).tobytes()], "vector": [x.tobytes()]})
        found = _searched(4, 4, 0.35, 20)(index, asked)
        assert found.column("vec_id").to_pylist() == list(range(1, 21)), n
        assert len(set(found.column("score").to_pylist())) == 1


def test_search_equals_a_plain_reading():
    """Footrule over the places, the share by distance and id, then the exact product."""
    import pyarrow as pa
    import pyarrow.compute as pc

    from jobsignals.llm import permutations

    rng = np.random.default_rng(11)
    for n, d, kind in ((400, 12, "plain"), (400, 3, "tied"), (300, 6, "huge")):
        x = rng.normal(size=(n, d))
        x = np.where(np.arange(n)[:, None] % 2, np.round(x) + 1, np.round(x[0])) if kind == "tied" else x
        x = x * 1e300 if kind == "huge" else x
        pivots = x[:40]
        prefix, share, k = 9, 0.3, 4
        with np.errstate(all="ignore"):
            longest = float(np.sqrt((x ** 2).sum(axis=1)).max())
            run = permutations._indexed(pivots, longest, prefix, lambda i: i % 20 == 0)
            batch = pa.record_batch({"uid": pa.array(np.arange(n)), "vec_id": pa.array(rng.permutation(n)), "vector": pa.array(list(x))})
            index = pa.Table.from_batches(list(run(iter([batch]))))
            asked = index.filter(pc.is_valid(index["query"]))
            got = permutations._searched(len(pivots), prefix, share, k)(index, asked).to_pylist()
        ids = index["vec_id"].to_pylist()
        places = [np.frombuffer(p, np.uint16).tolist() for p in index["places"].to_pylist()]
        want = []
        for uid, query_id, query in zip(*(asked[c].to_pylist() for c in ("uid", "vec_id", "query"))):
            own = np.frombuffer(query, np.uint16).tolist()
            saved = [sum(prefix - r - abs(r - p.index(q)) for r, q in enumerate(own) if q in p) for p in places]
            near = sorted(range(n), key=lambda i: (-saved[i], ids[i]))[: max(20 * k, int(np.ceil(share * n)))]
            near = np.array(sorted((i for i in near if i != uid), key=lambda i: ids[i]))
            with np.errstate(all="ignore"):
                score = (x[near] * x[uid]).sum(axis=1)
            want += [(uid, query_id, ids[near[i]], repr(float(score[i]))) for i in np.argsort(-score, kind="stable")[:k]]
        assert [(r["uid"], r["query_id"], r["vec_id"], repr(r["score"])) for r in got] == want
