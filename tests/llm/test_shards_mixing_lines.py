"""Sharding, mixing and line dedup: laws, odd rows and brute force."""

from collections import Counter, defaultdict

import pytest

from jobsignals.llm.boilerplate import without_boilerplate
from jobsignals.llm.mixing import in_mixed_order, mixed, op6_pfair_mix
from jobsignals.llm.shards import interleaved, sharded


@pytest.fixture(scope="module")
def sourced(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string, source string, shard string, "
                                           "position string, rows int, rank int")
    return make


def rows_of(sizes):
    out = []
    for source, n in sizes.items():
        out += [(len(out) + i, f"text {source} {i}", source, "s", "p", 1, 2) for i in range(n)]
    return out


def test_shards_match_the_mixture(sourced):
    got = interleaved(sourced(rows_of({"a": 300, "b": 100, None: 60, "c": 5})).repartition(3)).collect()
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sizes[shard]))
        share = Counter(r.doc_id < 300 for r in got if r.shard == shard)[True]
        assert abs(share - 300 / 8) <= 2


def test_shards_of_odd_rows(sourced, spark):
    odd = [(None, None, None, "s", "p", 1, 2), (1, "", "a", "s", "p", 1, 2), (1, "", "a", "s", "p", 1, 2),
           (2, "é" * 100_000, "a", None, None, None, None)]
    got = interleaved(sourced(odd)).collect()
    assert sorted(r.size for r in got) == [1, 1, 1, 200_001]
    assert all(r.text_crc32 == 0 for r in got if r.size == 1)
    assert len({(r.shard, r.slot) for r in got}) == 4
    whole = sharded(sourced(odd))
    assert sorted(whole.columns) == sorted(["doc_id", "text", "source", "position", "rows", "rank", "shard", "slot"])
    assert len({(r.shard, r.slot) for r in whole.collect()}) == 4
    assert interleaved(sourced([])).collect() == [] and sharded(sourced([])).collect() == []


def deviations(rows, weights):
    """Per source the largest distance from its share of the slots, while all last."""
    order = sorted({(r.slot, r.source) for r in rows})
    assert [s for s, _ in order] == list(range(len(order)))
    total = Counter(s for _, s in order)
    seen, worst = Counter(), Counter()
    for slot, source in order:
        seen[source] += 1
        for s, w in weights.items():
            worst[s] = max(worst[s], abs(seen[s] - (slot + 1) * w))
        if any(seen[s] == total[s] for s in weights):
            break
    return worst


def test_mixture_stays_within_a_block(sourced):
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    table = sourced(rows_of({"a": 700, "b": 300, "c": 333, None: 21})).repartition(4)
    got = mixed(table, weights, block_rows=4, period=10).collect()
    assert sorted(r.position for r in got) == list(range(1354))
    worst = deviations([r for r in got if r.source], weights)
    assert all(worst[s] < 1 for s in weights)
    blocks = defaultdict(list)
    for r in got:
        blocks[r.source, r.block].append(r.position)
    for at in blocks.values():
        assert len(at) <= 4 and max(at) - min(at) == len(at) - 1
    by_slot = [r.slot for r in sorted(got, key=lambda r: r.position)]
    assert by_slot == sorted(by_slot)
    assert min(r.position for r in got if r.source is None) == 1333  # no weight: at the end


def test_mixture_follows_irrational_weights_over_many_periods(spark):
    sizes = {f"s{i}": 3000 + i for i in range(20)} | {"big": 30_000, "rare": 40}
    weights = {s: n ** 0.5 for s, n in sizes.items()} | {"rare": 0.01}
    table = None
    for at, (source, n) in enumerate(sizes.items()):
        part = spark.range(n).selectExpr(f"id * 100 + {at} AS doc_id", "'' AS text", f"'{source}' AS source")
        table = part if table is None else table.unionAll(part)
    got = mixed(table, weights, block_rows=1).select("slot", "source").collect()
    order = [r.source for r in sorted(got, key=lambda r: r.slot)]
    assert len(order) == sum(sizes.values()) == len({r.slot for r in got})
    # The steady flow: shares of those that last, from the first slot to the last.
    seen, flow, active = Counter(), dict.fromkeys(sizes, 0.0), sum(weights.values())
    passed, going = 0.0, sorted(sizes, key=lambda s: sizes[s] / weights[s])
    for slot, source in enumerate(order):
        seen[source] += 1
        left = 1.0
        while going and left > 1e-9:
            step = min(left / active, sizes[going[0]] / weights[going[0]] - passed)
            passed += step
            left -= step * active
            while going and sizes[going[0]] / weights[going[0]] - passed < 1e-12:
                active -= weights[going.pop(0)]
        if slot % 97 == 0:
            assert all(abs(seen[s] - min(sizes[s], weights[s] * passed)) < 1 + 1e-6 for s in sizes), slot


def test_mixture_of_many_sources(spark):
    table = spark.range(4200).selectExpr("id AS doc_id", "'' AS text", "CAST(id % 1400 AS STRING) AS source")
    got = mixed(table, block_rows=2).collect()
    assert sorted(r.position for r in got) == list(range(4200))
    assert Counter(r.source for r in got if r.slot < 1400).most_common(1)[0][1] == 2


def test_mixture_of_odd_rows(sourced):
    odd = [(None, None, None, "s", "p", 1, 2), (1, "", "a", "s", "p", 1, 2), (1, "", "a", "s", "p", 1, 2)]
    assert sorted(r.position for r in mixed(sourced(odd)).collect()) == [0, 1, 2]
    assert mixed(sourced([])).collect() == []
    ordered = in_mixed_order(sourced(odd + rows_of({"b": 30})))
    assert ordered.count() == 33 and ordered.columns == sourced(odd).columns


def test_mixture_of_the_documents(spark):
    got = op6_pfair_mix(spark, "/root/testdata/sf0.001").collect()
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert sorted(r.position for r in got) == list(range(n))


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_site_lines(spark, limit):
    pages = [(i, "HTTP://Site.example/p", f"<p>menu</p> own {i} <b> menu </b>\nfooter {i % 2}", 1) for i in range(10)]
    pages += [(100, None, None, 1), (101, "no address", "", 1), (102, "http://one.example", "menu<br>", 1),
              (0, "http://site.example/p", "<p>menu</p> own 0 <b> menu </b>\nfooter 0", 1),
              (103, "http://one.example", "<" * 50_000 + "tail", 1),
              (104, "http://two.example/a", "menu<br>a", 1), (105, "http://two.example/b", "menu<br>b", 1),
              (106, "http://alone.example", "menu<br>c", 1)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, lines int")
    got = {(r.page_id, r.host): r for r in without_boilerplate(table, ratio=0.6, broadcast_lines=limit).collect()}
    assert len(got) == 17
    assert got[104, "two.example"].text == "a" and got[106, "alone.example"].text == "menu\nc"
    assert got[3, "site.example"].text == "own 3\nfooter 1" and got[3, "site.example"].n_dropped == 2
    assert got[100, ""].text == "" and got[101, ""].n_lines == 0
    assert got[102, "one.example"].text == "menu"
    assert without_boilerplate(table.limit(0)).collect() == []
