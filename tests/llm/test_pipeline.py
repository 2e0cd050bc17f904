"""Each stage of the corpus pipeline on what the one before it kept."""

from collections import Counter

import corpus_pipeline
from jobsignals.llm.decontaminate import normal
from jobsignals.llm.mixing import mixed
from jobsignals.llm.shards import interleaved
from tests.llm.test_nearcopies import by_force

SF_DIR = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    given = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_copies", "decontamination", "mixing", "sharding"]

    good = stages["quality"](spark, docs, SF_DIR).cache()
    assert good.columns == given
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    known = [d for d, _ in texts(docs) if d in labels]
    assert sum((labels[d] == 1) == (d in kept) for d in known) >= 0.95 * len(known)

    alone = stages["near_copies"](spark, good, SF_DIR).cache()
    assert alone.columns == given
    components = Counter(c for _, _, c in by_force(texts(good)))
    assert sorted(d for d, _ in texts(alone)) == sorted(components)

    clean = stages["decontamination"](spark, alone, SF_DIR).cache()
    assert clean.columns == given
    items = [normal(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    gone = {d for d, t in texts(alone) if any(i in normal(t or "") for i in items)}
    assert gone and sorted(d for d, _ in texts(clean)) == sorted(d for d, _ in texts(alone) if d not in gone)

    mixed = stages["mixing"](spark, clean, SF_DIR)
    assert mixed.columns == given and sorted(texts(mixed)) == sorted(texts(clean))

    sharded = stages["sharding"](spark, mixed, SF_DIR)
    rows = sharded.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted(texts(clean))
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_run_and_odd_rows(spark, documents, tmp_path):
    folder = str(tmp_path / "tables")
    rows = [(i, ("word " * i + "some more text of its own " + str(i))) for i in range(30)]
    rows += [(None, None), (None, "no id"), (40, None), (41, ""), (3, rows[3][1]), (50, "x" * 200_000)]
    table = documents(rows).withColumnRenamed("row", "source").withColumnRenamed("component_id", "shard")
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "anything else")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    found = corpus_pipeline.run(spark, folder)
    assert set(found.columns) == {*table.columns, "slot"}
    assert found.count() >= 30
    empty = str(tmp_path / "empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_mixing_decides_what_shards_hold_first(spark, tmp_path):
    sizes = {"big": 6400, "mid": 1600, "low": 400}
    docs = None
    for at, (source, n) in enumerate(sizes.items()):
        part = spark.range(n).selectExpr(f"id * 3 + {at} AS doc_id", "concat('text ', id) AS text", f"'{source}' AS source")
        docs = part if docs is None else docs.unionAll(part)
    docs.repartition(7).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    stages = dict(corpus_pipeline.STAGES)
    stages["mixing"](spark, docs, "").write.parquet(str(tmp_path / "mixed"))
    written = spark.read.parquet(str(tmp_path / "mixed"))
    position = {r.doc_id: r.position for r in mixed(docs).collect()}
    for given in (written, stages["mixing"](spark, docs, "")):
        rows = stages["sharding"](spark, given, "").collect()
        assert {r.doc_id: r.slot * 8 + r.shard for r in rows} == position
    # Square roots 80 : 40 : 20, until "low" runs out after some 400 * 7 rows; a shard
    # takes 8 rows of a block.
    for shard in range(8):
        first = sorted((r.slot, r.source) for r in rows if r.shard == shard)[:320]
        shares = Counter(s for _, s in first)
        assert all(abs(shares[s] - 320 * w) <= 8 for s, w in (("big", 4 / 7), ("mid", 2 / 7), ("low", 1 / 7)))
    alone = {r.doc_id: r.slot * 8 + r.shard for r in stages["sharding"](spark, docs, "").collect()}
    assert sorted(alone.values()) == list(range(8400)) and alone != position


def test_sharding_cuts_as_its_operator_does(spark, tmp_path):
    """99 rows in 8 shards: 12 whole turns give each shard a row, in their order; the rows of the last
    turn and so the sizes are spread as the interleaving spreads them."""
    spark.range(99).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'one' AS source").coalesce(1).write.parquet(
        str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    rows = dict(corpus_pipeline.STAGES)["sharding"](spark, docs, "").collect()
    sizes = Counter(r.shard for r in interleaved(docs).collect())
    assert Counter(r.shard for r in rows) == sizes and len(set(sizes.values())) == 2
    for shard in range(8):
        own = sorted((r.slot, r.doc_id) for r in rows if r.shard == shard)
        assert [s for s, _ in own] == list(range(sizes[shard]))
        assert [d for _, d in own[:12]] == [8 * s + shard for s in range(12)]
    assert sorted(r.doc_id for r in rows) == list(range(99))
