import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from jobsignals import schemas
from jobsignals.operators import postings as po
from jobsignals.plans import catalog
from jobsignals.sources import tables, topics
from jobsignals.streaming import jobs
from jobsignals.streaming.store import compact, read_store, snapshot, stream_id, upsert_batch

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    """A topic of several files, with malformed messages in between."""
    from jobsignals.plans.inputs import postings

    path = str(tmp_path_factory.mktemp("topic"))
    good = po.to_messages(postings(spark, SF_DIR)).select(F.col("value").cast("string"))
    bad = spark.createDataFrame([("{bad",), ("[]",)], "value string")
    good.union(bad).repartition(5, "value").write.mode("append").text(path)
    return path


def stream(spark, topic, **options):
    return topics.read_stream(spark, options, "text", path=topic)


def test_batch_equals_stream(spark, topic, tmp_path):
    rows = jobs.extract_stream(stream(spark, topic, maxFilesPerTrigger="2"))
    jobs.append_stream(rows, f"{tmp_path}/cp", f"{tmp_path}/out", once=True).awaitTermination()
    batch = jobs.extract_stream(topics.replay(spark, {}, "text", topic))
    assertDataFrameEqual(spark.read.schema(schemas.EXTRACTED).json(f"{tmp_path}/out"), batch)
    assert batch.count() > 100


def test_landing_keeps_malformed_messages_and_resumes(spark, topic, tmp_path):
    for _ in range(2):  # the second run finds nothing new
        jobs.land(stream(spark, topic), f"{tmp_path}/out", f"{tmp_path}/cp", once=True).awaitTermination()
    landed = tables.read_postings(spark, f"{tmp_path}/out")
    assert landed.count() == topics.replay(spark, {}, "text", topic).count()
    assert landed.filter("id IS NULL").count() == 2


def test_fan_out(spark, topic, tmp_path, capsys):
    queries = jobs.land_and_echo(stream(spark, topic), f"{tmp_path}/out", f"{tmp_path}/cp", once=True)
    for q in queries:
        q.awaitTermination()
    assert tables.read_postings(spark, f"{tmp_path}/out").count() > 100
    assert "Batch: 0" in capsys.readouterr().out


def test_raw_store(spark, topic, tmp_path):
    jobs.store_raw(stream(spark, topic, maxFilesPerTrigger="2"), f"{tmp_path}/s", f"{tmp_path}/cp", once=True).awaitTermination()
    stored = read_store(spark, f"{tmp_path}/s", schemas.POSTING_RAW_STORE)
    want = po.parse_postings(topics.replay(spark, {}, "text", topic)).filter("id IS NOT NULL")
    assertDataFrameEqual(stored, want.select(*stored.columns))


SCHEMA = "id string, n int"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(spark, path):
    return sorted(map(tuple, read_store(spark, path, batch(spark, ("x", 0)).schema).collect()))


def test_last_write_wins_and_reruns_replace(spark, tmp_path):
    path = f"{tmp_path}/s"
    write = upsert_batch(path)
    write(batch(spark, ("a", 1), ("a", 2), ("b", 9), (None, 5)), 0)
    write(batch(spark, ("b", 3), ("c", 4)), 1)
    write(batch(spark, ("b", 3), ("c", 4)), 1)  # the same batch again
    want = [("a", 2), ("b", 3), ("c", 4)]
    assert rows(spark, path) == want
    compact(spark, path, batch(spark, ("x", 0)).schema)
    assert rows(spark, path) == want
    at = snapshot(spark, path)
    assert at.base and not at.tails
    write(batch(spark, ("a", 0)), 2)
    assert rows(spark, path)[0] == ("a", 0)


def test_another_stream_and_a_renewed_checkpoint_keep_earlier_rows(spark, tmp_path):
    path = f"{tmp_path}/s"
    folder = f"{tmp_path}/in"
    schema = batch(spark, ("x", 0)).schema
    for name, given in (("one", [("a", 1), ("b", 1)]), ("two", [("a", 2), ("c", 2)]), ("three", [("d", 3)])):
        batch(spark, *given).write.parquet(f"{folder}/{name}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/{name}")
        jobs.upsert_stream(stream, f"{tmp_path}/cp-{name}", path, once=True).awaitTermination()
    assert rows(spark, path) == [("a", 2), ("b", 1), ("c", 2), ("d", 3)]
    assert snapshot(spark, path).batches == {
        stream_id(spark, f"{tmp_path}/cp-{n}"): 0 for n in ("one", "two", "three")}


def test_given_order_decides_over_batches(spark, tmp_path):
    write = upsert_batch(f"{tmp_path}/s", newest=["n"])
    write(batch(spark, ("a", 7)), 0)
    write(batch(spark, ("a", 1)), 1)
    assert rows(spark, f"{tmp_path}/s") == [("a", 7)]


def test_the_later_message_wins(spark, tmp_path):
    """Offsets decide within a partition, time stamps between partitions."""
    def placed(*given):
        return spark.createDataFrame(list(given), "id string, n int, partition int, offset long, timestamp long").selectExpr(
            "id", "n", "partition", "offset", "timestamp_seconds(timestamp) AS timestamp")

    for stream, parts in (("one batch", [slice(None)]), ("batches", [slice(0, 3), slice(3, None)])):
        path = f"{tmp_path}/{len(parts)}"
        given = [("a", 9, 0, 1, 100), ("b", 1, 0, 2, 100), ("c", 5, 0, 3, 50), ("a", 1, 0, 4, 90), ("b", 2, 1, 0, 99), ("c", 6, 1, 7, 60)]
        for number, part in enumerate(parts):
            upsert_batch(path, stream=stream)(placed(*given[part]), number)
        assert rows(spark, path) == [("a", 1), ("b", 1), ("c", 6)]
        compact(spark, path, batch(spark, ("x", 0)).schema)
        assert rows(spark, path) == [("a", 1), ("b", 1), ("c", 6)]


def test_a_failed_query_stops_the_others(spark, topic, tmp_path):
    good = jobs.append_stream(stream(spark, topic), f"{tmp_path}/cp", f"{tmp_path}/out", format="text")

    def fail(rows, number):
        raise ValueError("no such sink")

    bad = stream(spark, topic).writeStream.foreachBatch(fail).option("checkpointLocation", f"{tmp_path}/cp2").start()
    with pytest.raises(Exception, match="no such sink"):
        jobs.await_all([good, bad])
    assert not good.isActive


def test_each_query_has_its_own_checkpoint(spark, topic, tmp_path):
    for q in jobs.land_and_echo(stream(spark, topic), f"{tmp_path}/out", f"{tmp_path}/cp", once=True):
        q.awaitTermination()
    assert {p.name for p in (tmp_path / "cp").iterdir()} == {"files", "echo"}


def test_counts_extract_each_posting_once(spark, monkeypatch):
    """What comes again under the same text is taken as it was extracted."""
    calls = []
    extract = catalog.po.extract
    monkeypatch.setattr(catalog.po, "extract", lambda rows, *more: calls.append(rows) or extract(rows, *more))
    assert catalog.stream_counts(spark, "/root/testdata/sf0.001").count() > 0
    assert len(calls) == 2  # the other text of half of them, and all as they are
