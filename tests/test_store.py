"""The log and the buckets of the keyed store, its change feed and the counts over it."""

import random
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobsignals.plans import catalog
from jobsignals.sources.files import Folder
from jobsignals.streaming import jobs
from jobsignals.streaming.counts import merge_counts, read_counts, refresh_counts
from jobsignals.streaming.store import changes, compact, read_store, snapshot, upsert_batch, vacuum

SCHEMA = "id string, n int"


@pytest.fixture
def batch(spark):
    return lambda rows: spark.createDataFrame(list(rows), SCHEMA)


def held(spark, path, batch, **at):
    return {r.id: r.n for r in read_store(spark, path, batch([]).schema, **at).collect()}


def test_a_name_is_taken_once(spark, tmp_path):
    folder = Folder(spark, f"{tmp_path}/log")
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if folder.put("1.json", str(i)) else None) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and folder.text("1.json") == str(won[0])
    assert list(folder.names()) == ["1.json"] and Folder(spark, f"{tmp_path}/none").names() == {}


def test_no_commits_no_rows(spark, batch, tmp_path):
    assert held(spark, f"{tmp_path}/none", batch) == {}
    assert compact(spark, f"{tmp_path}/none", batch([]).schema) is None
    upsert_batch(f"{tmp_path}/s")(batch([]), 0)
    upsert_batch(f"{tmp_path}/s")(batch([(None, 1)]), 1)
    assert held(spark, f"{tmp_path}/s", batch) == {}


def test_streams_compaction_and_readers_at_once(spark, batch, tmp_path):
    """Nothing is lost or doubled while two streams write, one thread compacts and one reads."""
    path, schema = f"{tmp_path}/s", batch([]).schema
    rng, want, streams = random.Random(3), {}, []
    for name in ("x", "y"):
        folder = f"{tmp_path}/in-{name}"
        for _ in range(4):
            rows = [(f"k{rng.randrange(90)}", rng.randrange(10**6)) for _ in range(40)]
            batch(rows).coalesce(1).write.mode("append").parquet(folder)
            for k, n in rows:  # the number decides, whichever stream brings it
                want[k] = max(want.get(k, -1), n)
        streams.append(folder)
    queries = [
        jobs.upsert_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder),
                           f"{tmp_path}/cp-{i}", path, newest=["n"], once=True)
        for i, folder in enumerate(streams)]
    seen, failed = [], []

    def keep_reading():
        try:
            while any(q.isActive for q in queries):
                rows = read_store(spark, path, schema).collect()
                assert len({r.id for r in rows}) == len(rows) and len(rows) >= (seen[-1] if seen else 0)
                seen.append(len(rows))
        except BaseException as error:
            failed.append(error)

    reader = threading.Thread(target=keep_reading)
    reader.start()
    compactions = 0
    while any(q.isActive for q in queries):
        compactions += compact(spark, path, schema) is not None
    reader.join()
    jobs.await_all(queries)
    assert not failed and compactions and seen
    assert held(spark, path, batch) == want
    assert len(snapshot(spark, path).batches) == 2
    compact(spark, path, schema)
    assert held(spark, path, batch) == want


def test_a_batch_in_flight_survives_compaction(spark, batch, tmp_path):
    """Compaction between the writing of a batch and its commit leaves the batch alone."""
    path, schema = f"{tmp_path}/s", batch([]).schema
    upsert_batch(path)(batch([("a", 1), ("b", 1)]), 0)

    in_flight = tmp_path / "s" / "data" / "f" / "_temporary"
    in_flight.mkdir(parents=True)
    compact(spark, path, schema)
    assert in_flight.exists() and held(spark, path, batch) == {"a": 1, "b": 1}
    assert vacuum(spark, path) == 0 and in_flight.exists()  # younger than what is kept


def test_compaction_keeps_what_came_meanwhile(spark, batch, tmp_path, monkeypatch):
    from jobsignals.streaming import store

    path, schema = f"{tmp_path}/s", batch([]).schema
    write = upsert_batch(path)
    write(batch([("a", 1), ("b", 1)]), 0)
    plain = store._write

    def slow(rows, *args):
        out = plain(rows, *args)
        monkeypatch.setattr(store, "_write", plain)
        write(batch([("a", 2), ("c", 2)]), 1)  # committed before the compaction is
        return out

    monkeypatch.setattr(store, "_write", slow)
    assert compact(spark, path, schema) == 2
    assert held(spark, path, batch) == {"a": 2, "b": 1, "c": 2}
    assert held(spark, path, batch, version=0) == {"a": 1, "b": 1}


def test_of_two_compactions_one_counts(spark, batch, tmp_path, monkeypatch):
    from jobsignals.streaming import store

    path, schema = f"{tmp_path}/s", batch([]).schema
    upsert_batch(path)(batch([("a", 1), ("b", 1)]), 0)
    plain = store._write

    def slow(rows, *args):
        monkeypatch.setattr(store, "_write", plain)
        assert compact(spark, path, schema) == 1
        return plain(rows, *args)

    monkeypatch.setattr(store, "_write", slow)
    assert compact(spark, path, schema) is None
    assert held(spark, path, batch) == {"a": 1, "b": 1}


def files_read(df):
    return {f.rsplit("_bucket=", 1)[1].split("/")[0] for f in df.inputFiles()}


def test_a_key_opens_its_bucket_only(spark, batch, tmp_path):
    path, schema = f"{tmp_path}/s", batch([]).schema
    upsert_batch(path, buckets=8)(batch([(f"k{i}", i) for i in range(200)]), 0)
    compact(spark, path, schema)
    upsert_batch(path)(batch([("k7", -7)]), 1)
    assert held(spark, path, batch, keys=["k7", "k9", "none"]) == {"k7": -7, "k9": 9}
    assert len(files_read(read_store(spark, path, schema, keys=["k7"]))) == 1
    assert len(files_read(read_store(spark, path, schema))) == 8
    # One bucket has a tail: the others are read as they are, and only it is compacted.
    old = snapshot(spark, path)
    assert len(old.tails) == 1
    compact(spark, path, schema)
    new = snapshot(spark, path)
    assert sum(old.base[b] != new.base[b] for b in range(8)) == 1
    plan = read_store(spark, path, schema)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and held(spark, path, batch)["k7"] == -7


def test_many_commits_and_old_versions(spark, batch, tmp_path):
    path = f"{tmp_path}/s"
    for i in range(40):  # past the commits that hold the whole state
        upsert_batch(path, buckets=2)(batch([("a", i)]), i)
    assert held(spark, path, batch) == {"a": 39}
    for version in (0, 31, 32, 33):
        assert held(spark, path, batch, version=version) == {"a": version}
    with pytest.raises(ValueError):
        read_store(spark, path, batch([]).schema, version=77)


def test_a_committed_batch_is_not_written_again(spark, batch, tmp_path):
    path = f"{tmp_path}/s"
    write = upsert_batch(path, stream="one")
    write(batch([("a", 1)]), 0)
    write(batch([("a", 2)]), 0)
    assert held(spark, path, batch) == {"a": 1} and snapshot(spark, path).version == 0


def test_vacuum_leaves_what_is_read(spark, batch, tmp_path):
    path, schema = f"{tmp_path}/s", batch([]).schema
    for i in range(3):
        upsert_batch(path, buckets=2)(batch([("a", i), ("b", i), (f"c{i}", i)]), i)
        compact(spark, path, schema)
    want = held(spark, path, batch)
    assert vacuum(spark, path, keep_hours=-1) > 0
    assert held(spark, path, batch) == want == {"a": 2, "b": 2, "c0": 0, "c1": 1, "c2": 2}
    live = {folder for folder in snapshot(spark, path).base.values()}
    assert {p.name for p in (tmp_path / "s" / "data").iterdir()} == live


def test_the_rows_of_other_partitions_stay_in_the_base(spark, tmp_path):
    """A later offset can put another partition's row on top, after compaction too."""
    def placed(*given):
        return spark.createDataFrame(list(given), "id string, n int, partition int, offset long, timestamp long").selectExpr(
            "id", "n", "partition", "offset", "timestamp_seconds(timestamp) AS timestamp")

    path = f"{tmp_path}/s"
    schema = spark.createDataFrame([], SCHEMA).schema
    write = upsert_batch(path)
    write(placed(("a", 1, 0, 2, 100), ("a", 2, 1, 5, 99)), 0)
    compact(spark, path, schema)
    assert [tuple(r) for r in read_store(spark, path, schema).collect()] == [("a", 1)]
    write(placed(("a", 3, 0, 4, 90)), 1)
    assert [tuple(r) for r in read_store(spark, path, schema).collect()] == [("a", 2)]


def test_changes(spark, batch, tmp_path):
    path, schema = f"{tmp_path}/s", batch([]).schema
    write = upsert_batch(path)
    write(batch([("a", 1), ("b", 1), ("c", 1)]), 0)
    write(batch([("a", 2), ("b", 1), ("d", 1)]), 1)
    compact(spark, path, schema)
    write(batch([("a", 3)]), 2)
    upto = snapshot(spark, path).version

    def feed(after, to):
        return {r.id: (r.old and r.old.n, r.new and r.new.n) for r in changes(spark, path, schema, after, to).collect()}

    assert feed(-1, 0) == {"a": (None, 1), "b": (None, 1), "c": (None, 1)}
    assert feed(0, 1) == {"a": (1, 2), "d": (None, 1)}  # b was written and stayed as it was
    assert feed(1, upto) == {"a": (2, 3)} and feed(0, upto) == {"a": (1, 3), "d": (None, 1)}
    assert feed(upto, upto) == {}


def test_counts_equal_a_recount(spark, tmp_path):
    kind = "id string, terms array<string>"
    store, counts = f"{tmp_path}/s", f"{tmp_path}/c"
    rng = random.Random(5)
    schema = spark.createDataFrame([], kind).schema
    state = {}
    for number in range(4):
        rows = {f"k{rng.randrange(30)}": rng.choice([None, [], ["x"], ["x", "y", None], ["z", "z", "x"]]) for _ in range(12)}
        upsert_batch(store)(spark.createDataFrame(list(rows.items()), kind), number)
        state |= rows
        if number == 1:
            compact(spark, store, schema)
        if number != 2:
            refresh_counts(spark, counts, store, schema, "terms", "term")
        if number == 3:
            merge_counts(spark, counts, "term")
        got = {r.term: r["count"] for r in read_counts(spark, counts, "term").collect()}
        want = Counter(t for terms in state.values() for t in terms or [] if t is not None)
        assert number == 2 or got == want
    refresh_counts(spark, counts, store, schema, "terms", "term")  # nothing new
    assert {r.term: r["count"] for r in read_counts(spark, counts, "term").collect()} == want


def test_counts_open_what_was_written(spark, tmp_path):
    kind = "id string, terms array<string>"
    store = f"{tmp_path}/s"
    rows = spark.range(400).select(F.concat(F.lit("k"), "id").alias("id"), F.array(F.lit("x")).alias("terms"))
    upsert_batch(store, buckets=16)(rows, 0)
    compact(spark, store, rows.schema)
    after = snapshot(spark, store).version
    upsert_batch(store)(spark.createDataFrame([("k3", ["y"])], kind), 1)
    feed = changes(spark, store, rows.schema, after, after + 1)
    assert len(files_read(feed)) == 1
    assert [(r.old.terms, r.new.terms) for r in feed.collect()] == [(["x"], ["y"])]


def test_the_topic_of_a_split_table_is_dealt_to_no_two_tasks(spark, tmp_path):
    from jobsignals.plans import catalog

    rows = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'web' AS source")
    rows.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    folder = catalog._topic(spark, str(tmp_path), f"{tmp_path}/topic")
    for part in (0, 1):
        assert sum(n.startswith("part-") for n in Folder(spark, f"{folder}/part={part}").names()) == 4
    found = catalog.stream_raw_store(spark, str(tmp_path)).collect()
    assert sorted(int(r.id) for r in found) == list(range(400)) and {r.name for r in found} == {"web"}


def test_files_are_packed_and_a_read_merges_by_one_shuffle(spark, batch, tmp_path):
    write = upsert_batch(f"{tmp_path}/s", buckets=1)
    for number in range(2):
        write(batch([(f"k{i}", i + number) for i in range(20)]), number)
    found = read_store(spark, f"{tmp_path}/s", batch([]).schema)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r.id: r.n for r in found.collect()} == {f"k{i}": i + 1 for i in range(20)}
    files = [f.name for f in (tmp_path / "s" / "data").rglob("part-*")]
    assert len(files) == 2 and all(".zstd." in f for f in files)
    topic = catalog._topic(spark, "/root/testdata/sf0.001", f"{tmp_path}/topic")
    assert all(f.name.endswith(".gz") for f in (tmp_path / "topic").rglob("part-*")) and spark.read.text(topic).count() > 200
