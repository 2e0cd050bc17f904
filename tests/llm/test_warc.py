"""WARC files: round trip, equal files from any partitioning, revisits, damage."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from jobsignals.llm.warc import op4_warc_roundtrip, read_warc, write_warc


def expected(rows):
    groups = {}
    for at, (i, url, html) in enumerate(rows):
        groups.setdefault(html or "", []).append(((i is not None, i or 0, url or "", url is None), -at, at))
    out = []
    for html, members in groups.items():
        chosen = max(members)[2]
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        for *_, at in members:
            first = at == chosen
            out.append((rows[at][0], len(html.encode()), digest, "response" if first else "revisit",
                        None if first else rows[chosen][0]))
    return sorted(out, key=str)


def digest_rows(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i % 7}</p>" * 50) for i in range(60)]
    rows += [(None, None, None), (5, None, ""), (5, "http://h/ a\r\nb", "x"), (70, "u", "same"), (70, "u", "same"),
             (71, "long", "é" * 700_000), (70, "v", "same")]
    table = spark.createDataFrame([(*r, "s", 1) for r in rows],
                                  "page_id long, url string, html string, shard string, records int")
    return rows, table


def written(table, folder, **options):
    manifest = write_warc(table, folder, shard_bytes=20_000, roll_bytes=400, **options)
    return manifest.withColumn("root", F.lit(folder))


@pytest.mark.parametrize("digests", [100, 0])
def test_round_trip(pages, tmp_path, digests):
    rows, table = pages
    manifest = written(table.repartition(3), str(tmp_path / "a"), broadcast_digests=digests)
    back = read_warc(manifest)
    assert digest_rows(back) == expected(rows)
    payloads = {r.payload for r in back.collect() if r.record_type == "response"}
    assert payloads == {(html or "").encode() for _, _, html in rows}
    assert manifest.count() > 5 and manifest.agg(F.countDistinct("shard")).first()[0] > 1


def test_same_files_from_any_partitioning(pages, tmp_path):
    _, table = pages
    found = []
    for name, frame in (("a", table.repartition(5)), ("b", table.coalesce(1))):
        rows = written(frame, str(tmp_path / name)).orderBy("shard", "file").collect()
        found.append([(r.shard, r.file, r.records, r.bytes, r.sha1) for r in rows])
        for r in rows:
            data = open(r.path, "rb").read()
            assert hashlib.sha1(data).hexdigest() == r.sha1 and len(data) == r.bytes
            assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        assert not list((tmp_path / name).glob("*.open"))
    assert found[0] == found[1]


def test_order_small_payloads_and_damage(pages, tmp_path):
    rows, table = pages
    manifest = written(table, str(tmp_path / "c"), least_bytes=10)
    back = read_warc(manifest)
    assert back.where("payload_bytes < 10 AND record_type = 'revisit'").count() == 0
    first = manifest.orderBy("shard", "file").first()
    data = bytearray(open(first.path, "rb").read())
    data[len(data) // 2] ^= 1
    open(first.path, "wb").write(data)
    with pytest.raises(Exception):
        read_warc(manifest).collect()


def test_no_pages(pages, tmp_path):
    assert read_warc(written(pages[1].limit(0), str(tmp_path / "d"))).collect() == []


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert digest_rows(op4_warc_roundtrip(spark, sf_dir)) == expected(rows)
