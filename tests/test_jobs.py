"""The jobs from pages to reports, files standing in for topics and indexes."""

import pytest
from pyspark.testing import assertDataFrameEqual

import __spark_entry__ as entry_point
from jobsignals import schemas
from jobsignals.__main__ import main
from jobsignals.plans.inputs import job_pages
from jobsignals.sources import tables
from jobsignals.streaming.store import read_store

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("jobs"))
    job_pages(spark, SF_DIR).write.parquet(f"{path}/pages")
    main(["publish", "--input", f"{path}/pages", "--topic", f"{path}/topic"])
    return path


def test_land_then_clean_and_index_and_report(spark, folder, capsys):
    main(["land", "--topic", f"{folder}/topic", "--output", f"{folder}/raw", "--checkpoint", f"{folder}/cp1", "--once"])
    landed = tables.read_postings(spark, f"{folder}/raw/*.json")
    assertDataFrameEqual(landed, entry_point.queries()["page_postings"](spark, SF_DIR))

    capsys.readouterr()
    main(["clean", "--input", f"{folder}/raw/*.json", "--output", f"{folder}/clean", "--files", "1"])
    assert int(capsys.readouterr().out) == landed.count() == tables.read_postings(spark, f"{folder}/clean").count()

    main(["extract", "--input", f"{folder}/raw/*.json", "--format", "parquet", "--output", f"{folder}/index"])
    index = spark.read.parquet(f"{folder}/index")
    assert set(index.columns) == set(schemas.INDEX_NAMES.values()) and index.count() == landed.count()

    main(["report", "--input", f"{folder}/index", "--format", "parquet", "--output", f"{folder}/report"])
    top = spark.read.json(f"{folder}/report/knowledge").orderBy("count", ascending=False).first()
    assert top["count"] > 0
    assert spark.read.json(f"{folder}/report/category").columns == ["Category", "count"]


def test_links_job(spark, folder):
    main(["links", "--pages", "3-5", "--output", f"{folder}/listing"])
    assert [r.page for r in spark.read.json(f"{folder}/listing").orderBy("page").collect()] == [3, 4, 5]
    main(["links", "--input", f"{folder}/pages", "--output", f"{folder}/links"])
    found = spark.read.json(f"{folder}/links")
    assert found.count() == spark.read.parquet(f"{folder}/pages").count() and found.columns == ["link", "url"]


def test_store_job(spark, folder):
    for _ in range(2):
        main(["store", "--topic", f"{folder}/topic", "--output", f"{folder}/store", "--checkpoint", f"{folder}/cp2", "--once",
              "--source-option", "maxFilesPerTrigger=1"])
    stored = read_store(spark, f"{folder}/store", schemas.EXTRACTED)
    want = entry_point.queries()["crawl_to_extract"](spark, SF_DIR)
    assert stored.count() == want.count() > 0
    main(["store", "--topic", f"{folder}/topic", "--output", f"{folder}/plain", "--checkpoint", f"{folder}/cp3", "--once",
          "--format", "json", "--option", "compression=gzip"])
    assertDataFrameEqual(spark.read.schema(schemas.EXTRACTED).json(f"{folder}/plain"), stored)
    main(["compact", "--output", f"{folder}/store"])
    assert read_store(spark, f"{folder}/store", schemas.EXTRACTED).count() == want.count()
