import json

import pytest
from pyspark.sql import functions as F

from jobsignals import schemas
from jobsignals.functions import matching as m
from jobsignals.operators import postings as po
from jobsignals.operators import terms as tm
from jobsignals.sources import tables, topics


def test_parse_golden(spark):
    values = ['{"id": 1734858000.123456, "name": "a"}', '{"name":"b"}', "{bad", '{"id":"x","name":{"k":1}}',
              None, "[]"]
    df = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
    got = [(r.id, r.name) for r in po.parse_postings(df).collect()]
    assert got == [("1734858000.123456", "a"), (None, "b"), (None, None), ("x", '{"k":1}'), (None, None), (None, None)]


@pytest.mark.parametrize("raw, text", [
    ("1734858000.123456", "1734858000.123456"), ("1734858000.5", "1734858000.5"), ("1734858000.0", "1734858000.0"),
    ("1734858000", "1734858000"), ('"007"', "007"), ('"1e5"', "1e5"), ("12.5", "12.5")])
def test_ids_agree_with_the_file_reader(spark, tmp_path, raw, text):
    line = '{"id": %s}' % raw
    (tmp_path / "m.json").write_text(line)
    messages = spark.createDataFrame([(line.encode(),)], "value binary")
    assert po.parse_postings(messages).first().id == text
    assert tables.read_postings(spark, str(tmp_path / "*.json")).first().id == text


def test_nine_field_message_of_test_values(spark):
    record = {"id": 1.5, **{c: "test" for c in schemas.POSTING.fieldNames()[1:]}}
    df = spark.createDataFrame([(json.dumps(record),)], "value string")
    row = po.extract(po.drop_incomplete(po.parse_postings(df))).first()
    assert row.asDict() == {"id": "1.5", "company_name": "test", "framework_platforms": [], "languages": [],
                            "design_patterns": [], "knowledges": [], "salaries": []}


def test_json_sent_with_escapes_parses_alike(spark):
    record = {"id": "1", "name": "Lập trình"}
    lines = [json.dumps(record), json.dumps(record, ensure_ascii=False)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert len(set(po.parse_postings(df).collect())) == 1


def test_extract_schema_and_null_texts(spark):
    columns = schemas.POSTING_STREAM.fieldNames()
    rows = [["1", "x", "y", "Java, Git", "C", "10-15 triệu đồng", "z"], ["2", "x", "y", None, "C", None, "z"]]
    out = po.extract(spark.createDataFrame(rows, schemas.POSTING_STREAM))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.EXTRACTED]
    first, second = out.orderBy("id").collect()
    assert first.languages == ["Java"] and first.knowledges == ["Git"] and first.salaries == [10, 15]
    assert second.languages == second.knowledges == second.salaries == []
    assert po.index_documents(out).columns == [
        "CompanyName", "FrameworkPlattforms", "Languages", "DesignPatterns", "Knowledges", "Salaries"]
    assert columns[0] == "id"


def test_own_vocabularies(spark):
    own = [m.Vocabulary("tools", ("hammer", "saw")), m.Vocabulary("woods", ("oak",))]
    rows = [["1", "x", "y", "Oak, chainsaw", "hammer", "", "z"]]
    row = po.extract(spark.createDataFrame(rows, schemas.POSTING_STREAM), own).first()
    assert row.tools == ["hammer", "saw"] and row.woods == ["oak"]


def test_second_site_rows(spark):
    a = spark.createDataFrame([("1", "x")], "id string, chuyen_mon string")
    b = spark.createDataFrame([("2",)], "id string")
    both = po.union_sites(a, b)
    assert both.count() == 2 and po.drop_incomplete(both).count() == 1
    assert po.drop_incomplete(both, ["id"]).count() == 2
    assert po.fill_missing(both).filter("chuyen_mon = 'N/A'").count() == 1


def test_counts_golden(spark):
    rows = [(["Word", "Git"],), (["Word"],), ([],), (None,), ([" AI "],)]
    counts = tm.count_terms(spark.createDataFrame(rows, "Knowledges array<string>"))
    assert [tuple(r) for r in counts.collect()] == [("Word", 2), (" AI ", 1), ("Git", 1)]
    assert sorted(map(tuple, tm.count_categories(counts).collect())) == [("office", 2), ("version_control", 1)]


def test_category_null_text_and_own_labels(spark):
    counts = spark.createDataFrame([("a", 2), ("b", 3), ("c", 5)], "Knowledge string, count long")
    labels = spark.createDataFrame([("a", "null"), ("b", "k")], "Knowledge string, Category string")
    assert [tuple(r) for r in tm.count_categories(counts, labels).collect()] == [("k", 3)]


def test_one_term_in_most_rows(spark):
    """A hot key is combined before the shuffle: at most one row per task and term."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.array(F.lit("Git"), F.lit("Word"))).otherwise(F.array(F.lit("Git"))).alias("knowledges"))
    counts = tm.count_terms(rows)
    assert [tuple(r) for r in counts.collect()] == [("Git", 40_000), ("Word", 13_334)]
    assert "partial_count" in counts._jdf.queryExecution().executedPlan().toString()


def test_json_files_and_index(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("id"))
    tables.write_json(df, str(tmp_path / "one"), files=1)
    tables.write_json(df, str(tmp_path / "one"), files=1)  # replaces
    assert len(list((tmp_path / "one").glob("*.json"))) == 1
    assert tables.read_postings(spark, str(tmp_path / "one" / "*.json")).count() == 10
    tables.write_index(df, "parquet", {}, str(tmp_path / "index"))
    assert spark.read.parquet(str(tmp_path / "index")).count() == 10


def test_publish_and_replay(spark, tmp_path):
    df = spark.createDataFrame([("1", "Lắp đặt\nmáy", None)], "id string, name string, quyen_loi string")
    for _ in range(2):
        topics.publish(po.to_messages(df), {}, "text", str(tmp_path / "t"))
    back = po.parse_postings(topics.replay(spark, {}, "text", str(tmp_path / "t")))
    assert back.count() == 2
    assert back.select(*df.columns).distinct().collect() == df.collect()


def test_kafka_options():
    assert "startingOffsets" not in topics.kafka_options("broker:29092")
    assert topics.kafka_options("b:1", starting="earliest") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "recruitment_information", "startingOffsets": "earliest"}
    assert topics.kafka_sink_options("b:1")["topic"] == "recruitment_information"


def test_ensure_table_twice(spark, tmp_path):
    for _ in range(2):
        tables.ensure_table(spark, "extracted_twice", location=str(tmp_path / "t"))
    assert [f.dataType for f in spark.table("extracted_twice").schema] == [f.dataType for f in schemas.EXTRACTED]
