"""What the plans must and must not hold."""

import re

import pytest

import __spark_entry__ as entry_point
from jobsignals.plans.catalog import QUERIES
from jobsignals.session import get_spark, shared_folder

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [q for q in QUERIES if not q.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join(spark, name):
    text = plan(entry_point.queries()[name](spark, SF_DIR))
    for bad in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize("name", ["knowledge_counts", "extract_postings", "knowledge_matches", "crawl_to_extract"])
def test_text_is_scanned_once_per_vocabulary(spark, name):
    """The search for terms is not repeated in filters or projections."""
    text = plan(entry_point.queries()[name](spark, SF_DIR))
    assert len(re.findall(r"regexp_extract_all\([^(]*, \(\?=\(", text)) == 1


@pytest.mark.parametrize("name", ["extract_postings", "knowledge_matches", "salary_bins", "page_fields", "crawl_to_extract"])
def test_maps_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(entry_point.queries()[name](spark, SF_DIR))


def test_messages_are_parsed_once(spark):
    from jobsignals.operators import postings as po
    from jobsignals.plans.inputs import postings

    parsed = po.drop_incomplete(po.parse_postings(po.to_messages(postings(spark, SF_DIR))))
    assert plan(parsed).count("from_json(") == 1


def test_category_report(spark):
    text = plan(entry_point.queries()["knowledge_by_category"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "Inner" in text and "LocalTableScan" in text
    assert text.count("Exchange hashpartitioning(Knowledge") == 1
    assert "rangepartitioning" not in text  # the order of the counts is not needed


def test_latest_per_key_limits_before_the_shuffle(spark):
    text = plan(entry_point.queries()["upsert_latest"](spark, SF_DIR))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


@pytest.mark.parametrize("name, columns", [
    ("page_urls", "page_id"), ("page_links", "url"), ("knowledge_counts", "text"), ("parse_props", "props")])
def test_only_needed_columns_are_read(spark, name, columns):
    text = plan(entry_point.queries()[name](spark, SF_DIR))
    schema = re.findall(r"ReadSchema: struct<(.*?)>", text)[0]
    assert columns in schema
    assert not {"n_chars", "event_type", "user_id"} & set(re.findall(r"\w+", schema))


def test_shared_folder_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b and a.startswith(root)


def test_running_session_is_used(spark):
    assert get_spark("other").sparkContext is spark.sparkContext
