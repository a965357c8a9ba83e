"""The physical plans of the operators that matter at scale."""

import pytest
from pyspark.sql import functions as F

from checks.spark_queries import QUERIES
from checks.standins import given
from obsframe.operators.envelope import current_rows, parse_messages, valid_messages
from obsframe.operators.versions import latest

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_is_cut_before_the_shuffle(spark):
    text = plan(latest(given(spark, DATA, "events").select("event_id", "user_id", "ts"), ["user_id"], [F.desc("ts")]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1


def test_scans_read_only_what_is_needed(spark):
    text = plan(QUERIES["q_location_join"](spark, DATA))
    assert "props" not in text and "event_type" not in text and "c_mktsegment" not in text
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_means_are_combined_before_the_shuffle(spark):
    text = plan(QUERIES["q_cluster_summary_current"](spark, DATA))
    assert "partial_avg" in text and text.count("Exchange") == 1


def test_a_message_is_parsed_once(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    text = plan(current_rows(valid_messages(parse_messages(messages))))
    assert text.count("from_json") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_functions_in_python(spark, name):
    if name in ("q_run_once", "q_kmeans_daily", "q_kmeans_current", "q_stream_ingest", "q_stream_forecasts", "q_stream_dedup"):
        pytest.skip("runs jobs, and returns a read of their result")
    text = plan(QUERIES[name](spark, DATA))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
