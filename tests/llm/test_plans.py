"""Plans of the operators: what is shuffled, and where Python runs."""

import pytest

from obsframe.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op1_byte_bpe", "op13_periodic_runs"])
def test_texts_are_not_shuffled(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert text.count("MapInArrow") == 1 and "Exchange" not in text and "lang" not in text and "n_chars" not in text


def test_sharding_runs_no_python(spark):
    text = plan(QUERIES["op3_sharding"](spark, DATA))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_labels_meet_vectors_by_broadcast(spark):
    text = plan(QUERIES["op12_vector_codes"](spark, DATA))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_pages_are_read_for_what_is_needed(spark):
    text = plan(QUERIES["op11_html_text"](spark, DATA))
    assert "BroadcastHashJoin" in text and "Cartesian" not in text and "NestedLoop" not in text
