"""Plans: what the scans read, and joins that must not be there."""

import pytest

from folioforge.operators import pages as P
from folioforge.plans import catalogue

SF = "/root/testdata/sf0.001"
#: These act while they are built.
EAGER = {"q33_cmd_stream"}


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - EAGER))
def test_no_nested_loops(spark, name):
    text = plan(catalogue.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_read_what_is_used(spark):
    text = plan(catalogue.QUERIES["q05_resume_pending"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in text and "LeftAnti" in text
    text = plan(catalogue.QUERIES["q26_backoff"](spark, SF))
    assert "EqualTo(event_type,error)" in text and "ReadSchema: struct<event_id:bigint,event_type:string>" in text
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text


@pytest.mark.parametrize("name", ["q01_truncate", "q08_rollup", "q10_titles_explode", "q11_format_output", "q25_breaker", "q27_throttle"])
def test_no_python_on_the_main_path(spark, name):
    assert "Python" not in plan(catalogue.QUERIES[name](spark, SF))


def test_counts_take_one_shuffle(spark):
    assert plan(catalogue.QUERIES["q37_run_summary"](spark, SF)).count("Exchange (") <= 3


def test_range_join_is_an_equi_join(spark):
    pages = spark.createDataFrame([("p", 1, "t")], "pdf_id string, page_no int, text string")
    entries = spark.createDataFrame([("p", "k", 1, 3)], "pdf_id string, k string, start_page int, end_page int")
    text = plan(P.range_text(entries, pages, ["k"]))
    assert "NestedLoop" not in text and "page_no" in text
