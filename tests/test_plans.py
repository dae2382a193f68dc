"""What the physical plans must and must not hold."""

import re

import pytest

import __spark_entry__ as entry

from conftest import SMALL

QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small enough to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Queries whose result comes from an index or a report written by the call itself.
RUNS = {
    "index_replace", "incremental_run", "incremental_rerun_idempotent", "incremental_late_rows",
    "run_report", "stream_upsert", "sync_state_table", "view_health", "view_row_counts",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUNS))
def test_no_pairs_no_python_no_single_task_window(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|BatchEvalPython|ArrowEvalPython", text)
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"[-:] Window \[", line):
            assert "Exchange SinglePartition" not in "".join(lines[i : i + 4])


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_eq", "EqualTo(o_orderstatus,F)"),
        ("filter_gt", "GreaterThan(o_totalprice,250000.0)"),
        ("filter_between", "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)"),
        ("filter_contains", "StringContains(text,tion)"),
        ("filter_startswith", "StringStartsWith(text,The )"),
        ("filter_endswith", "StringEndsWith(text,ing.)"),
        ("filter_date_text", "GreaterThanOrEqual(ts,2024-01-15T12:00)"),
        ("scan_incremental", "GreaterThan(o_orderdate,2000-12-01T00:00)"),
        ("query_topk", "EqualTo(event_type,purchase)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    df = QUERIES[name](spark, SMALL)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert pushed in df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize(
    "name, read",
    [
        ("dup_report", "struct<l_orderkey:bigint,l_linenumber:int>"),
        ("query_distinct", "struct<c_custkey:bigint,c_name:string>"),
        ("agg_grouped_count", "struct<doc_id:bigint,quality:int>"),
        ("doc_url", "struct<doc_id:bigint>"),
    ],
)
def test_only_needed_columns_are_read(spark, name, read):
    assert read in plan(QUERIES[name](spark, SMALL))


def test_last_wins_reduces_before_the_shuffle(spark):
    text = plan(QUERIES["dedupe_last_wins"](spark, SMALL))
    final, exchange, partial = (text.index(s) for s in ("Final", "Exchange hash", "Partial"))
    assert final < exchange < partial


def test_top_k_and_partial_aggregates(spark):
    assert "TakeOrderedAndProject(limit=100" in plan(QUERIES["query_topk"](spark, SMALL))
    assert "partial_sum" in plan(QUERIES["agg_grouped_sum"](spark, SMALL))
    assert "partial_count" in plan(QUERIES["dup_report"](spark, SMALL))
