"""Global positions and pages, with heavily repeated sort values."""

import pytest
from pyspark.sql import functions as F

from vistaflow.operators.position import page_plan, page_size, with_pages, with_position


def test_positions_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("v"))
    for unique in (True, False):
        rows = with_position(df, ["k"], unique=unique).collect()
        assert all(r["k"] == r["position"] for r in rows) and len(rows) == 1000


def test_one_value_holds_most_rows(spark):
    df = spark.range(9000).select(F.greatest(F.col("id") - 6000, F.lit(0)).alias("k"))
    rows = sorted(with_position(df, ["k"]).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(9000))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_identical_rows_are_spread_and_numbered(spark):
    df = spark.range(8000).select(F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = with_position(df, ["k"]).withColumn("file", F.input_file_name())
        rows = placed.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["position"] for r in rows) == list(range(8000))
    assert len({r["file"] for r in rows}) > 1


def test_empty(spark):
    assert with_position(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("n, size", [(1, 500), (500, 500), (501, 500), (1234, 100)])
def test_pages_partition_the_rows(spark, n, size):
    paged = with_pages(spark.range(n), "id", size)
    plan = sorted(page_plan(paged).collect(), key=lambda r: r["page"])
    assert sum(r["rows"] for r in plan) == n
    assert all(r["rows"] == size for r in plan[:-1]) and plan[-1]["rows"] <= size
    assert [r["is_first"] for r in plan] == [True] + [False] * (len(plan) - 1)
    assert [r["is_last"] for r in plan] == [False] * (len(plan) - 1) + [True]
    assert [r["restart"] for r in plan] == [r["is_first"] for r in plan]
    assert not any(r["restart"] for r in page_plan(paged, restart_first=False).collect())


def test_page_sizes():
    assert page_size(0, upsert=True) == 1
    assert page_size(1000, upsert=True) == 500
    assert page_size(1000, upsert=False) == 1000
