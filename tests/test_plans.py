"""Plans: what reaches the scan, and what must not be there."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tidemark.operators import windows

PACKAGE = Path(__file__).resolve().parent.parent / "tidemark"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["src_7_pruned_scan"](spark, SMALL))
    assert "GreaterThanOrEqual(l_shipdate" in text
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_shipdate", text)


def test_flagship_reads_four_columns(spark):
    text = plan(entry.queries()["mart_1_daily_revenue"](spark, SMALL))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"l_quantity", "l_extendedprice", "l_discount", "l_shipdate"}


LAZY = [n for n in entry.queries() if n.split("_")[0] in ("prj", "flt", "join", "agg", "win", "set", "fn", "mart") and n not in ("mart_7_nation_dimension", "mart_8_user_days", "mart_9_zscores")]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_of_all_rows_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text, text


def test_no_task_of_the_order_free_sums_grows_with_the_table(spark, tmp_path):
    rows = "id as l_orderkey, cast(id % 7 as int) as l_linenumber, id * 0.5d as l_quantity, 1d as l_extendedprice, 0.1d as l_discount, 0.2d as l_tax, 'A' as l_returnflag"
    spark.range(800).repartition(8).selectExpr(*rows.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    old = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "100k")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        found = entry.queries()["agg_11_order_free_sums"](spark, str(tmp_path))
        text = plan(found)
        assert found.first()["same_when_shuffled"]
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old[0])
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[1])
    # Two of eight splits at a time; as many partitions as the session has, not a fixed number.
    assert re.findall(r"Coalesce (\d+)", text) == ["4"]
    assert "REPARTITION_BY_NUM" not in text and "REPARTITION_BY_COL" in text


@pytest.mark.parametrize("name", ["win_7_ignore_nulls", "win_9_row_number", "win_4_top_per_group", "agg_9_percentiles"])
def test_windows_over_detail_rows_are_partitioned(spark, name):
    assert "Exchange SinglePartition" not in plan(entry.queries()[name](spark, SMALL))


def test_detail_rows_move_once_for_a_hot_key(spark, inputs):
    events = inputs("events").select("event_id", "user_id", "ts")
    bucket = windows.time_bucket(events, ["user_id"], "ts", max_rows=2)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(windows.numbered(events, ["user_id"], ["ts", "event_id"], bucket, "n"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # One exchange carries the rows; the other two on the group carry counts.
    assert text.count("Exchange hashpartitioning(__group") == 3


def test_no_forbidden_shortcuts_in_the_library():
    # The optional text operators have a rule of their own beside their tests.
    for path in (p for p in PACKAGE.rglob("*.py") if p.parent != PACKAGE / "llm"):
        code = path.read_text()
        for bad in ("broadcast(", "localCheckpoint", "toPandas", "crossJoin", ".rdd", "toLocalIterator"):
            assert bad not in code, (path, bad)
