"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

import warehouse_queries as q


def plan(spark, sf, name):
    return q.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_no_single_task_and_no_cross_join(spark, sf, name):
    text = plan(spark, sf, name)
    for word in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text


@pytest.mark.parametrize(
    "name", ["dwd_unique_visitor", "dwd_order_detail_first_wins", "dwd_pay_detail_latest_wins", "dwd_order_pre_process_latest"]
)
def test_first_rows_are_cut_before_the_shuffle(spark, sf, name):
    text = plan(spark, sf, name)
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["dws_page_view_window", "dws_login_window", "dws_cart_add_window", "dws_register_window"])
def test_counts_are_combined_before_the_shuffle(spark, sf, name):
    assert "partial_" in plan(spark, sf, name)


def test_jumps_are_partitioned_by_slot(spark, sf):
    assert "hashpartitioning(_key" in plan(spark, sf, "dwd_user_jump") and "_slot" in plan(spark, sf, "dwd_user_jump")


def test_changes_of_one_table_read_one_file(spark, sf):
    text = plan(spark, sf, "dwd_coupon_pay")
    assert text.count("FileScan") == 1 and "o_orderstatus" in text and "PushedFilters: [IsNotNull(o_orderstatus)" in text


def test_columns_are_pruned_at_the_scan(spark, sf):
    scans = [line for line in plan(spark, sf, "dws_register_window").split("\n") if "FileScan" in line]
    assert len(scans) == 1 and "c_acctbal" not in scans[0] and "c_mktsegment" not in scans[0]


def test_time_bounded_joins_are_equi_joins_on_slots(spark, sf):
    assert "_r_slot" in plan(spark, sf, "stream_join_inner")
