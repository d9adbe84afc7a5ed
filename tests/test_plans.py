"""What the physical plans must and must not contain."""

import pytest

from carelake import catalog
from tests.plans import plan_of

SF = "/root/testdata/sf0.001"
WRITES = ("csv_", "normalize_columns_b", "normalize_columns_a", "stream_", "layered_")
LAZY = [name for name in catalog.QUERIES if not name.startswith(WRITES)]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_unkeyed_join(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInArrow"):
        assert operator not in plan


def test_top_hospitals_need_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(catalog.QUERIES["i04_busiest_hospitals"](spark, SF))


def test_plan_changes_need_no_join(spark):
    assert "Join" not in plan_of(catalog.QUERIES["q6_plan_change"](spark, SF))


@pytest.mark.parametrize("name", ["clean_dates", "feature_admission_flags"])
def test_row_wise_work_on_orders_shuffles_only_the_lines(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    assert plan.count("Exchange hashpartitioning(o_orderkey") <= 1
    if name == "clean_dates":
        assert "Exchange" not in plan


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(catalog.QUERIES["i06_premium_per_plan"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan
    days = plan_of(catalog.QUERIES["i15_emergencies_per_day"](spark, SF))
    assert "lineitem" not in days and "l_orderkey" not in days


def test_premium_average_is_a_subquery(spark):
    assert "Subquery" in plan_of(catalog.QUERIES["q1_above_avg_premium"](spark, SF))
