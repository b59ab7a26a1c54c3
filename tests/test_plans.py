"""Plan-shape checks: the properties that matter at scale, asserted on
``explain`` output rather than on timings."""

import contextlib
import io

import pytest

from orderlens.operators import clean as cl
from orderlens.operators import performance as perf
from orderlens.operators import profile as pr
from orderlens.operators import queries as q
from orderlens.operators import scorecard as sc
from orderlens.plans.landing import raw_staging, typed_orders
from orderlens.sources.fixtures import food_orders
from tests.conftest import SF_SMALL


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def orders(spark):
    return typed_orders(spark, SF_SMALL)


def test_filter_and_columns_reach_the_scan(orders):
    p = plan(q.revenue_by_restaurant(orders))
    assert "EqualTo(order_status,Delivered)" in p
    assert "ReadSchema: struct<restaurant_name:string,order_status:string,total:double>" in p


def test_group_by_is_partially_aggregated(orders):
    p = plan(perf.restaurant_performance(orders, "restaurant_id"), "simple")
    assert "partial_count" in p and "partial_sum" in p
    # the per-row part reads only the columns the roll-up needs
    assert "order_status" not in p


def test_top_k_is_take_ordered(orders):
    assert "TakeOrderedAndProject" in plan(q.top_orders(orders), "simple")


def test_cleaning_is_map_only(spark):
    p = plan(cl.clean_orders(raw_staging(spark, SF_SMALL)), "simple")
    assert "Exchange" not in p


def test_per_column_top_k_limits_before_the_shuffle(spark):
    p = plan(pr.categorical_top(raw_staging(spark, SF_SMALL)), "simple")
    partial = p.index("WindowGroupLimit")  # Final appears above the exchange ...
    assert "Partial" in p[partial:] and p.count("WindowGroupLimit") == 2


def test_scorecard_reads_the_fact_table_once(orders):
    card = sc.scorecard(perf.restaurant_metrics(orders, "restaurant_id"))
    p = plan(card, "simple")
    assert "orders_typed" not in p and "restaurant_metrics" in p  # branches read the written copy
    assert card.count() == 25


def test_only_one_row_aggregates_are_hinted(orders):
    """Every BroadcastNestedLoopJoin in the scorecard joins a global aggregate."""
    p = plan(sc.scorecard(perf.restaurant_metrics(orders, "restaurant_name")), "simple")
    assert p.count("BroadcastNestedLoopJoin") >= 1
    assert "SortMergeJoin" not in p
