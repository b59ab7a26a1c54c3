"""All twelve results from one scan of the fact table."""

import pytest

from orderlens.operators import queries as q
from orderlens.operators import results as res
from orderlens.plans.landing import typed_orders
from tests.conftest import SF_SMALL
from tests.test_plans import plan

QUERIES = {
    "q01": q.total_orders, "q02": q.orders_by_restaurant, "q03": q.orders_by_status,
    "q04": q.revenue_by_restaurant, "q05": q.avg_order_value_by_restaurant, "q06": q.top_orders,
    "q07": q.kpt_by_restaurant, "q08": q.rider_wait_by_restaurant, "q09": q.distance_behaviour,
    "q10": q.rating_by_restaurant, "q11": q.complaint_types, "q12": q.high_performing_restaurants,
}


def rounded(rows):
    return [tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r) for r in rows]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(f"o{k}", [None, "A", " A", "", "B"][k % 5], ["Delivered", "Rejected", None][k % 3], ["1km", None][k % 2],
             ["", None, "late", "cold"][k % 4], [None, 10.5, -3.0, float(k)][k % 4 if k % 7 else 0],
             [None, 4.0, 5.0][k % 3], [None, 12.5][k % 2], [3.5, None][k % 2]) for k in range(400)]
    return spark.createDataFrame(rows, "order_id string, restaurant_name string, order_status string, distance string, "
                                       "customer_complaint_tag string, total double, rating double, "
                                       "kpt_duration_minutes double, rider_wait_time_minutes double")


@pytest.mark.parametrize("source", ["table", "awkward", "empty"])
def test_each_result_equals_its_query(spark, awkward, source):
    orders = typed_orders(spark, SF_SMALL) if source == "table" else awkward if source == "awkward" else awkward.limit(0)
    everything = res.all_results(orders, min_orders=3, min_rating=3.0).cache()
    for name, fn in QUERIES.items():
        want = fn(orders, min_orders=3, min_rating=3.0) if name == "q12" else fn(orders)
        got = res.result_of(everything, name)
        assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
        assert rounded(got.collect()) == rounded(want.collect()), name
    titles = {r["query"]: r["query_title"] for r in everything.select("query", "query_title").distinct().collect()}
    assert titles == {k: v for k, v in q.TITLES.items() if k in titles} and (source != "table" or len(titles) == 12)
    everything.unpersist()


def test_grouped_part_scans_the_fact_table_once(spark):
    orders = typed_orders(spark, SF_SMALL)
    p = plan(res.grouped_results(orders), "simple")
    assert p.count("FileScan") == 1 and "Expand" in p and p.count("Exchange hashpartitioning") == 1
    assert "partial_count" in p and "order_placed_at" not in p
