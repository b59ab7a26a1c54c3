"""Row-level traps: NULL / NaN / infinity / whitespace / rounding / ties."""

import math

import pytest
from pyspark.sql import functions as F

from orderlens.functions.expr import any_negative, fmt2, safe_ratio, strip_ws, to_double, to_ts, valid_minutes
from orderlens.operators import performance as perf
from orderlens.operators import queries as q
from orderlens.operators import reconcile as rec


def _one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first().r


def test_t1_blank_numeric_is_null(spark):
    for v in ["", "abc", "NaN", "Infinity", "-Infinity", None]:
        assert _one(spark, to_double("v"), v) is None
    assert _one(spark, to_double("v"), " 12.50 ") == 12.5


def test_t2_nan_does_not_poison_aggregates(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (float("inf"),)], "v double")
    r = df.agg(F.sum(to_double("v")).alias("s"), F.avg(to_double("v")).alias("a")).first()
    assert r.s == 4.0 and r.a == 2.0


def test_t3_negative_flag_never_null(spark):
    df = spark.createDataFrame([(None, None), (1.0, None), (None, -2.0), (float("nan"), 1.0)], "a double, b double")
    got = [r.f for r in df.select(any_negative(["a", "b"]).alias("f")).collect()]
    assert got == [False, False, True, False]


def test_t4_strip_unicode_whitespace(spark):
    assert _one(spark, strip_ws("v"), " \t x y 　\n") == "x y"
    assert _one(spark, strip_ws("v"), None) is None


def test_t8_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r.r for r in df.select(safe_ratio("a", "b").alias("r")).collect()] == [None, None]


def _orders(spark, rows):
    ddl = ("restaurant_id string, restaurant_name string, order_id string, order_status string, "
           "total double, kpt_duration_minutes double, rider_wait_time_minutes double, rating double, "
           "distance string, customer_complaint_tag string")
    return spark.createDataFrame(rows, ddl)


TRAP_ROWS = [
    ("1", "A", "o1", "Delivered", 100.0, 10.0, 5.0, 4.0, "1km", "Late"),
    ("1", "A", "o2", "Cancelled", None, -3.0, float("nan"), None, "1km", ""),
    ("1", "A", "o3", "Delivered", 50.0, 20.0, None, 5.0, "2km", None),
    (" 2 ", "B\t", "o4", "Cancelled", None, None, None, None, "2km", "Late"),
    ("", "C", "o5", "Delivered", 70.0, 1.0, 1.0, 1.0, "3km", None),
]


def test_t9_t13_rollup_semantics(spark):
    o = _orders(spark, TRAP_ROWS)
    got = {r.restaurant_id: r for r in perf.restaurant_performance(o, "restaurant_id").collect()}
    assert set(got) == {"1", "2"}  # empty id rejected, " 2 " trimmed
    a = got["1"]
    assert a.order_count == 3 and a.total_revenue == 150.0 and a.avg_order_value == 50.0
    assert a.avg_kpt == 15.0  # negative minutes dropped
    assert a.avg_rider_wait == 5.0  # NaN dropped
    b = got["2"]
    assert b.restaurant_name == "B" and b.total_revenue == 0.0 and b.avg_kpt is None  # T9, T8
    # validator keeps negative KPT
    exp = {r.restaurant_name: r for r in rec.expected_metrics(o).collect()}
    assert exp["A"].avg_kpt == pytest.approx(9.0)
    # Q4 keeps SQL SUM semantics: all-NULL totals sum to NULL
    q4 = {r.restaurant_name: r.total_revenue for r in q.revenue_by_restaurant(o, status="Cancelled").collect()}
    assert q4["A"] is None


def test_q11_excludes_empty_tag(spark):
    got = {r.customer_complaint_tag: r.complaint_count for r in q.complaint_types(_orders(spark, TRAP_ROWS)).collect()}
    assert got == {"Late": 2}


def test_t19_top_k_tie_break(spark):
    rows = [(str(i), "R", f"o{i:02d}", "Delivered", 10.0, None, None, None, "x", None) for i in range(12)]
    got = [r.order_id for r in q.top_orders(_orders(spark, rows), k=10).collect()]
    assert got == [f"o{i:02d}" for i in range(10)]


def test_t10_even_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "v double")
    assert df.agg(F.median("v")).first()[0] == 3.0


def test_t11_round_half_up_and_format(spark):
    assert _one(spark, F.round(F.col("v"), 2), 0.125, "v double") == 0.13
    assert _one(spark, fmt2("v"), None, "v double") is None
    assert _one(spark, fmt2("v"), 2.5, "v double") == "2.50"


def test_valid_minutes(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (float("inf"),), (None,)], "v double")
    assert [r.m for r in df.select(valid_minutes("v").alias("m")).collect()] == [None, 0.0, None, None]


def test_t20_timestamp_formats(spark):
    got = _one(spark, to_ts("v"), "11:38 PM, September 10 2024")
    assert got is not None and got.hour == 23
    assert _one(spark, to_ts("v"), "not a date") is None


def test_t22_null_keys_do_not_match(spark):
    a = spark.createDataFrame([(None, 1, 1.0, 1.0, 1.0)], "restaurant_name string, order_count long, "
                              "total_revenue double, avg_kpt double, avg_rider_wait double")
    r = rec.reconcile(a, a, tolerance=0.0).collect()
    assert sorted(x.side for x in r) == ["only_actual", "only_expected"]


def test_q12_having_on_unrounded_mean(spark):
    rows = [(str(i), "A", f"o{i}", "Delivered", 1.0, 1.0, 1.0, 3.995 if i % 2 else 4.004, "x", None)
            for i in range(4)]
    got = q.high_performing_restaurants(_orders(spark, rows), min_orders=3, min_rating=4.0).collect()
    assert got == []  # mean 3.9995 < 4.0 although it rounds to 4.0
    assert not math.isnan(0.0)


def test_cluster_conf_scales_with_input():
    from orderlens.session import cluster_conf
    small = cluster_conf(1 << 30, executor_cores=8)
    big = cluster_conf(100 << 40, executor_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
