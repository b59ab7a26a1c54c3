"""Bucketed, day-partitioned and replaced tables."""

import datetime as dt
import threading

import pytest

from orderlens.operators import performance as perf
from orderlens.operators import reconcile as rec
from orderlens.plans.landing import typed_orders
from orderlens.sources import store, tables
from tests.conftest import SF_SMALL
from tests.test_plans import plan


def same(a, b):
    tidy = lambda df: sorted((tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)
    return tidy(a) == tidy(b)


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    orders = typed_orders(spark, SF_SMALL)
    store.save_bucketed(orders, "bucketed_orders_t", path=str(tmp_path_factory.mktemp("b")), buckets=8, salts=4)
    yield spark.table("bucketed_orders_t")
    tables.drop_table(spark, "bucketed_orders_t")


def fact_side(p):
    """The lines of a plan from the scan up to the first exchange, per scan."""
    parts, lines = [], p.splitlines()
    for i, line in enumerate(lines):
        if "FileScan" in line:
            above = []
            for upper in reversed(lines[:i]):
                if "Exchange" in upper:
                    break
                above.append(upper)
            parts.append("\n".join(above))
    return parts


def test_roll_up_and_reconciliation_without_an_exchange_on_the_fact_side(spark, bucketed):
    orders = typed_orders(spark, SF_SMALL)
    within = (store.SALT,)
    actual = perf.restaurant_performance(bucketed, "restaurant_id", within=within)
    assert same(actual, perf.restaurant_performance(orders, "restaurant_id"))
    expected = rec.expected_metrics(bucketed, "restaurant_id", within=within)
    both = rec.reconcile(actual, expected, "restaurant_id", tolerance=0.01)
    assert same(both, rec.reconcile(perf.restaurant_performance(orders, "restaurant_id"),
                                    rec.expected_metrics(orders, "restaurant_id"), "restaurant_id", tolerance=0.01))
    for df in (actual, both):
        scans = fact_side(plan(df, "simple"))
        assert scans
        for above in scans:  # the first level is complete, partial and final, before anything is exchanged
            assert above.count("partial_count(1)") >= 1 and ", ".join(["functions=[count(1)"]) in above
    # without the bucket columns the first level has to exchange orders' partial rows
    assert "functions=[count(1)" not in fact_side(plan(perf.restaurant_performance(orders, "restaurant_id"), "simple"))[0]


def test_a_hot_restaurant_is_spread_over_buckets(spark, tmp_dir):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS restaurant_id",
                                        "CAST(NULL AS STRING) AS order_id").repartition(4)
    store.save_bucketed(rows, "hot_orders_t", path=f"{tmp_dir}/hot", buckets=8, salts=8)
    hot = spark.table("hot_orders_t").where("restaurant_id = 'hot'")
    per_bucket = hot.groupBy("_metadata.file_name").count().collect()
    buckets = {}
    for r in per_bucket:
        number = r["file_name"].split("_")[1].split(".")[0]
        buckets[number] = buckets.get(number, 0) + r["count"]
    assert sum(buckets.values()) == 1000 and len(buckets) >= 4 and max(buckets.values()) <= 500
    assert spark.table("hot_orders_t").count() == 3000
    tables.drop_table(spark, "hot_orders_t")


@pytest.fixture
def days(spark):
    rows = [(f"o{k}", dt.datetime(2024, 9, 1 + k % 5, k % 24) if k % 7 else None, float(k)) for k in range(200)]
    return spark.createDataFrame(rows, "order_id string, order_placed_at timestamp_ntz, total double")


def test_ingesting_a_day_again_leaves_equal_rows(spark, days, tmp_dir):
    path = f"{tmp_dir}/days"
    store.ingest_days(days, path)
    first = sorted(map(repr, store.read_days(spark, path).collect()))
    one = days.where("date(order_placed_at) = DATE '2024-09-03'")
    for _ in range(2):
        store.ingest_days(one, path)
        assert sorted(map(repr, store.read_days(spark, path).collect())) == first
    store.ingest_days(one.withColumn("total", one.total + 1), path)
    changed = store.read_days(spark, path)
    assert changed.count() == 200 and changed.where("order_day = '2024-09-03'").exceptAll(store.with_day(one)).count() == one.count()
    store.ingest_days(days.where("order_placed_at IS NULL").limit(3), path)  # orders without a day are a partition too
    assert store.read_days(spark, path).where("order_day IS NULL").count() == 3


def test_days_are_pruned(spark, days, tmp_dir):
    path = f"{tmp_dir}/days"
    store.ingest_days(days, path)
    some = store.read_days(spark, path, "2024-09-02", dt.date(2024, 9, 3))
    p = plan(some, "formatted")
    assert "PartitionFilters: [isnotnull(order_day" in p and "order_day#" in p
    assert some.count() == days.where("date(order_placed_at) BETWEEN '2024-09-02' AND '2024-09-03'").count()
    assert some.select("order_day").distinct().count() == 2


def test_replacing_a_table_leaves_no_gap(spark, tmp_dir):
    table = "replaced_orders_t"
    make = lambda n: spark.range(n).selectExpr("id AS order_id", f"{n} AS version")
    assert store.replace_table(make(100), table, tmp_dir) is None
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(tuple(r["version"] for r in spark.table(table).select("version").collect()))

    reader = threading.Thread(target=read)
    reader.start()
    held = spark.table(table)  # planned on the first version
    old = [store.replace_table(make(n), table, tmp_dir) for n in (200, 300, 400)]
    stop.set()
    reader.join()
    assert seen and all(len(s) == s[0] and set(s) == {len(s)} for s in seen)
    assert spark.table(table).count() == 400 and held.count() in (100, 400)
    assert store.replace_table(spark.table(table).where("order_id < 50"), table, tmp_dir) is not None  # reads itself
    assert spark.table(table).count() == 50
    for path in old:
        store.drop_version(spark, path)
    assert spark.table(table).count() == 50
    with pytest.raises(ValueError):
        store.replace_table(spark.range(3), table, tmp_dir)
    tables.drop_table(spark, table)
