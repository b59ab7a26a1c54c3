"""Row-level reconciliation names exactly the planted differences."""

from pyspark.sql import functions as F

from orderlens.operators.reconcile_rows import differing_buckets, reconcile_rows
from orderlens.plans.landing import typed_orders
from tests.conftest import SF_SMALL


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_planted_differences_and_no_others(spark):
    left = typed_orders(spark, SF_SMALL)
    ids = [r[0] for r in left.select("order_id").orderBy("order_id").limit(40).collect()]
    right = left.where(~F.col("order_id").isin(ids[0], ids[1]))
    right = right.withColumn("total", F.when(F.col("order_id") == ids[2], F.col("total") + 1).otherwise(F.col("total")))
    right = right.withColumn("review", F.when(F.col("order_id") == ids[3], F.lit(None)).otherwise(F.coalesce("review", F.lit("r"))))
    left = left.withColumn("review", F.coalesce("review", F.lit("r")))
    right = right.withColumn("restaurant_id", F.when(F.col("order_id") == ids[4], F.lit("moved")).otherwise(F.col("restaurant_id")))
    right = right.unionByName(right.where(F.col("order_id") == ids[5])).unionByName(
        right.where(F.col("order_id") == ids[6]).withColumn("order_id", F.lit("new")))
    right = right.repartition(5)
    want = [(ids[0], "only_left", 1, 0, None), (ids[1], "only_left", 1, 0, None), (ids[2], "changed", 1, 1, "total"),
            (ids[3], "changed", 1, 1, "review"), (ids[4], "changed", 1, 1, "restaurant_id"), (ids[5], "copies", 1, 2, None),
            ("new", "only_right", 0, 1, None)]
    assert found(reconcile_rows(left, right)) == sorted(want, key=str)
    assert 5 <= differing_buckets(left, right).count() <= 9  # of hundreds
    assert found(reconcile_rows(left, left.repartition(3))) == []


def test_nulls_copies_and_empty_sides(spark):
    schema = "restaurant_id string, order_id string, total double, note string"
    left = spark.createDataFrame([(None, None, 1.0, None), (None, None, 1.0, None), ("a", "1", None, "x"), ("a", "2", 2.0, None)], schema)
    right = spark.createDataFrame([(None, None, 1.0, None), ("a", "1", None, "x"), ("a", "2", None, None)], schema)
    assert found(reconcile_rows(left, right)) == [("2", "changed", 1, 1, "total"), (None, "copies", 2, 1, None)]
    swapped = spark.createDataFrame([("a", "1", None, "x"), ("b", "9", 1.0, None)], schema)
    # a NULL that moves to the next column is a change
    shifted = spark.createDataFrame([("a", "1", None, "x"), ("b", "9", None, "1.0")], schema)
    assert found(reconcile_rows(swapped, shifted)) == [("9", "changed", 1, 1, "total|note")]
    assert [r[1] for r in found(reconcile_rows(left.limit(0), right))] == ["only_right"] * 3
    assert found(reconcile_rows(left.limit(0), right.limit(0))) == []


def test_a_hot_restaurant_is_split_by_order(spark):
    left = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS restaurant_id",
                                        "CAST(id AS STRING) AS order_id", "CAST(id AS DOUBLE) AS total")
    right = left.withColumn("total", F.when(F.col("order_id") == "3000", F.lit(-1.0)).otherwise(F.col("total")))
    assert found(reconcile_rows(left, right)) == [("3000", "changed", 1, 1, "total")]
    assert differing_buckets(left, right).count() == 1
