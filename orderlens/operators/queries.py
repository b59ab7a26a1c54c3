"""The twelve order-analytics queries over the typed order table.

Each is ``f(orders, ...) -> DataFrame``: a filter pushed to the scan, one
partially aggregated ``groupBy`` (map-side combine, so a hot restaurant
costs one row per partition in the shuffle, not one row per order) and a
sort of the small grouped result.  Every ordering has a key tie-break so
results are reproducible; thresholds and the status value are parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.expr import r2

DELIVERED = "Delivered"


def total_orders(orders: DataFrame) -> DataFrame:
    """Q1: number of orders."""
    return orders.agg(F.count(F.lit(1)).alias("total_orders"))


def orders_by_restaurant(orders: DataFrame, by: str = "restaurant_name") -> DataFrame:
    """Q2: orders per restaurant, most first."""
    return (orders.groupBy(by).agg(F.count(F.lit(1)).alias("order_count"))
            .orderBy(F.desc("order_count"), F.asc_nulls_last(by)))


def orders_by_status(orders: DataFrame) -> DataFrame:
    """Q3: orders per status."""
    return (orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc_nulls_last("order_status")))


def revenue_by_restaurant(orders: DataFrame, by: str = "restaurant_name",
                          status: str = DELIVERED, digits: int | None = None) -> DataFrame:
    """Q4: SUM(total) of delivered orders per restaurant (unrounded unless ``digits``).

    A group whose totals are all NULL sums to NULL, as in SQL."""
    rev = F.sum("total")
    rev = r2(rev, digits) if digits is not None else rev
    return (orders.filter(F.col("order_status") == status)
            .groupBy(by).agg(rev.alias("total_revenue"))
            .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last(by)))


def avg_order_value_by_restaurant(orders: DataFrame, by: str = "restaurant_name",
                                  status: str = DELIVERED) -> DataFrame:
    """Q5: rounded AVG(total) of delivered orders per restaurant."""
    return (orders.filter(F.col("order_status") == status)
            .groupBy(by).agg(r2(F.avg("total")).alias("avg_order_value"))
            .orderBy(F.desc_nulls_last("avg_order_value"), F.asc_nulls_last(by)))


def top_orders(orders: DataFrame, k: int = 10, status: str = DELIVERED) -> DataFrame:
    """Q6: the k highest-value delivered orders (top-k is the feature here).

    ``orderBy + limit`` plans as TakeOrderedAndProject: each partition keeps
    its local top k, only k rows per partition reach the final merge."""
    return (orders.filter(F.col("order_status") == status)
            .select("order_id", "restaurant_name", "total")
            .orderBy(F.desc_nulls_last("total"), F.asc("order_id"))
            .limit(k))


def kpt_by_restaurant(orders: DataFrame, by: str = "restaurant_name") -> DataFrame:
    """Q7: kitchen preparation time per restaurant: rounded mean, max, min."""
    k = F.col("kpt_duration_minutes")
    return (orders.filter(k.isNotNull())
            .groupBy(by).agg(r2(F.avg(k)).alias("avg_kpt"), F.max(k).alias("max_kpt"),
                             F.min(k).alias("min_kpt"))
            .orderBy(F.desc("avg_kpt"), F.asc_nulls_last(by)))


def rider_wait_by_restaurant(orders: DataFrame, by: str = "restaurant_name") -> DataFrame:
    """Q8: rounded mean rider wait per restaurant."""
    w = F.col("rider_wait_time_minutes")
    return (orders.filter(w.isNotNull())
            .groupBy(by).agg(r2(F.avg(w)).alias("avg_rider_wait"))
            .orderBy(F.desc("avg_rider_wait"), F.asc_nulls_last(by)))


def distance_behaviour(orders: DataFrame) -> DataFrame:
    """Q9: orders and rounded mean total per distance bucket, every status."""
    return (orders.groupBy("distance")
            .agg(F.count(F.lit(1)).alias("order_count"), r2(F.avg("total")).alias("avg_order_value"))
            .orderBy(F.desc("order_count"), F.asc_nulls_last("distance")))


def rating_by_restaurant(orders: DataFrame, by: str = "restaurant_name") -> DataFrame:
    """Q10: rounded mean rating and number of ratings per restaurant."""
    r = F.col("rating")
    return (orders.filter(r.isNotNull())
            .groupBy(by).agg(r2(F.avg(r)).alias("avg_rating"), F.count(r).alias("num_ratings"))
            .orderBy(F.desc("avg_rating"), F.asc_nulls_last(by)))


def complaint_types(orders: DataFrame) -> DataFrame:
    """Q11: complaints per tag; NULL and '' are not complaints."""
    t = F.col("customer_complaint_tag")
    return (orders.filter(t.isNotNull() & (t != ""))
            .groupBy(t).agg(F.count(F.lit(1)).alias("complaint_count"))
            .orderBy(F.desc("complaint_count"), F.asc("customer_complaint_tag")))


def high_performing_restaurants(orders: DataFrame, by: str = "restaurant_name",
                                min_orders: int = 500, min_rating: float = 4.0,
                                status: str = DELIVERED) -> DataFrame:
    """Q12: delivered volume above ``min_orders`` and mean rating >= ``min_rating``.

    The HAVING tests the unrounded mean; the output shows rounded means."""
    g = (orders.filter(F.col("order_status") == status)
         .groupBy(by).agg(F.count(F.lit(1)).alias("order_count"),
                          F.avg("rating").alias("_rating"),
                          F.avg("kpt_duration_minutes").alias("_kpt")))
    return (g.filter((F.col("order_count") > min_orders) & (F.col("_rating") >= min_rating))
            .select(by, "order_count", r2("_rating").alias("avg_rating"), r2("_kpt").alias("avg_kpt"))
            .orderBy(F.desc("avg_rating"), F.asc_nulls_last(by)))


def with_title(df: DataFrame, title: str) -> DataFrame:
    """Prefix a result with a constant title column (report banners)."""
    return df.select(F.lit(title).alias("query_title"), "*")


# --- fixed values: report banner titles of the script version, in run order ---
TITLES = {
    "q01": "--- Q1: Total Orders ---",
    "q02": "--- Q2: Orders by Restaurant ---",
    "q03": "--- Q3: Orders by Status ---",
    "q04": "--- Q4: Revenue by Restaurant ---",
    "q05": "--- Q5: Average Order Value by Restaurant ---",
    "q06": "--- Q6: Top 10 Highest-Value Orders ---",
    "q07": "--- Q7: Kitchen Prep Time (KPT) by Restaurant ---",
    "q08": "--- Q8: Rider Wait Time by Restaurant ---",
    "q09": "--- Q9: Distance-based Order Behaviour ---",
    "q10": "--- Q10: Customer Rating and Review Count by Restaurant ---",
    "q11": "--- Q11: Most Frequent Customer Complaints ---",
    "q12": "--- Q12: High-Performing Restaurants (Volume > 500 & Rating >= 4.0) ---",
}
