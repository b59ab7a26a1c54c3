"""The twelve results together, from one scan of the fact table.

Q1-Q5 and Q7-Q12 group the same table by five key sets: none, restaurant,
status, distance and complaint tag.  ``GROUPING SETS`` expands each order to
these five inside the scan's own stage, and one partially aggregated grouping
computes every measure of every set; the grouping id tells the sets apart, so a
NULL restaurant is not taken for "all restaurants".  Each query is then a filter
on the small grouped result.  Q6, a top-k over single orders, has no group and
is the only other scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.expr import r2
from orderlens.operators import queries as q

KEYS = ("restaurant_name", "order_status", "distance", "customer_complaint_tag")
#: the grouping id has a bit, from the left, for each key that a set leaves out
ALL = 0b1111
SET_OF = {"restaurant_name": 0b0111, "order_status": 0b1011, "distance": 0b1101, "customer_complaint_tag": 0b1110}

#: query -> its key (None: no group), then {measure here: column of the query}
SHAPES: dict[str, tuple[str | None, dict[str, str]]] = {
    "q01": (None, {"order_count": "total_orders"}),
    "q02": ("restaurant_name", {"order_count": "order_count"}),
    "q03": ("order_status", {"order_count": "cnt"}),
    "q04": ("restaurant_name", {"total_revenue": "total_revenue"}),
    "q05": ("restaurant_name", {"avg_order_value": "avg_order_value"}),
    "q06": ("order_id", {"restaurant_name": "restaurant_name", "total": "total"}),
    "q07": ("restaurant_name", {"avg_kpt": "avg_kpt", "max_kpt": "max_kpt", "min_kpt": "min_kpt"}),
    "q08": ("restaurant_name", {"avg_rider_wait": "avg_rider_wait"}),
    "q09": ("distance", {"order_count": "order_count", "avg_order_value": "avg_order_value"}),
    "q10": ("restaurant_name", {"avg_rating": "avg_rating", "num_ratings": "num_ratings"}),
    "q11": ("customer_complaint_tag", {"order_count": "complaint_count"}),
    "q12": ("restaurant_name", {"order_count": "order_count", "avg_rating": "avg_rating", "avg_kpt": "avg_kpt"}),
}
MEASURES = {
    "order_count": "bigint", "total_revenue": "double", "avg_order_value": "double", "avg_kpt": "double", "max_kpt": "double",
    "min_kpt": "double", "avg_rider_wait": "double", "avg_rating": "double", "num_ratings": "bigint",
    "restaurant_name": "string", "total": "double",
}
#: the measure each result is sorted by, largest first
SORTED_BY = {"q02": "order_count", "q03": "order_count", "q04": "total_revenue", "q05": "avg_order_value", "q06": "total",
             "q07": "avg_kpt", "q08": "avg_rider_wait", "q09": "order_count", "q10": "avg_rating", "q11": "order_count",
             "q12": "avg_rating"}


def _grouped(orders: DataFrame, status: str) -> DataFrame:
    delivered = F.col("order_status_of") == status
    of = lambda c: F.when(delivered, F.col(c))
    kpt, wait = F.col("kpt_duration_minutes"), F.col("rider_wait_time_minutes")
    # the status is both a key, which its set alone keeps, and a condition in all sets
    rows = orders.select(*KEYS, F.col("order_status").alias("order_status_of"), "total", "rating",
                         "kpt_duration_minutes", "rider_wait_time_minutes")
    sets = [[], *([k] for k in KEYS)]
    return rows.groupingSets([[F.col(k) for k in s] for s in sets], *KEYS).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.count_if(delivered).alias("n_delivered"),
        F.sum(of("total")).alias("revenue"), F.avg("total").alias("mean_total"), F.avg(of("total")).alias("mean_delivered"),
        F.avg(kpt).alias("mean_kpt"), F.max(kpt).alias("max_kpt"), F.min(kpt).alias("min_kpt"), F.count(kpt).alias("n_kpt"),
        F.avg(wait).alias("mean_wait"), F.avg("rating").alias("mean_rating"), F.count("rating").alias("n_ratings"),
        F.avg(of("rating")).alias("delivered_rating"), F.avg(of("kpt_duration_minutes")).alias("delivered_kpt"))


def grouped_results(orders: DataFrame, min_orders: int = 500, min_rating: float = 4.0, status: str = q.DELIVERED,
                    digits: int | None = None) -> DataFrame:
    """All results but Q6 as (query, query_title, group_key, measures); revenue is rounded only with ``digits``."""
    revenue = F.col("revenue") if digits is None else r2("revenue", digits)
    tag = F.col("customer_complaint_tag")
    # query -> (which groups it reports, its measures)
    parts: dict[str, tuple[Column, dict[str, Column]]] = {
        "q01": (F.lit(True), {"order_count": F.col("n")}),
        "q02": (F.lit(True), {"order_count": F.col("n")}),
        "q03": (F.lit(True), {"order_count": F.col("n")}),
        "q04": (F.col("n_delivered") > 0, {"total_revenue": revenue}),
        "q05": (F.col("n_delivered") > 0, {"avg_order_value": r2("mean_delivered")}),
        "q07": (F.col("n_kpt") > 0, {"avg_kpt": r2("mean_kpt"), "max_kpt": F.col("max_kpt"), "min_kpt": F.col("min_kpt")}),
        "q08": (F.col("mean_wait").isNotNull(), {"avg_rider_wait": r2("mean_wait")}),
        "q09": (F.lit(True), {"order_count": F.col("n"), "avg_order_value": r2("mean_total")}),
        "q10": (F.col("n_ratings") > 0, {"avg_rating": r2("mean_rating"), "num_ratings": F.col("n_ratings")}),
        "q11": (tag.isNotNull() & (tag != ""), {"order_count": F.col("n")}),
        "q12": ((F.col("n_delivered") > min_orders) & (F.col("delivered_rating") >= min_rating),
                {"order_count": F.col("n_delivered"), "avg_rating": r2("delivered_rating"), "avg_kpt": r2("delivered_kpt")}),
    }
    rows = []
    for name, (reported, measures) in parts.items():
        key = SHAPES[name][0]
        here = (F.col("gid") == (SET_OF[key] if key else ALL)) & reported
        group_key = F.col(key).cast("string") if key else F.lit(None).cast("string")
        row = F.struct(F.lit(name).alias("query"), F.lit(q.TITLES[name]).alias("query_title"), group_key.alias("group_key"),
                       *(measures.get(m, F.lit(None)).cast(t).alias(m) for m, t in MEASURES.items()))
        rows.append(F.when(here, row))
    # a group's results as rows of their own: one pass over the grouped table, no union of scans
    listed = F.filter(F.array(*rows), lambda r: r.isNotNull())
    return _grouped(orders, status).select(F.inline(listed))


def all_results(orders: DataFrame, k: int = 10, min_orders: int = 500, min_rating: float = 4.0, status: str = q.DELIVERED,
                digits: int | None = None) -> DataFrame:
    """All twelve results as (query, query_title, group_key, measures); a measure that a query has not is NULL."""
    top = q.top_orders(orders, k, status)
    own = {"restaurant_name", "total"}
    top = top.select(F.lit("q06").alias("query"), F.lit(q.TITLES["q06"]).alias("query_title"), F.col("order_id").alias("group_key"),
                     *((F.col(m) if m in own else F.lit(None)).cast(t).alias(m) for m, t in MEASURES.items()))
    return grouped_results(orders, min_orders, min_rating, status, digits).unionByName(top)


def result_of(results: DataFrame, name: str) -> DataFrame:
    """One query's own table, columns and order out of ``all_results``.

    Without an order no set has a group; the count of all orders is then 0."""
    key, measures = SHAPES[name]
    mine = results.where(F.col("query") == name)
    if key is None:
        return mine.agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(c) for m, c in measures.items()))
    mine = mine.orderBy(F.desc_nulls_last(SORTED_BY[name]), F.asc_nulls_last("group_key"))
    return mine.select(F.col("group_key").alias(key), *(F.col(m).alias(c) for m, c in measures.items()))
