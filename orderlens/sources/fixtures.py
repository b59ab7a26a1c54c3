"""Order tables derived from the driver's TPC-H-style tables.

One order row = one ``orders`` row joined to its ``customer``, ``nation``
and ``region``.  The column mapping is plain SQL text that runs unchanged
on Spark and on DuckDB, so the oracle queries can inline the same mapping.

Join plan: the two fixed-size dimensions (nation, region) join ``customer``
first; the widened customer side then joins ``orders`` on the customer key.
Nothing is hinted: the planner broadcasts that side only if its measured bytes
are under the broadcast threshold and otherwise shuffles both sides (sort-merge),
with the AQE skew rule splitting a hot customer key across tasks.  The fact
table is always the streamed side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# (column, SQL expression over aliases o, c, n, r) for the typed order table.
FOOD_ORDERS_MAPPING: list[tuple[str, str]] = [
    ("restaurant_id", "CASE WHEN o.o_orderkey % 211 = 0 THEN '' WHEN o.o_orderkey % 199 = 0 "
     "THEN CONCAT(' ', CAST(n.n_nationkey AS STRING), chr(9)) ELSE CAST(n.n_nationkey AS STRING) END"),
    ("restaurant_name", "r.r_name"),
    ("subzone", "c.c_mktsegment"),
    ("city", "n.n_name"),
    ("order_id", "CAST(o.o_orderkey AS STRING)"),
    ("order_placed_at", "o.o_orderdate"),
    ("order_status", "CASE o.o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Cancelled' ELSE 'Rejected' END"),
    ("delivery", "'Standard'"),
    ("distance", "CONCAT(CAST(o.o_custkey % 8 AS STRING), 'km')"),
    ("items_in_order", "CONCAT('1 x item ', CAST(o.o_orderkey % 7 AS STRING))"),
    ("instructions", "CASE WHEN o.o_orderkey % 10 = 0 THEN CONCAT('leave at gate, say \"hi\" ', o.o_orderpriority) END"),
    ("discount_construct", "CASE WHEN o.o_orderkey % 6 = 0 THEN CONCAT(CAST(o.o_orderkey % 50 AS STRING), '% off, max 80') END"),
    ("bill_subtotal", "CASE WHEN o.o_orderkey % 61 = 0 THEN -1.0E0 * o.o_totalprice ELSE o.o_totalprice END"),
    ("packaging_charges", "CAST(o.o_orderkey % 3 AS DOUBLE) * 10"),
    ("restaurant_discount_promo", "CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(o.o_orderkey % 80 AS DOUBLE) / 2 END"),
    ("restaurant_discount_flat", "CASE WHEN o.o_orderkey % 7 = 0 THEN CAST(o.o_orderkey % 30 AS DOUBLE) - 2 END"),
    ("gold_discount", "CASE WHEN o.o_orderkey % 8 = 0 THEN CAST(o.o_custkey % 40 AS DOUBLE) END"),
    ("brand_pack_discount", "CASE WHEN o.o_orderkey % 12 = 0 THEN CAST(o.o_custkey % 9 AS DOUBLE) END"),
    ("total", "CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE o.o_totalprice END"),
    ("rating", "CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 4 = 0 AND n.n_nationkey <> 7 THEN CAST(5 - (o.o_custkey % 3) AS DOUBLE) END"),
    ("review", "CASE WHEN o.o_orderkey % 13 = 0 THEN CONCAT('said \"good\", would order ', CAST(o.o_orderkey % 5 AS STRING)) "
     "WHEN o.o_orderkey % 17 = 0 THEN '   ' END"),
    ("cancellation_reason", "CASE WHEN o.o_orderstatus = 'O' THEN 'Customer cancelled' WHEN o.o_orderstatus = 'P' THEN 'Restaurant rejected' END"),
    ("restaurant_compensation", "CASE WHEN o.o_orderkey % 29 = 0 THEN CAST(o.o_orderkey % 100 AS DOUBLE) END"),
    ("restaurant_penalty", "CASE WHEN o.o_orderkey % 31 = 0 THEN -1.0E0 * CAST(o.o_orderkey % 20 AS DOUBLE) END"),
    ("kpt_duration_minutes", "CASE WHEN o.o_orderkey % 53 = 0 THEN -3.0E0 WHEN n.n_nationkey = 11 THEN NULL WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 9 <> 0 THEN CAST(10 + (o.o_orderkey * 7) % 20 + n.n_nationkey % 5 AS DOUBLE) END"),
    ("rider_wait_time_minutes", "CASE WHEN o.o_orderkey % 67 = 0 THEN -1.5E0 WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 11 <> 0 THEN CAST((o.o_orderkey * 3) % 10 + n.n_nationkey % 4 AS DOUBLE) END"),
    ("order_ready_marked", "CASE WHEN o.o_orderstatus = 'F' THEN 'Correctly' END"),
    ("customer_complaint_tag", "CASE o.o_orderkey % 40 WHEN 0 THEN 'Poor taste' WHEN 1 THEN 'Wrong item' WHEN 2 THEN 'Late' WHEN 3 THEN '' WHEN 4 THEN 'Late' END"),
    ("customer_id", "c.c_name"),
    ("order_placed_at_raw", "SUBSTRING(CAST(o.o_orderdate AS STRING), 1, 19)"),
    ("flag_negative_financial", "((o.o_orderkey % 61 = 0 AND o.o_totalprice > 0) OR (o.o_orderkey % 7 = 0 AND o.o_orderkey % 30 < 2) "
     "OR (o.o_orderkey % 31 = 0 AND o.o_orderkey % 20 > 0))"),
]

# The dirty all-string staging table: same grain, every column STRING.
_AMOUNT = "CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS STRING)"
_DIRTY = {
    "restaurant_name": "CONCAT(' ', r.r_name, chr(9))",
    "order_placed_at": ("CASE WHEN o.o_orderkey % 101 = 0 THEN 'not a date' "
                        "WHEN o.o_orderkey % 103 = 0 THEN NULL "
                        "WHEN o.o_orderkey % 109 = 0 THEN CONCAT('9:05 PM, September ', CAST(1 + o.o_orderkey % 28 AS STRING), ' 2024') "
                        "WHEN o.o_orderkey % 113 = 0 THEN CONCAT('2024-3-10 2:30:0', CAST(o.o_orderkey % 10 AS STRING)) "
                        "WHEN o.o_orderkey % 127 = 0 THEN '1/2/2024 3:04' "
                        "WHEN o.o_orderkey % 131 = 0 THEN '2024-03-10 02:30:00.123' "
                        "ELSE SUBSTRING(CAST(o.o_orderdate AS STRING), 1, 19) END"),
    "bill_subtotal": ("CASE WHEN o.o_orderkey % 97 = 0 THEN 'abc' "
                      "WHEN o.o_orderkey % 89 = 0 THEN 'NaN' "
                      "WHEN o.o_orderkey % 83 = 0 THEN '' "
                      f"WHEN o.o_orderkey % 61 = 0 THEN CONCAT('-', {_AMOUNT}) "
                      f"ELSE CONCAT(' ', {_AMOUNT}) END"),
    "total": ("CASE WHEN o.o_orderkey % 50 = 0 THEN NULL WHEN o.o_orderkey % 137 = 0 THEN '12d' "
              f"WHEN o.o_orderkey % 139 = 0 THEN '0x1p3' WHEN o.o_orderkey % 149 = 0 THEN '5F' ELSE {_AMOUNT} END"),
    "gold_discount": ("CASE WHEN o.o_orderkey % 16 = 0 THEN 'n/a' WHEN o.o_orderkey % 8 = 0 THEN 'ten' END"),
    "rating": ("CASE WHEN o.o_orderstatus <> 'F' THEN '' "
               "WHEN o.o_orderkey % 107 = 0 THEN '7' "
               "ELSE CAST(5 - (o.o_custkey % 3) AS STRING) END"),
}
RAW_STAGING_COLUMNS = [c for c, _ in FOOD_ORDERS_MAPPING if c not in ("order_placed_at_raw", "flag_negative_financial")]
FOOD_ORDERS_RAW_MAPPING: list[tuple[str, str]] = [
    (c, _DIRTY.get(c, f"CAST({e} AS STRING)")) for c, e in FOOD_ORDERS_MAPPING if c in RAW_STAGING_COLUMNS
]

FROM_CLAUSE = (
    "orders o JOIN customer c ON o.o_custkey = c.c_custkey "
    "JOIN nation n ON c.c_nationkey = n.n_nationkey "
    "JOIN region r ON n.n_regionkey = r.r_regionkey"
)


def mapping_sql(mapping: list[tuple[str, str]]) -> str:
    """``SELECT <mapping> FROM <joins>`` — the same text runs on DuckDB."""
    cols = ",\n  ".join(f"{e} AS {c}" for c, e in mapping)
    return f"SELECT\n  {cols}\nFROM {FROM_CLAUSE}"


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
    o = read("orders").alias("o")
    c = read("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("c")
    n = read("nation").select("n_nationkey", "n_name", "n_regionkey").alias("n")
    r = read("region").select("r_regionkey", "r_name").alias("r")
    # dimensions first: customer x (nation x region) is a customer-sized side
    dim = (c.join(n, c["c_nationkey"] == n["n_nationkey"])
            .join(r, n["n_regionkey"] == r["r_regionkey"]))
    return o.join(dim, o["o_custkey"] == c["c_custkey"])


def _select(df: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in mapping])


def food_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed 31-column order table (``ORDERS_TYPED`` layout)."""
    return _select(_joined(spark, sf_dir), FOOD_ORDERS_MAPPING)


def food_orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty 29-column all-string staging table (SQL names)."""
    return _select(_joined(spark, sf_dir), FOOD_ORDERS_RAW_MAPPING)


# --- fixed values: the six published per-restaurant metric rows -------------
# (restaurant_name, order_count, total_revenue, avg_order_value, avg_kpt,
#  avg_rider_wait, avg_rating, num_ratings)
METRICS6_ROWS = [
    ("Aura Pizzas", 14548, 10751617.42, 739.04, 17.08, 4.94, 4.32, 1697),
    ("Dilli Burger Adda", 227, 101709.62, 448.06, 19.41, 5.09, 4.18, 40),
    ("Masala Junction", 28, 9162.30, 327.23, 13.66, 4.57, 4.83, 23),
    ("Swaad", 6332, 3545521.86, 559.94, 17.77, 4.51, 4.43, 682),
    ("Tandoori Junction", 154, 133665.95, 867.96, 21.26, 6.18, 4.65, 23),
    ("The Chicken Junction", 32, 12380.99, 386.91, 15.55, 7.26, 4.69, 26),
]
# --- end fixed values --------------------------------------------------------


def metrics6(spark: SparkSession) -> DataFrame:
    """The six published metric rows as a DataFrame (golden test input)."""
    from orderlens.schema import METRICS
    return spark.createDataFrame(METRICS6_ROWS, METRICS)
