"""The order table's column model.

Positional: the raw CSV header, the staging table and the typed table list
the same columns in the same order (two extra at the end after cleaning).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source data's contract) -------------------
# Raw CSV header, in file order (29 columns).
RAW_HEADERS = [
    "Restaurant ID", "Restaurant name", "Subzone", "City", "Order ID", "Order Placed At",
    "Order Status", "Delivery", "Distance", "Items in order", "Instructions",
    "Discount construct", "Bill subtotal", "Packaging charges",
    "Restaurant discount (Promo)", "Restaurant discount (Flat offs, Freebies & others)",
    "Gold discount", "Brand pack discount", "Total", "Rating", "Review",
    "Cancellation / Rejection reason", "Restaurant compensation (Cancellation)",
    "Restaurant penalty (Rejection)", "KPT duration (minutes)", "Rider wait time (minutes)",
    "Order Ready Marked", "Customer complaint tag", "Customer ID",
]
# The two columns cleaning appends, as CSV headers.
CLEAN_EXTRA_HEADERS = ["Order Placed At (raw)", "flag_negative_financial"]

# SQL names of the 31 staging/typed columns, in the same positional order.
COLUMNS = [
    "restaurant_id", "restaurant_name", "subzone", "city", "order_id", "order_placed_at",
    "order_status", "delivery", "distance", "items_in_order", "instructions",
    "discount_construct", "bill_subtotal", "packaging_charges",
    "restaurant_discount_promo", "restaurant_discount_flat",
    "gold_discount", "brand_pack_discount", "total", "rating", "review",
    "cancellation_reason", "restaurant_compensation",
    "restaurant_penalty", "kpt_duration_minutes", "rider_wait_time_minutes",
    "order_ready_marked", "customer_complaint_tag", "customer_id",
    "order_placed_at_raw", "flag_negative_financial",
]

# Column classes used by profiling and cleaning (SQL names).
NUMERIC = [
    "bill_subtotal", "packaging_charges", "restaurant_discount_promo",
    "restaurant_discount_flat", "gold_discount", "brand_pack_discount", "total", "rating",
    "restaurant_compensation", "restaurant_penalty", "kpt_duration_minutes",
    "rider_wait_time_minutes",
]
FINANCIAL = [
    "bill_subtotal", "packaging_charges", "total", "restaurant_discount_promo",
    "restaurant_discount_flat", "gold_discount", "brand_pack_discount",
]
CATEGORICAL = [
    "restaurant_name", "city", "subzone", "order_status", "delivery", "distance",
    "order_ready_marked", "customer_complaint_tag", "cancellation_reason",
]
TEXT = [
    "items_in_order", "instructions", "discount_construct", "review",
    "cancellation_reason", "customer_complaint_tag",
]
# Columns whose missing rate is reported per order status.
STATUS_DEPENDENT = [
    "rating", "cancellation_reason", "kpt_duration_minutes", "rider_wait_time_minutes",
    "order_ready_marked", "customer_complaint_tag",
]
# Spellings a CSV reader of the original pipeline treats as missing
# (pandas ``read_csv`` default NA tokens).
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# --- end fixed values -------------------------------------------------------

HEADER_TO_COLUMN = dict(zip(RAW_HEADERS + CLEAN_EXTRA_HEADERS, COLUMNS))
COLUMN_TO_HEADER = {v: k for k, v in HEADER_TO_COLUMN.items()}

RAW_COLUMNS = COLUMNS[:29]

# The raw file read with fixed all-string types: never infer.
RAW_29 = T.StructType([T.StructField(h, T.StringType(), True) for h in RAW_HEADERS])
# Staging: 31 strings under SQL names.
STAGING_31 = T.StructType([T.StructField(c, T.StringType(), True) for c in COLUMNS])


def _typed_field(c: str) -> T.StructField:
    if c in NUMERIC:
        return T.StructField(c, T.DoubleType(), True)
    if c == "order_placed_at":
        return T.StructField(c, T.TimestampNTZType(), True)
    if c == "flag_negative_financial":
        return T.StructField(c, T.BooleanType(), True)
    return T.StructField(c, T.StringType(), True)


# Typed analytical table.
ORDERS_TYPED = T.StructType([_typed_field(c) for c in COLUMNS])

# Per-restaurant metric rows (the roll-up joined with ratings).
METRICS = T.StructType([
    T.StructField("restaurant_name", T.StringType(), True),
    T.StructField("order_count", T.LongType(), True),
    T.StructField("total_revenue", T.DoubleType(), True),
    T.StructField("avg_order_value", T.DoubleType(), True),
    T.StructField("avg_kpt", T.DoubleType(), True),
    T.StructField("avg_rider_wait", T.DoubleType(), True),
    T.StructField("avg_rating", T.DoubleType(), True),
    T.StructField("num_ratings", T.LongType(), True),
])
