"""Cross-path reconciliation of per-restaurant metrics.

The original validator loops over restaurants and re-filters the whole clean
table for each (N full scans).  Here the expected side is ONE aggregate and
the comparison ONE full outer join on the key, so restaurants present on
only one side are reported instead of skipped silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.expr import abs_diff_or_zero, finite_or_null, pct_diff, strip_ws

METRIC_COLUMNS = ("order_count", "total_revenue", "avg_kpt", "avg_rider_wait")


def expected_metrics(orders: DataFrame, key: str = "restaurant_name", within: Sequence[str] = ()) -> DataFrame:
    """The validator's recomputation: every row counts, revenue sums finite
    totals (0 if none), KPT and wait average all present values — negative
    minutes included, unlike the roll-up.

    Aggregated on the raw key text first, then trimmed and merged per
    distinct key (no string work per order); ``within`` as for the roll-up."""
    total = finite_or_null(F.col("total"))
    kpt = finite_or_null(F.col("kpt_duration_minutes"))
    wait = finite_or_null(F.col("rider_wait_time_minutes"))
    l1 = orders.groupBy(key, *within).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(total).alias("_rev"),
        F.sum(kpt).alias("_ks"), F.count(kpt).alias("_kn"),
        F.sum(wait).alias("_ws"), F.count(wait).alias("_wn"))
    l2 = (l1.withColumn(key, strip_ws(key)).groupBy(key)
          .agg(*[F.sum(c).alias(c) for c in ("_n", "_rev", "_ks", "_kn", "_ws", "_wn")]))
    return l2.select(
        key,
        F.col("_n").alias("order_count"),
        F.coalesce(F.col("_rev"), F.lit(0.0)).alias("total_revenue"),
        F.try_divide(F.col("_ks"), F.col("_kn")).alias("avg_kpt"),
        F.try_divide(F.col("_ws"), F.col("_wn")).alias("avg_rider_wait"),
    )


def reconcile(actual: DataFrame, expected: DataFrame, key: str = "restaurant_name",
              tolerance: float | None = None, digits: int = 4) -> DataFrame:
    """One row per key on either side.

    ``side`` is both / only_actual / only_expected.  For matched keys:
    ``count_match``; ``revenue_diff_pct`` (0 when expected revenue <= 0);
    ``kpt_diff_minutes`` / ``wait_diff_minutes`` (0 when expected is missing);
    rounded to ``digits``.  With a ``tolerance`` (same unit as each diff),
    ``within_tolerance`` tells whether every diff is at most that much."""
    a = actual.select(strip_ws(key).alias(key), *[F.col(c).alias(f"a_{c}") for c in METRIC_COLUMNS])
    e = expected.select(strip_ws(key).alias(key), F.lit(True).alias("_in_e"),
                        *[F.col(c).alias(f"e_{c}") for c in METRIC_COLUMNS])
    a = a.withColumn("_in_a", F.lit(True))
    j = a.join(e, on=key, how="full")
    both = F.coalesce("_in_a", F.lit(False)) & F.coalesce("_in_e", F.lit(False))
    side = (F.when(both, "both").when(F.col("_in_a").isNotNull(), "only_actual")
            .otherwise("only_expected"))
    out = j.select(
        key, side.alias("side"),
        F.when(both, F.coalesce(F.col("a_order_count") == F.col("e_order_count"), F.lit(False))).alias("count_match"),
        F.when(both, F.round(pct_diff("a_total_revenue", "e_total_revenue"), digits)).alias("revenue_diff_pct"),
        F.when(both, F.round(abs_diff_or_zero("a_avg_kpt", "e_avg_kpt"), digits)).alias("kpt_diff_minutes"),
        F.when(both, F.round(abs_diff_or_zero("a_avg_rider_wait", "e_avg_rider_wait"), digits)).alias("wait_diff_minutes"),
    )
    if tolerance is not None:
        ok = (F.col("count_match") & (F.col("revenue_diff_pct") <= tolerance)
              & (F.col("kpt_diff_minutes") <= tolerance) & (F.col("wait_diff_minutes") <= tolerance))
        out = out.withColumn("within_tolerance", F.coalesce(ok, F.lit(False)))
    return out


REPORT_ENTRY = ("restaurant_name string, side string, count_match boolean, revenue_diff_pct double, "
                "kpt_diff_minutes double, wait_diff_minutes double")
REPORT_SCHEMA = f"status string, metrics_validation array<struct<{REPORT_ENTRY.replace(' string', ':string').replace(' boolean', ':boolean').replace(' double', ':double')}>>"


def validation_report(rec: DataFrame, key: str = "restaurant_name") -> DataFrame:
    """Report document: ``status`` and every compared key as an array of structs.

    Keys on one side only are kept, with their ``side`` and no differences.
    MISMATCH when a key is unmatched or, with a tolerance, a row fails it; else
    SUCCESS.  One row; the array holds one entry per restaurant."""
    bad = F.col("side") != "both"
    if "within_tolerance" in rec.columns:
        bad = bad | ~F.col("within_tolerance")
    entry = F.struct(F.col(key).alias("restaurant_name"), "side", "count_match", "revenue_diff_pct", "kpt_diff_minutes",
                     "wait_diff_minutes")
    return rec.agg(F.when(F.count_if(bad) > 0, "MISMATCH").otherwise("SUCCESS").alias("status"),
                   F.sort_array(F.collect_list(entry)).alias("metrics_validation"))


def validation_status(rec: DataFrame) -> DataFrame:
    """The report's status with the number of keys compared and of those that fail; the entries stay the rows of ``rec``."""
    bad = F.col("side") != "both"
    if "within_tolerance" in rec.columns:
        bad = bad | ~F.col("within_tolerance")
    return rec.agg(F.when(F.count_if(bad) > 0, "MISMATCH").otherwise("SUCCESS").alias("status"),
                   F.count(F.lit(1)).alias("compared"), F.count_if(bad).alias("failed"))


def _status_report(spark: SparkSession, status: str) -> DataFrame:
    return spark.createDataFrame([(status, [])], REPORT_SCHEMA)


def skipped_report(spark: SparkSession) -> DataFrame:
    """The report when no clean data is available."""
    return _status_report(spark, "SKIPPED_NO_CLEAN_DATA")


def error_report(spark: SparkSession, error: Exception) -> DataFrame:
    """The report when the comparison itself failed."""
    return _status_report(spark, f"ERROR: {error}")
