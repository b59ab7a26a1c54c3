"""Scorecard: revenue share, efficiency, median imputation, flags, summary.

Input is a metrics table with one row per restaurant (``restaurant_metrics``
or literal rows).  Everything platform-wide (revenue total, four medians) is ONE
global aggregate of exactly one row, joined to every metric row with a
broadcast of that single row; nothing is windowed over an unpartitioned frame.
The metric rows are written once (``scorecard`` -> ``plans.materialize``), so
the fact table is aggregated once though two branches read them.
Medians are the built-in exact ``median`` (mean of the middle two for an even
count) at every size.  Its state is a map of distinct values, which is bounded
by the values, not by the rows: metrics are rounded to two decimals (ratings
401 values, minutes a few hundred thousand), and restaurants with distinct
order counts number at most the square root of twice the orders.
Filling missing values with a column's median leaves that median as it is, so
the flags compare with the medians of the values before filling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.expr import r2, safe_ratio
from orderlens.plans.materialize import materialize


def _with_scalars(df: DataFrame, *aggs) -> DataFrame:
    """Attach a one-row global aggregate to every row (broadcast of 1 row)."""
    return df.crossJoin(F.broadcast(df.agg(*aggs)))


def revenue_share(metrics: DataFrame) -> DataFrame:
    """Share of platform revenue in percent, 2 dp."""
    return (_with_scalars(metrics, F.sum("total_revenue").alias("_platform_rev"))
            .withColumn("revenue_share_pct", r2(safe_ratio(F.col("total_revenue"), F.col("_platform_rev")) * 100))
            .drop("_platform_rev"))


def efficiency_ratio(metrics: DataFrame) -> DataFrame:
    """Revenue per order per KPT minute (AOV / KPT), 2 dp; NULL if KPT is 0/NULL."""
    return metrics.withColumn(
        "efficiency_ratio",
        r2(safe_ratio(F.col("total_revenue"), F.col("avg_kpt") * F.col("order_count"))))


_MEDIANS = {"_m_rating": "avg_rating", "_m_kpt": "avg_kpt", "_m_wait": "avg_rider_wait", "_m_count": "order_count"}
_CLEAN = {"avg_rating_clean": ("avg_rating", "_m_rating"), "avg_kpt_clean": ("avg_kpt", "_m_kpt"),
          "avg_wait_clean": ("avg_rider_wait", "_m_wait")}


def _medians(names) -> list:
    return [F.median(_MEDIANS[m]).alias(m) for m in names]


def _filled(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(v, m) for c, (v, m) in _CLEAN.items()})


def median_impute(metrics: DataFrame) -> DataFrame:
    """``*_clean`` helper columns: missing rating/KPT/wait -> column median."""
    names = [m for _, m in _CLEAN.values()]
    return _filled(_with_scalars(metrics, *_medians(names))).drop(*names)


def _flagged(df: DataFrame) -> DataFrame:
    """A comparison with a missing value is False, never NULL."""
    def true(c):
        return F.coalesce(c, F.lit(False))

    return (df.withColumns({"kpt_flag": true(F.col("avg_kpt_clean") > F.col("_m_kpt")),
                            "wait_flag": true(F.col("avg_wait_clean") > F.col("_m_wait")),
                            "growth_opportunity": true((F.col("avg_rating_clean") >= F.col("_m_rating"))
                                                       & (F.col("order_count") < F.col("_m_count")))})
            .withColumn("bottleneck", F.col("kpt_flag") & F.col("wait_flag")))


def flags(cleaned: DataFrame) -> DataFrame:
    """Bottleneck = KPT and wait strictly above their medians;
    growth = rating at/above median with order count below median."""
    medians = [F.median("avg_kpt_clean").alias("_m_kpt"), F.median("avg_wait_clean").alias("_m_wait"),
               F.median("avg_rating_clean").alias("_m_rating"), F.median("order_count").alias("_m_count")]
    return _flagged(_with_scalars(cleaned, *medians)).drop(*_MEDIANS)


SCORECARD_COLUMNS = [
    "order_count", "total_revenue", "avg_order_value", "avg_kpt", "avg_rider_wait",
    "restaurant_name", "avg_rating", "num_ratings", "revenue_share_pct", "efficiency_ratio",
    "avg_rating_clean", "avg_kpt_clean", "avg_wait_clean", "kpt_flag", "wait_flag",
    "bottleneck", "growth_opportunity",
]


def scorecard(metrics: DataFrame, materialized: bool = False) -> DataFrame:
    """The 17-column scorecard (plus ``restaurant_id`` when present).

    The metrics are materialised once: the rows and the one global aggregate
    each read them, and the fact-table aggregate must run only once.
    Pass ``materialized=True`` when ``metrics`` already reads a written copy."""
    if not materialized:
        metrics = materialize(metrics, "restaurant_metrics")
    s = _with_scalars(metrics, F.sum("total_revenue").alias("_platform_rev"), *_medians(_MEDIANS))
    s = s.withColumn("revenue_share_pct", r2(safe_ratio(F.col("total_revenue"), F.col("_platform_rev")) * 100))
    s = _flagged(_filled(efficiency_ratio(s)))
    cols = (["restaurant_id"] if "restaurant_id" in metrics.columns else []) + SCORECARD_COLUMNS
    return s.select(*cols)


def _ids(card: DataFrame) -> list[str]:
    return [c for c in ("restaurant_id",) if c in card.columns]


def bottlenecks(card: DataFrame) -> DataFrame:
    """Bottleneck report rows (with ``restaurant_id`` when the card has it)."""
    return (card.filter(F.col("bottleneck"))
            .select(*_ids(card), "restaurant_name", "order_count", "avg_kpt", "avg_rider_wait",
                    "avg_rating"))


def growth_opportunities(card: DataFrame) -> DataFrame:
    """Growth-opportunity report rows (with ``restaurant_id`` when present)."""
    return (card.filter(F.col("growth_opportunity"))
            .select(*_ids(card), "restaurant_name", "order_count", "revenue_share_pct", "avg_rating",
                    "avg_order_value"))


def summary_totals(card: DataFrame) -> DataFrame:
    """The executive summary's one row of figures, without the names."""
    rev, cnt = F.sum("total_revenue"), F.sum("order_count")
    return card.agg(
        F.count(F.lit(1)).alias("total_restaurants"), cnt.cast("bigint").alias("total_orders"),
        rev.alias("total_platform_revenue"), r2(safe_ratio(rev, cnt)).alias("avg_platform_order_value"),
        F.count_if("bottleneck").alias("bottlenecks"), F.count_if("growth_opportunity").alias("growth_opportunities"))


def summary_names(card: DataFrame) -> DataFrame:
    """(section, restaurant_name): the summary's flagged restaurants as rows, for any number of them."""
    flags = [F.when(F.col(flag), F.lit(flag)) for flag in ("bottleneck", "growth_opportunity")]
    return card.select(F.explode(F.array_compact(F.array(*flags))).alias("section"), "restaurant_name")


def executive_summary(card: DataFrame) -> DataFrame:
    """One row: restaurants, orders, revenue, weighted AOV, flagged names.

    The weighted AOV is a ratio of sums, not a mean of per-restaurant AOVs.
    Name lists are sorted; they hold one entry per flagged restaurant
    (``summary_totals`` and ``summary_names`` give the same as rows)."""
    rev, cnt = F.sum("total_revenue"), F.sum("order_count")
    name = F.col("restaurant_name")
    return card.agg(
        F.count(F.lit(1)).alias("total_restaurants"),
        cnt.cast("bigint").alias("total_orders"),
        rev.alias("total_platform_revenue"),
        r2(safe_ratio(rev, cnt)).alias("avg_platform_order_value"),
        F.sort_array(F.collect_list(F.when(F.col("bottleneck"), name))).alias("bottleneck_restaurants"),
        F.sort_array(F.collect_list(F.when(F.col("growth_opportunity"), name))).alias("growth_opportunity_restaurants"),
    )
