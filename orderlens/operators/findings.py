"""Findings over the scorecard: extremes, top ratings, shares, thresholds,
correlation, weighted vs unweighted AOV.

Inputs are per-restaurant tables.  Platform scalars are one-row global
aggregates broadcast to the rows; ties at an extreme are all reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.expr import r2, safe_ratio


def _ids(card: DataFrame) -> list[str]:
    """``restaurant_id`` first when the card is keyed by id."""
    return [c for c in ("restaurant_id",) if c in card.columns]


def extremes(card: DataFrame) -> DataFrame:
    """Rows (finding, restaurant_name, value) for the highest KPT, the highest
    AOV and the lowest rating; every restaurant tied at the extreme is kept."""
    spec = [("highest_kpt", "avg_kpt", F.max), ("highest_aov", "avg_order_value", F.max),
            ("lowest_rating", "avg_rating", F.min)]
    out = None
    for name, col, agg in spec:
        best = card.agg(agg(col).alias("_best"))
        rows = (card.crossJoin(F.broadcast(best)).filter(F.col(col) == F.col("_best"))
                .select(F.lit(name).alias("finding"), *_ids(card), "restaurant_name",
                        F.col(col).alias("value")))
        out = rows if out is None else out.unionByName(rows)
    return out


def top_ratings(card: DataFrame, k: int = 3) -> DataFrame:
    """The k best-rated restaurants (top-k report), name as tie-break."""
    return (card.filter(F.col("avg_rating").isNotNull())
            .select(*_ids(card), "restaurant_name", "avg_rating", "order_count")
            .orderBy(F.desc("avg_rating"), *[F.asc(c) for c in _ids(card) + ["restaurant_name"]]).limit(k))


def volume_share(card: DataFrame) -> DataFrame:
    """Share of platform orders per restaurant, percent, 2 dp."""
    tot = card.agg(F.sum("order_count").alias("_tot"))
    return (card.crossJoin(F.broadcast(tot))
            .select(*_ids(card), "restaurant_name", "order_count",
                    r2(safe_ratio(F.col("order_count") * 100.0, F.col("_tot"))).alias("volume_share_pct")))


def group_volume_share(card: DataFrame, names: DataFrame) -> DataFrame:
    """Combined order share (percent, 3 dp) of a set of restaurants."""
    tot = card.agg(F.sum("order_count").alias("_tot"))
    keys = _ids(names) or ["restaurant_name"]
    sel = card.join(names.select(*keys).distinct(), keys, "left_semi")
    return (sel.agg(F.sum("order_count").alias("orders"), F.count(F.lit(1)).alias("restaurants"))
            .crossJoin(F.broadcast(tot))
            .select("restaurants", F.col("orders").cast("bigint").alias("orders"),
                    F.round(safe_ratio(F.col("orders") * 100.0, F.col("_tot")), 3).alias("volume_share_pct")))


def slow_kitchens(card: DataFrame, threshold: float = 19.0) -> DataFrame:
    """Restaurants whose mean KPT exceeds ``threshold`` minutes."""
    return (card.filter(F.col("avg_kpt") > threshold)
            .select(*_ids(card), "restaurant_name", "avg_kpt", "avg_rider_wait", "order_count"))


def kpt_rating_corr(card: DataFrame) -> DataFrame:
    """Pearson correlation of mean KPT and mean rating across restaurants."""
    return card.agg(F.round(F.corr("avg_kpt", "avg_rating"), 4).alias("kpt_rating_corr"),
                    F.count(F.when(F.col("avg_kpt").isNotNull() & F.col("avg_rating").isNotNull(), 1))
                    .alias("n_restaurants"))


def weighted_vs_unweighted_aov(card: DataFrame) -> DataFrame:
    """Order-weighted platform AOV (ratio of sums) next to the plain mean of
    per-restaurant AOVs."""
    return card.agg(
        r2(safe_ratio(F.sum("total_revenue"), F.sum("order_count"))).alias("weighted_aov"),
        r2(F.avg("avg_order_value")).alias("unweighted_aov"),
    )
