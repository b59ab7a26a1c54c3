"""Per-restaurant performance roll-up and rating metrics.

One ``groupBy(key).agg(...)`` replaces the map/shuffle/reduce job: Spark's
partial aggregation is the combiner the original job lacked, so each task
ships one partial row per restaurant instead of one row per order, and a
restaurant holding a third of all orders costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.expr import finite_or_null, r2, safe_ratio, strip_ws, valid_minutes

KEYS = ("restaurant_id", "restaurant_name")


def _check_key(key: str) -> None:
    if key not in KEYS:
        raise ValueError(f"key must be one of {KEYS}, got {key!r}")


def _rollup(orders: DataFrame, key: str, digits: int | None, with_ratings: bool, within: Sequence[str] = ()) -> DataFrame:
    """Two-level aggregation that trims keys per distinct key, not per order.

    Level 1 groups the fact table by the raw key text (and raw name when
    keyed by id) with sums and counts: no string work per row, and map-side
    combine leaves each task one row per distinct raw key.  Level 2 trims
    those few keys, drops empty ones and merges the partial sums, so padded
    spellings of one key (' 2 ' and '2') end in the same group.  ``within`` names
    further columns of level 1: with the bucket columns of a bucketed table it
    needs no exchange.
    """
    _check_key(key)
    raw_keys = [key] + (["restaurant_name"] if key == "restaurant_id" else [])
    total = finite_or_null(F.col("total"))
    kpt = valid_minutes("kpt_duration_minutes")
    wait = valid_minutes("rider_wait_time_minutes")
    parts = [F.count(F.lit(1)).alias("_n"), F.sum(total).alias("_rev"),
             F.sum(kpt).alias("_kpt_s"), F.count(kpt).alias("_kpt_n"),
             F.sum(wait).alias("_wait_s"), F.count(wait).alias("_wait_n")]
    if with_ratings:
        rating = finite_or_null(F.col("rating"))
        parts += [F.sum(rating).alias("_r_s"), F.count(rating).alias("_r_n")]
    l1 = orders.groupBy(*raw_keys, *within).agg(*parts)
    l1 = l1.select(*[strip_ws(k).alias(k) for k in raw_keys], *[c for c in l1.columns if c.startswith("_")])
    l1 = l1.filter(F.length(F.col(key)) > 0)
    merged = [F.sum(c).alias(c) for c in l1.columns if c.startswith("_")]
    if key == "restaurant_id":
        merged = [F.max("restaurant_name").alias("restaurant_name")] + merged
    g = l1.groupBy(key).agg(*merged)

    rnd = (lambda c: r2(c, digits)) if digits is not None else (lambda c: c)
    rev = F.coalesce(F.col("_rev"), F.lit(0.0))
    out = [key] + (["restaurant_name"] if key == "restaurant_id" else []) + [
        F.col("_n").alias("order_count"),
        rnd(rev).alias("total_revenue"),
        rnd(safe_ratio(rev, F.col("_n"))).alias("avg_order_value"),
        rnd(safe_ratio(F.col("_kpt_s"), F.col("_kpt_n"))).alias("avg_kpt"),
        rnd(safe_ratio(F.col("_wait_s"), F.col("_wait_n"))).alias("avg_rider_wait"),
    ]
    if with_ratings:
        out += [r2(safe_ratio(F.col("_r_s"), F.col("_r_n"))).alias("avg_rating"),
                F.when(F.col("_r_n") > 0, F.col("_r_n")).alias("num_ratings")]
    return g.select(*out)


def restaurant_performance(orders: DataFrame, key: str = "restaurant_id",
                           digits: int | None = 2, within: Sequence[str] = ()) -> DataFrame:
    """Count, revenue, all-order AOV, mean valid KPT and wait per restaurant.

    * keys (and, keyed by id, names) are trimmed; rows without a key belong
      to no restaurant and are skipped;
    * revenue sums finite totals; a restaurant with none has revenue 0;
    * AOV divides revenue by *all* orders (cancelled and total-less included);
    * KPT / wait average only finite, non-negative minutes; NULL if none;
    * keyed by id, the name is ``max(name)`` (deterministic representative).
    Values are rounded half-up to ``digits`` like the two-decimal text output.
    """
    return _rollup(orders, key, digits, with_ratings=False, within=within).orderBy(key)


def rating_metrics(orders: DataFrame, key: str = "restaurant_name") -> DataFrame:
    """Rounded mean rating and number of ratings per key (rated orders only).

    Aggregated on the raw key text first, then trimmed and merged per
    distinct key (no string work per order)."""
    r = finite_or_null(F.col("rating"))
    l1 = (orders.filter(r.isNotNull()).groupBy(key)
          .agg(F.sum(r).alias("_s"), F.count(r).alias("_n")))
    l2 = l1.withColumn(key, strip_ws(key)).groupBy(key).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    return l2.select(key, r2(F.col("_s") / F.col("_n")).alias("avg_rating"), F.col("_n").alias("num_ratings"))


def restaurant_metrics(orders: DataFrame, key: str = "restaurant_name",
                       digits: int | None = 2) -> DataFrame:
    """Performance and rating metrics in ONE scan of the fact table.

    Equal to ``combine(restaurant_performance(o), rating_metrics(o))`` (a left
    join on the key), without scanning the fact table twice or joining:
    a restaurant without ratings gets NULL ``avg_rating`` and ``num_ratings``.
    """
    return _rollup(orders, key, digits, with_ratings=True)


def combine(perf: DataFrame, ratings: DataFrame, key: str = "restaurant_name") -> DataFrame:
    """Left equi-join of a performance table with a rating table on a trimmed key.

    Both sides are one row per restaurant; the planner broadcasts the rating
    side when its estimate is below the broadcast threshold, else shuffles."""
    p = perf.withColumn(key, strip_ws(key))
    r = ratings.withColumn(key, strip_ws(key)).select(key, "avg_rating", "num_ratings")
    return p.join(r, on=key, how="left")
