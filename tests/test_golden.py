"""Golden test: the six published metric rows -> scorecard and summary."""

import pytest
from pyspark.sql import functions as F

from orderlens.operators import findings as fnd
from orderlens.operators import scorecard as sc
from orderlens.sources.fixtures import metrics6

# published scorecard: name -> (share %, efficiency, bottleneck, growth, kpt_flag, wait_flag)
EXPECTED = {
    "Aura Pizzas": (73.87, 43.27, False, False, False, False),
    "Dilli Burger Adda": (0.70, 23.08, True, False, True, True),
    "Masala Junction": (0.06, 23.95, False, True, False, False),
    "Swaad": (24.36, 31.51, False, False, True, False),
    "Tandoori Junction": (0.92, 40.83, True, True, True, True),
    "The Chicken Junction": (0.09, 24.88, False, True, False, True),
}


@pytest.fixture(scope="module")
def card(spark):
    return sc.scorecard(metrics6(spark))


def test_scorecard_matches_published(card):
    rows = {r["restaurant_name"]: r for r in card.collect()}
    assert set(rows) == set(EXPECTED)
    for name, (share, eff, bott, growth, kf, wf) in EXPECTED.items():
        r = rows[name]
        assert r["revenue_share_pct"] == pytest.approx(share)
        assert r["efficiency_ratio"] == pytest.approx(eff)
        assert r["bottleneck"] is bott and r["growth_opportunity"] is growth
        assert r["kpt_flag"] is kf and r["wait_flag"] is wf
        assert r["avg_rating_clean"] == r["avg_rating"]


def test_scorecard_has_17_columns(card):
    assert card.columns == sc.SCORECARD_COLUMNS and len(card.columns) == 17


def test_medians(spark):
    m = metrics6(spark).agg(F.median("avg_kpt").alias("k"), F.median("avg_rider_wait").alias("w"),
                            F.median("avg_rating").alias("r"), F.median("order_count").alias("c")).first()
    assert (m.k, m.w, m.r, m.c) == pytest.approx((17.425, 5.015, 4.54, 190.5))


def test_executive_summary(card):
    s = sc.executive_summary(card).first()
    assert s.total_restaurants == 6 and s.total_orders == 21321
    assert s.total_platform_revenue == pytest.approx(14554058.14)
    assert s.avg_platform_order_value == pytest.approx(682.62)
    assert s.bottleneck_restaurants == ["Dilli Burger Adda", "Tandoori Junction"]
    assert s.growth_opportunity_restaurants == ["Masala Junction", "Tandoori Junction", "The Chicken Junction"]


def test_findings(card):
    ex = {(r.finding, r.restaurant_name) for r in fnd.extremes(card).collect()}
    assert ex == {("highest_kpt", "Tandoori Junction"), ("highest_aov", "Tandoori Junction"),
                  ("lowest_rating", "Dilli Burger Adda")}
    top3 = [r.restaurant_name for r in fnd.top_ratings(card, 3).collect()]
    assert top3 == ["Masala Junction", "The Chicken Junction", "Tandoori Junction"]
    share = fnd.group_volume_share(card, fnd.top_ratings(card, 3)).first()
    assert share.orders == 214 and share.volume_share_pct == pytest.approx(1.004)
    assert fnd.kpt_rating_corr(card).first().kpt_rating_corr == pytest.approx(-0.486, abs=1e-3)
    slow = {r.restaurant_name for r in fnd.slow_kitchens(card, 19).collect()}
    assert slow == {"Dilli Burger Adda", "Tandoori Junction"}
    w = fnd.weighted_vs_unweighted_aov(card).first()
    assert w.weighted_aov == pytest.approx(682.62) and w.unweighted_aov != w.weighted_aov


def test_growth_uses_imputed_rating(spark):
    """A restaurant without rating takes the median rating, so its flag is not NULL."""
    rows = [("A", 10, 100.0, 10.0, 10.0, 5.0, None, None), ("B", 20, 100.0, 5.0, 10.0, 5.0, 4.0, 3),
            ("C", 30, 100.0, 3.3, 12.0, 6.0, 5.0, 2)]
    from orderlens.schema import METRICS
    card = sc.scorecard(spark.createDataFrame(rows, METRICS))
    got = {r.restaurant_name: r for r in card.collect()}
    assert got["A"].avg_rating_clean == pytest.approx(4.5)
    assert got["A"].growth_opportunity is True
    assert all(r.growth_opportunity is not None for r in got.values())
