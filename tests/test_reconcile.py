"""Reconciliation pair: equal, count differs, revenue differs, only-left,
only-right, NULL KPT, zero revenue."""

from orderlens.operators import reconcile as rec

DDL = "restaurant_name string, order_count long, total_revenue double, avg_kpt double, avg_rider_wait double"


def test_reconcile_cases(spark):
    actual = spark.createDataFrame([
        ("eq", 10, 100.0, 10.0, 5.0), ("cnt", 11, 100.0, 10.0, 5.0), ("rev", 10, 110.0, 10.0, 5.0),
        ("left", 1, 1.0, 1.0, 1.0), ("nullkpt", 5, 50.0, 12.0, 3.0), ("zero", 5, 7.0, 1.0, 1.0)], DDL)
    expected = spark.createDataFrame([
        (" eq ", 10, 100.0, 10.004, 5.0), ("cnt", 10, 100.0, 10.0, 5.0), ("rev", 10, 100.0, 10.0, 5.0),
        ("right", 1, 1.0, 1.0, 1.0), ("nullkpt", 5, 50.0, None, 3.0), ("zero", 5, 0.0, 1.0, 1.0)], DDL)
    got = {r.restaurant_name: r for r in rec.reconcile(actual, expected, tolerance=0.01).collect()}
    assert got["eq"].side == "both" and got["eq"].count_match and got["eq"].kpt_diff_minutes == 0.004
    assert got["eq"].within_tolerance
    assert got["cnt"].count_match is False and not got["cnt"].within_tolerance
    assert got["rev"].revenue_diff_pct == 10.0 and not got["rev"].within_tolerance
    assert got["left"].side == "only_actual" and got["left"].count_match is None
    assert got["right"].side == "only_expected"
    assert got["nullkpt"].kpt_diff_minutes == 0.0
    assert got["zero"].revenue_diff_pct == 0.0
    report = rec.validation_report(rec.reconcile(actual, expected, tolerance=0.01)).first()
    assert report.status == "MISMATCH" and len(report.metrics_validation) == 7
    assert {e.side for e in report.metrics_validation} == {"both", "only_actual", "only_expected"}
    none = rec.validation_report(rec.reconcile(actual.filter("restaurant_name = 'left'"), expected.filter("restaurant_name = 'right'")))
    assert none.first().status == "MISMATCH"
    ok = rec.validation_report(rec.reconcile(actual, actual)).first()
    assert ok.status == "SUCCESS"
    assert rec.error_report(spark, ValueError("x")).first().status == "ERROR: x"
    assert rec.skipped_report(spark).first().status == "SKIPPED_NO_CLEAN_DATA"
