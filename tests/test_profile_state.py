"""States of periods add up to the profile of the whole table."""

import pytest
from pyspark.sql import functions as F

from orderlens.operators import profile as pr
from orderlens.operators import profile_state as ps
from orderlens.plans.landing import raw_staging
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw(spark):
    return raw_staging(spark, SF_SMALL)


@pytest.fixture(scope="module")
def merged(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("states"))
    ps.save_states(ps.column_states(raw, grain="year"), f"{path}/columns")
    ps.save_states(ps.value_states(raw, grain="year"), f"{path}/values")
    # one year is profiled again: its states are replaced, not added
    again = raw.where(ps.period_of("order_placed_at", "year") == F.lit("1995-01-01").cast("date"))
    assert 0 < again.count() < raw.count()
    ps.save_states(ps.column_states(again, grain="year"), f"{path}/columns")
    ps.save_states(ps.value_states(again, grain="year"), f"{path}/values")
    return ps.read_states(spark, f"{path}/columns"), ps.read_states(spark, f"{path}/values")


def test_merged_states_equal_a_full_pass(raw, merged):
    assert merged[0].select(ps.PERIOD).distinct().count() > 5
    got = {r["column"]: r for r in ps.merged_profile(merged[0]).collect()}
    assert set(got) == set(raw.columns) and all(r["rows"] == raw.count() for r in got.values())
    for r in pr.missing_report(raw).collect():
        assert (got[r["column"]]["missing"], got[r["column"]]["missing_pct"]) == (r["missing_count"], r["missing_pct"])
    for r in pr.numeric_audit(raw).collect():
        g = got[r["column"]]
        assert (g["non_numeric"], g["min"], g["max"], g["negatives"]) == (r["non_numeric"], r["min"], r["max"], r["negatives"])
    for r in pr.text_audit(raw).collect():
        assert (got[r["column"]]["with_comma"], got[r["column"]]["with_quote"]) == (r["with_comma"], r["with_quote"])
    for r in pr.distinct_counts(raw).collect():
        assert abs(got[r["column"]]["distinct_values"] - r["distinct_values"]) <= 4 * ps.standard_error() * r["distinct_values"]


def test_merged_top_values_equal_a_full_pass(raw, merged):
    assert sorted(map(str, ps.merged_top(merged[1]).select("column", "value", "count", "rank").collect())) == \
        sorted(map(str, pr.categorical_top(raw).select("column", "value", "count", "rank").collect()))


def test_unreadable_times_are_a_period_and_empty_tables_have_none(spark, tmp_dir):
    rows = spark.createDataFrame([("2024-09-01 10:00:00", "1"), ("nonsense", "-2"), (None, "x")], "order_placed_at string, total string")
    ps.save_states(ps.column_states(rows), f"{tmp_dir}/s")
    states = ps.read_states(spark, f"{tmp_dir}/s")
    assert states.where("period IS NULL AND column = 'total'").select("rows", "non_numeric", "negatives").first() == (2, 1, 1)
    total = ps.merged_profile(states).where("column = 'total'").first()
    assert (total["rows"], total["min"], total["max"], total["distinct_values"]) == (3, -2.0, 1.0, 3)
    assert ps.column_states(rows.limit(0)).count() == 0 and ps.merged_profile(ps.column_states(rows.limit(0))).count() == 0
