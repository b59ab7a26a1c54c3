"""Property tests of the expression library against plain Python."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from orderlens.functions.expr import WHITESPACE, any_negative, strip_ws, to_double

WS = st.sampled_from(list(WHITESPACE))
TEXT = st.builds(lambda a, b, c: a + b + c, st.text(WS, max_size=3),
                 st.text(st.characters(blacklist_categories=("Cs",)), max_size=8), st.text(WS, max_size=3))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=30))
def test_strip_equals_python_strip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.s for r in df.select(strip_ws("v").alias("s")).collect()]
    assert got == [None if v is None else v.strip() for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(allow_nan=True, allow_infinity=True), min_size=1, max_size=30))
def test_to_double_round_trips_finite_values(spark, values):
    df = spark.createDataFrame([(repr(v),) for v in values], "v string")
    got = [r.d for r in df.select(to_double("v").alias("d")).collect()]
    assert got == [v if math.isfinite(v) else None for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(allow_nan=False, width=32)),
                          st.one_of(st.none(), st.floats(allow_nan=False, width=32))), min_size=1, max_size=30))
def test_any_negative_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r.f for r in df.select(any_negative(["a", "b"]).alias("f")).collect()]
    assert got == [any(x is not None and x < 0 for x in row) for row in rows]
