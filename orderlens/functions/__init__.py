"""Column-level building blocks (built-in Spark SQL functions only)."""

from orderlens.functions.expr import (  # noqa: F401
    DEFAULT_TS_FORMATS, abs_diff_or_zero, any_negative, finite_or_null, fmt2, is_missing,
    pct_diff, r2, safe_ratio, strip_ws, to_double, to_ts, valid_minutes,
)
