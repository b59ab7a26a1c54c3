"""Column expressions shared by every operator.

All are built-in Spark SQL functions, so they stay inside whole-stage
codegen: no Python UDF anywhere in the library.  Each one encodes a
NULL-faithful rule of the original pipeline (missing stays missing).
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.schema import MISSING_TOKENS

ColumnOrName = Column | str

# Every character Python's ``str.strip()`` removes, derived from the rule
# ``str.isspace`` (Spark's ``trim`` removes only the space character).
# ``btrim`` with an explicit set is ~4x cheaper than an anchored regex.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Timestamp layouts tried in order; the first that parses wins.  The source
# format is not fixed, so the list is a parameter of ``to_ts``.
# Single pattern letters take one or two digits; brackets are optional parts.
DEFAULT_TS_FORMATS = (
    "yyyy-M-d H:mm:ss[.SSSSSSSSS]",
    "yyyy-M-d'T'H:mm:ss[.SSSSSSSSS]",
    "yyyy-M-d H:mm",
    "yyyy-M-d",
    "h:mm a, MMMM d yyyy",
    "d-M-yyyy H:mm",
    "M/d/yyyy H:mm",
    "d-M-yyyy h:mm a",
    "yyyy/M/d[ H:mm[:ss]]",
    "MMM d[,] yyyy[ H:mm[:ss]]",
    "MMMM d[,] yyyy[ H:mm[:ss]]",
    "yyyyMMdd",
)
# Layouts with an offset of their own: the instant, as UTC wall time.
OFFSET_TS_FORMATS = tuple(f"yyyy-M-d{gap}H:mm:ss[.SSSSSSSSS]{offset}" for gap in ("'T'", " ") for offset in ("XXX", "XX"))
# What the letters of a layout stand for in a text.
_SHAPES = {"yyyy": r"\d{4}", "MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]{3}", "MM": r"\d{2}", "dd": r"\d{2}", "M": r"\d{1,2}",
           "d": r"\d{1,2}", "H": r"\d{1,2}", "h": r"\d{1,2}", "mm": r"\d{2}", "ss": r"\d{2}", "a": "[AaPp][Mm]",
           "SSSSSSSSS": r"\d{1,9}", "SSSSSS": r"\d{1,6}", "XXX": r"(?:Z|[+-]\d{2}:\d{2})", "XX": r"(?:Z|[+-]\d{4})"}


def col_(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: ColumnOrName) -> Column:
    """Strip leading/trailing whitespace; NULL stays NULL."""
    return F.btrim(col_(c), F.lit(WHITESPACE))


def is_missing(c: ColumnOrName, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """NULL or one of the reader's missing-value spellings."""
    c = col_(c)
    return c.isNull() | c.isin(list(tokens))


def finite_or_null(v: Column) -> Column:
    """NaN and +-infinity become NULL (NaN poisons SUM/AVG/MAX in Spark)."""
    return F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(v)


def parse_number(text: Column) -> Column:
    """Text -> DOUBLE, NULL where it is no decimal number (never raises).

    The JVM's parser also takes type suffixes (``12d``, ``5F``) and hexadecimal
    floats (``0x1p3``); such text is no number here.  Infinities pass."""
    last = F.right(text, F.lit(1))
    plain = ~last.isin("d", "D", "f", "F") & ~text.contains("x") & ~text.contains("X")
    return F.when(plain | F.lower(F.right(text, F.lit(3))).eqNullSafe("inf"), text.try_cast("double"))


def to_double(c: ColumnOrName) -> Column:
    """Lenient numeric parse: invalid text, NaN and infinities -> NULL."""
    return finite_or_null(parse_number(strip_ws(col_(c).cast("string"))))


def layout_shape(fmt: str) -> str | None:
    """A regular expression that every text of a layout matches; None for layouts with other letters than above."""
    out = ""
    for m in re.finditer(r"'([^']*)'|([A-Za-z])\2*|(.)", fmt):
        literal, letter, other = m.groups()
        if letter:
            if m[0] not in _SHAPES:
                return None
            out += _SHAPES[m[0]]
        else:
            out += {"[": "(?:", "]": ")?"}.get(other) or re.escape(literal if other is None else other)
    return rf"\A{out}\z"


def to_ts(c: ColumnOrName, formats: Iterable[str] = DEFAULT_TS_FORMATS) -> Column:
    """Parse a timestamp trying several layouts; unparseable -> NULL.

    Text is read as UTC and turned into wall time from the count of
    microseconds, so the session's time zone and its clock changes play no part.
    A layout is tried only on text of its shape: a failed parse costs an
    exception, a look at the shape does not."""
    c = col_(c)
    c = F.when(c.startswith("Sept "), F.concat(F.lit("Sep "), F.substr(c, F.lit(6)))).otherwise(c)

    def shaped(parsed: Column, fmt: str) -> Column:
        shape = layout_shape(fmt)
        return parsed if shape is None else F.when(c.rlike(shape), parsed)

    parsed = [shaped(F.try_to_timestamp(F.concat(c, F.lit(" Z")), F.lit(f"{fmt} XXX")), fmt) for fmt in formats]
    parsed += [shaped(F.try_to_timestamp(c, F.lit(fmt)), fmt) for fmt in OFFSET_TS_FORMATS]
    seconds = F.unix_micros(F.coalesce(*parsed)).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def valid_minutes(c: ColumnOrName) -> Column:
    """A duration that counts: finite and non-negative, else NULL."""
    v = finite_or_null(col_(c))
    return F.when(v >= 0, v)


def any_negative(cols: Iterable[ColumnOrName]) -> Column:
    """TRUE if any column is negative; NULL terms count as FALSE (never NULL)."""
    terms = [F.coalesce(col_(c) < 0, F.lit(False)) for c in cols]
    return reduce(lambda a, b: a | b, terms, F.lit(False))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises)."""
    return F.try_divide(col_(num), col_(den))


def r2(c: ColumnOrName, digits: int = 2) -> Column:
    """Half-up rounding (SQL ROUND)."""
    return F.round(col_(c), digits)


def pct_diff(actual: ColumnOrName, expected: ColumnOrName) -> Column:
    """|actual - expected| / expected * 100, 0 when expected <= 0 or missing."""
    a, e = col_(actual), col_(expected)
    return F.when(e > 0, F.abs(a - e) / e * 100).otherwise(F.lit(0.0))


def abs_diff_or_zero(actual: ColumnOrName, expected: ColumnOrName) -> Column:
    """|actual - expected|, 0 when expected is missing."""
    a, e = col_(actual), col_(expected)
    return F.when(e.isNull(), F.lit(0.0)).otherwise(F.abs(a - e))


def fmt2(c: ColumnOrName) -> Column:
    """Fixed two-decimal text; NULL stays NULL (``format_string`` would print 'nu')."""
    c = col_(c)
    return F.when(c.isNotNull(), F.format_string("%.2f", c))
