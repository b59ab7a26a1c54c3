"""Cleaning: header renaming, missing tokens, whitespace, numeric coercion,
timestamp parsing, negative-amount flag, typed table projection.

Every step is a narrow per-row projection (no shuffle): cleaning a 100 TB
staging table is one map-only pass.  Missing stays missing: nothing is
filled with 0 and no row is dropped.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.expr import (
    DEFAULT_TS_FORMATS, any_negative, finite_or_null, is_missing, parse_number, strip_ws, to_double, to_ts,
)
from orderlens.schema import COLUMNS, FINANCIAL, HEADER_TO_COLUMN, MISSING_TOKENS, NUMERIC


def rename_headers(df: DataFrame, mapping: dict[str, str] = HEADER_TO_COLUMN) -> DataFrame:
    """CSV headers -> SQL names; unknown columns keep their name."""
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def to_headers(df: DataFrame) -> DataFrame:
    """SQL names -> CSV headers (for the clean CSV sink)."""
    inv = {v: k for k, v in HEADER_TO_COLUMN.items()}
    return df.select(*[F.col(c).alias(inv.get(c, c)) for c in df.columns])


def _string_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def null_missing_tokens(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS,
                        cols: Iterable[str] | None = None) -> DataFrame:
    """Reader semantics of the original pipeline: missing spellings -> NULL."""
    cols = set(cols if cols is not None else _string_cols(df))
    return df.select(*[F.when(~is_missing(c, tokens), F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def strip_strings(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Strip leading/trailing whitespace of every string column; NULL kept."""
    cols = set(cols if cols is not None else _string_cols(df))
    return df.select(*[strip_ws(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def coerce_numeric(df: DataFrame, cols: Iterable[str] = NUMERIC) -> DataFrame:
    """Numeric columns -> DOUBLE; invalid text, NaN, infinities -> NULL."""
    cols = set(c for c in cols if c in df.columns)
    return df.select(*[to_double(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def parse_timestamp(df: DataFrame, col: str = "order_placed_at", raw_col: str = "order_placed_at_raw",
                    formats: Iterable[str] = DEFAULT_TS_FORMATS) -> DataFrame:
    """Keep the original text in ``raw_col``; parse ``col`` (bad -> NULL)."""
    out = [to_ts(col, formats).alias(col) if c == col else F.col(c) for c in df.columns if c != raw_col]
    return df.select(*out, F.col(col).cast("string").alias(raw_col))


def negative_flag(df: DataFrame, cols: Iterable[str] = FINANCIAL,
                  flag: str = "flag_negative_financial") -> DataFrame:
    """Flag (never drop) rows with a negative amount in any financial column."""
    present = [c for c in cols if c in df.columns]
    return df.withColumn(flag, any_negative(present))


def cleaned_value(c: str, formats: Iterable[str] = DEFAULT_TS_FORMATS,
                  tokens: Sequence[str] = MISSING_TOKENS):
    """The clean value of raw text column ``c`` as one expression (the same
    rules ``clean_orders`` applies step by step)."""
    s = strip_ws(F.when(~is_missing(c, tokens), F.col(c).cast("string")))
    if c in NUMERIC:
        return to_double(s)
    if c == "order_placed_at":
        return to_ts(s, formats)
    return s


def clean_orders(staging: DataFrame, formats: Iterable[str] = DEFAULT_TS_FORMATS,
                 tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Raw 29-column strings -> the 31-column clean table.

    missing tokens -> NULL, strip, coerce the 12 numeric columns, parse the
    timestamp (raw text kept), flag negative amounts; positional order kept.
    One map-only pass in three projections: clean text once per cell, parse
    the typed columns from it once, then derive the flag from typed values
    (each stage reads the previous one's columns instead of re-deriving)."""
    df = staging
    if any(c in HEADER_TO_COLUMN and c not in COLUMNS for c in df.columns):
        df = rename_headers(df)
    strings = set(_string_cols(df))
    text = df.select(*[strip_ws(F.when(~is_missing(c, tokens), F.col(c))).alias(c) if c in strings
                       else F.col(c) for c in df.columns])
    parsed = text.select(*[
        parse_number(F.col(c).cast("string")).alias(c) if c in NUMERIC
        else to_ts(c, formats).alias(c) if c == "order_placed_at"
        else F.col(c) for c in text.columns],
        F.col("order_placed_at").cast("string").alias("order_placed_at_raw"))
    typed = parsed.select(*[finite_or_null(F.col(c)).alias(c) if c in NUMERIC else F.col(c)
                            for c in parsed.columns])
    df = negative_flag(typed)
    ordered = [c for c in COLUMNS if c in df.columns] + [c for c in df.columns if c not in COLUMNS]
    return df.select(*ordered)


def type_orders(staging31: DataFrame, formats: Iterable[str] = DEFAULT_TS_FORMATS) -> DataFrame:
    """All-string 31-column staging -> typed table (the CTAS projection).

    Numeric columns use ``try_cast`` semantics (never raise under ANSI);
    the timestamp is parsed; the flag text becomes BOOLEAN."""
    out = []
    for c in staging31.columns:
        if c in NUMERIC:
            out.append(to_double(c).alias(c))
        elif c == "order_placed_at":
            out.append(to_ts(c, formats).alias(c))
        elif c == "flag_negative_financial":
            out.append(F.lower(strip_ws(c)).try_cast("boolean").alias(c))
        else:
            out.append(F.col(c))
    return staging31.select(*out)


def reject_empty_keys(df: DataFrame, key: str = "restaurant_id") -> DataFrame:
    """Rows whose (trimmed) key is NULL or empty belong to no restaurant."""
    return df.filter(F.length(strip_ws(key)) > 0)


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column subset for display (missing names are an error)."""
    return df.select(*cols)


def record_before_after(raw: DataFrame, clean: DataFrame, key: str, value: str) -> DataFrame:
    """One record side by side: (column, raw_value, clean_value) for ``key = value``.

    Both inputs are filtered on the key before the join, so only the chosen
    record is shuffled."""
    r = raw.filter(F.col(key) == value)
    c = clean.filter(F.col(key) == value)
    cols = [x for x in raw.columns if x in clean.columns]
    rr = r.select(F.explode(F.array(*[F.struct(F.lit(x).alias("column"), F.col(x).cast("string").alias("v"))
                                      for x in cols])).alias("e")).select("e.column", F.col("e.v").alias("raw_value"))
    cc = c.select(F.explode(F.array(*[F.struct(F.lit(x).alias("column"), F.col(x).cast("string").alias("v"))
                                      for x in cols])).alias("e")).select("e.column", F.col("e.v").alias("clean_value"))
    return rr.join(cc, "column", "full")
