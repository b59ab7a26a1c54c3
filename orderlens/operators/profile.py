"""Data-quality profiling of an order table; every report is a DataFrame.

All per-column reports are ONE aggregate pass over the table (a wide
``agg`` of one expression per column, partially aggregated per task),
unpivoted afterwards into (column, ...) rows — never one job per column.
Value-level reports explode (column, value) pairs on the map side and
aggregate them with map-side combine, so a value held by a third of all
rows costs one partial row per task.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.functions.expr import (
    DEFAULT_TS_FORMATS, finite_or_null, is_missing, parse_number, strip_ws, to_double, to_ts,
)
from orderlens.schema import CATEGORICAL, MISSING_TOKENS, NUMERIC, STATUS_DEPENDENT, TEXT


def _present(cols: Iterable[str], df: DataFrame) -> list[str]:
    return [c for c in cols if c in df.columns]


def _unpivot_row(one_row: DataFrame, fields: dict[str, list[str]], cols: list[str]) -> DataFrame:
    """Turn a one-row wide aggregate into one row per column.

    ``fields`` maps output field -> list of wide column names (aligned with
    ``cols``)."""
    structs = [F.struct(F.lit(c).alias("column"),
                        *[F.col(names[i]).alias(f) for f, names in fields.items()])
               for i, c in enumerate(cols)]
    return one_row.select(F.inline(F.array(*structs)))


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def schema_check(spark: SparkSession, actual: Sequence[str], expected: Sequence[str]) -> DataFrame:
    """One row per name: ok / missing / unexpected / duplicate (metadata only)."""
    seen: dict[str, int] = {}
    for c in actual:
        seen[c] = seen.get(c, 0) + 1
    rows = [(c, "ok" if c in seen else "missing") for c in expected]
    rows += [(c, "unexpected") for c in dict.fromkeys(actual) if c not in expected]
    rows += [(c, "duplicate") for c, n in seen.items() if n > 1]
    return spark.createDataFrame(rows, "column string, status string")


def schema_check_by_file(headers: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(file, header) rows -> (file, column, status) as ``schema_check`` has it, and ``misplaced`` for a name that is
    there once but not where it is expected (columns are read by position)."""
    want, have = F.array(*map(F.lit, expected)), F.col("header")
    times = lambda c: F.size(F.filter(have, lambda h: h == c))
    entry = lambda c, status: F.struct(c.alias("column"), status.alias("status"))
    placed = lambda c, i: F.coalesce(F.get(have, i) == c, F.lit(False))
    known = F.transform(want, lambda c, i: entry(c, F.when(times(c) == 0, "missing").when((times(c) == 1) & ~placed(c, i), "misplaced")
                                                 .otherwise("ok")))
    other = F.transform(F.array_except(have, want), lambda c: entry(c, F.lit("unexpected")))
    twice = F.transform(F.filter(F.array_distinct(have), lambda c: times(c) > 1), lambda c: entry(c, F.lit("duplicate")))
    return headers.select("file", F.inline(F.concat(known, other, twice)))


def column_types(df: DataFrame) -> DataFrame:
    """(column, dtype) as Spark reports them."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def missing_report(df: DataFrame, tokens: Sequence[str] | None = MISSING_TOKENS,
                   top: int | None = None) -> DataFrame:
    """Per column: missing count, percent (2 dp), type; most missing first.

    On raw text, the reader's missing spellings count as missing."""
    cols = df.columns
    dtypes = dict(df.dtypes)

    def miss(c):
        return is_missing(c, tokens) if (tokens is not None and dtypes[c] == "string") else F.col(c).isNull()

    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.sum(miss(c).cast("long")).alias(f"_m{i}") for i, c in enumerate(cols)])
    long = _unpivot_row(wide, {"missing_count": [f"_m{i}" for i in range(len(cols))],
                               "_n": ["_n"] * len(cols)}, cols)
    types = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(dtypes[c]))])
    out = (long.select("column", F.coalesce("missing_count", F.lit(0)).alias("missing_count"),
                       F.round(F.try_divide(F.col("missing_count") * 100.0, F.col("_n")), 2).alias("missing_pct"),
                       types[F.col("column")].alias("dtype"))
           .orderBy(F.desc("missing_count"), F.asc("column")))
    return out.limit(top) if top else out


def missing_rate_by_status(df: DataFrame, cols: Sequence[str] = STATUS_DEPENDENT,
                           status: str = "order_status", tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Share of missing values per order status for the status-dependent columns (3 dp)."""
    cols = _present(cols, df)
    dtypes = dict(df.dtypes)
    miss = {c: (is_missing(c, tokens) if dtypes[c] == "string" else F.col(c).isNull()) for c in cols}
    g = (df.filter(~is_missing(status, tokens)).groupBy(status)
         .agg(*[F.round(F.avg(miss[c].cast("double")), 3).alias(f"_r{i}") for i, c in enumerate(cols)]))
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"_r{i}").alias("missing_rate")) for i, c in enumerate(cols)]
    return g.select(status, F.inline(F.array(*structs)))


def numeric_audit(df: DataFrame, cols: Sequence[str] = NUMERIC,
                  tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Per numeric column: values present but not numeric, min, max, negatives.

    Each cell is parsed once in a projection; the aggregate then reads plain
    columns (the parse is not repeated for every statistic)."""
    cols = _present(cols, df)
    cells = df.select(*[c for i, col in enumerate(cols) for c in (
        (~is_missing(F.col(col).cast("string"), tokens)).alias(f"_p{i}"),
        parse_number(strip_ws(F.col(col).cast("string"))).alias(f"_x{i}"))])
    cells = cells.select(*[c for i in range(len(cols)) for c in (
        (F.col(f"_p{i}") & F.col(f"_x{i}").isNull()).alias(f"_bad{i}"),
        finite_or_null(F.col(f"_x{i}")).alias(f"_v{i}"))])
    aggs = []
    for i in range(len(cols)):
        v = F.col(f"_v{i}")
        aggs += [F.sum(F.col(f"_bad{i}").cast("long")).alias(f"_x{i}"),
                 F.min(v).alias(f"_lo{i}"), F.max(v).alias(f"_hi{i}"),
                 F.sum((v < 0).cast("long")).alias(f"_neg{i}")]
    wide = cells.agg(*aggs)
    n = range(len(cols))
    return _unpivot_row(wide, {"non_numeric": [f"_x{i}" for i in n], "min": [f"_lo{i}" for i in n],
                               "max": [f"_hi{i}" for i in n], "negatives": [f"_neg{i}" for i in n]}, cols) \
        .select("column", F.coalesce("non_numeric", F.lit(0)).alias("non_numeric"), "min", "max",
                F.coalesce("negatives", F.lit(0)).alias("negatives"))


def coercion_failures(df: DataFrame, cols: Sequence[str] = NUMERIC,
                      tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Per numeric column: values that coercion turns into NULL."""
    return numeric_audit(df, cols, tokens).select("column", F.col("non_numeric").alias("failed"))


def rating_out_of_range(df: DataFrame, col: str = "rating", lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """Ratings outside [lo, hi] (after numeric coercion)."""
    r = to_double(F.col(col))
    return df.agg(F.sum(((r < lo) | (r > hi)).cast("long")).alias("out_of_range"))


def timestamp_audit(df: DataFrame, col: str = "order_placed_at",
                    formats: Iterable[str] = DEFAULT_TS_FORMATS,
                    tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Present, parsed and unparseable counts, and the parsed range."""
    raw = F.col(col).cast("string")
    present = ~is_missing(raw, tokens)
    ts = to_ts(strip_ws(raw), formats)
    return df.agg(F.sum(present.cast("long")).alias("present"),
                  F.count(ts).alias("parsed"),
                  F.sum((present & ts.isNull()).cast("long")).alias("unparseable"),
                  F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def timestamp_samples(df: DataFrame, col: str = "order_placed_at", n: int = 10,
                      order_by: str = "order_id") -> DataFrame:
    """The first ``n`` present raw values in ``order_by`` order (a preview)."""
    return (df.filter(~is_missing(col)).select(order_by, col)
            .orderBy(order_by).limit(n))


def _value_pairs(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] | None) -> DataFrame:
    """(column, value) for every cell of ``cols``; missing spellings -> NULL."""
    def v(c):
        s = F.col(c).cast("string")
        return F.when(~is_missing(s, tokens), s) if tokens is not None else s
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), v(c).alias("value")) for c in cols])))


def categorical_top(df: DataFrame, cols: Sequence[str] = CATEGORICAL, k: int = 15,
                    tokens: Sequence[str] | None = MISSING_TOKENS) -> DataFrame:
    """Per column, the k most frequent values (NULL counted as a value).

    ``row_number() <= k`` over ``partitionBy(column)`` plans a partial
    per-task group limit before the shuffle, so at most k rows per task and
    column reach the final window, whatever a column's cardinality."""
    cols = _present(cols, df)
    counts = _value_pairs(df, cols, tokens).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    return (counts.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None,
                    tokens: Sequence[str] | None = MISSING_TOKENS, approximate: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Number of distinct non-missing values per column.

    Exact by default: (column, value) pairs are de-duplicated per task, then
    shuffled and counted, so an id-like column ships its distinct values.
    ``approximate`` instead keeps one HyperLogLog sketch per column in a
    single wide aggregate (relative error ``rsd``): no value is shuffled."""
    cols = list(cols) if cols is not None else df.columns
    if approximate:
        def v(c):
            s = F.col(c).cast("string")
            return F.when(~is_missing(s, tokens), s) if tokens is not None else s
        wide = df.agg(*[F.approx_count_distinct(v(c), rsd).alias(f"_d{i}") for i, c in enumerate(cols)])
        return _unpivot_row(wide, {"distinct_values": [f"_d{i}" for i in range(len(cols))]}, cols)
    return (_value_pairs(df, cols, tokens).groupBy("column")
            .agg(F.count_distinct("value").alias("distinct_values")))


def text_audit(df: DataFrame, cols: Sequence[str] = TEXT) -> DataFrame:
    """Rows whose text holds a comma / a double quote, per text column."""
    cols = _present(cols, df)
    aggs = []
    for i, c in enumerate(cols):
        s = F.col(c).cast("string")
        aggs += [F.sum(F.coalesce(s.contains(","), F.lit(False)).cast("long")).alias(f"_c{i}"),
                 F.sum(F.coalesce(s.contains('"'), F.lit(False)).cast("long")).alias(f"_q{i}")]
    n = range(len(cols))
    return _unpivot_row(df.agg(*aggs), {"with_comma": [f"_c{i}" for i in n],
                                        "with_quote": [f"_q{i}" for i in n]}, cols)


def flagged_rows(df: DataFrame, flag: str = "flag_negative_financial") -> DataFrame:
    """Rows per flag value."""
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("rows"))


def cleaning_diff(raw: DataFrame, formats: Iterable[str] = DEFAULT_TS_FORMATS,
                  tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Before/after comparison for the whole table: per column, the cells
    whose text cleaning stripped and the cells it turned into NULL.

    Cleaning is a per-row projection: each cell is tested and stripped once,
    parsed once from the stripped text, and the marks are then counted in one
    aggregate pass (no join; one partial row a task is shuffled)."""
    cols = raw.columns
    n = range(len(cols))
    text = raw.select(*[F.col(c).cast("string").alias(f"_r{i}") for i, c in enumerate(cols)])
    text = text.select("*", *[F.when(~is_missing(f"_r{i}", tokens), strip_ws(f"_r{i}")).alias(f"_t{i}") for i in n])

    def value(i: int, c: str):
        t = F.col(f"_t{i}")
        return to_double(t) if c in NUMERIC else to_ts(t, formats) if c == "order_placed_at" else t

    marks = text.select(*[m for i, c in enumerate(cols) for m in (
        (F.col(f"_t{i}") != F.col(f"_r{i}")).alias(f"_m{i}"),
        (F.col(f"_r{i}").isNotNull() & value(i, c).isNull()).alias(f"_n{i}"))])
    aggs = [a for i in n for a in (F.count_if(f"_m{i}").alias(f"_s{i}"), F.count_if(f"_n{i}").alias(f"_z{i}"))]
    return _unpivot_row(marks.agg(*aggs), {"stripped_cells": [f"_s{i}" for i in n],
                                         "nulled_cells": [f"_z{i}" for i in n]}, cols)
