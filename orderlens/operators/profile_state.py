"""A profile that is kept up to date period by period.

Each period's orders leave one small state row for each column: how many rows,
missing and non-numeric cells, negatives, minimum and maximum, cells with a comma
or a quote, and a HyperLogLog sketch of the values; and for the categorical columns
the number of rows of each value.  States add up: counts sum, minima and maxima
compare, sketches unite (``hll_union_agg``).  So a new day is profiled by reading
that day alone, a day read again replaces its state, and the whole table's report
is an aggregate over states.

Everything but the number of distinct values equals a pass over the whole table;
that number has a relative standard error of ``standard_error(lg_k)`` (1.6 % for
the default), whichever way the orders were split into periods.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.functions.expr import DEFAULT_TS_FORMATS, finite_or_null, is_missing, parse_number, strip_ws, to_ts
from orderlens.operators.profile import _present
from orderlens.schema import CATEGORICAL, MISSING_TOKENS, NUMERIC, TEXT

PERIOD = "period"
LG_K = 12
COUNTS = ("rows", "missing", "non_numeric", "negatives", "with_comma", "with_quote")


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def period_of(at: str, grain: str, formats: Iterable[str] = DEFAULT_TS_FORMATS) -> Column:
    """First day of the order's period; NULL where the time cannot be read."""
    return F.trunc(to_ts(strip_ws(F.col(at).cast("string")), formats).cast("date"), grain) if grain != "day" \
        else to_ts(strip_ws(F.col(at).cast("string")), formats).cast("date")


def column_states(df: DataFrame, at: str = "order_placed_at", grain: str = "day",
                  tokens: Sequence[str] = MISSING_TOKENS, lg_k: int = LG_K) -> DataFrame:
    """(period, column, rows, missing, non_numeric, negatives, with_comma, with_quote, min, max, values) of raw text orders.

    One aggregate over one scan; cells are parsed once, in the projection below it."""
    cols = df.columns
    numeric, text = set(_present(NUMERIC, df)), set(_present(TEXT, df))
    cells = [period_of(at, grain).alias("_period")]
    for i, c in enumerate(cols):
        value = F.col(c).cast("string")
        cells.append(F.when(~is_missing(value, tokens), value).alias(f"_s{i}"))
        if c in numeric:
            cells.append(parse_number(strip_ws(value)).alias(f"_x{i}"))
        if c in text:
            cells.append(value.alias(f"_t{i}"))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        s = F.col(f"_s{i}")
        aggs += [F.count_if(s.isNull()).alias(f"_m{i}"), F.hll_sketch_agg(s, F.lit(lg_k)).alias(f"_h{i}")]
        if c in numeric:
            x, v = F.col(f"_x{i}"), finite_or_null(F.col(f"_x{i}"))
            aggs += [F.count_if(s.isNotNull() & x.isNull()).alias(f"_b{i}"), F.count_if(v < 0).alias(f"_n{i}"),
                     F.min(v).alias(f"_lo{i}"), F.max(v).alias(f"_hi{i}")]
        if c in text:
            aggs += [F.count_if(F.col(f"_t{i}").contains(mark)).alias(f"_{name}{i}") for mark, name in ((",", "c"), ('"', "q"))]
    wide = df.select(*cells).groupBy("_period").agg(*aggs)

    def state(i: int, c: str) -> Column:
        have = lambda name, there, kind: (F.col(f"_{name}{i}") if there else F.lit(None)).cast(kind)
        return F.struct(
            F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(f"_m{i}").alias("missing"),
            have("b", c in numeric, "bigint").alias("non_numeric"), have("n", c in numeric, "bigint").alias("negatives"),
            have("c", c in text, "bigint").alias("with_comma"), have("q", c in text, "bigint").alias("with_quote"),
            have("lo", c in numeric, "double").alias("min"), have("hi", c in numeric, "double").alias("max"),
            F.col(f"_h{i}").alias("values"))

    return wide.select(F.col("_period").alias(PERIOD), F.inline(F.array(*[state(i, c) for i, c in enumerate(cols)])))


def value_states(df: DataFrame, cols: Sequence[str] = CATEGORICAL, at: str = "order_placed_at", grain: str = "day",
                 tokens: Sequence[str] | None = MISSING_TOKENS) -> DataFrame:
    """(period, column, value, rows): how often each value of the categorical columns occurs, NULL a value too."""
    cols = _present(cols, df)
    name = "_period_of_order"
    pairs = df.withColumn(name, period_of(at, grain)).select(
        F.col(name).alias(PERIOD), F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.when(
            ~is_missing(F.col(c).cast("string"), tokens), F.col(c).cast("string")).alias("value") if tokens is not None
            else F.col(c).cast("string").alias("value")) for c in cols])))
    return pairs.groupBy(PERIOD, "column", "value").agg(F.count(F.lit(1)).alias("rows"))


def save_states(states: DataFrame, path: str) -> None:
    """Keep states by period; a period that is there already is replaced."""
    (states.repartition(PERIOD).write.mode("overwrite").partitionBy(PERIOD)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_profile(states: DataFrame) -> DataFrame:
    """One row a column over all periods of ``states``; ``distinct_values`` is the sketches' estimate."""
    return states.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct_values")).withColumn(
        "missing_pct", F.round(F.try_divide(F.col("missing") * 100.0, F.col("rows")), 2))


def merged_top(states: DataFrame, k: int = 15) -> DataFrame:
    """Per column the k most frequent values over all periods, as ``profile.categorical_top`` gives them."""
    counts = states.groupBy("column", "value").agg(F.sum("rows").alias("count"))
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)
