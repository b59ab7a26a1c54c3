"""Tab-separated metric text: the plain roll-up output and the ``key=value``
variant, as sink and source.

Reading is a narrow projection of ``spark.read.text`` (one line = one
record): lines and cells are stripped of white space, tabs included, and
empty cells before the metrics ignored; blank lines and lines without a
prefix cell are skipped; one prefix cell is the restaurant name, two are id and name; metric cells are
``key=value`` (split once on the first ``=``, the last cell of a key wins).
Values that do not parse as numbers become NULL (one type per column).

Ids and names may hold any character: a tab, a line end, an equals sign and a
backslash are written as ``\\t``, ``\\n``, ``\\r``, ``\\e`` and two backslashes, and
read back; other backslashes are read as they stand.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.expr import fmt2, strip_ws, to_double

METRIC_KEYS = ("order_count", "total_revenue", "avg_order_value", "avg_kpt", "avg_rider_wait")
PLAIN_COLUMNS = ("restaurant_id", "restaurant_name", "order_count", "total_revenue",
                 "avg_order_value", "avg_kpt", "avg_rider_wait")


# a character and how it is written in an id or a name; the backslash first
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("=", "\\e"))


def escaped(c: Column) -> Column:
    for char, written in ESCAPES:
        c = F.replace(c, F.lit(char), F.lit(written))
    return c


def unescaped(c: Column) -> Column:
    """Two backslashes are set aside first, so that what stands behind them is not taken for an escape."""
    c = F.replace(c, F.lit(ESCAPES[0][1]), F.lit("\0"))
    for char, written in ESCAPES[1:]:
        c = F.replace(c, F.lit(written), F.lit(char))
    return F.replace(c, F.lit("\0"), F.lit("\\"))


def _has_key(key: str):
    prefix = key + "="
    return lambda p: p.startswith(prefix)


def read_kv_tsv(spark: SparkSession, path: str | list[str], keys: Sequence[str] = METRIC_KEYS) -> DataFrame:
    lines = spark.read.text(path).select(strip_ws("value").alias("line"))
    parts = (lines.filter(F.length("line") > 0)
             .select(F.filter(F.transform(F.split("line", "\t", -1), strip_ws), lambda x: F.length(x) > 0).alias("p")))
    parts = parts.select(F.filter("p", lambda x: x.contains("=")).alias("kv"),
                         F.filter("p", lambda x: ~x.contains("=")).alias("prefix"))
    parts = parts.filter(F.size("prefix") > 0)
    two = F.size("prefix") >= 2
    cols = [unescaped(F.when(two, F.element_at("prefix", 1))).alias("restaurant_id"),
            unescaped(F.when(two, F.element_at("prefix", 2)).otherwise(F.element_at("prefix", 1))).alias("restaurant_name")]
    for k in keys:
        hit = F.filter("kv", _has_key(k))
        raw = F.when(F.size(hit) > 0, F.element_at(F.split(F.element_at(hit, -1), "=", 2), 2))
        cols.append(to_double(raw).alias(k))
    return parts.select(*cols)


def read_plain_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The plain roll-up text: id, name, count, revenue, AOV, KPT, wait.

    Missing cells at the end are NULL; an empty name is NULL, as it was written."""
    p = spark.read.text(path).filter(F.length(strip_ws("value")) > 0).select(F.split("value", "\t", -1).alias("p"))
    cell = lambda i: F.try_element_at("p", F.lit(i))
    text = lambda i: unescaped(F.when(F.length(cell(i)) > 0, cell(i)))
    num = lambda i: to_double(cell(i))
    return p.select(text(1).alias("restaurant_id"), text(2).alias("restaurant_name"),
                    cell(3).try_cast("bigint").alias("order_count"),
                    num(4).alias("total_revenue"), num(5).alias("avg_order_value"),
                    num(6).alias("avg_kpt"), num(7).alias("avg_rider_wait"))


def to_tsv_lines(perf: DataFrame, style: str = "plain") -> DataFrame:
    """One ``value`` text line per roll-up row; numbers as fixed 2-decimal text.

    ``plain``: id, name, count, revenue, AOV, KPT, wait.  ``kv``: id, name,
    then ``key=value`` cells.  A NULL metric is an empty cell / omitted; a NULL
    id or name is an empty cell, so the other cells keep their places."""
    lead = [F.coalesce(escaped(F.col(c)), F.lit("")) for c in ("restaurant_id", "restaurant_name") if c in perf.columns]
    metrics = [F.col("order_count").cast("string").alias("order_count")] + [
        fmt2(c).alias(c) for c in METRIC_KEYS[1:]]
    if style == "plain":
        cells = lead + [F.coalesce(m, F.lit("")) for m in metrics]
    elif style == "kv":
        cells = lead + [F.when(m.isNotNull(), F.concat(F.lit(k + "="), m)) for k, m in zip(METRIC_KEYS, metrics)]
    else:
        raise ValueError("style is 'plain' or 'kv'")
    return perf.select(F.concat_ws("\t", *cells).alias("value"))


def write_tsv(perf: DataFrame, path: str, style: str = "plain", mode: str = "overwrite") -> None:
    to_tsv_lines(perf, style).write.mode(mode).text(path)
