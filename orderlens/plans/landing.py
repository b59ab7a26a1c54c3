"""Land the derived order tables once per application, then scan them.

The original workflow builds its typed columnar table once (CTAS) and runs
every query against it.  Here the typed order table and the dirty staging
table are derived from the driver tables by one Spark job each, written as
Parquet under the shared work folder (``spark.checkpoint.dir``), and every
later query of the same application scans the written copy: the 4-table
join runs once, not once per query, and the copy survives executor loss.

A landed copy is keyed by the Spark application, the input folder, and the number and
an order-free hash of path, length and modification time of the input files as Spark's
own reader lists them (so on any storage; one row reaches the driver): a rewritten input is landed anew.  The write is
direct; the plan that derives the table runs exactly once.
"""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import scratch_path
from orderlens.sources.fixtures import food_orders, food_orders_raw
from orderlens.sources.reports import file_usage

_LANDED: dict[tuple, str] = {}
_LOCKS: defaultdict[tuple, threading.Lock] = defaultdict(threading.Lock)
_INPUTS = ("orders", "customer", "nation", "region")


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    files = file_usage(spark, [f"{sf_dir}/{t}.parquet" for t in _INPUTS])
    one = F.xxhash64("path", "bytes", "modified")
    return tuple(files.agg(F.count(F.lit(1)), F.bit_xor(one), F.sum("bytes")).first())


def write_table(df: DataFrame, name: str) -> str:
    """Write ``df`` as Parquet under the shared work folder; return the path."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return path


def _land(spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, name, sf_dir, _fingerprint(spark, sf_dir))
    with _LOCKS[key]:  # one writer a table; other tables land meanwhile
        path = _LANDED.get(key)
        if path is None:
            path = write_table(build(spark, sf_dir), name)
            _LANDED[key] = path
    return spark.read.parquet(path)


def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed 31-column order table, landed once per application."""
    return _land(spark, sf_dir, "orders_typed", food_orders)


def raw_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty 29-column string staging table, landed once per application."""
    return _land(spark, sf_dir, "orders_raw", food_orders_raw)


def restaurant_metrics(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Per-restaurant metrics (one row per key), aggregated once per
    application from the landed typed table; every scorecard-derived report
    reads this copy instead of re-aggregating the fact table."""
    from orderlens.operators import performance as perf

    return _land(spark, sf_dir, f"metrics_{key}",
                 lambda s, d: perf.restaurant_metrics(typed_orders(s, d), key))
