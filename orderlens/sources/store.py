"""The typed order table kept for many readers: bucketed, by day, replaced without a gap.

*Bucketed.*  A table bucketed by restaurant and a small ``order_salt`` is
aggregated per restaurant where it lies: the roll-up's first level groups by the
bucket columns too and needs no exchange.  The salt spreads a restaurant that
holds a third of all orders over ``salts`` buckets, so that no scan task has to
read it alone; the second level merges one partial row for each salt.

*By day.*  The table is partitioned by the day of the order; ingesting replaces
the days it brings and no others (dynamic overwrite), so that a rerun of a day
leaves the same rows, and a reader of some days lists and scans those alone.

*Replaced.*  A new version is written beside the old one, and one catalog
statement turns the table to it.  Readers see the old rows or the new ones; the
old files stay until ``drop_version``.

Writes are dealt out by bucket or day through a rebalancing shuffle, which AQE
splits where a bucket or a day is large, so files have the advisory size.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALT = "order_salt"
DAY = "order_day"


def _dealt_by(df: DataFrame, by) -> DataFrame:
    """Rows of one value of ``by`` together, large values in several tasks."""
    name = f"_{uuid.uuid4().hex}"
    return df.withColumn(name, by).hint("rebalance", name).drop(name)


def save_bucketed(df: DataFrame, table: str, key: str = "restaurant_id", buckets: int = 64, salts: int = 8,
                  path: str | None = None, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table bucketed and sorted by (key, order_salt)."""
    # any even spread will do: the salt is written with its row and never computed again
    rows = df.withColumn(SALT, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    rows = _dealt_by(rows, F.pmod(F.hash(key, SALT), F.lit(buckets)))
    w = rows.write.format(fmt).mode(mode).bucketBy(buckets, key, SALT).sortBy(key, SALT)
    (w.option("path", path) if path else w).saveAsTable(table)


def with_day(orders: DataFrame, at: str = "order_placed_at", grain: str = "day") -> DataFrame:
    """``order_day``: the date of the order (of a coarser ``grain``, as month: its first day), NULL where its time is."""
    return orders.withColumn(DAY, F.date_trunc(grain, F.col(at)).cast("date"))


def ingest_days(orders: DataFrame, path: str, fmt: str = "parquet", at: str = "order_placed_at", grain: str = "day") -> None:
    """Replace the days (months, ...) that ``orders`` has rows of by these rows; others stay.

    A day is brought as a whole: rows of a day that are not in ``orders`` go."""
    rows = with_day(orders, at, grain)
    (_dealt_by(rows, F.col(DAY)).write.format(fmt).mode("overwrite").partitionBy(DAY)
     .option("partitionOverwriteMode", "dynamic").save(path))


def read_days(spark: SparkSession, path: str, first: dt.date | str | None = None, last: dt.date | str | None = None,
              fmt: str = "parquet") -> DataFrame:
    """The table, or its days from ``first`` to ``last``; either bound prunes partitions and leaves out orders without a day."""
    rows = spark.read.format(fmt).load(path)
    rows = rows.withColumn(DAY, F.col(DAY).cast("date")) if dict(rows.dtypes)[DAY] != "date" else rows
    if first is not None:
        rows = rows.where(F.col(DAY) >= F.lit(str(first)).cast("date"))
    if last is not None:
        rows = rows.where(F.col(DAY) <= F.lit(str(last)).cast("date"))
    return rows


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def replace_table(df: DataFrame, table: str, root: str, fmt: str = "parquet") -> str | None:
    """Make ``table`` hold the rows of ``df``: written to a folder of its own below ``root``, then switched to.

    Returns the folder of the version before (None for a new table).  ``df`` may
    read the table itself.  A version has the columns of the one before."""
    spark = df.sparkSession
    there = spark.catalog.tableExists(table)
    if there and spark.table(table).dtypes != df.dtypes:
        raise ValueError(f"{table} has columns {spark.table(table).dtypes}, not {df.dtypes}")
    path = f"{root.rstrip('/')}/version-{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).save(path)
    if not there:
        spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{path}'")
        return None
    before = location(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    return before


def drop_version(spark: SparkSession, path: str) -> None:
    """Delete a version's files, through the folder's own file system, when its readers are done."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
