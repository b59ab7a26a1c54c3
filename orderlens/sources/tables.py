"""Typed columnar tables and catalog helpers.

The typed order table is written once as ORC or Parquet (the analytical
copy every query scans, with filter pushdown and column pruning).  Managed
tables live in the session catalog; external ones keep their files at a
given path (dropping the table keeps the files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.schema import STAGING_31
from orderlens.sources.csv_records import files_with_line_ends


def save_typed(df: DataFrame, table: str | None = None, path: str | None = None,
               fmt: str = "orc", mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write the typed table: managed (``table``), external (``table`` +
    ``path``) or a bare path.  ``partition_by`` enables partition pruning."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table and path:
        w.option("path", path).saveAsTable(table)
    elif table:
        w.saveAsTable(table)
    elif path:
        w.save(path)
    else:
        raise ValueError("give a table name, a path, or both")


def read_typed(spark: SparkSession, path: str, fmt: str = "orc") -> DataFrame:
    return spark.read.format(fmt).load(path)


def create_database(spark: SparkSession, name: str, use: bool = True) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    if use:
        spark.catalog.setCurrentDatabase(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d.name,) for d in spark.catalog.listDatabases()], "database string")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table string, table_type string, is_temporary boolean")


def describe(df: DataFrame) -> DataFrame:
    """(column, type) of a DataFrame."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def preview(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """First ``n`` rows; ordered when ``order_by`` is given (reproducible)."""
    return (df.orderBy(order_by) if order_by else df).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def create_staging_table(spark: SparkSession, name: str, path: str,
                         schema: T.StructType = STAGING_31, multiline: bool | None = None) -> DataFrame:
    """External all-STRING staging table over a CSV folder, declared in SQL.

    The files stay where they are (dropping the table keeps them); the CSV
    dialect is the same RFC-4180 one the DataFrame reader uses.  A table
    declared over files with line ends inside quotes reads each file as a whole
    (found by a scan of the text unless ``multiline`` says so)."""
    if multiline is None:
        multiline = bool(files_with_line_ends(spark, path)[0])
    cols = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({cols}) USING csv "
              f"OPTIONS (header 'true', sep ',', quote '\"', escape '\"', nullValue '\\u0000', multiLine '{str(multiline).lower()}') "
              f"LOCATION '{path}'")
    return spark.table(name)
