"""JSON report sinks and the input-file usage source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report_json(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-row report document as JSON; NULL fields are kept.

    Reports are single aggregated rows, so one output file is natural."""
    report.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)


def read_report_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def file_usage(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, bytes, modified) per file under ``path`` (or several); file
    contents are never read (the binary source prunes the content column)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def usage_total(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
