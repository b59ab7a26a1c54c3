"""Which of several input paths is there, asked of the paths' own file systems.

A path may be of any scheme that Spark reads, and may hold a glob.  Only the
file system's listing is used: nothing is opened, and nothing local is assumed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder (for a glob: any) is at ``path``."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(there)
    return found is not None and len(found) > 0


def first_existing(spark: SparkSession, *paths: str) -> str | None:
    """The first of the paths that exists; None if none does."""
    return next((p for p in paths if exists(spark, p)), None)


def resolve(spark: SparkSession, *paths: str) -> str:
    """The first of the paths that exists, or an error that names them all."""
    found = first_existing(spark, *paths)
    if found is None:
        raise FileNotFoundError(f"none of these paths exists: {', '.join(paths)}")
    return found
