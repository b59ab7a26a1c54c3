"""Lineage cuts for small results that several branches of a plan read.

A per-restaurant table referenced by N scalar branches would otherwise be
recomputed from the fact table N times (each branch prunes different
columns, so exchange reuse does not apply).  ``materialize`` writes it once
as a Parquet table under the shared folder named by ``spark.checkpoint.dir``
and returns a DataFrame over the written copy: the lineage is cut, the copy
survives executor loss, and — unlike an RDD checkpoint, which keeps every
shuffle partition — the write is sized by AQE, so a 25-row table is one file
and a large one is split into advisory-sized files.  ``localCheckpoint``
(executor-local) is never used.

The folder belongs to whoever set ``spark.checkpoint.dir``.  A copy that a
returned, still unread DataFrame depends on has to stay as long as that
DataFrame; a copy whose readers have all been written out is removed with
``discard``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlens.session import scratch_path


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Compute ``df`` once and return a DataFrame reading the written copy."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    copy = spark.read.parquet(path)
    copy.materialized_at = path
    return copy


def discard(copy: DataFrame) -> None:
    """Delete the written copy behind a DataFrame that ``materialize`` returned.

    Only for copies that nothing unwritten depends on any more; goes through
    the folder's own file system."""
    jvm, session = copy.sparkSession._jvm, copy.sparkSession._jsparkSession
    path = jvm.org.apache.hadoop.fs.Path(copy.materialized_at)
    path.getFileSystem(session.sessionState().newHadoopConf()).delete(path, True)
