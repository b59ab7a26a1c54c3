"""Session construction and the shared work folder.

Library code never builds its own session: every operator takes a
DataFrame.  ``local_session`` is for tests, the bench and the smoke entry.
Scratch output (materialised tables, checkpoints) goes to the folder the
cluster names in ``spark.checkpoint.dir``; only when that is unset (local
runs, tests) is a fresh temporary folder chosen.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours should carry.  AQE re-plans joins and
# coalesces/splits shuffle partitions at runtime from real sizes; the skew
# rule splits an oversized join partition (one hot key) into several tasks.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def cluster_conf(input_bytes: int, executor_cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings sized from the input volume for a cluster run.

    Scan splits of ``partition_bytes``; an initial shuffle width that gives
    every core several tasks and keeps each shuffle partition near the
    advisory size, which AQE then coalesces (small stages) or splits (skew)
    from runtime statistics."""
    initial = max(2 * executor_cores, -(-input_bytes // partition_bytes))
    return {
        **SESSION_CONF,
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "orderlens", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if "spark.checkpoint.dir" not in (extra or {}):
        b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orderlens-ckpt-"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset, a
    single-process session (master ``local[...]``: tests, bench) gets a fresh
    temporary folder; on a cluster that is an error, since executors could
    not read each other's files."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        current = sc.getCheckpointDir()
        if current:
            d = os.path.dirname(current.rstrip("/"))
        elif sc.master == "local" or sc.master.startswith("local["):
            d = tempfile.mkdtemp(prefix="orderlens-ckpt-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared work folder."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
