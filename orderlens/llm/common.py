"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` has a byte-wise fast path and does exactly this on texts that
    are ASCII throughout (as many bytes as characters); others go through
    ``translate``, so letters outside A-Z stay as they are."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null ids count as empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(mod))
