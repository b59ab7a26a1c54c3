"""Exact deduplication by content sort (DataFrame operations only).

Normalised texts are range-partitioned by sampled splitters, each range is
sorted (externally: Spark's sorter spills), equal texts then stand side by
side, and a window whose partition key is the whole text compares every row
with its neighbour byte by byte.

* Splitters are taken over the first ``PREFIX`` characters plus a 64-bit hash
  of the whole text.  The sampled keys that reach the driver thus have a fixed
  size however long texts are, and texts that share a long header still spread
  over many ranges.  The hash only places rows; equality is always decided on
  the whole text.
* A text held by more than ``1/(4 x shuffle partitions)`` of all rows is hot.
  Hot texts are found first by counting hashes (partially aggregated: eight
  bytes a row and no text moves), there can be at most ``4 x shuffle
  partitions`` of them (the proven bound of the only broadcast), and their rows
  are dealt in turn into parts below that share, whatever their ids; the deal is
  fixed in a written copy, so that a lost task cannot deal them anew.  Each part is
  deduplicated like any other text; the parts' leaders, a bounded number per text,
  are then compared again, in full, and merged.

Defined cases: a null text counts as empty; empty texts are equal to each
other; a null id is smaller than any other when the largest stays and larger
when the smallest stays (it stays only if all ids are null); of repeated rows with one id and one text exactly one
stays; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import ascii_lower, shuffle_width, table
from orderlens.plans.materialize import materialize

PREFIX = 64
MIN_HOT_ROWS = 64


def _salted(base: DataFrame, limit: int) -> DataFrame:
    """``base`` (doc_id, norm, h, salt -1) with the part each row is in as ``salt`` for texts of more than ``limit`` rows;
    ``base`` itself if there is no such text."""
    hot = materialize(base.groupBy("h").count().where(F.col("count") > limit)
                      .select("h", F.ceil(F.col("count") / limit).alias("salts")), "dedup_hot")
    if hot.isEmpty():
        return base
    marked = base.join(F.broadcast(hot), "h", "left")
    dealt = F.pmod(F.monotonically_increasing_id(), F.col("salts")).cast("bigint")
    warm = materialize(marked.where("salts IS NOT NULL").select("doc_id", "norm", "h", dealt.alias("salt")), "dedup_hot_rows")
    return marked.where("salts IS NULL").select("doc_id", "norm", "h", "salt").unionByName(warm)


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       keep: str = "smallest") -> DataFrame:
    """One row per input row: its id, the id that stays of its group of equal
    texts (``keep``: "smallest" or "largest"), the group's size, whether this
    row stays, and the SHA-256 of the normalised text."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"),
                       ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    base = base.withColumn("h", F.xxhash64("norm")).withColumn("salt", F.lit(-1).cast("bigint"))
    limit = max(MIN_HOT_ROWS, docs.count() // (4 * shuffle_width(spark)))
    salted = _salted(base, limit)
    rows = salted.withColumn("prefix", F.substring("norm", 1, PREFIX))
    # a salt that is the same for all would be taken for a constant, and no longer for a part of the windows' key
    ranges = ["prefix", "h", *(["salt"] if salted is not base else [])]

    def best(c: str):
        return F.col(c).desc_nulls_last() if keep == "largest" else F.col(c).asc_nulls_last()

    equal = Window.partitionBy("prefix", "h", "salt", "norm")
    ordered = equal.orderBy(best("doc_id"))
    parts = (rows.select("doc_id", "norm", "prefix", "h", "salt")
             .repartitionByRange(*ranges)
             .select("doc_id", "norm", "h", "salt",
                     F.row_number().over(ordered).alias("place"),
                     F.first("doc_id").over(ordered).alias("part_keep"),
                     F.count(F.lit(1)).over(equal).alias("part_rows"))
             .select("doc_id", "h", "salt", "place", "part_keep", "part_rows",
                     F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"),
                     F.when((F.col("salt") >= 0) & (F.col("place") == 1), F.col("norm")).alias("leader")))
    parts = materialize(parts, "dedup_parts")
    cold = parts.where("salt < 0").select(
        "doc_id", F.col("part_keep").alias("keep_id"), F.col("part_rows").alias("group_size"),
        (F.col("place") == 1).alias("kept"), "text_sha256")
    same = Window.partitionBy("h", "leader")
    merged = (parts.where("salt >= 0 and place = 1")
              .select("h", "salt", "text_sha256",
                      F.first("part_keep").over(same.orderBy(best("part_keep"), "salt")).alias("keep_id"),
                      F.sum("part_rows").over(same).alias("group_size"),
                      (F.row_number().over(same.orderBy(best("part_keep"), "salt")) == 1).alias("wins")))
    warm = (parts.where("salt >= 0").join(merged, ["h", "salt", "text_sha256"])
            .select("doc_id", "keep_id", "group_size",
                    ((F.col("place") == 1) & F.col("wins")).alias("kept"), "text_sha256"))
    return cold.unionByName(warm)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort_dedup(table(spark, sf_dir, "documents"), keep="largest")


SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
