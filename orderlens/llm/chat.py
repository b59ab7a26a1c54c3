"""Chat formatting with cumulative-snapshot collapse (DataFrame operations only).

A logger that saves a conversation after every turn leaves many snapshots,
each a prefix of the next.  Turns are numbered within their conversation and
hashed with their number, role and text; the running XOR of these hashes (two
independent 64-bit lanes) is the rolling hash of each turn prefix.  XOR is
distributive, so a conversation is handled as blocks of ``BLOCK`` turn numbers
whose counts and XORs are carried forward over one small row a block; no task
needs the turns of a whole conversation.

A conversation is a snapshot if its (length, rolling hash) occurs as a proper
prefix of a longer one; these go by an anti-join against the distinct prefixes.
Of equal conversations the one with the smallest id stays.  The maximal ones
are rendered as ChatML-like text in parts of ``turns_per_part`` turns, so a
part is bounded; concatenated in order, the parts are the whole rendering.

Defined cases: a null id is a conversation of its own, before all others; a null role is
"unknown", a null text is empty (and equals an empty one); turns are ordered
by (turn, role, text), null turns first, so ties have a fixed order and
repeated rows stay as repeated turns; very long texts are rendered whole; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import table
from orderlens.plans.materialize import materialize

BLOCK = 256
TURNS_PER_PART = 256


def _carried(blocks: DataFrame, value, name: str) -> DataFrame:
    """blocks (conv, block, ...) with ``value`` aggregated over the earlier blocks of the conversation."""
    before = (Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, -1))
    return blocks.withColumn(name, F.coalesce(value.over(before), F.lit(0).cast("long")))


def _on_block(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    right = blocks.withColumnsRenamed({"conv": "_conv", "block": "_block"})
    return rows.join(right, F.col("conv").eqNullSafe(F.col("_conv"))
                     & F.col("block").eqNullSafe(F.col("_block"))).drop("_conv", "_block")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv, pos (1..n), role, text and the two rolling hashes a, b of the turns up to pos."""
    rows = turns.select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.floor(F.col("turn") / BLOCK).alias("block"))
    within = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    counts = rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    rows = (_on_block(rows.withColumn("place", F.row_number().over(within)),
                      _carried(counts, F.sum("n"), "skipped").drop("n"))
            .withColumn("pos", F.col("skipped") + F.col("place")))
    rows = rows.withColumns({"va": F.xxhash64(F.lit(1), "pos", "role", "text"),
                             "vb": F.xxhash64(F.lit(2), "pos", "role", "text")})
    rows = materialize(rows.select("conv", "block", "pos", "role", "text", "va", "vb"), "chat_turns")
    sums = rows.groupBy("conv", "block").agg(F.bit_xor("va").alias("xa"), F.bit_xor("vb").alias("xb"))
    sums = _carried(_carried(sums, F.bit_xor("xa"), "ca"), F.bit_xor("xb"), "cb").drop("xa", "xb")
    running = (Window.partitionBy("conv", "block").orderBy("pos")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (_on_block(rows.withColumns({"a": F.bit_xor("va").over(running), "b": F.bit_xor("vb").over(running)}), sums)
            .withColumns({"a": F.col("a").bitwiseXOR(F.col("ca")), "b": F.col("b").bitwiseXOR(F.col("cb"))})
            .select("conv", "pos", "role", "text", "a", "b"))


def format_chats(turns: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """conv_id, part, n_parts, n_turns, chat: the maximal conversations, rendered."""
    rows = materialize(prefix_hashes(turns), "chat_prefixes")
    lengths = rows.groupBy("conv").agg(F.max("pos").alias("n")).withColumnRenamed("conv", "_conv")
    marked = rows.select("conv", "pos", "a", "b").join(lengths, F.col("conv").eqNullSafe(F.col("_conv")))
    whole = (marked.where("pos = n").groupBy("pos", "a", "b")
             .agg(F.min(F.struct("conv")).alias("id")).select("pos", "a", "b", F.col("id.conv").alias("_conv")))
    prefixes = marked.where("pos < n").select("pos", "a", "b").distinct()
    maximal = whole.join(prefixes, ["pos", "a", "b"], "left_anti").select("_conv", F.col("pos").alias("n_turns"))
    said = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    return (rows.join(maximal, F.col("conv").eqNullSafe(F.col("_conv")))
            .groupBy("conv", F.floor((F.col("pos") - 1) / turns_per_part).cast("long").alias("part"), "n_turns")
            .agg(F.array_sort(F.collect_list(F.struct("pos", said.alias("said")))).alias("parts"))
            .select(F.col("conv").alias("conv_id"), "part",
                    F.ceil(F.col("n_turns") / turns_per_part).cast("long").alias("n_parts"), "n_turns",
                    F.array_join("parts.said", "").alias("chat")))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM conversations),
r AS (
  SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS said FROM t),
h AS (
  SELECT conv_id, pos, n_turns, string_agg(md5(said), '') OVER (
    PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
  FROM r),
w AS (SELECT prefix, min(conv_id) AS conv_id FROM h WHERE pos = n_turns GROUP BY prefix),
m AS (SELECT conv_id FROM w WHERE prefix NOT IN (SELECT prefix FROM h WHERE pos < n_turns))
SELECT r.conv_id, (pos - 1) // {TURNS_PER_PART} AS part, (n_turns + {TURNS_PER_PART - 1}) // {TURNS_PER_PART} AS n_parts,
       n_turns, string_agg(said, '' ORDER BY pos) AS chat
FROM r JOIN m ON r.conv_id = m.conv_id
GROUP BY r.conv_id, part, n_parts, n_turns
"""
