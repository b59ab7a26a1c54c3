r"""SimHash near-deduplication with Golay-code fuzzy hashing.

Fingerprint: A-Z lower-cased, words ``[^\x20\x09-\x0D]+``, word shingles joined
by one space, 64-bit XXH64 (seed 42) of each, repeats included; a bit is set if
it is set in over half of the hashes.  Documents link at ``max_bits`` = 2 or
fewer differing bits.

Links: the 64 bits are cut into segments A, B, C of 22, 21 and 21 bits.  Of two
errors over three segments, for every pattern one of the ordered pairs A-B,
B-C, C-A has no error in its first segment and at most one in its second (errors 1+1: take the clean segment first, its successor
holds one; 2: start behind the damaged one).  Each fingerprint gets, per pair,
the exact first segment together with every Golay codeword within four bits of
the second: one to six keys.  Fingerprints up to two bits apart in a segment
share a codeword, so all links share a key; candidates are verified by counting
bits.

Work is done on distinct fingerprints, so copies never meet each other.  A key
shared by more than ``BUCKET`` distinct fingerprints makes no pairs: its members are linked through
their one-bit neighbours instead (two fingerprints are at most two bits apart
exactly if they share one), each to the smallest member of the neighbour, which is
linear and just as complete.  Components come from alternating stars.

Defined cases: a null text counts as empty; a text without words has
fingerprint zero and links like any other; fewer words than a shingle give one
shingle of all; a null id never becomes a component id unless all are null;
repeated rows give repeated results; very long texts are read whole, their shingles
counted some thousand at a time; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import table
from orderlens.llm.components import components
from orderlens.llm.golay import near_indices
from orderlens.plans.materialize import materialize

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BUCKET = 32
SEGMENTS = ((0, 22), (22, 21), (43, 21))
CHUNK = 1 << 14  # shingles whose bits are counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    spaced = [w + b" " for w in words[:-1]]
    counts, n = np.zeros(64, dtype=np.int64), len(words) - shingle + 1
    if shingle == 3:
        shingles = (a + b + c for a, b, c in zip(spaced, spaced[1:], words[2:]))
    else:
        shingles = (b" ".join(words[i:i + shingle]) for i in range(n))
    for at in range(0, n, CHUNK):
        m = min(CHUNK, n - at)
        hashes = np.fromiter((digest(s, SEED) for s, _ in zip(shingles, range(m))), dtype="<u8", count=m)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
        for row in range(0, m, 255):  # sums of 255 bits fit in a byte
            counts += bits[row:row + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id (bigint), fp, the fingerprint as a signed long, and text_hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)],
                                  names=["doc_id", "fp", "text_hash"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint, text_hash bigint")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        bits = fps.view(np.uint64)
        parts = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
        for pair in range(3):
            exact, fuzzy = parts[pair], near_indices(parts[(pair + 1) % 3])
            row, col = np.nonzero(fuzzy >= 0)
            keys = (exact[row] << 14) | (fuzzy[row, col] << 2) | pair
            yield pa.record_batch([pa.array(keys), pa.array(fps[row])], names=["key", "fp"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 4096):
            some = fps[at:at + 4096]
            near = (some.view(np.uint64)[:, None] ^ flips[None, :]).ravel().view(np.int64)
            yield pa.record_batch([pa.array(near), pa.array(np.repeat(some, len(flips)))], names=["near", "fp"])


def link_edges(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components
    are those of all links at up to two bits."""
    keys = materialize(prints.mapInArrow(_keys, "key bigint, fp bigint"), "golay_keys")
    # written first: the join with a crowded key can then be split by AQE
    sizes = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "golay_sizes")
    shared = materialize(keys.join(sizes, "key"), "golay_shared")
    small = shared.where(F.col("n") <= bucket)
    pairs = (small.select("key", F.col("fp").alias("a"))
             .join(small.select("key", F.col("fp").alias("b")), "key").where("a < b")
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).select("a", "b").distinct())
    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    near = crowded.mapInArrow(_neighbours, "near bigint, fp bigint")
    least = near.groupBy("near").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least < most")
    stars = (near.join(least.select("near", "least"), "near").where("fp <> least")
             .select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct())
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (hex), component_id, text_hash (xxhash64 of the text as it is), root: a row per input row.

    ``root`` is the component's smallest fingerprint; unlike component_id, which is null for a component without an
    id and shared where unrelated texts have one id, it names one component only."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct_prints")
    roots = components(link_edges(distinct.select("fp"), bucket)).withColumnRenamed("node", "fp")
    members = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    members = materialize(members, "print_roots")
    least = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    least = materialize(least, "component_ids")
    classes = materialize(members.select("fp", "root").join(least, "root").select("fp", "component_id", "root"), "print_classes")
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_hash", "root")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("root")
