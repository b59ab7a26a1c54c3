"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared with A-Z lower-cased and runs of white space
as one space.  An item of m characters may be found with up to
``k = floor(max_error x m)`` edits.  It is split into k+1 pieces; k edits cannot
touch them all, so a passage within the budget holds one piece unchanged.  All
pieces are found by one Aho-Corasick pass over the whole text; around each hit
the window that can hold the item is verified by Myers' bit-parallel distance
(overlapping windows of one item are verified together).  Windows that share
fewer 8-grams with the item than any match within the budget must are passed over first,
which is exact.

The benchmark is the query set: it is read in blocks of at most ``block_chars``
characters of items, and only a block, whose size is thereby bounded, is sent
to the executors.  Documents stream through in place: no join and no shuffle,
so a hot source or passage changes nothing.

Defined cases: a null text counts as empty and matches nothing; an item that is
null or has no characters beyond white space matches nothing; items with one
and the same text are all reported; a null item id is reported as null;
repeated rows give repeated results; very long texts are searched whole; empty tables give no rows, or rows without
hits; further columns of the documents pass through (the hits win a clash).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import table

MAX_ERROR = 0.08
BLOCK_CHARS = 1 << 22
GRAM = 8
HITS = "array<struct<item_id:bigint,distance:int>>"
HITS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())]))


def normalise(text: str | None) -> str:
    return b" ".join((text or "").encode("utf-8", "replace").lower().split()).decode("utf-8")


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item cut into budget + 1 pieces (offset, text), as even as can be."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers_best(item: str, window: str, most: int) -> int:
    """The least edit distance between the item and any part of the window, or
    ``most`` + 1 if it is larger; bit-parallel over the item's characters."""
    if item in window:
        return 0
    m = len(item)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    vp, vn, score, best = mask, 0, m, most + 1
    for c in window:
        x = at.get(c, 0) | vn
        d0 = ((vp + (x & vp)) ^ vp) | x
        hn = vp & d0
        hp = (vn | ~(vp | d0)) & mask
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        y = hp << 1
        vn = y & d0 & mask
        vp = ((hn << 1) | ~(y | d0)) & mask
        if score < best:
            best = score
    return best


def may_match(grams: frozenset[str], item: str, window: str, budget: int) -> bool:
    """The q-gram lemma: a part of the window within the budget shares at least
    ``needed`` grams with the item, each at a place of its own."""
    needed = len(item) - GRAM + 1 - GRAM * budget
    if needed <= 0:
        return True
    return sum(window[i:i + GRAM] in grams for i in range(len(window) - GRAM + 1)) >= needed


class Matcher:
    """Finds the items of one block in a text."""

    def __init__(self, items: list[tuple[int | None, str]], max_error: float):
        self.items = []
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normalise(text)
            if not text:
                continue
            budget = int(max_error * len(text))
            for offset, piece in pieces(text, budget):
                where.setdefault(piece, []).append((len(self.items), offset))
            grams = frozenset(text[i:i + GRAM] for i in range(len(text) - GRAM + 1))
            self.items.append((item_id, text, budget, grams))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), tuple(places)))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[dict]:
        if not self.items or not text:
            return []
        text = normalise(text)
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for i, offset in places:
                _, item, budget, _ = self.items[i]
                start = end + 1 - length - offset
                windows.setdefault(i, []).append((max(0, start - budget), start + len(item) + budget))
        hits = []
        for i, spans in windows.items():
            item_id, item, budget, grams = self.items[i]
            spans.sort()
            best, (low, high) = budget + 1, spans[0]
            for a, b in [*spans[1:], (math.inf, 0)]:
                if a <= high:
                    high = max(high, b)
                    continue
                if may_match(grams, item, text[low:high], budget):
                    best = min(best, myers_best(item, text[low:high], budget))
                    if best == 0:
                        break
                low, high = a, b
            if best <= budget:
                hits.append({"item_id": item_id, "distance": best})
        return sorted(hits, key=lambda h: (h["item_id"] is not None, h["item_id"]))


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", max_error: float = MAX_ERROR, block_chars: int = BLOCK_CHARS,
                   keep_text: bool = True, name: str = "hits") -> DataFrame:
    """``docs`` with ``name``: array of (item_id, distance) of the items found,
    by item id.  ``keep_text=False`` leaves the text column out."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("bigint").alias("id"), F.col(item_text_col).cast("string").alias("t"))
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-total // (block_chars // 2)))
    out = docs.drop(name).withColumn(name, F.array().cast(HITS))
    block_of = F.pmod(F.xxhash64("id", "t"), F.lit(blocks))
    for k in range(blocks):
        block = spark.sparkContext.broadcast(
            ([(r["id"], r["t"]) for r in items.where(block_of == k).collect()], max_error))
        columns = [c for c in out.columns if k < blocks - 1 or keep_text or c != text_col]

        def run(batches: Iterator[pa.RecordBatch], block=block, columns=columns) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(*block.value)
            for batch in batches:
                texts, hits = batch.column(batch.schema.get_field_index(text_col)), batch.column(batch.num_columns - 1)
                found = [matcher.find(t.as_py()) for t in texts]
                if blocks > 1:
                    found = [sorted(h.as_py() + f, key=lambda x: (x["item_id"] is not None, x["item_id"]))
                             for h, f in zip(hits, found)]
                arrays = [batch.column(batch.schema.get_field_index(c)) for c in columns if c != name]
                yield pa.record_batch([*arrays, pa.array(found, HITS_ARROW)], names=columns)

        out = out.mapInArrow(run, out.select(*columns).schema)
    return out


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"),
                        F.col("hits.item_id").alias("item_ids"), F.col("hits.distance").alias("distances"))
