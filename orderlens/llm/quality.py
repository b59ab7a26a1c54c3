"""Quality classification by naive Bayes support vectors (NBSVM).

Features are indicators of n-grams of the whole text: byte n-grams of orders 1
to 3, and word n-grams of orders 2 to 9 by their equality pattern (all words
the same), all hashed into ``DIMS`` slots.  For each slot the smoothed
log ratio of its share among documents of class 1 and of class 0 is counted over
all labelled training rows, as a Spark aggregation of at most ``DIMS`` groups.  A document's vector holds the
ratios of its slots, at unit length; on a bounded sample of ``SAMPLE``
labelled rows (spread by hash, documented bound) a linear hinge-loss model is
fitted by dual coordinate descent.  A logistic curve fitted to margins of
rows left out (two halves) turns margins into scores.  Scoring streams over all
rows with the weight vector (half a megabyte) broadcast.

Defined cases: a null text counts as empty; an empty text has no features and
scores by the bias alone; rows whose label is null are not learned from; without
rows of both classes the score is the share of class 1, smoothed, for all;
a document labelled twice counts twice; repeated rows give repeated results; very
long texts are read whole; the fit sees about ``sample`` labelled rows, drawn by hash,
never more than twice as many; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import crc_mod, table

DIMS = 1 << 16
FIRST = 16  # slots below hold the word patterns
SAMPLE = 6000
SMOOTH = 1.0
COST = 1.0
EPOCHS = 12
THRESHOLD = 0.7


def slots(text: str | None) -> np.ndarray:
    """The sorted distinct slots (uint16) of a text's byte n-grams."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    seen = np.zeros(DIMS, dtype=bool)
    words = (text or "").split()
    same = np.fromiter(map(eq, words, words[1:]), dtype=bool, count=max(len(words) - 1, 0))
    for order in range(2, 10):
        if not same.any():
            break
        seen[order] = True  # some n-gram of this order repeats one word
        same = same[:-1] & same[1:]
    for at in range(0, max(len(data), 1), 1 << 20):  # long texts in pieces that overlap by two bytes
        part = data[at:at + (1 << 20) + 2]
        pair = (part[:-1] << 8 | part[1:]) if len(part) > 1 else part[:0]
        triple = (pair[:-1] << 8 | part[2:]) if len(part) > 2 else part[:0]
        for order, grams in ((1, part), (2, pair), (3, triple)):
            at_slot = (grams * np.uint32(2654435761) + np.uint32(order * 40503)) >> np.uint32(16)
            seen[np.maximum(at_slot, FIRST)] = True
    return np.flatnonzero(seen).astype(np.uint16)


@dataclass
class Model:
    weights: np.ndarray  # per slot: model weight times log ratio
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        norm = float(np.sqrt(np.square(self.ratios[found]).sum())) or 1.0
        return float(self.weights[found].sum()) / norm + self.bias

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(slots(text)) + self.shift, -500, 500))))


def fit_hinge(rows: list[np.ndarray], ratios: np.ndarray, y: np.ndarray, cost: float = COST,
              epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1-loss linear support vector machine.

    Classes weigh alike: the smaller one has a larger upper bound."""
    w, bias = np.zeros(DIMS), 0.0
    values = [ratios[r] / (np.sqrt(np.square(ratios[r]).sum()) or 1.0) for r in rows]
    square = np.array([float(v @ v) + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    share = np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    upper = cost * len(y) / (2.0 * np.maximum(share, 1))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (float(w[rows[i]] @ values[i]) + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            if (step := new - alpha[i]) != 0.0:
                w[rows[i]] += step * y[i] * values[i]
                bias += step * y[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def fit_logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of Platt's curve by Newton's method, targets smoothed."""
    n1, n0 = int((y > 0).sum()), int((y < 0).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -500, 500)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * margins).sum() + 1e-3 * (slope - 1), d.sum()])
        hess = np.array([[(h * margins * margins).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum()]])
        step = np.linalg.solve(hess + 1e-9 * np.eye(2), g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(shift)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, DIMS + 1), dtype=np.int64)
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1)):
            k = label.as_py()
            counts[k, slots(text.as_py())] += 1
            counts[k, DIMS] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(counts[0, used]), pa.array(counts[1, used])],
                          names=["slot", "n0", "n1"])


def _sampled_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([batch.column(2), batch.column(1),
                               pa.array([slots(t.as_py()).tobytes() for t in batch.column(0)], pa.binary())],
                              names=["h", "label", "slots"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, label 0 or 1).

    The counts join all labelled texts, always by merging, so the plan is the
    same at every size.  The sample is drawn from the labels first, by hash of
    the id; these few thousand ids, a fixed bound, are broadcast, and no other text moves."""
    docs = docs.select("doc_id", F.col("text").cast("string"))
    labels = labels.where("label in (0, 1)").select("doc_id", F.col("label").cast("int"))
    counts = np.zeros((2, DIMS + 1))
    known = docs.join(labels.hint("merge"), "doc_id").select("text", "label")
    grouped = known.mapInArrow(_slot_counts, "slot int, n0 bigint, n1 bigint").groupBy("slot").agg(F.sum("n0"), F.sum("n1"))
    for slot, n0, n1 in grouped.collect():  # at most DIMS + 1 rows
        counts[:, slot] = n0, n1
    n0, n1 = counts[:, DIMS]
    prior = (n1 + 1) / (n0 + n1 + 2)
    flat = Model(np.zeros(DIMS), np.zeros(DIMS), 0.0, 0.0, float(np.log(prior / (1 - prior))))
    if min(n0, n1) < 2:
        return flat
    shares = (counts[:, :DIMS] + SMOOTH) / (counts[:, DIMS:] + 2 * SMOOTH)
    ratios = np.log(shares[1] / shares[0])
    # thinned per class by hash: half the sample each, all of a class that has less
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    keep = F.when(F.col("label") == 1, sample / 2 / n1).otherwise(sample / 2 / n0)
    picks = labels.where(spread < keep).orderBy(F.xxhash64("doc_id"), "label").limit(2 * sample)
    drawn = (docs.join(F.broadcast(picks), "doc_id").select("text", "label", F.xxhash64("text").alias("h"))
             .mapInArrow(_sampled_slots, "h bigint, label int, slots binary")
             .orderBy("h", "slots", "label").limit(2 * sample).collect())
    found = [np.frombuffer(r["slots"], dtype=np.uint16) for r in drawn]
    y = np.array([1.0 if r["label"] else -1.0 for r in drawn])
    if len(set(y)) < 2:
        return flat
    margins = np.zeros(len(y))
    for half in (0, 1):
        own = [i for i in range(len(y)) if i % 2 == half]
        w, bias = fit_hinge([found[i] for i in own], ratios, y[own], epochs=4)
        part = Model(w * ratios, ratios, bias, 1.0, 0.0)
        for i in range(1 - half, len(y), 2):
            margins[i] = part.margin(found[i])
    slope, shift = fit_logistic(margins, y)
    w, bias = fit_hinge(found, ratios, y)
    return Model(w * ratios, ratios, bias, slope, shift)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([own.score(t.as_py()) for t in batch.column(1)], pa.float64())],
                                  names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held_out).select("doc_id", "text"),
                labels.where(~held_out).select("doc_id", F.col("quality").alias("label")))
    scored = score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
