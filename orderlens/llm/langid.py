"""Language identification with a bidirectional gated recurrent network over bytes.

Every byte of a text is read: texts are cut into windows of ``WINDOW`` bytes,
and in each window one gated recurrent unit runs forwards, one backwards.  The
two states of a position give its language probabilities (softmax); a
document's probabilities are the mean over its letter positions.  Gates use the
algebraic sigmoid x / (1 + |x|), which numpy evaluates many times faster than
exp or tanh and which backpropagates just as well.

Training is numpy backpropagation through time with Adam on a bounded sample:
at most ``SAMPLE`` distinct texts of each language, one excerpt of ``EXCERPT`` characters of
each, chosen by hash over the whole training share.  Prediction streams over
all rows and whole texts; only the weights (tens of kilobytes) are broadcast.

Defined cases: a null text or one without a letter is ``und`` with score 0;
rows whose language is null are not learned from; without any labelled row
every text is ``und``; repeated rows give repeated results; an empty table
gives no rows; further columns pass through in ``identify`` unless they clash
with the two names given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import crc_mod, table

WINDOW = 128
HIDDEN = 8
SAMPLE = 1500
EXCERPT = 256
STEPS = 700
BATCH = 128
RATE = 0.02
SLAB = 2048  # windows run together
_LETTER_BYTE = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])


def _bend(x: np.ndarray, scratch: np.ndarray) -> None:
    """x / (1 + |x|) in place."""
    np.abs(x, out=scratch)
    scratch += 1
    x /= scratch


class Direction:
    """One gated recurrent unit; columns of W and U: update, reset, candidate."""

    def __init__(self, w: np.ndarray, u: np.ndarray):
        self.w, self.u, self.h = w, u, u.shape[0]

    def forward(self, x: np.ndarray, tape: list | None = None) -> np.ndarray:
        """x (T, N) bytes -> states (T, N, H); ``tape`` gets what backward needs."""
        size, k = x.shape[1], self.h
        states = np.empty((len(x), size, k), dtype=np.float32)
        before = np.zeros((size, k), dtype=np.float32)
        g, u, s = (np.empty((size, 3 * k), dtype=np.float32) for _ in range(3))
        for t in range(len(x)):
            np.take(self.w, x[t], axis=0, out=g, mode="clip")
            np.matmul(before, self.u, out=u)
            gates = g[:, :2 * k] + u[:, :2 * k]
            _bend(gates, s[:, :2 * k])
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :k], gates[:, k:]
            n = r * u[:, 2 * k:]
            n += g[:, 2 * k:]
            _bend(n, s[:, :k])
            if tape is not None:
                tape.append((before, gates, u[:, 2 * k:].copy(), n.copy()))
            now = states[t]
            np.subtract(before, n, out=now)
            now *= z
            now += n
            before = now
        return states

    def backward(self, x: np.ndarray, tape: list, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of W and U, given those of the states (T, N, H)."""
        k = self.h
        into_w = np.empty((len(x), x.shape[1], 3 * k), dtype=np.float32)
        du = np.zeros_like(self.u)
        carry = np.zeros_like(out[0])
        for t in range(len(x) - 1, -1, -1):
            before, gates, c, n = tape[t]
            z, r = gates[:, :k], gates[:, k:]
            carry = carry + out[t]
            dn = carry * (1 - z) * (1 - np.abs(n)) ** 2
            dg = into_w[t]
            dg[:, :k] = carry * (before - n)
            dg[:, k:2 * k] = dn * c
            dg[:, :2 * k] *= 0.5 * (1 - np.abs(2 * gates - 1)) ** 2
            dg[:, 2 * k:] = dn
            through = dg.copy()
            through[:, 2 * k:] *= r
            du += before.T @ through
            carry = carry * z + through @ self.u.T
        flat, rows = x.ravel(), into_w.reshape(-1, 3 * k)
        order = np.argsort(flat, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(flat[order]) > 0])
        dw = np.zeros_like(self.w)
        dw[flat[order][starts]] = np.add.reduceat(rows[order], starts, axis=0)
        return dw, du


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


class Network:
    def __init__(self, langs: list[str], weights: list[np.ndarray]):
        self.langs, self.weights = langs, weights
        self.ahead, self.back = Direction(*weights[:2]), Direction(*weights[2:4])
        self.v, self.b = weights[4:]

    @staticmethod
    def fresh(langs: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        f = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
        return Network(langs, [f(256, 3 * hidden, scale=0.3), f(hidden, 3 * hidden, scale=0.35),
                               f(256, 3 * hidden, scale=0.3), f(hidden, 3 * hidden, scale=0.35),
                               f(2 * hidden, len(langs), scale=0.3), np.zeros(len(langs), dtype=np.float32)])

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Windows (N, T) of bytes -> probabilities (T, N, langs) of every position."""
        x = np.ascontiguousarray(x.T)
        ahead = self.ahead.forward(x)
        back = self.back.forward(x[::-1])[::-1]
        k = ahead.shape[2]
        return _softmax(ahead @ self.v[:k] + back @ self.v[k:] + self.b)

    def gradients(self, x: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Mean cross-entropy gradients over the letter positions of windows (N, T)."""
        x = np.ascontiguousarray(x.T)
        tapes: tuple[list, list] = ([], [])
        ahead, back = self.ahead.forward(x, tapes[0]), self.back.forward(x[::-1], tapes[1])[::-1]
        states = np.concatenate([ahead, back], axis=2)
        delta = _softmax(states @ self.v + self.b)
        delta[:, np.arange(len(label)), label] -= 1
        weight = _LETTER_BYTE[x].astype(np.float32)
        delta *= (weight / max(weight.sum(), 1.0))[:, :, None]
        flat = delta.reshape(-1, delta.shape[2])
        into = delta @ self.v.T
        k = ahead.shape[2]
        return [*self.ahead.backward(x, tapes[0], into[:, :, :k]),
                *self.back.backward(np.ascontiguousarray(x[::-1]), tapes[1], np.ascontiguousarray(into[::-1, :, k:])),
                states.reshape(-1, states.shape[2]).T @ flat, flat.sum(axis=0)]

    def documents(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Labels and scores of whole texts."""
        labels, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return labels, scores
        has = [bool(t) and any(map(str.isalpha, t)) for t in texts]
        raw = [t.encode("utf-8", "replace") if ok else b"" for t, ok in zip(texts, has)]
        pooled = np.zeros((len(texts), len(self.langs) + 1))
        docs, held, room = [], [], 0
        for i, data in enumerate(raw):
            for at in range(0, len(data), WINDOW * SLAB):  # a very long text takes several slabs
                part = data[at:at + WINDOW * SLAB]
                n = -(-len(part) // WINDOW)
                docs.append((i, n))
                held.append(part.ljust(n * WINDOW))
                room += n
                if room >= SLAB:
                    self._pool(pooled, docs, held)
                    docs, held, room = [], [], 0
        if docs:
            self._pool(pooled, docs, held)
        share = pooled[:, :-1] / np.maximum(pooled[:, -1:], 1e-9)
        best = share.argmax(axis=1)
        for i in np.flatnonzero(has):
            labels[i], scores[i] = self.langs[best[i]], min(max(share[i, best[i]], 0.0), 1.0)
        return labels, scores

    def _pool(self, pooled: np.ndarray, docs: list[tuple[int, int]], held: list[bytes]) -> None:
        x = np.frombuffer(b"".join(held), dtype=np.uint8).reshape(-1, WINDOW)
        of = np.repeat([i for i, _ in docs], [n for _, n in docs])
        for at in range(0, len(x), SLAB):
            some = x[at:at + SLAB]
            letters = _LETTER_BYTE[some]
            sums = np.einsum("tnk,nt->nk", self.positions(some), letters.astype(np.float32), optimize=True)
            np.add.at(pooled, of[at:at + SLAB], np.column_stack([sums, letters.sum(axis=1)]))


def train(sample: list[tuple[str, str]], steps: int = STEPS, batch: int = BATCH, seed: int = 7) -> Network:
    """A network from (language, excerpt) pairs."""
    sample = sorted((lang, text) for lang, text in sample if lang is not None and text)
    langs = sorted({lang for lang, _ in sample})
    net = Network.fresh(langs, seed=seed)
    rng = np.random.default_rng(seed)
    by_lang = [[t.encode("utf-8", "replace") for lang, t in sample if lang == one] for one in langs]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights]
    for step in range(steps if len(langs) > 1 else 0):
        label = rng.integers(len(langs), size=batch)
        x = np.full((batch, WINDOW // 2), 32, dtype=np.uint8)
        for row, k in enumerate(label):
            data = by_lang[k][rng.integers(len(by_lang[k]))]
            at = rng.integers(max(1, len(data) - x.shape[1] + 1))
            part = np.frombuffer(data[at:at + x.shape[1]], dtype=np.uint8)
            x[row, :len(part)] = part
        rate = RATE * (1 - step / steps) + 1e-4
        for w, g, (m, v) in zip(net.weights, net.gradients(x, label), moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            fix = np.sqrt(1 - 0.99 ** (step + 1)) / (1 - 0.9 ** (step + 1))
            w -= (rate * fix * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
    return net


def training_sample(rows: DataFrame, per_lang: int = SAMPLE, excerpt: int = EXCERPT) -> list[tuple[str, str]]:
    """(lang, excerpt) of at most ``per_lang`` distinct texts a language, spread by hash.

    Texts are thinned by hash to about twice the bound before they are ranked,
    so ranking sees a bounded number of short excerpts; copies are counted and ranked once."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    counts = rows.select("lang", "h").distinct().groupBy("lang").count()
    spread = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    start = F.pmod(F.shiftright("h", 32), F.greatest(F.length("text") - excerpt, F.lit(0)) + 1).cast("int")
    thin = (rows.join(F.broadcast(counts), "lang").where(spread < F.lit(2.0 * per_lang) / F.col("count"))
            .select("lang", "h", F.substring(F.col("text"), start + 1, F.lit(excerpt)).alias("part"))
            .distinct())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "part"))
    kept = thin.withColumn("rank", rank).where(F.col("rank") <= per_lang)
    return [(r["lang"], r["part"]) for r in kept.select("lang", "part").collect()]


def fit(rows: DataFrame, **options) -> Network:
    """A network learned from the columns lang and text of ``rows``."""
    return train(training_sample(rows), **options)


def identify(docs: DataFrame, net: Network, text_col: str = "text", keep_text: bool = True,
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and its score under ``names``; ``keep_text=False`` leaves the text out."""
    docs = docs.drop(*names)
    columns = [c for c in docs.columns if keep_text or c != text_col]
    shared = docs.sparkSession.sparkContext.broadcast((net.langs, net.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(*shared.value)
        for batch in batches:
            labels, scores = own.documents(batch.column(batch.schema.get_field_index(text_col)).to_pylist())
            yield pa.record_batch([*[batch.column(batch.schema.get_field_index(c)) for c in columns],
                                   pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                                  names=[*columns, *names])

    schema = docs.select(*columns, F.lit("").alias(names[0]), F.lit(0.0).alias(names[1])).schema
    return docs.mapInArrow(run, schema)


def learned(docs: DataFrame) -> Network:
    """The network of the training share: crc32 of the id modulo 3 is not 1."""
    return fit(docs.where(crc_mod(F.col("doc_id"), 3) != 1).select("lang", "text"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), learned(docs), keep_text=False)
