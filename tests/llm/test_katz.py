import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import katz
from orderlens.llm.common import crc_mod
from orderlens.llm.katz import K, katz_scores, pack, unpack
from tests.llm.helpers import awkward, documents, empty, words


def discounts(hist):
    n = [0] + [hist.get(r, 0) for r in range(1, K + 2)]
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    out = {}
    for r in range(1, K + 1):
        if n[r] and common != 1.0:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
            out[r] = d if 0 < d <= 1 else 1.0
    return lambda c: out.get(c, 1.0)


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["</s>"]


class Brute:
    def __init__(self, texts):
        self.uni, self.pairs, self.after, self.next = Counter(), Counter(), Counter(), defaultdict(set)
        for t in texts:
            line = tokens(t)
            self.uni.update(line)
            for a, b in zip(["<s>"] + line, line):
                self.pairs[a, b] += 1
                self.after[a] += 1
                self.next[a].add(b)
        self.n = sum(self.uni.values())
        self.du, self.db = discounts(Counter(self.uni.values())), discounts(Counter(self.pairs.values()))
        kept = sum(self.du(c) * c for c in self.uni.values())
        self.whole = self.n if kept < self.n - 1e-9 else self.n + 1
        self.unknown = 1 - kept / self.whole if self.n else 1.0

    def p1(self, w):
        return self.du(self.uni[w]) * self.uni[w] / self.whole if w in self.uni else self.unknown

    def p2(self, h, w):
        if h not in self.after:
            return self.p1(w)
        freed = sum((1 - self.db(self.pairs[h, x])) * self.pairs[h, x] for x in self.next[h])
        whole = self.after[h] if freed > 1e-12 else self.after[h] + 1
        if w in self.next[h]:
            return self.db(self.pairs[h, w]) * self.pairs[h, w] / whole
        left = 1 - sum(self.db(self.pairs[h, x]) * self.pairs[h, x] / whole for x in self.next[h])
        return left / (1 - sum(self.p1(x) for x in self.next[h])) * self.p1(w)

    def row(self, text):
        line = tokens(text)
        score = sum(math.log10(self.p2(a, b)) for a, b in zip(["<s>"] + line, line))
        base = sum(math.log10((self.uni[w] + 0.1) / (self.n + 0.1 * (len(self.uni) + 1))) for w in line)
        return len(line), sum(w in self.uni for w in line), self.n, base, score


def check(rows, df):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    model = Brute([t for i, t in rows if not held(i)])
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                  for r in katz_scores(df, crc_mod(F.col("doc_id"), 10) == 0).collect()), key=repr)
    want = sorted(((i, held(i), *model.row(t)) for i, t in rows), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return model


@pytest.mark.parametrize("block_chars", [1 << 23, 900])
def test_scores_equal_brute_force(spark, monkeypatch, block_chars):
    monkeypatch.setattr(katz, "BLOCK_CHARS", block_chars)
    rng = random.Random(5)
    rows = [(i, " ".join(words(i, rng.randint(0, 60)) + ([f"rare{i}"] if i % 5 == 0 else []))) for i in range(160)]
    model = check(rows, documents(spark, [(i, t, None) for i, t in rows]).repartition(3))
    vocabulary = [*model.uni, "never seen"]
    for h in ["<s>", *list(model.uni)[:40], "never seen"]:  # exactly normalised
        assert sum(model.p2(h, w) for w in vocabulary) == pytest.approx(1, abs=1e-9)


def test_awkward_rows_equal_brute_force(spark):
    df = awkward(spark)
    check([(r["doc_id"], r["text"]) for r in df.collect()], df)


def test_without_training_rows_all_is_unknown(spark):
    df = documents(spark, [(i, "some text", None) for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0])
    rows = katz_scores(df, crc_mod(F.col("doc_id"), 10) == 0).collect()
    assert rows and all(r["score"] == 0.0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in rows)


def test_empty_table(spark):
    assert katz_scores(empty(spark), F.lit(False)).count() == 0


def test_packing_round_trip():
    for values in (np.arange(0), np.array([0, 255]), np.array([1 << 40, 3]), np.linspace(0, 1, 7)):
        assert (unpack(pack(values)) == values).all()
