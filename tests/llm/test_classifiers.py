import random
import zlib

import numpy as np
import pytest

from orderlens.llm import langid, quality
from orderlens.llm.langid import Network, identify, op4_language_id
from orderlens.llm.quality import op6_quality_classifier
from tests.conftest import SF_ORACLE
from tests.llm.helpers import awkward, documents, empty


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(2)
    net = Network.fresh(["a", "b", "c"], hidden=3)
    net = Network(net.langs, [w.astype(np.float64) for w in net.weights])
    x, label = rng.integers(97, 122, size=(4, 9)).astype(np.uint8), np.array([0, 1, 2, 1])
    x[0, 3] = 32

    def loss():
        p = net.positions(x)
        letters = langid._LETTER_BYTE[x.T]
        picked = -np.log(p[:, np.arange(4), label])
        return float((picked * letters).sum() / letters.sum())

    for weights, gradient in zip(net.weights, net.gradients(x, label)):
        for at in [tuple(rng.integers(s) for s in weights.shape) for _ in range(6)] + [
                (int(x[1, 2]), 1)] * (weights.shape[0] == 256):
            kept = weights[at]
            weights[at] = kept + 1e-3
            up = loss()
            weights[at] = kept - 1e-3
            down = loss()
            weights[at] = kept
            assert gradient[at] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def toy(steps=200):
    rng = random.Random(1)
    make = lambda letters: " ".join("".join(rng.choices(letters, k=5)) for _ in range(60))
    return langid.train([("one", make("abcde")) for _ in range(20)] + [("two", make("uvwxy")) for _ in range(20)], steps=steps)


def test_whole_texts_are_read_and_pooled():
    net = toy()
    assert net.documents(["abcab " * 50, "uvwxy " * 50])[0] == ["one", "two"]
    # the tail decides: prefixes would give the other label
    labels, scores = net.documents(["abcab " * 200 + "uvwxy " * 2000, None, "", "123 !?", "x" * 400_000])
    assert labels == ["two", "und", "und", "und", "two"] and list(scores[1:4]) == [0, 0, 0]
    assert ((scores >= 0) & (scores <= 1)).all()


def test_sample_takes_copies_once(spark):
    rows = [(k, f"text number {k} of this language", "aa") for k in range(40)]
    rows += [(100 + k, "one text with very many copies", "aa") for k in range(400)]
    rows += [(600 + k, "one text with very many copies", "bb") for k in range(3)]
    got = langid.training_sample(documents(spark, rows).select("lang", "text"), per_lang=50)
    assert sorted(got) == sorted({(g, t) for _, t, g in rows})


def test_number_signs_are_not_letters():
    labels, scores = toy(20).documents(["\u00bd", "2 \u00b2 \u2460", "\u2167 \u2167", "\u00bd a"])
    assert labels[:3] == ["und"] * 3 and labels[3] != "und" and list(scores[:3]) == [0, 0, 0]


def test_awkward_rows_and_empty_tables(spark):
    net = toy(60)
    df = awkward(spark)
    got = identify(df, net)
    kept = [c for c in df.columns if c != "score"]  # the new score wins the clash
    assert got.count() == df.count() and got.columns == [*kept, "lang_pred", "score"]
    by_id = {r["doc_id"]: r["lang_pred"] for r in got.collect()}
    assert by_id[3] == by_id[4] == by_id[9] == "und" and by_id[6] in ("one", "two")
    assert identify(empty(spark), net).count() == 0
    nothing = langid.fit(empty(spark).select("lang", "text"))
    assert {r["lang_pred"] for r in identify(df, nothing).collect()} == {"und"}


def test_held_out_language_accuracy(spark):
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    rows = op4_language_id(spark, SF_ORACLE).collect()
    assert len(rows) == len(want)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_held_out_quality(spark):
    want = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    rows = op6_quality_classifier(spark, SF_ORACLE).collect()
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in want]
    assert sum(r["predicted"] == want[r["doc_id"]] for r in held) >= 0.93 * len(held)


def test_hinge_model_separates_and_respects_the_dual():
    rng = random.Random(3)
    rows = [quality.slots(" ".join(rng.choices(["good", "fine"] if i % 2 else ["bad", "junk"], k=6))) for i in range(60)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(60)])
    w, bias = quality.fit_hinge(rows, np.ones(quality.DIMS), y)
    margins = [float(w[r].sum()) / len(r) ** 0.5 + bias for r in rows]
    assert all(m * t > 0 for m, t in zip(margins, y))


def test_slots_match_brute_force():
    text = "aab aab aab é"
    raw = text.encode()
    want = {quality.FIRST if s < quality.FIRST else s for order in (1, 2, 3) for i in range(len(raw) - order + 1)
            for s in [(int.from_bytes(raw[i:i + order], "big") * 2654435761 + order * 40503) % (1 << 32) >> 16]}
    assert set(quality.slots(text)) == want | {2, 3}  # two and three times the same word
    assert len(quality.slots(None)) == 0 == len(quality.slots(""))


def test_quality_defined_cases(spark):
    texts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "c")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, None), (9, 0), (None, 0)], "doc_id bigint, label int")
    flat = quality.fit(texts, labels)
    got = quality.score(awkward(spark), flat).collect()
    assert len(got) == 14 and {round(r["score"], 6) for r in got} == {0.75}
    assert quality.score(empty(spark), flat).count() == 0
    assert quality.fit(texts.limit(0), labels.limit(0)).score("x") == pytest.approx(0.5)
