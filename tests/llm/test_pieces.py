import math
import random
import time
from collections import Counter

import pytest

from orderlens.llm import pieces as sp
from tests.llm.helpers import awkward, documents, empty


@pytest.fixture(scope="module")
def vocab():
    return sp.vocabulary(sp.model_path(), 0.3)


def every_path(text, vocab):
    """All segmentations of a short text with their log probabilities, by exhaustion."""
    by_text = {p: i for i, p in enumerate(vocab.pieces) if i not in vocab.bytes_of and i not in vocab.control and i}
    scores = {int(p): float(s) for p, s in zip(vocab.piece_of, vocab.score_of) if p >= 0}
    whole = sp.SPACE + text.replace(" ", sp.SPACE)
    done = {len(whole): [((), 0.0)]}
    for at in range(len(whole) - 1, -1, -1):
        out = []
        for end in range(at + 1, min(len(whole), at + 16) + 1):
            i = by_text.get(whole[at:end])
            if i is not None:
                out += [((i, *p), s + scores[i]) for p, s in done[end]]
        if whole[at] not in by_text:
            raw = whole[at].encode()
            out += [((*(int(vocab.byte_ids[b]) for b in raw), *p), s + len(raw) * vocab.byte_score) for p, s in done[at + 1]]
        done[at] = out
    total = math.log(sum(math.exp(s) for _, s in done[0]))
    return {p: s - total for p, s in done[0]}


@pytest.mark.parametrize("text", ["the a", "ab  c", "é\n🙂 x", "x"])
def test_probabilities_equal_exhaustion(vocab, text):
    want = every_path(text, vocab)
    got = {tuple(r[2]): r[3] for r in sp.sample_batch([1], [text], vocab, len(want) + 5)}
    assert got.keys() == want.keys()  # all of them when k is large, none twice
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_samples_are_distributed_without_replacement(vocab):
    text, n = "the a", 20_000
    want = every_path(text, vocab)
    rows = {}
    weight = Counter()
    for row, _, ids, log_p, _, log_inclusion in sp.sample_batch(list(range(n)), [text] * n, vocab, 3):
        rows.setdefault(row, []).append(tuple(ids))
        weight[tuple(ids)] += math.exp(log_p - log_inclusion) / n
    first, pair = Counter(r[0] for r in rows.values()), Counter((r[0], r[1]) for r in rows.values())
    assert all(len(set(r)) == 3 for r in rows.values())
    for a, x in want.items():
        p = math.exp(x)
        assert abs(first[a] / n - p) < 5 * math.sqrt(p / n) + 1e-4
        for b, y in want.items():
            if a != b:
                q = p * math.exp(y) / (1 - p)
                assert abs(pair[a, b] / n - q) < 5 * math.sqrt(q / n) + 1e-4
    assert abs(sum(weight.values()) - 1) < 0.02  # inclusion scores make unbiased estimates


def test_long_text_keys_fall_and_samples_differ(vocab):
    text = "lorem ipsum dolor sit amet\n" * 3000
    rows = list(sp.sample_batch([5], [text], vocab, 4))
    assert len({tuple(r[2]) for r in rows}) == 4
    assert [r[4] for r in rows] == sorted((r[4] for r in rows), reverse=True)
    assert all(vocab.decode(r[2]) == text for r in rows)


def test_rows_do_not_depend_on_their_neighbours(vocab):
    a = list(sp.sample_batch([1, 2], ["some words here", "other words"], vocab, 2))
    b = list(sp.sample_batch([2], ["other words"], vocab, 2))
    assert [tuple(r[2]) for r in a if r[0] == 1] == [tuple(r[2]) for r in b]


def test_round_trip_of_awkward_rows(spark):
    df = awkward(spark)
    got = sp.encode_samples(df, k=2)
    decoded = sp.decode(got).collect()
    texts = {r["doc_id"]: (r["text"] or "") for r in df.collect()}
    assert all(r["round_trip"] for r in decoded)
    assert all(r["decoded"] == texts[r["doc_id"]] for r in decoded if r["doc_id"] is not None)
    counts = Counter(r["doc_id"] for r in decoded)
    assert counts[3] == counts[4] == 1 and counts[1] == 2 and counts[8] == 4
    nothing = [r for r in decoded if r["doc_id"] == 4][0]
    assert nothing["ids"] == [] and nothing["log_prob"] == 0.0 and nothing["log_inclusion"] == 0.0


def test_space_sign_is_documented_as_a_space(spark):
    row = sp.decode(sp.encode_samples(documents(spark, [(1, "a▁b", None)]), k=1)).first()
    assert row["decoded"] == "a b" and row["round_trip"]
    assert "``▁`` in a text is taken as a space" in sp.__doc__ and "taken as a space" in sp.encode_samples.__doc__


def test_empty_table(spark):
    assert sp.encode_samples(empty(spark)).count() == 0
    assert sp.encode_samples(documents(spark, [(1, "▁ literal", None)])).first()["round_trip"]


def test_long_unspaced_units_equal_short_ones_method_and_take_linear_time(vocab):
    """One unit beyond LONG_UNIT: the same draws as by levels, and half a million characters in seconds."""
    rng = random.Random(3)
    letters = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzé漢", k=500_000))
    texts = [letters[:3_000], letters[:700] + " x", "a b c", "x" * 2_000]
    kept = sp.LONG_UNIT, sp.FEW, sp.BLOCK
    try:
        runs = []
        for sp.LONG_UNIT, sp.FEW, sp.BLOCK in ((100, 4, 64), (512, 4, 1 << 16), (1 << 30, 0, 1 << 16)):
            runs.append([(row, sample, list(map(int, ids)), *numbers)
                         for row, sample, ids, *numbers in sp.sample_batch([1, 2, 3, 4], texts, vocab, 2)])
    finally:
        sp.LONG_UNIT, sp.FEW, sp.BLOCK = kept
    for run in runs[:2]:
        assert [r[:3] for r in run] == [r[:3] for r in runs[2]]
        assert all(math.isclose(x, y, abs_tol=1e-6) for a, b in zip(run, runs[2]) for x, y in zip(a[3:], b[3:]))
    started = time.process_time()
    (_, _, ids, *_), (_, _, other, *_) = sp.sample_batch([1], [letters], vocab, 2)
    assert time.process_time() - started < 20
    assert vocab.decode(ids) == vocab.decode(other) == letters and list(ids) != list(other)


def test_inclusion_scores_of_long_texts_are_finite(vocab):
    """A long text's segmentations have probabilities below the smallest double."""
    assert sp._log_inclusion(-2000.0) == -2000.0
    assert all(math.isclose(sp._log_inclusion(x), math.log(-math.expm1(-math.exp(x))), rel_tol=1e-12)
               for x in (-60.0, -40.5, -39.5, -20.0, -1.0, 0.5))
    found = list(sp.sample_batch([1], ["some words of a longer text " * 400], vocab, 3))
    assert len(found) == 3 and min(f[3] for f in found) < -800
    assert all(math.isfinite(f[5]) and f[5] <= 0 for f in found)


def test_byte_pieces_are_compared_and_decoded_at_once(vocab, monkeypatch):
    """Texts with line ends need no second decoding; bytes that are no UTF-8 decode run by run."""
    def run_by_run(ids):
        out, held = [], bytearray()
        for i in [*ids, None]:
            if i in vocab.bytes_of:
                held.append(vocab.bytes_of[i])
                continue
            out.append(held.decode("utf-8", "replace"))
            held = bytearray()
            if i is not None and i not in vocab.control:
                out.append(vocab.pieces[i])
        text = "".join(out).replace(sp.SPACE, " ")
        return text[1:] if text.startswith(" ") else text

    rng = random.Random(11)
    some = [i for p, i in zip(vocab.pieces, range(len(vocab.pieces))) if any(c in p for c in "é漢a▁")][:300]
    for _ in range(3_000):
        ids = [rng.choice(some) if rng.random() < 0.3 else int(vocab.byte_ids[rng.choice((0x0A, *range(0x80, 0x100)))])
               for _ in range(rng.randint(0, 12))] + rng.choices([0, *vocab.control], k=rng.randint(0, 1))
        assert vocab.decode(ids) == run_by_run(ids)
    texts = ["two\nlines\n", "\n", "🙂 \U00013000\r\n x", " lead"]
    found = [(texts[row], ids) for row, _, ids, *_ in sp.sample_batch([1, 2, 3, 4], texts, vocab, 2)]
    monkeypatch.setattr(sp.Vocabulary, "decode", None)
    assert all(vocab.spells(ids, text) for text, ids in found)


@pytest.mark.parametrize("size", [1, 7, 64])
def test_lattices_built_in_parts_are_those_built_at_once(vocab, monkeypatch, size):
    rng = random.Random(size)
    words = list({"".join(rng.choices("abcé漢▁", k=rng.randint(1, 40))) for _ in range(200)} | {"x" * 700})
    made = {}
    for part in (size, 1 << 30):
        monkeypatch.setattr(sp, "PART", part)
        made[part] = sp.Lattice(words, vocab)
    a, b = made.values()
    for name in ("codes", "start_of", "first", "target", "piece", "last_piece", "log_share"):
        assert getattr(a, name).tolist() == getattr(b, name).tolist() and getattr(a, name).dtype == getattr(b, name).dtype
    assert abs(a.reach - b.reach).max() < 1e-9
    assert not len(sp.Lattice([], vocab).codes)
