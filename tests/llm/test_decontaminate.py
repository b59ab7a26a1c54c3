import random

from orderlens.llm.decontaminate import Matcher, find_benchmark, myers_best, normalise, pieces
from tests.llm.helpers import LONG, awkward, documents, empty, words


def distance(item, text):
    """Least edit distance between the item and any part of the text."""
    last = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i] + [0] * len(text)
        for j, b in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a != b))
        last = row
    return min(last)


def edited(rng, text, n, letters="abcd e"):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out) + 1)
        kind = rng.random()
        if kind < 0.3 and out:
            out.pop(min(at, len(out) - 1))
        elif kind < 0.6:
            out.insert(at, rng.choice(letters))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


def test_matches_equal_brute_force():
    rng = random.Random(3)
    draw = lambda a, b: "".join(rng.choice("abcd e") for _ in range(rng.randint(a, b)))
    for _ in range(300):
        item = draw(1, 60)
        text = draw(0, 40) + edited(rng, item, rng.randint(0, 6)) + draw(0, 40)
        assert myers_best(item, text, len(item)) == min(distance(item, text), len(item) + 1)
        rate = rng.choice([0, 0.08, 0.2])
        a, b = normalise(item), normalise(text)
        best = distance(a, b) if a else 99
        want = [{"item_id": 1, "distance": best}] if a and best <= int(rate * len(a)) else []
        assert Matcher([(1, item)], rate).find(text) == want


def test_pieces_cover_the_item():
    for n in (1, 9, 40, 201):
        for k in range(0, n):
            cut = pieces("x" * n, k)
            assert len(cut) == k + 1 and sum(len(p) for _, p in cut) == n and all(p for _, p in cut)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_planted_passages_in_blocks_of_the_benchmark(spark):
    rng = random.Random(1)
    items = [(i, " ".join(words(100 + i, 40))) for i in range(30)] + [(None, None), (77, "   "), (78, "")]
    rows = []
    for i in range(30):
        kind = i % 3
        passage = items[i][1]
        if kind == 1:
            passage = edited(rng, passage, int(0.08 * len(normalise(passage))), "qxz")
        if kind == 2:
            passage = passage.upper().replace(" ", " \n\t ")
        rows.append((i, " ".join(words(500 + i, 60)) + " " + passage + " " + " ".join(words(600 + i, 60)), None))
    rows += [(50 + i, " ".join(words(700 + i, 200)), None) for i in range(10)]
    df = documents(spark, rows)
    for block_chars in (1 << 22, 2000):
        got = {r["doc_id"]: [h["item_id"] for h in r["hits"]]
               for r in find_benchmark(df, bench(spark, items), block_chars=block_chars).collect()}
        assert got == {**{i: [i] for i in range(30)}, **{50 + i: [] for i in range(10)}}


def test_awkward_rows_and_columns(spark):
    df = awkward(spark)
    got = find_benchmark(df, bench(spark, [(1, "ALPHA beta"), (2, "alpha  BETA"), (None, "ipsum dolor sit amet lorem")]))
    assert set(got.columns) == set(df.columns) and got.count() == df.count()
    hits = {r["doc_id"]: [h["item_id"] for h in r["hits"]] for r in got.collect() if r["doc_id"] is not None}
    assert hits[1] == hits[2] == [1, 2] and hits[6] == hits[7] == [None] and hits[3] == hits[4] == hits[9] == []
    assert [r["text"] for r in got.where("doc_id = 7").collect()] == [LONG]


def test_empty_tables(spark):
    assert find_benchmark(empty(spark), bench(spark, [(1, "a")])).count() == 0
    assert all(r["hits"] == [] for r in find_benchmark(awkward(spark), bench(spark, [])).collect())
