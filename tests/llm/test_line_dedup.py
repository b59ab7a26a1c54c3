import hashlib
import random
import re
import time

from orderlens.llm.line_dedup import BASE, CLASSES, MODULUS, drop_repeated_chunks
from tests.llm.helpers import LONG, awkward, documents, empty


def cut(text, window=2, classes=CLASSES):
    """(start, end) of every chunk: runs of windows of one class; equal neighbours are apart."""
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    rolled = [sum(h[i + j] * pow(BASE, j, MODULUS) for j in range(window)) % MODULUS
              for i in range(len(lines) - window + 1)]
    chunks = []
    for i, r in enumerate(rolled):
        if i and rolled[i - 1] % classes == r % classes and rolled[i - 1] != r:
            chunks[-1] = (chunks[-1][0], i + window - 1)
        else:
            chunks.append((i, i + window - 1))
    return chunks


def brute(rows, **options):
    """id -> (text, chunks, removed chunks, removed lines)"""
    first = {}
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        for s, e in cut(t, **options):
            first.setdefault("\n".join(t.split("\n")[s:e + 1]), (i, s))
    out = {}
    for i, t in rows:
        if t is None:
            out[i] = (None, 0, 0, 0)
            continue
        lines, gone, dropped = t.split("\n"), set(), 0
        chunks = cut(t, **options)
        for s, e in chunks:
            body = "\n".join(lines[s:e + 1])
            if re.search(r"\S", body) and first[body] != (i, s):
                gone |= set(range(s, e + 1))
                dropped += 1
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(chunks), dropped, len(gone))
    return out


def repeated_lines(rows):
    """id -> positions of the lines of every pair of adjacent lines that stands earlier in the corpus."""
    seen, out = set(), {}
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        lines = t.split("\n")
        for k, pair in enumerate(zip(lines, lines[1:])):
            if pair in seen:
                out.setdefault(i, set()).update((k, k + 1))
            seen.add(pair)
    return out


def run(spark, rows, **options):
    df = documents(spark, [(i, t, None) for i, t in rows]).repartition(5)
    return {r["doc_id"]: (r["text"], r["n_chunks"], r["removed_chunks"], r["removed_lines"])
            for r in drop_repeated_chunks(df, **options).collect()}


def corpus(seed):
    rng = random.Random(seed)
    pool = [f"line {k}" for k in range(60)]
    passage = [f"shared line {k}" for k in range(12)]
    rows = []
    for i in range(120):
        lines = rng.choices(pool, k=rng.randint(1, 12))
        if i % 3 == 0:
            at = rng.randint(0, len(lines))
            lines[at:at] = passage
        rows.append((i, "\n".join(lines)))
    return rows + [(500, None), (501, "\n\n\n\n\n\n"), (502, "\n\n\n\n\n\n"), (503, "a\na\na\na"), (510, "=\n#\n=\n#\n|n"), (511, "#\n=\n#\n|n\n \n\t"), (504, "b\na\na\na\na\nb\na\na\na\na"),
                   (505, "p\nq\np\nq\np\nq\np"), (506, ""), (507, "q"), (508, "é 🙂\nñ"), (509, "x\né 🙂\nñ\ny")]


def test_matches_brute_force(spark):
    rows = corpus(4)
    got = run(spark, rows)
    assert got == brute(rows)
    assert got[501][0] == got[502][0] == "\n" * 6 and got[509][0] == "x\ny"
    for options in ({"classes": 2}, {"classes": 5, "window": 3}):  # long chunks, and chunks that share two lines
        assert run(spark, rows, **options) == brute(rows, **options)


def test_two_line_passages_are_found_whatever_stands_around_them(spark):
    """Passages of two to six lines of more than fifty words, each in several documents between foreign lines."""
    rng = random.Random(7)
    def line(words):
        return " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(words))
    passages = [[line(30) for _ in range(2 + k % 5)] for k in range(150)]
    rows, planted = [], {}
    for i in range(600):
        before, after = [line(8) for _ in range(rng.randint(0, 4))], [line(8) for _ in range(rng.randint(0, 4))]
        rows.append((i, "\n".join(before + passages[i % 150] + after)))
        planted[i] = (before, passages[i % 150], after)
    got = run(spark, rows)
    missed = [i for i in range(150, 600) if any(x in got[i][0].split("\n") for x in planted[i][1])]
    assert len(missed) <= 0.1 * 450
    # foreign lines stay, and so does the first occurrence of every passage
    assert all(set(got[i][0].split("\n")) >= set(planted[i][0] + planted[i][2]) - {""} for i in range(600))
    assert all(got[i][0] == rows[i][1] for i in range(150))


def test_recall_on_all_repeated_runs_and_no_line_is_lost(spark):
    rows = corpus(11)
    got, repeated = run(spark, rows), repeated_lines(rows)
    texts = dict(rows)
    want = sum(len({k for k in at if texts[i].split("\n")[k] != ""}) for i, at in repeated.items())
    assert want > 300
    assert sum(r[3] for r in got.values()) >= 0.9 * want
    left = {x for t in got.values() if t[0] is not None for x in t[0].split("\n")}
    assert left == {x for t in texts.values() if t is not None for x in t.split("\n")}


def test_many_lines_take_time_in_proportion(spark):
    lines = [f"row {k}" for k in range(80_000)]
    started = time.time()
    got = run(spark, [(1, "\n".join(lines)), (2, "\n".join(["head"] + lines[::-1][:3] + lines))])
    assert time.time() - started < 60
    assert got[1][0] == "\n".join(lines)
    assert got[2][3] >= 79_990 and got[2][0].startswith("head\n")


def test_awkward_rows_keep_their_columns(spark):
    df = awkward(spark)
    got = drop_repeated_chunks(df)
    assert got.columns[:len(df.columns)] == df.columns
    rows = got.collect()
    assert len(rows) == df.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[3]["text"] is None and by_id[3]["n_lines"] == 0
    assert by_id[4]["text"] == "" and by_id[4]["n_lines"] == 1 and by_id[4]["n_chunks"] == 0
    assert by_id[7]["text"] == LONG
    assert all(r["removed_lines"] == 0 for r in rows)


def test_columns_named_like_the_inner_ones_come_back_unchanged(spark):
    names = ["_id", "_text", "_row", "_lines", "_cut", "__cid", "_KEPT", "N_Lines"]
    df = spark.createDataFrame([(1, "a\nb", *names), (2, "a\nb\nc", *names)], ["doc_id", "text", *names])
    got = drop_repeated_chunks(df)
    assert got.columns == ["doc_id", "text", *names[:-1], "n_lines", "n_chunks", "removed_chunks", "removed_lines"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[1]["text"] == "a\nb" and rows[2]["text"] == "c" and rows[2]["n_lines"] == 3
    assert all(rows[2][n] == n for n in names[:-1])


def test_null_and_shared_ids(spark):
    got = drop_repeated_chunks(documents(spark, [(None, "a\nb\nx", None), (None, "a\nb\ny", None), (1, "a\nb\nz", None), (1, "a\nb\nw", None)]))
    texts = sorted(r["text"] for r in got.collect())
    assert sum(t.startswith("a\nb\n") for t in texts) == 1 and len(texts) == 4


def test_repeated_rows_are_one_document(spark):
    text = "\n".join(f"a{k}" for k in range(9))
    got = drop_repeated_chunks(documents(spark, [(1, text, None), (1, text, None)])).collect()
    assert [r["text"] for r in got] == [text, text]


def test_empty_table(spark):
    assert drop_repeated_chunks(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = drop_repeated_chunks(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
