import random
from collections import defaultdict

from orderlens.llm import chat
from orderlens.llm.chat import format_chats

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos string, block string, a string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "unknown", text or ""))
    seqs = {c: tuple((r, t) for *_, r, t in sorted(v)) for c, v in turns.items()}
    best = {}
    for c, s in seqs.items():
        key = (c is not None, c or 0)
        if s not in best or key < best[s][0]:
            best[s] = (key, c)
    prefixes = {s[:n] for s in seqs.values() for n in range(1, len(s))}
    return {c: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in s) for s, (_, c) in best.items() if s not in prefixes}


def joined(df):
    parts = defaultdict(dict)
    for r in df.collect():
        parts[r["conv_id"]][r["part"]] = r["chat"]
        assert r["part"] < r["n_parts"]
    return {c: "".join(p[k] for k in sorted(p)) for c, p in parts.items()}


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)  # conversations over several blocks
    rng = random.Random(2)
    rows = []
    for conv in range(150):
        source = conv % 20
        n = rng.randint(1, 9)
        rows += [(conv, t, "user" if t % 2 == 0 else "assistant", f"{source} says {t}") for t in range(n)]
    rows += [(900, None, None, None), (900, 0, "user", ""), (901, 5, "user", "x"), (901, 5, "user", "x"), (901, 5, "user", "a"),
             (None, 0, "user", "alone"), (None, 1, "user", None), (902, -4, "user", "neg"), (902, 700, "user", "far")]
    rng.shuffle(rows)
    got = joined(format_chats(frame(spark, rows).repartition(6), turns_per_part=4))
    assert got == brute(rows)


def test_long_conversation_is_rendered_in_parts(spark):
    rows = [(1, t, "user", f"turn {t}") for t in range(1000)] + [(2, t, "user", f"turn {t}") for t in range(600)]
    got = format_chats(frame(spark, rows))
    assert joined(got) == brute(rows)
    assert got.count() == 4


def test_empty_table(spark):
    assert format_chats(frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = format_chats(frame(spark, [(1, 0, "user", "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
