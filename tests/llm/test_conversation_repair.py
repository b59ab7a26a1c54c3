import hashlib
import heapq
import random
import re
import zlib

import pytest

from orderlens.llm import conversation_repair as cr
from orderlens.llm.conversation_repair import op12_conversation_repair, ordered_rows, repair, repair_damaged

SHAPE = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, at string, audit string, cost string, total int"


def brute_repair(rows):
    """rows: (role, text, fault) -> (cost, audit, lines), by a search over prefixes of the repaired conversation
    with tuples (cost, audit) as priorities; up to two insertions in front of each row and at the end.
    Of short conversations every prefix is followed, of others only the least of those with one last role."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if i > len(rows):
            return cost, audit, lines
        if len(rows) > 4:
            if (i, roles[-1:]) in seen:
                continue
            seen.add((i, roles[-1:]))
        for inserted in ("", "u", "a", "ua", "au"):
            c0, a0, r0 = cost + 3 * len(inserted), audit + "I" * len(inserted), roles + inserted
            l0 = lines + tuple("user:" if x == "u" else "assistant:" for x in inserted)
            if i == len(rows):
                if SHAPE.fullmatch(r0):
                    heapq.heappush(heap, (c0, a0, i + 1, r0, l0))
                continue
            role, text, fault = rows[i]
            options = [("D", 4, "", ())]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                options += [("K", more, role[:1] or "?", (f"{role}:{text}",))]
                options += [("R", 3 + more, r[0], (f"{r}:{text}",)) for r in ("user", "assistant")]
            for letter, c, r, line in options:
                new = r0 + r
                if any(SHAPE.fullmatch(new + tail) for tail in ("", "a", "ua")):
                    heapq.heappush(heap, (c0 + c, a0 + letter, i + 1, new, l0 + line))
    raise AssertionError


def brute_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(cr.SPACES)
        out.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen
                    else "truncated" if bare[-1] not in ".!?" else None))
        seen.add((role, text))
    return out


def brute(table):
    """(conv_id, turn, role, text) rows -> {conv_id: result}, as the contract reads."""
    convs = {}
    for conv_id, turn, role, text in table:
        rows = convs.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv_id, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in rows if t is not None]
        faults = brute_faults([(r, t) for _, r, t in rows])
        kinds = [f for _, _, f in faults]
        cost, audit, lines = brute_repair(faults)
        out[conv_id] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                        *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                        sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _, _), (b, _, _) in zip(faults, faults[1:])),
                        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", 1) for r in rows], SCHEMA)


def collected(df):
    rows = df.collect()
    out = {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                          r["repaired_sha256"]) for r in rows}
    assert len(out) == len(rows)
    return out


def made(rng, n, conv_id, roles=("user", "assistant", "system", "tool", "", None, "u", "auditor")):
    weights = [8, 8, 2, 1, 1, 1, 1, 1][:len(roles)]
    texts = ["Yes.", "No!", "a", "b. ", "", "\t", None, "é🙂?", "c.\n", "long " * 30 + "end.", "long " * 30 + "End."]
    return [(conv_id, rng.choice([None, *range(n)]) if rng.random() < 0.3 else k, rng.choices(roles, weights)[0], rng.choice(texts))
            for k in range(n)]


@pytest.mark.parametrize("n_rows, n_chars", [(256, 1 << 20), (1, 1 << 20), (3, 1 << 20), (256, 20)])
def test_repair_matches_search(spark, n_rows, n_chars):
    rng = random.Random(n_rows + n_chars)
    table = [r for k in range(60) for r in made(rng, rng.randint(1, 9), k)] + made(rng, 7, None) + made(rng, 40, 1000)
    rng.shuffle(table)
    assert collected(repair_damaged(frame(spark, table), n_rows, n_chars)) == brute(table)


def test_chained_segments_equal_one_path():
    """Whatever the cut, the segments' states and audits are those of one path over all rows."""
    rng = random.Random(5)
    for _ in range(150):
        rows = [(rng.choice(["user", "assistant", "system", "x"]), rng.choice([None, None, None, "truncated", "blank"]))
                for _ in range(rng.randint(1, 10))]
        cost, audit, _ = brute_repair([(r, "t", f) for r, f in rows])
        for size in (1, 2, 3, 11):
            best, steps = {cr.START: (0, 0)}, []
            for at in range(0, len(rows), size):
                solved = {e: cr.solve(rows[at:at + size], e) for e in cr.STATES}
                ways = {(e, to): (found[to][0], sorted(found, key=lambda t: found[t][1]).index(to))
                        for e, found in solved.items() for to in found}
                best, before = cr.advance(best, ways)
                steps.append((solved, before))
            total, state = cr.ended(best)
            letters = cr.ENDING[state]
            for solved, before in reversed(steps):
                letters, state = solved[before[state]][state][1] + letters, before[state]
            assert (total, letters, state) == (cost, audit, cr.START)


def test_audit_order_is_ascii_and_short_audits_come_first():
    assert "".join(sorted(cr.LETTERS)) == cr.LETTERS
    rows = [("user", None), ("user", None)]  # KDI 7, KR 3, KIKI 6, ...
    assert brute_repair([(r, "t", f) for r, f in rows])[:2] == (3, "KR")
    assert cr.solve(rows, cr.START)[cr.ASSISTANT] == (3, "KR")


def test_copies_are_counted_and_all_but_the_first_deleted(spark):
    # a third of all rows is one row: it is counted before any sort
    rows = [(7, 5, "user", "Same.", 400)] + [(7, 100 + k, ("assistant", "user")[k % 2], f"t{k}.", 1) for k in range(800)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, copies bigint")
    out = repair(df).collect()
    assert len(out) == 1 and out[0]["duplicate"] == 399 and out[0]["cost"] == 4 * 399 + 3
    assert out[0]["audit"] == "K" + "D" * 399 + "K" * 800 + "I"
    lines = ["user:Same.", *(f"{r}:{t}" for _, _, r, t, _ in rows[1:]), "assistant:"]
    assert out[0]["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_one_conversation_is_spread_over_tasks(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(6000)] + [(k, 0, "user", "x.") for k in range(2, 3000)]
    df = frame(spark, rows).selectExpr("conv_id", "turn", "role", "text", "1L AS copies")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task
    try:
        spread = ordered_rows(df).where("conv_id = 1").selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
        assert len(spread) >= 4 and max(r["count"] for r in spread) < 3000
        result = {r["conv_id"]: r for r in repair(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(result) == 2999 and result[1]["audit"] == "K" * 6000 and result[1]["cost"] == 0 and result[2]["audit"] == "KI"


def test_long_texts_and_lost_conversations(spark):
    lost = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kept = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 > 4)
    table = [(lost, 0, "user", "Hi."), (kept, 0, "user", "word " * 700_000 + "."), (kept, 0, None, "word " * 700_000 + ".")]
    assert collected(repair_damaged(frame(spark, table))) == brute(table)


def test_query_on_the_table_and_on_an_empty_one(spark, tmp_dir):
    sf_dir = "/root/testdata/sf0.001"
    got = collected(op12_conversation_repair(spark, sf_dir))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows)
    frame(spark, []).write.parquet(f"{tmp_dir}/conversations.parquet")
    assert op12_conversation_repair(spark, tmp_dir).collect() == []
