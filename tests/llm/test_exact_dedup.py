import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderlens.llm import exact_dedup
from orderlens.llm.exact_dedup import content_sort_dedup
from orderlens.plans.materialize import materialize
from tests.llm.helpers import awkward, documents, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if largest else min)(known) if known else None
        stayed = False
        for i in ids:
            stays = i == best and not stayed
            stayed |= stays
            out.append((i, best, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df, keep):
    got = content_sort_dedup(df, keep=keep).collect()
    return sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got], key=repr)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_awkward_rows_match_brute_force(spark, keep):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert result(df, keep) == brute(rows, keep == "largest")


def test_hot_text_is_salted_and_merged(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MIN_HOT_ROWS", 5)
    rows = [(i, "Hot Text" if i % 3 == 0 else f"text {i % 50}") for i in range(600)]
    df = documents(spark, [(i, t, None) for i, t in rows]).repartition(7)
    assert result(df, "largest") == brute(rows, True)


def test_a_hot_text_with_null_or_one_id_is_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MIN_HOT_ROWS", 20)
    rows = [(None, "hot") if i % 3 == 0 else (7, "warm") if i % 3 == 1 else (i, f"text {i % 150}") for i in range(1500)]
    df = documents(spark, [(i, t, None) for i, t in rows]).repartition(7)
    for keep in ("largest", "smallest"):
        assert result(df, keep) == brute(rows, keep == "largest")
    base = df.select("doc_id", df.text.alias("norm"), F.xxhash64("text").alias("h"), F.lit(-1).cast("bigint").alias("salt"))
    parts = exact_dedup._salted(base, 50).where("salt >= 0").groupBy("norm", "salt").count().collect()
    assert {r["norm"] for r in parts} == {"hot", "warm"} and sum(r["count"] for r in parts) == 1000
    assert max(r["count"] for r in parts) <= 100


def test_texts_that_share_a_long_start_stay_apart(spark):
    rows = [(i, "z" * 500 + str(i % 4)) for i in range(40)]
    assert result(documents(spark, [(i, t, None) for i, t in rows]), "smallest") == brute(rows, False)


def test_empty_table(spark):
    assert content_sort_dedup(empty(spark)).count() == 0


def test_whole_texts_are_shuffled_once(spark, monkeypatch):
    """The windows use the range partitioning, with hot texts and without."""
    plans = []
    monkeypatch.setattr(exact_dedup, "materialize", lambda df, name: plans.append(df) or materialize(df, name))
    for hot in (5, 1000):
        monkeypatch.setattr(exact_dedup, "MIN_HOT_ROWS", hot)
        content_sort_dedup(documents(spark, [(i, f"text {i % 3}", None) for i in range(60)]))
        plan = plans[-1]._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" in plan and "hashpartitioning(prefix" not in plan


def test_no_python_in_the_plan(spark):
    plan = content_sort_dedup(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
