import random
from itertools import combinations

import numpy as np
import xxhash

from orderlens.llm import golay, simhash
from orderlens.llm.components import components
from orderlens.llm.simhash import fingerprint, link_edges, near_duplicates
from tests.llm.helpers import awkward, documents, empty, words


def brute_print(text):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    grams = [b" ".join(tokens)] if len(tokens) < 3 else [b" ".join(tokens[i:i + 3]) for i in range(len(tokens) - 2)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: list of (id, fingerprint) -> component id of each, by breadth-first search."""
    out = {}
    for i in range(len(prints)):
        if i in out:
            continue
        group, queue = {i}, [i]
        while queue:
            a = queue.pop()
            for b in range(len(prints)):
                if b not in group and bin(prints[a][1] ^ prints[b][1]).count("1") <= 2:
                    group.add(b)
                    queue.append(b)
        ids = [prints[k][0] for k in group if prints[k][0] is not None]
        out.update(dict.fromkeys(group, min(ids) if ids else None))
    return [out[i] for i in range(len(prints))]


def test_golay_neighbours_share_a_codeword():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 23, size=300)
    for flips in [(), *[(a,) for a in range(23)], *combinations(range(23), 2)]:
        other = base ^ sum(1 << f for f in flips)
        a, b = golay.near_indices(base), golay.near_indices(other)
        assert ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any(axis=(1, 2)).all()


def test_fingerprints_match_brute_force():
    texts = [None, "", " \n", "one", "One two", "a b c", "A\tB\x0bC d", "é É x", " ".join(words(1, 700)),
             " ".join(words(2, simhash.CHUNK + 600))]
    assert [fingerprint(t) for t in texts] == [brute_print(t) for t in texts]


def links(spark, prints, bucket):
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in sorted(set(prints))], "fp bigint")
    roots = {r["node"]: r["root"] for r in components(link_edges(frame, bucket)).collect()}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    return [roots.get(p, p) for p in signed]


def test_links_equal_brute_force_with_and_without_crowded_buckets(spark):
    rng = random.Random(6)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for seed in prints[:12]:
        at = seed
        for _ in range(12):  # chains and balls around it
            at ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3, 4])))
            prints.append(at)
            prints.append(seed ^ 1 << rng.randrange(64))
    want = brute_components(list(enumerate(prints)))
    for bucket in (2, 32):
        got = links(spark, prints, bucket)
        assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_near_duplicates_on_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r["doc_id"], brute_print(r["text"])) for r in df.collect()]
    want = sorted(((i, f"{p:016x}", c) for (i, p), c in zip(rows, brute_components(rows))), key=repr)
    got = sorted([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in near_duplicates(df).collect()], key=repr)
    assert got == want


def test_near_copies_are_found(spark):
    base = words(9, 900)
    rows = []
    for i in range(20):
        own = list(base)
        own[i * 7] = "changed"
        rows.append((i, " ".join(own), None))
    rows.append((99, " ".join(words(10, 900)), None))
    df = documents(spark, rows)
    prints = [(i, brute_print(t)) for i, t, _ in rows]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()}
    assert got == {i: c for (i, _), c in zip(prints, brute_components(prints))} and got[99] == 99


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).count() == 0
