import hashlib
import random
import re

from orderlens.llm.pii import find_pii, op9_pii
from tests.llm.helpers import awkward, documents, empty


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def found(df, keep_at=0.5):
    return {r["doc_id"]: [f"{s['kind']}:{s['start']}:{s['stop']}" for s in r["spans"]]
            for r in find_pii(df, keep_at=keep_at).collect()}


def base(spans):
    return [s for s in spans if s.split(":")[0] in ("email", "ip", "card", "phone")]


FIXED = [
    "mail a.b+c@x-y.example.org or foo@bar@baz.com, a@b.c_d@e.f g@h", "1.2.3.4.5.6.7.8 and 256.1.1.1 and 000255.0.0.1 9.9.9",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111000", "+1 (555) 010-9999 +44.20.7946.0958- +1 +12 3",
    "é🙂 x@y.zz 🙂 10.0.0.255", "1" * 40, "99999999999999999999.1.1.1", "@@@@ a@ @b.c", "+1" * 30, "1.1.1.1" * 20,
]


def test_fixed_texts_match_brute_force(spark):
    got = found(documents(spark, [(i, t, None) for i, t in enumerate(FIXED)]))
    for i, t in enumerate(FIXED):
        assert base(got[i]) == brute(t), t


def test_random_texts_match_brute_force(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("a1 0.-@+()é4", k=rng.randint(0, 80))) for _ in range(400)]
    got = found(documents(spark, [(i, t, None) for i, t in enumerate(texts)]))
    for i, t in enumerate(texts):
        assert base(got[i]) == brute(t), t


def test_long_runs_neither_overflow_nor_stall(spark):
    texts = ["a" * 300_000, "1" * 300_000 + "@", "1-" * 150_000, "+" + "1(" * 100_000, "1." * 100_000, "x@y.z " * 20_000,
             "a@" + "b." * 100_000]
    got = found(documents(spark, [(i, t, None) for i, t in enumerate(texts)]))
    # stated, not computed: the plain patterns take quadratic time on these
    assert base(got[0]) == base(got[2]) == []
    assert base(got[4]) == [f"ip:{8 * k}:{8 * k + 7}" for k in range(25_000)]
    assert base(got[5]) == [f"email:{6 * k}:{6 * k + 5}" for k in range(20_000)]
    assert base(got[6]) == ["email:0:200001"]


def test_added_kinds_need_checksum_and_context(spark):
    texts = ["iban DE89370400440532013000 end", "iban DE88370400440532013000 end", "GB29 NWBK 6016 1331 9268 19",
             "ssn 078-05-1120", "part 078-05-1120", "visa 4222222222222", "order 4222222222222"]
    got = found(documents(spark, [(i, t, None) for i, t in enumerate(texts)]))
    kinds = {i: [s.split(":")[0] for s in v] for i, v in got.items()}
    assert kinds == {0: ["iban"], 1: [], 2: ["iban"], 3: ["ssn"], 4: [], 5: ["card13"], 6: []}


def test_ibans_end_where_their_country_says(spark):
    texts = ["NL91ABNA0417164300", "DE89370400440532013000 BIC COBADEFFXXX", "GB29NWBK60161331926819 EUR 50",
             "DE89370400440532013000 I paid", "DE89 3704 0044 0532 0130 00 EUR 50", "NO93 8601 1117 947 2024",
             "AT12 DE89 3704 0044 0532 0130 00", "UK12 NL91ABNA0417164300", "NL91ABNA0417164300 BE68 5390 0754 7034 DE",
             "MT84MALT011000012345MTLCAST001S", "DE89370400440532013000X", "XNL91ABNA0417164300", "DE8937040044053201300"]
    got = found(documents(spark, [(i, t, None) for i, t in enumerate(texts)]))
    ibans = {i: [tuple(map(int, s.split(":")[1:])) for s in v if s.startswith("iban:")] for i, v in got.items()}
    assert ibans == {0: [(0, 18)], 1: [(0, 22)], 2: [(0, 22)], 3: [(0, 22)], 4: [(0, 27)], 5: [(0, 18)], 6: [(5, 32)],
                     7: [(5, 23)], 8: [(0, 18), (19, 38)], 9: [(0, 31)], 10: [], 11: [], 12: []}


def test_awkward_rows(spark):
    assert all(v == [] for v in found(awkward(spark)).values())
    assert find_pii(awkward(spark)).count() == 14
    assert find_pii(empty(spark)).count() == 0


def test_digest_of_the_query(spark, tmp_dir):
    rows = [(1, "a@b.cc 1.2.3.4", None), (2, None, None)]
    documents(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in op9_pii(spark, tmp_dir).collect()}
    assert got[1]["base_sha256"] == hashlib.sha256(b"email:0:6,ip:7:14").hexdigest()
    assert (got[1]["n_email"], got[1]["n_ip"], got[2]["n_email"]) == (1, 1, 0)
    assert got[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_no_python_in_the_plan(spark):
    plan = find_pii(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
