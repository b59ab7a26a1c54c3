import math

import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import whitening
from orderlens.llm.whitening import op11_embedding_whitening, whiten

SCHEMA = "vec_id bigint, embedding array<float>, component string, whitened string, vector int, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", 1, "x") for i, v in rows], SCHEMA)


def brute(rows, k=8):
    """Plain loops for whole numbers and deviations, numpy's symmetric eigenvectors of the covariance for the rest."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    xs = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] + [100000] * (d - len(v)) for _, v in kept]
    n = len(xs)
    sums = [sum(x[j] for x in xs) for j in range(d)]
    deviations = [sum((n * x[j] - sums[j]) ** 2 for j in range(d)) for x in xs]
    centred = np.array([[(n * x[j] - sums[j]) / n for j in range(d)] for x in xs]).reshape(n, d)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return [i for i, _ in kept], n, deviations, centred, values, vectors, np.trace(covariance)


def compare(df, rows, k=8):
    ids, n, deviations, centred, values, vectors, trace = brute(rows, k)
    got = df.collect()
    width = len(values)
    assert len(got) == n * width
    by = {}
    for r in got:
        by.setdefault((str(r["vec_id"]), r["deviation_digits"]), []).append(r)
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["deviation"] == (int(r["deviation_digits"]) if int(r["deviation_digits"]) < 2**63 else None)
    want = centred @ vectors / np.sqrt(np.where(values > 1e-12 * max(values), values, np.nan))
    signs = {}
    copies = {}
    for i, (vec_id, deviation) in enumerate(zip(ids, deviations)):
        rows_here = by[str(vec_id), str(deviation)]
        copies.setdefault((str(vec_id), str(deviation)), []).append(i)
        for r in rows_here:
            c = r["component"] - 1
            assert r["explained"] == pytest.approx(values[c] / trace if trace else 0, rel=1e-9, abs=1e-14)
            if np.isnan(want[i, c]):
                assert r["whitened"] is None
                continue
            if abs(want[i, c]) > 1e-3:
                sign = signs.setdefault(c, np.sign(want[i, c] * r["whitened"]))
                assert len(rows_here) > width or r["whitened"] * sign == pytest.approx(want[i, c], rel=1e-7, abs=1e-9)
    for key, members in copies.items():
        assert len(by[key]) == len(members) * width


def test_matches_brute_force_with_nulls_copies_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    scales = np.geomspace(1, 0.02, 12)
    rows = [(i, (rng.normal(size=12) * scales).tolist()) for i in range(400)]
    rows += [(None, rng.normal(size=12).tolist()), (3, None), (4, [None] * 12), (5, [float("nan")] * 12),
             (6, [float("inf")] + [0.0] * 11), (7, [])]
    rows += [(900, [0.25] * 12)] * 150  # a third of all rows are copies
    compare(whiten(frame(spark, rows)), rows)


def test_ill_conditioned_columns_keep_their_small_eigenvalues(spark):
    """Of nearly dependent columns the Gram matrix alone would lose the small values."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(500, 2)) * 3000
    table = np.concatenate([base, base @ rng.normal(size=(2, 2)) + rng.normal(size=(500, 2)) / 16], axis=1)
    rows = list(enumerate(table.tolist()))
    ids, n, deviations, centred, values, vectors, trace = brute(rows)
    sigma = np.linalg.svd(centred, compute_uv=False)
    found = whitening.fit(whitened_input(spark, rows))
    assert found.values == pytest.approx(sigma**2 / n, rel=1e-8)
    assert found.identity_error < 1e-6


def whitened_input(spark, rows):
    return spark.createDataFrame(rows, "id bigint, vector array<float>").selectExpr("id", "cast(vector AS array<double>) AS vector")


@pytest.mark.parametrize("rows", [
    [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [1.0, 5.0, 2.0]), (2, [3.0, 5.0, 6.0]), (3, [2.0, 5.0, 4.0])],
    [(k, [float(k % 3), 7.0, float(k % 3) * 2, float(k % 5)]) for k in range(60)],
])
def test_components_without_variance(spark, rows):
    compare(whiten(frame(spark, rows)), rows)


def test_short_and_huge_vectors(spark):
    rows = [(k, [float(k), 1.0, float(k * k % 7)][:1 + k % 3]) for k in range(50)]
    compare(whiten(frame(spark, rows), k=2), rows, k=2)
    huge = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [5.0, 4.0])]
    out = whiten(frame(spark, huge)).collect()
    assert len(out) == 6 and all(r["deviation"] is None and int(r["deviation_digits"]) > 2**63 for r in out if r["vec_id"] < 3)


def test_many_tasks(spark):
    rng = np.random.default_rng(4)
    rows = list(enumerate((rng.normal(size=(300, 40)) * np.geomspace(2, 0.1, 40)).tolist()))
    compare(whiten(frame(spark, rows).repartition(13)), rows)


def test_blocks_cover_every_row_once(monkeypatch):
    vectors = [[float(k), 1.5][:k % 3] for k in range(50)]
    batch = pa.record_batch([pa.array(range(50)), pa.array(vectors, pa.list_(pa.float64()))], names=["id", "vector"])
    whole = whitening.whole(batch.column(1), 2)
    monkeypatch.setattr(whitening, "ROWS", 7)
    parts = list(whitening.blocks(iter([batch.slice(0, 20), batch.slice(20)]), 2))
    assert len(parts) == 3 + 5 and (np.concatenate([x for _, x in parts]) == whole).all()
    assert whole.tolist() == [[100000 + 1024 * k if k % 3 else 100000, 101536 if k % 3 == 2 else 100000] for k in range(50)]


def test_query_and_empty_tables(spark, tmp_dir):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(op11_embedding_whitening(spark, sf_dir), rows)
    for name, content in (("none", []), ("nulls", [(1, None), (2, [None])]), ("flat", [(1, [])])):
        frame(spark, content).write.parquet(f"{tmp_dir}/{name}/embeddings.parquet")
        out = op11_embedding_whitening(spark, f"{tmp_dir}/{name}")
        assert out.collect() == [] and out.columns[0] == "vec_id"
