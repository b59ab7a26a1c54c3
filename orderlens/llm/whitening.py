r"""Embedding whitening by shifted CholeskyQR.

Vectors are made integers, x = floor(1024 c) + 100000, and centred exactly: with
n vectors and sums S per dimension, n x - S is a whole number.  The centred
rows, a tall matrix X spread over the cluster, are orthogonalised by passes

    G = Q'Q summed over all rows,   R = chol(G + s I),   Q <- Q inv(R),

beginning with Q = X.  The shift s, a few rounding errors of G's norm, keeps
the first factorisation from breaking down where columns depend on each other
(later ones need none, or take it up where they break down).  No Q
is ever stored: a pass recomputes its rows from the vectors by one triangular
solve for each factor so far.  When Q'Q is the identity to rounding (or after
``PASSES`` factors, as columns without any variance never get there), its square
root F is the last factor and X'X = (F R_k .. R_1)'(F R_k .. R_1), so the singular
values and right singular vectors of that d x d product are those of X:
e = sigma^2 / n are the eigenvalues and the vectors the components.  No covariance
matrix of the rows is decomposed, so small eigenvalues keep their digits.

Scale: every pass is one map over the vectors with one d x d Gram matrix a task,
added up entry by entry in Spark; the driver sees the d x d sum alone, never
anything that grows with the number of vectors.  Integer sums are exact, as decimals of 38 digits.  The measured
covariance of the whitened vectors is one more pass of the same kind.

Defined cases: a vector that is null or holds a null, NaN or infinite entry is
left out; vectors shorter than the longest have zero for what they lack; entries
of 2^42 and more in size count as that bound; equal vectors each count, rows with null or equal ids stay rows of
their own; a component without variance (its singular value is below the
rounding error of the largest) has ``explained`` 0 and null ``whitened``, and
``identity_error`` is measured over the others (0 if there are none); a sum of
squares that a long cannot hold is null in ``deviation``, ``deviation_digits``
has it in full; an empty table, or one without a dimension, gives no rows;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import table

SCALE, OFFSET = 1024, 100_000
LARGEST = 1 << 52
COMPONENTS = 8
PASSES = 4  # factors at most; two or three suffice unless columns depend on each other
ROWS = 4096  # vectors that are worked on at a time


def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null, NaN or infinite."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def whole(vectors: pa.Array, d: int) -> np.ndarray:
    """Lists of doubles -> rows of d whole numbers."""
    lengths = np.diff(vectors.offsets.to_numpy())
    entries = np.asarray(vectors.flatten(), dtype=np.float64)
    x = np.full((len(vectors), d), OFFSET, dtype=np.int64)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(entries * SCALE), -LARGEST, LARGEST).astype(np.int64) + OFFSET
    x[np.arange(d)[None, :] < lengths[:, None]] = scaled
    return x


def blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches (id, vector) in parts of some thousand rows, with their whole numbers."""
    step = max(1, min(ROWS, (1 << 22) // max(1, d)))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, whole(part.column(1), d)


def offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: as longs where they and the products fit, else as Python's integers."""
    if n * (LARGEST if np.abs(x).max(initial=0) >= 1 << 31 else 1 << 31) < 1 << 62 and all(abs(s) < 1 << 62 for s in sums):
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squares(y: np.ndarray) -> list[int]:
    """Sums of squares over the dimensions, exact."""
    if y.dtype != object:
        if int(np.abs(y).max(initial=0)) ** 2 * max(1, y.shape[1]) < 1 << 63:
            return (y * y).sum(axis=1).tolist()
        y = y.astype(object)
    return [int(v) for v in (y * y).sum(axis=1)] if y.size else [0] * len(y)


class Whitener:
    """What the passes have found: n, sums, the factors, then values and components."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums, self.factors = n, sums, []
        self.values = self.components = np.zeros(0)
        self.identity_error = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (offsets(x, self.n, self.sums) / self.n).astype(np.float64)

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        """Rows of Q after the factors so far."""
        q = self.centred(x).T
        for r in self.factors:
            q = substitute(r, q)
        return q.T

    def finish(self, last: np.ndarray) -> None:
        """Singular values and vectors of the product of all factors and the last one."""
        product = np.eye(len(self.sums))
        for r in self.factors:
            product = r @ product
        _, sigma, turned = np.linalg.svd(last @ product)
        sigma[sigma <= sigma.max(initial=0) * len(sigma) * np.finfo(float).eps] = 0
        self.values, self.components = sigma * sigma / self.n, turned

    def rank(self, k: int) -> int:
        """How many of the first k components have variance."""
        return int(np.count_nonzero(self.values[:k]))

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        """Projections on the first components over the square roots of their values."""
        k = self.rank(k)
        return self.centred(x) @ (self.components[:k] / np.sqrt(self.values[:k])[:, None]).T


def substitute(r: np.ndarray, q: np.ndarray, width: int = 32) -> np.ndarray:
    """Solve r' y = q for upper triangular r, some rows of y after the others."""
    y = np.empty_like(q)
    for at in range(0, len(r), width):
        to = slice(at, at + width)
        y[to] = np.linalg.solve(r[to, to].T, q[to] - r[:at, to].T @ y[:at])
    return y


def shifted_cholesky(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper triangular R with R'R = G + s I; s is 0 behind the first pass unless the factorisation breaks down."""
    d, unit = len(gram), np.finfo(float).eps
    least = 11 * (d * min(n, 1 << 20) + d * (d + 1)) * unit * max(np.linalg.norm(gram, 2), np.finfo(float).tiny)
    for shift in (least if first else 0, *(least * 16**k for k in range(16))):
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
    raise ArithmeticError("the Gram matrix is not finite")


def half(gram: np.ndarray) -> np.ndarray:
    """F with F'F = G, also where G is singular."""
    values, vectors = np.linalg.eigh(gram)
    return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


def gram_pass(vectors: DataFrame, rows: Callable[[np.ndarray], np.ndarray], d: int, width: int) -> np.ndarray:
    """The sum of y y' over the rows y (of ``width`` numbers) that ``rows`` makes of the vectors."""
    i, j = np.triu_indices(width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, x in blocks(batches, d):
            y = rows(x)
            total += y.T @ y
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])

    gram = np.zeros((width, width))
    for r in vectors.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = r["v"]
    return gram


def sums_pass(vectors: DataFrame, d: int) -> list[int]:
    """Sums of the whole numbers of each dimension, exact."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for _, x in blocks(batches, d):
            # high and low halves: neither sum of a block can overflow
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(w) for t, h, w in zip(total, high, low)]
        yield pa.record_batch([pa.array(range(d), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["at", "total"])

    by_place = vectors.mapInArrow(partial, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total"))
    return [int(r["total"]) for r in sorted(by_place.collect(), key=lambda r: r["at"])]


def fit(vectors: DataFrame, k: int = COMPONENTS) -> Whitener | None:
    """vectors: (id, vector array<double>), usable ones alone.  None without a vector or a dimension."""
    known = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d")).first()
    n, d = known["n"], known["d"]
    if not n or not d:
        return None
    found = Whitener(n, sums_pass(vectors, d))
    while True:
        gram = gram_pass(vectors, found.orthogonal, d, d)
        done = np.abs(gram - np.eye(d)).max() < 8 * d * np.finfo(float).eps
        if found.factors and (done or len(found.factors) == PASSES):
            break
        found.factors.append(shifted_cholesky(gram, n, not found.factors))
    found.finish(half(gram))
    if k := found.rank(k):  # the centred rows add up to zero, and so do their projections
        covariance = gram_pass(vectors, lambda x: found.whitened(x, k), d, k) / n
        found.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return found


def whiten(frame: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """The id, component, n, deviation, whitened, explained, identity_error, deviation_digits: a row for each usable
    vector and component."""
    vectors = frame.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"),
                                                            F.col(vector_col).cast("array<double>").alias("vector"))
    kind = dict(vectors.dtypes)["id"]
    ddl = (f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
           "identity_error double, deviation_digits string")
    found = fit(vectors, k)
    if found is None:
        return frame.sparkSession.createDataFrame([], ddl)
    d = len(found.sums)
    width, total = min(k, d), found.values.sum()
    explained = found.values[:width] / (total or 1.0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in blocks(batches, d):
            projected = np.full((len(x), width), np.nan)
            projected[:, :found.rank(width)] = found.whitened(x, width)
            deviation = squares(offsets(x, found.n, found.sums))
            each = np.repeat(np.arange(len(x)), width)
            yield pa.record_batch([
                part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), found.n, dtype=np.int64)),
                pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()).take(pa.array(each)),
                pa.array(projected.ravel(), from_pandas=True), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(each), found.identity_error)),
                pa.array([str(v) for v in deviation], pa.string()).take(pa.array(each)),
            ], names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_digits"])

    return vectors.mapInArrow(rows, ddl)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
