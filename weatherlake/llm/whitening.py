"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Whitening turns vectors into uncorrelated components of unit deviation.  The
components are right singular vectors of X, the centred rows of the fit list,
and their deviations its singular values over the square root of n.  X is never
multiplied with itself: the bidiagonalisation

    X v_k = beta_(k-1) u_(k-1) + alpha_k u_k,    X^T u_k = alpha_k v_k + beta_k v_(k+1)

alternates the products X v and X^T u, each one a pass over blocks of rows on
the executors.  What comes back is as long as a row, so the driver holds the
short vectors v and the small bidiagonal matrix, and its SVD.  The long vectors
u are not stored beside the rows: each is X y for a short y, and a pass
computes the block of U that it needs from its block of rows.  Both sides are
reorthogonalised in full against all earlier vectors, u inside the passes.

Rows are whole numbers (fixed point), so sums and centring start from exact
figures: with the sums S over n rows, a centred entry is (n * x - S) / n.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weatherlake.llm.shared import modest_batches, stored, table, tidy

SCALE, SHIFT = 64, 1_000_000
WIDEST = 1 << 40  # larger fixed-point values are cut to this, so that no sum overflows
BLOCK = 1 << 21  # entries of a block of rows
TINY = 1e-12  # of the largest singular value: directions in which the fit list does not vary


@dataclass(frozen=True)
class Whitening:
    """Components (columns, unit vectors), their eigenvalues of the covariance,
    its trace, and the exact row count and sums of the fit list."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def fixed(embedding: str | Column) -> Column:
    """Entries as whole numbers: floor(64 * c) + 1000000, in double precision."""
    e = F.col(embedding) if isinstance(embedding, str) else embedding
    x = lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-float(WIDEST))), F.lit(float(WIDEST)))).cast("long") + SHIFT
    return F.transform(e.cast("array<double>"), x)


def usable(embedding: str | Column) -> Column:
    """Not null, and without null and non-finite entries."""
    e = F.col(embedding) if isinstance(embedding, str) else embedding
    return F.coalesce(e.isNotNull() & F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _packed(dim: int) -> Callable:
    """Rows -> blocks of rows, with their number and exact sums."""
    height = max(BLOCK // dim, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            x = np.concatenate(held)
            # halves of the numbers cannot overflow, whatever is in a block
            high, low = (x >> 20).sum(0), (x & 0xFFFFF).sum(0)
            sums = [str((int(h) << 20) + int(v)) for h, v in zip(high, low, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([len(x)], pa.int64()),
                                               pa.array([sums], pa.list_(pa.string()))], names=["rows", "n", "sums"])

        for batch in batches:
            held.append(_rows(batch.column(0), dim))
            if sum(map(len, held)) >= height:
                yield block()
                held = []
        if held:
            yield block()
    return run


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n in double precision: the whole part of the mean is subtracted exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


class _Passes:
    """Passes over the blocks; each returns sums of short vectors."""

    def __init__(self, blocks: DataFrame, dim: int, n: int, sums: tuple[int, ...]):
        self.blocks, self.dim, self.n, self.sums = blocks, dim, n, sums

    def over(self, work: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
        """The sum of ``work`` over all blocks.  A task adds up its own; as many numbers as
        tasks reach the driver, and there are at most a few tasks per core."""
        dim, n, sums = self.dim, self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(length)
            for batch in batches:
                for rows in batch.column(0):
                    total += work(centred(np.frombuffer(rows.as_buffer(), np.int64).reshape(-1, dim), n, sums))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

        parts = [np.frombuffer(bytes(r[0]), np.float64) for r in self.blocks.select("rows").mapInArrow(tidy(run), "total binary").collect()]
        return np.sum(parts, 0) if parts else np.zeros(length)

    def back(self, y: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """For w = X q: X^T w, U^T w and the squared length of w."""
        def work(x: np.ndarray) -> np.ndarray:
            w = x @ q
            return np.concatenate([x.T @ w, (x @ y).T @ w, [w @ w]])
        out = self.over(work, self.dim + y.shape[1] + 1)
        return out[:self.dim], out[self.dim:-1], float(out[-1])


def _fresh(v: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A unit vector orthogonal to the columns of v."""
    x = rng.standard_normal(v.shape[0])
    for _ in range(3):
        x -= v @ (v.T @ x)
        x /= np.linalg.norm(x)
    return x


def bidiagonalise(passes: _Passes, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """V (orthonormal columns) and the upper bidiagonal B with X V = U B.

    As many steps as rows have entries: the spectrum of embeddings is flat, so
    fewer do not bring the components to double precision.  Where a product
    vanishes (the fit list does not vary in further directions, or equal
    singular values) the search goes on in a fresh direction.
    """
    dim = passes.dim
    rng = np.random.default_rng(seed)
    v = _fresh(np.zeros((dim, 0)), rng)[:, None]
    y, back = np.zeros((dim, 0)), np.zeros((dim, 0))  # u_j = X y_j, and X^T u_j
    b = np.zeros((dim, dim))
    columns: list[int] = []  # the step whose u each column of y is
    largest = 0.0
    for k in range(dim):
        # X v_k, less all earlier u: by what their passes returned (u_j^T X v = (X^T u_j)^T v), and
        # once more inside the pass for what rounding left
        along = back.T @ v[:, k]
        q = v[:, k] - y @ along
        z, again, square = passes.back(y, q)
        q, z = q - y @ again, z - back @ again
        alpha = float(np.sqrt(max(square - again @ again, 0.0)))
        b[columns, k] = along + again  # u_j^T X v_k: beta for the last one, rounding for those before
        largest = max(largest, alpha, float(np.abs(b[:, k]).max(initial=0.0)))
        if alpha > TINY * largest:
            b[k, k] = alpha
            columns.append(k)
            y, back = np.column_stack([y, q / alpha]), np.column_stack([back, z / alpha])
            ahead = z / alpha
        else:
            ahead = np.zeros(dim)
        if k + 1 < dim:
            for _ in range(2):
                ahead = ahead - v @ (v.T @ ahead)
            beta = np.linalg.norm(ahead)
            v = np.column_stack([v, ahead / beta if beta > TINY * max(largest, 1e-300) else _fresh(v, rng)])
    return v, b


def fit_whitening(vectors: DataFrame, dim: int, most: int = 16) -> Whitening | None:
    """The whitening of the distinct rows of ``vectors`` (one column, arrays of
    ``dim`` longs): up to ``most`` components, those in which they vary.
    None without rows."""
    spark = vectors.sparkSession
    # few partitions, each a task of every pass that reads its blocks one after another
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    blocks = stored(vectors.distinct().mapInArrow(tidy(_packed(dim)), "rows binary, n long, sums array<string>")).coalesce(tasks)
    # figures of a block only, some kilobytes for megabytes of rows
    figures = blocks.select("n", F.posexplode("sums").alias("at", "s")).groupBy("at").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()
    if not figures:
        return None
    n, sums = int(figures[0]["n"]), tuple(int(r["s"]) for r in figures)
    passes = _Passes(blocks, dim, n, sums)
    trace = float(passes.over(lambda x: np.array([(x * x).sum()]), 1)[0]) / n
    if trace == 0.0:
        return Whitening(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0, 0.0)
    v, b = bidiagonalise(passes)
    _, singular, right = np.linalg.svd(b)
    varies = singular > max(dim, n) * np.finfo(float).eps * singular[0]
    count = min(most, int(varies.sum()))
    components, _ = np.linalg.qr(v @ right[:count].T)
    components *= np.sign((components * (v @ right[:count].T)).sum(0))
    eigenvalues = singular[:count] ** 2 / n
    per = components / np.sqrt(eigenvalues)

    def moments(x: np.ndarray) -> np.ndarray:
        w = x @ per
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    out = passes.over(moments, count + count * count) / n
    mean, square = out[:count], out[count:].reshape(count, count)
    error = float(np.abs(square - np.outer(mean, mean) - np.eye(count)).max()) if count else 0.0
    return Whitening(n, sums, components, eigenvalues, trace, error)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The sum over entries of (n * x - S)^2, exact; None where it is no long."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    d = x - whole
    if x.size and float(np.abs(d).max()) * n + n < (2.0 ** 62 / x.shape[1]) ** 0.5:
        return ((d * n - rest) ** 2).sum(1).tolist()
    # n * x - S = n * (x - S // n) - S % n, in whole numbers of any size
    out = [sum((int(a) * n - int(r)) ** 2 for a, r in zip(row, rest, strict=True)) for row in d]
    return [v if v < 1 << 63 else None for v in out]


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _applier(m: Whitening, dim: int) -> Callable:
    per = m.components / np.sqrt(m.eigenvalues)
    count = per.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(1), dim)
            w = centred(x, m.n, m.sums) @ per
            k = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(k), count))), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), k)),
                pa.array(np.full(k * count, m.n)), pa.array(deviations(x, m.n, m.sums), pa.int64()).take(pa.array(np.repeat(np.arange(k), count))),
                pa.array(w.ravel()), pa.array(np.tile(m.eigenvalues / m.trace, k) if count else np.zeros(0)), pa.array(np.full(k * count, m.identity_error))],
                names=["id", *[c.split()[0] for c in OUT.split(", ")]])
    return run


def whiten(vectors: DataFrame, *, id: str = "vec_id", embedding: str = "embedding", components: int = 16) -> DataFrame:
    """Whitened components of embeddings.

    Rows whose vector is null or holds null or non-finite entries are left
    out, and so are empty vectors, which have no components.  Entries become
    whole numbers (``fixed``; beyond 2^40 they are cut to it).  The fit list is
    each distinct vector once; vectors of different length are fitted each for
    themselves.  Returns per row and component, numbered from 1 by falling
    eigenvalue: the id (any type, nulls and repeats kept), ``component``, ``n`` (of the fit list),
    ``deviation`` (sum of (n * x - S)^2, exact; null where that is no long), ``whitened``,
    ``explained`` (share of the trace), ``identity_error`` (largest entry by which the covariance
    of the whitened fit list differs from the identity).  Fewer components
    come where the fit list varies in fewer directions, none where it has one
    vector only; an empty table gives no rows.
    """
    kind = vectors.schema[id].dataType.simpleString()
    rows = vectors.filter(usable(embedding) & (F.size(embedding) > 0)).select(F.col(id).alias("id"), fixed(embedding).alias("x"))
    dims = sorted(r[0] for r in rows.select(F.size("x")).distinct().collect())
    out = vectors.sparkSession.createDataFrame([], f"id {kind}, {OUT}")
    for k, dim in enumerate(dims):
        own = rows.filter(F.size("x") == dim) if len(dims) > 1 else rows
        model = fit_whitening(own.select("x"), dim, components)
        found = own.mapInArrow(tidy(_applier(model, dim)), f"id {kind}, {OUT}")
        out = found if k == 0 else out.unionByName(found)
    return out.withColumnRenamed("id", id)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    return whiten(table(spark, sf_dir, "embeddings"))
