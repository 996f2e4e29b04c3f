"""Whitening of embeddings by their leading principal components, found by LOBPCG.

The covariance is never formed.  A pass over the rows multiplies it with a
block of vectors: each task sends the product of its centred rows with the
block, ``dim`` numbers a column, and Spark sums them.  On the driver, which
only holds such blocks, Rayleigh-Ritz runs over the iterate, its residuals and
the previous directions; all three are multiplied anew in every pass, so no
recurrence drifts, and the last residuals are certified by a pass of their own.

Vectors become exact long integers first, so sums and squared deviations are
exact.  Rows whose vector is null, or holds nulls, NaN or infinities, are left
out; so are vectors shorter than the longest, as their missing entries are
nulls.  Entries beyond 2**33 either way count as 2**33.  Null or repeated ids,
repeated vectors and other columns do not matter.  Components without variance
(under 1e-12 of the total) have no scale and give no rows; without rows, or
where all vectors are alike, there are none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .shared import discard, materialize, read_table

SCALE, SHIFT, LARGEST = 1024, 100_000, 2.0**33
#: Residuals, relative to the largest eigenvalue: aimed at, and the most that is accepted where rounding stops them.
AIM, ACCEPTED = 2e-14, 1e-10
FLAT = 1e-12
MOST_PASSES = 500


class Whitening(NamedTuple):
    """Number of rows, exact sums, mean, components (a column each), their variances, the variance of all dimensions, certified residuals."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float
    residuals: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.total

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, without loss through the size of x."""
        whole = [s // self.n for s in self.sums]
        return (x - np.array(whole, np.int64)).astype(float) - np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum of (n * x - sums) ** 2, exact; null where it is too large for a long."""
        wrap = lambda v: (v + 2**63) % 2**64 - 2**63  # noqa: E731 - arithmetic modulo 2**64 gives every sum that fits
        with np.errstate(over="ignore"):
            a = x * np.int64(wrap(self.n)) - np.array([wrap(s) for s in self.sums], np.int64)
            exact = (a * a).sum(axis=1)
        about = float(self.n) ** 2 * (self.centred(x) ** 2).sum(axis=1)
        return pa.array(exact, pa.int64(), mask=about >= 2.0**63 * (1 - 1e-9))

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.variances))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def whole_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Written table of (row: the columns of ``df``, x: array<long>) of the rows with a whole vector."""
    v = F.col(vector).cast("array<double>")
    longest = df.agg(F.max(F.size(v))).first()[0] or 0
    good = F.coalesce(F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))), F.lit(False))
    x = F.transform(v, lambda c: F.floor(SCALE * F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST))) + SHIFT)
    kept = df.where(good & (F.size(v) == longest) & (longest > 0))
    return materialize(kept.select(F.struct(*[F.col(c) for c in df.columns if c != vector]).alias("row"), x.alias("x")), "vectors")


def _summed(rows: DataFrame, size: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``of(batch of x)``, ``size`` numbers, over all rows; each task sends its own sum."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += of(_matrix(b["x"]))
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(size), pa.int32()), "v": pa.array(total)})

    got = rows.select("x").mapInArrow(part, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(size)
    out[got["k"].to_numpy()] = got["v"].to_numpy()
    return out


def _moments(rows: DataFrame) -> tuple[int, list[int]]:
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, []
        for b in batches:
            if b.num_rows:
                own = _matrix(b["x"]).sum(axis=0).tolist()
                n, sums = n + b.num_rows, [p + q for p, q in zip(sums or [0] * len(own), own, strict=True)]
        yield pa.RecordBatch.from_pydict({"k": pa.array(range(-1, len(sums)), pa.int32()), "v": pa.array([str(v) for v in (n, *sums)])})

    sums = rows.select("x").mapInArrow(part, "k int, v string").groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    got = {r["k"]: int(r["v"]) for r in sums.collect()}  # a row for each dimension
    return got.pop(-1, 0), [got[k] for k in sorted(got)]


def _complement(block: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the span of the others (themselves orthonormal)."""
    norms = np.linalg.norm(block, axis=0)
    block = block[:, norms > 0] / norms[norms > 0]
    for _ in range(2):  # twice is enough
        for o in others:
            block = block - o @ (o.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-8]
    return block


def fit(rows: DataFrame, count: int, seed: int = 1) -> Whitening:
    """Leading components of the written ``rows`` (x), at most ``count``."""
    n, sums = _moments(rows)
    dim = len(sums)
    w = Whitening(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0, np.zeros(0))
    if not n:
        return w
    total = float(_summed(rows, 1, lambda x: np.array([(w.centred(x) ** 2).sum()]))[0]) / n
    if not total:
        return w

    def times(block: np.ndarray) -> np.ndarray:
        """Covariance times a block: one pass over the rows."""

        def of(x):
            z = w.centred(x)
            return (z.T @ (z @ block)).ravel()

        return _summed(rows, block.size, of).reshape(block.shape) / n

    wide = min(dim, 2 * count + 4)  # columns beyond those wanted speed the last ones up
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, wide)))[0]
    ax = times(x)
    values, c = np.linalg.eigh(x.T @ ax)
    values, x, ax = values[::-1], x @ c[:, ::-1], ax @ c[:, ::-1]
    p, best, stuck = np.zeros((dim, 0)), np.inf, 0
    wanted = min(count, dim)
    for _ in range(MOST_PASSES):
        r = ax - x * values
        worst = np.linalg.norm(r[:, :wanted], axis=0).max() / values[0]
        stuck = 0 if worst < best / 2 else stuck + 1
        best = min(best, worst)
        if worst <= AIM or (stuck >= 3 and worst <= ACCEPTED):
            x = np.linalg.qr(x)[0]
            ax = times(x)  # certified on a product of its own
            values = np.einsum("ij,ij->j", x, ax)
            order = np.argsort(-values, kind="stable")
            x, ax, values = x[:, order], ax[:, order], values[order]
            residuals = np.linalg.norm(ax - x * values, axis=0)[:wanted]
            if residuals.max() <= ACCEPTED * values[0]:
                keep = np.flatnonzero(values[:wanted] > FLAT * total)
                return w._replace(components=x[:, keep], variances=values[keep], total=total, residuals=residuals[keep])
            r = ax - x * values
        x = np.linalg.qr(x)[0]
        res = _complement(r, x)
        p = _complement(p, x, res) if p.shape[1] and res.shape[1] else np.zeros((dim, 0))
        basis = np.hstack([x, res, p])
        product = times(basis)
        inner = basis.T @ product
        _, c = np.linalg.eigh((inner + inner.T) / 2)
        c = c[:, ::-1][:, :wide]
        beside = c.copy()
        beside[:wide] = 0  # the new direction: what did not come from the old iterate
        x, ax, p = basis @ c, product @ c, basis @ beside
        values = np.einsum("ij,ij->j", x, ax)
    raise ArithmeticError(f"residuals stay at {best:.2g} of the largest variance after {MOST_PASSES} passes")


def whiten(rows: DataFrame, w: Whitening) -> DataFrame:
    """Add ``deviation`` and ``whitened`` (array<double>, one for each component) to written ``rows``; x goes."""
    row = rows.schema["row"]

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b["x"])
                out = w.project(x)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([b["row"], w.deviations(x), lists], names=["row", "deviation", "whitened"])

    return rows.mapInArrow(body, StructType([row, StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))]))


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, over all rows."""
    k = len(w.variances)

    def of(x):
        out = np.hstack([w.project(x), np.ones((len(x), 1))])
        return (out.T @ out).ravel()

    m = _summed(rows, (k + 1) ** 2, of).reshape(k + 1, k + 1) / w.n
    return float(np.abs(m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k)).max())


def op12_whitening(spark: SparkSession, sf_dir: str, count: int = 8) -> DataFrame:
    rows = whole_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    w = fit(rows, count)
    if not len(w.variances):
        discard(rows)
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double")
    facts = F.array(*[F.struct(F.lit(k + 1).alias("component"), F.lit(float(e)).alias("explained"), F.lit(float(r)).alias("residual")) for k, (e, r) in enumerate(zip(w.explained, w.residuals, strict=True))])
    out = whiten(rows, w).select("row.vec_id", "deviation", F.explode(F.arrays_zip(facts.alias("f"), F.col("whitened").alias("w"))).alias("p"))
    return out.select(
        "vec_id", "p.f.component", F.lit(w.n).cast("long").alias("n"), "deviation", F.col("p.w").alias("whitened"), "p.f.explained",
        F.lit(identity_error(rows, w)).alias("identity_error"), "p.f.residual",
    )
