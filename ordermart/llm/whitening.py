"""Whitening of embeddings by polarisation.

Vectors are scaled to integers, and every distinct one counts once (the fit
list). For each dimension a and each pair a < b the exact sums of the squared
centred values z_a and z_a + z_b are aggregated, z = n*x - S. The polarisation
identity gives all cross-covariances from these variances alone:
2 * sum z_a z_b = sum (z_a + z_b)^2 - sum z_a^2 - sum z_b^2, exactly.

A task turns its rows into one partial sum for each dimension and pair, in
integers; Spark adds the partial sums. Only the covariance matrix, its size the
square of the dimension, reaches the driver, for eigh.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, COMPONENTS, ROWS = 256, 4, 1024
#: partial sums travel as high and low decimal parts, so no sum of them overflows
UNIT = 10 ** 18
PARTS = "a int, b int, high decimal(38,0), low decimal(38,0)"
#: a component with less than this share of all variance has no direction of its own in double precision
LEAST = 1e-13


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and x, the vector times ``scale`` rounded down, of the rows whose
    vector is fit to use: not null or empty, only finite entries that a long
    holds after scaling, and of the commonest length (of equally common: the
    longest)."""
    entry = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), entry.alias("v"))
    # NaN is above every number for Spark; 2^63 and beyond are no longs
    fits = F.forall("v", lambda c: c.isNotNull() & (c * scale < F.lit(2.0 ** 63)) & (c * scale >= F.lit(-2.0 ** 63)))
    rows = rows.where((F.size("v") > 0) & fits)
    rows = rows.select("vec_id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))
    # one row per length of vector
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("x") == F.lit(top["d"] if top else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows x dimensions of a list column without nulls, all of one length."""
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1)


def square_sums(z: np.ndarray) -> list[int]:
    """Exact sum of the squares of each column."""
    top = int(max(z.max(), -int(z.min()))) if z.size else 0
    if z.dtype != object and top * top * len(z) < 1 << 63:
        return np.einsum("ij,ij->j", z, z).tolist()
    if z.dtype != object and top < 1 << 52 and len(z) <= 1 << 10:
        # two limbs of 26 bits, their products summed apart
        high, low = z >> 26, z & ((1 << 26) - 1)
        hh, hl, ll = (np.einsum("ij,ij->j", p, q).tolist() for p, q in ((high, high), (high, low), (low, low)))
        return [(h << 52) + (m << 27) + s for h, m, s in zip(hh, hl, ll, strict=True)]
    z = z.astype(object)
    return (z * z).sum(axis=0).tolist()


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S exactly: longs where twice the largest fits, else Python integers."""
    top = int(max(x.max(), -int(x.min()))) if x.size else 0
    if 2 * (n * top + max(map(abs, sums.tolist()), default=0)) < 1 << 62:
        return x * np.int64(n) - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _sent(index, totals) -> pa.RecordBatch:
    high, low = zip(*(divmod(t, UNIT) for t in totals), strict=True)
    kind = pa.decimal128(38, 0)
    a, b = index
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                                       pa.array([int(h) for h in high], kind), pa.array([int(v) for v in low], kind)],
                                      names=["a", "b", "high", "low"])


def _added(parts: DataFrame) -> dict[tuple[int, int], int]:
    """The exact totals: one row per dimension or pair on the driver."""
    rows = parts.groupBy("a", "b").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(r["a"], r["b"]): int(r["high"]) * UNIT + int(r["low"]) for r in rows}


def dimension_sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and exact sum of each dimension."""

    def run(batches):
        n, totals = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                n += len(x)
                # halves of 32 bits: their sums stay longs
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                own = [(int(h) << 32) + int(v) for h, v in zip(high, low, strict=True)]
                totals = own if totals is None else [p + q for p, q in zip(totals, own, strict=True)]
        if totals:
            d = len(totals)
            yield _sent(([*range(d), -1], [*range(d), -1]), [*totals, n])

    found = _added(fit.select("x").mapInArrow(run, PARTS))
    n = found.pop((-1, -1), 0)
    return n, np.array([found[k] for k in sorted(found)], object)


def polarised_sums(fit: DataFrame, n: int, sums: np.ndarray) -> dict[tuple[int, int], int]:
    """Exact sums over the fit list of z_a^2 at (a, a) and (z_a + z_b)^2 at
    (a, b), a < b."""
    d = len(sums)
    a, b = np.triu_indices(d)

    def run(batches):
        totals = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                z = centred(_matrix(batch.column("x").slice(start, ROWS)), n, sums)
                own: list[int] = []
                for k in range(d):
                    both = z[:, k:k + 1] + z[:, k:]
                    both[:, 0] = z[:, k]  # the dimension itself
                    own += square_sums(both)
                totals = own if totals is None else [p + q for p, q in zip(totals, own, strict=True)]
        if totals:
            yield _sent((a, b), totals)

    return _added(fit.select("x").mapInArrow(run, PARTS))


@dataclass
class Whitener:
    """Fit of a list of ``n`` integer vectors: exact sums and covariance, unit
    components by falling eigenvalue, and the share of variance of each."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    def projected(self, z: np.ndarray, count: int) -> np.ndarray:
        """Rows x components; NaN for components without variance."""
        values = self.values[:count]
        usable = values > LEAST * max(self.values.sum(), 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (z.astype(np.float64) / self.n) @ self.vectors[:, :count] / np.sqrt(values)
        out[:, ~usable] = np.nan
        return out


def fitted(fit: DataFrame) -> Whitener | None:
    """The whitener of a list of distinct vectors ``x``; None without rows."""
    n, sums = dimension_sums(fit)
    if not n:
        return None
    d, found = len(sums), polarised_sums(fit, n, sums)
    exact = [[0] * d for _ in range(d)]
    for a in range(d):
        for b in range(a, d):
            # 2 z_a z_b = (z_a + z_b)^2 - z_a^2 - z_b^2; z is n times the centred value
            twice = 2 * found[a, a] if a == b else found[a, b] - found[a, a] - found[b, b]
            exact[a][b] = exact[b][a] = Fraction(twice, 2 * n ** 3)
    v = np.array([[float(x) for x in row] for row in exact])
    values, vectors = np.linalg.eigh(v)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1].copy()
    # of the two signs the one that makes the largest entry positive
    lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(d)]
    vectors *= np.where(lead < 0, -1.0, 1.0)
    trace = float(sum(exact[k][k] for k in range(d)))
    return Whitener(n, sums, v, values, vectors, values / trace if trace else np.zeros(d))


def identity_error(fit: DataFrame, model: Whitener, components: int = COMPONENTS) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus
    the identity, over the components that have variance."""
    count = min(components, len(model.sums))

    def run(batches):
        n, total, cross = 0, np.zeros(count), np.zeros((count, count))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                w = model.projected(centred(_matrix(batch.column("x").slice(start, ROWS)), model.n, model.sums), count)
                n, total, cross = n + len(w), total + w.sum(axis=0), cross + w.T @ w
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(count + 1), pa.int32()), pa.array(
                [total.tolist(), *cross.tolist()], pa.list_(pa.float64()))], names=["k", "parts"])

    added = (fit.select("x").mapInArrow(run, "k int, parts array<double>")
             .select("k", F.posexplode("parts")).groupBy("k", "pos").agg(F.sum("col").alias("s")).collect())
    m = np.zeros((count + 1, count))
    for r in added:
        m[r["k"], r["pos"]] = r["s"]
    mean = m[0] / model.n
    off = np.abs(m[1:] / model.n - np.outer(mean, mean) - np.eye(count))
    usable = ~np.isnan(m[0])
    return float(off[np.ix_(usable, usable)].max()) if usable.any() else 0.0


def whiten(vectors: DataFrame, scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """A row for each fit vector and component: vec_id, component (from 1 by
    falling eigenvalue), n (distinct vectors), deviation (sum over dimensions
    of (n*x - S)^2, decimal(38,0)), whitened, explained, identity_error.

    Rows whose vector is null, empty or holds a null or non-finite entry, or
    one that no long holds after scaling, are left out, and so are vectors of
    another length than the commonest. Repeated rows and repeated vectors give
    rows each and count once in the fit. Null vec_ids pass through. Equal
    eigenvalues are in the order eigh gives. A component without variance has
    null in whitened and 0 in explained. A deviation beyond 38 digits is null.
    Long vectors cost the square of their length. An empty table gives no rows.
    Other columns are not read.
    """
    rows = stored(scaled(vectors, scale), "scaled-vectors")
    fit = stored(rows.select("x").distinct(), "distinct-vectors")
    model = fitted(fit)
    kind = ("vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
            "identity_error double")
    if model is None:
        return vectors.sparkSession.createDataFrame([], kind)
    count = min(components, len(model.sums))
    error = identity_error(fit, model, components)

    def run(batches):
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                z, m = centred(_matrix(part.column("x")), model.n, model.sums), part.num_rows
                far = [t if t < 10 ** 38 else None for t in square_sums(z.T)]
                w = model.projected(z, count).ravel()
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * count, model.n)),
                    pa.array([t for t in far for _ in range(count)], pa.decimal128(38, 0)),
                    pa.array(w, mask=np.isnan(w)),
                    pa.array(np.tile(model.explained[:count], m)),
                    pa.array(np.full(m * count, error))], names=names)

    return rows.mapInArrow(run, kind)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """The first four whitened components of all embeddings."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
