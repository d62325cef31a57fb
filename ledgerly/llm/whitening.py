"""Whitening of embeddings: distributed covariance, eigenvectors by mixed-precision refinement.

The covariance of the distinct vectors is gathered exactly, in integers, from
one matrix per partition. Its eigenvectors are first taken in float32, then
corrected by matrix products in higher precision (the iteration of Ogita and
Aishima); eigenvalues that lie too close for it are told apart by a small
eigenproblem in the space they span. Only matrices of the vectors' dimension
reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.llm.common import written

#: A component whose eigenvalue is below this share of the trace has no variance to scale to one.
FLAT = 1e-12
#: Matrix products are summed in float64 as long as every sum of integers stays below this.
EXACT = 1 << 53


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, no null or non-finite entry."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def scaled(vector: Column) -> Column:
    """floor(256 * entry) in double precision, as 64-bit integers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(256.0)).cast("long"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def gram(rows: np.ndarray) -> np.ndarray:
    """rows' x rows, exact, as Python integers."""
    most = max(1, int(np.abs(rows).max(initial=0)))
    step = EXACT // (most * most)
    if step < 1:
        return rows.astype(object).T @ rows.astype(object)
    out = np.zeros((rows.shape[1],) * 2, dtype=object)
    for p in range(0, len(rows), step):
        part = rows[p:p + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def moments(fit: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums per dimension, n^2 times the covariance), all exact.

    Two passes: the sums, then the products of the vectors less the integers
    nearest to the mean; the rest of the mean is taken off in integers. One
    row of products per partition and dimension is shuffled; sums are decimal.
    """
    rows = fit.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("j").collect()
    n, sums = rows[0].n, [int(r.s) for r in rows]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    shift = np.array(centre, dtype=object)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), dtype=object)
        for batch in batches:
            x = _matrix(batch.column("x"))
            if max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))), *map(abs, centre)) < 1 << 61:
                total = total + gram(x - shift.astype(np.int64))
            else:
                total = total + (x.astype(object) - shift).T @ (x.astype(object) - shift)
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in total[i, j]])], ["i", "j", "v"])

    # A product sum may leave 64 bits, so it travels as text and is summed as a decimal.
    parts = fit.select("x").mapInArrow(partial, "i int, j int, v string")
    cells = parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    rest = [s - n * c for s, c in zip(sums, centre)]
    out = np.empty((dim, dim), dtype=object)
    for c in cells:
        out[c.i, c.j] = out[c.j, c.i] = n * int(c.v) - rest[c.i] * rest[c.j]
    return n, sums, out


def clusters(values: np.ndarray, gap: float) -> list[tuple[int, int]]:
    """Runs [a, b) of sorted values whose neighbours lie within ``gap``."""
    cuts = np.flatnonzero(np.diff(values) > gap) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]))


def refined(a: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors of a symmetric matrix in extended precision.

    Starts from float32 eigenvectors. Each round measures how far the vectors
    are from orthonormal (r) and the matrix in their basis from diagonal (s),
    and corrects both at once. Where two eigenvalues lie closer than the
    error of that round, the quotient that would turn their vectors apart says
    nothing: such a cluster is only made orthonormal, and the matrix within the
    space of the cluster, less the cluster's middle, is solved on its own.
    """
    a = a.astype(np.longdouble)
    size = max(float(np.abs(a).max(initial=0)), np.finfo(np.float64).tiny)
    a, dim = a / size, len(a)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eye, last = np.eye(dim, dtype=np.longdouble), np.inf
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        value = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(value, kind="stable")
        x, r, s, value = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], value[order]
        off = s - np.diag(value)
        error = 2 * float(np.linalg.norm(off.astype(np.float64)) + np.linalg.norm(r.astype(np.float64)))
        apart = value[None, :] - value[:, None]
        # a quotient may turn two vectors by little only; closer pairs are left to the sub-solves
        turn = np.where(np.abs(apart) > error, s + value[None, :] * r, 0) / np.where(np.abs(apart) > error, apart, 1)
        x = x + x @ np.where(np.abs(apart) > error, turn, r / 2)
        for lo, hi in clusters(value.astype(np.float64), error):
            if hi - lo > 1:
                basis = x[:, lo:hi]
                basis = basis + basis @ (np.eye(hi - lo) - basis.T @ basis) / 2
                middle = value[lo:hi].mean()
                within = basis.T @ (a @ basis - middle * basis)
                within = (within + within.T) / 2
                spread = max(float(np.abs(within).max()), np.finfo(np.float64).tiny)
                x[:, lo:hi] = basis @ np.linalg.eigh((within / spread).astype(np.float64))[1].astype(np.longdouble)
        if error < 1e-17 or error >= last * 0.5 and error < 1e-14:
            break
        last = error
    x = x + x @ (eye - x.T @ x) / 2
    value = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(value, kind="stable")
    return value[order] * size, x[:, order]


def _centred(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return x.astype(np.longdouble) - mean


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error for each row and component.

    Entries become x = floor(256 * entry). The fit list holds each distinct x
    once; mean, covariance and eigenvectors come from it alone, so repeated
    vectors do not weigh more. ``identity_error`` is measured on the whitened
    fit list in a pass of its own. Rows whose vector is null or holds null or
    non-finite entries take no part, nor do vectors of another length than the
    most frequent one (the longer of two as frequent) and empty ones. Null ids
    stay null; repeated rows come back each. Components without variance
    (fewer distinct vectors than components) are left out, so one distinct
    vector, like an empty table, gives no rows. Of tied eigenvalues any basis
    may come, the same for all rows. A deviation beyond 64 bits is an error.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    schema = (f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    clean = vectors.filter(usable(F.col(vector_col))).select(F.col(id_col), scaled(F.col(vector_col)).alias("x"))
    lengths = clean.groupBy(F.size("x").alias("dim")).count().filter("dim > 0").orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = lengths.dim
    clean = clean.filter(F.size("x") == dim)
    fit = written(clean.select("x").distinct(), "fit")
    n, sums, v = moments(fit, dim)
    exact = [Fraction(s, n) for s in sums]
    mean = np.array([np.longdouble(int(m)) + np.longdouble(float(m - int(m))) for m in exact])
    shrink = int(np.abs(v).max(initial=0)).bit_length() - 60  # scaled by a power of two to fit the extended range exactly enough
    wide = np.array([[np.longdouble(int(c) >> shrink if shrink > 0 else int(c)) for c in row] for row in v])
    value, vector = refined(wide)
    trace = np.trace(wide)
    kept = [k for k in range(dim - 1, max(dim - 1 - components, -1), -1) if value[k] > FLAT * trace]
    if not kept:
        return spark.createDataFrame([], schema)
    # values are those of n^2 V over 2^shrink; the axes carry the division by the square root
    scale = np.ldexp(np.longdouble(1), max(shrink, 0)) / (np.longdouble(n) * np.longdouble(n))
    axes = vector[:, kept] / np.sqrt(value[kept] * scale)
    explained = [float(value[k] / trace) for k in kept]
    m = len(kept)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m + 1, m), dtype=np.longdouble)
        for batch in batches:
            w = _centred(_matrix(batch.column("x")), mean) @ axes
            total += np.concatenate([w.T @ w, w.sum(axis=0)[None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float64).ravel().tolist()])], ["t"])

    cells = fit.select("x").mapInArrow(second, "t array<double>").select(F.posexplode("t").alias("k", "t")).groupBy("k").agg(F.sum("t").alias("t")).orderBy("k").collect()
    t = np.array([c.t for c in cells]).reshape(m + 1, m) / n
    off = float(np.abs(t[:m] - np.outer(t[m], t[m]) - np.eye(m)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            w = (_centred(x, mean) @ axes).astype(np.float64)
            most = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums))
            kind = np.int64 if most * most * dim < 1 << 62 else object
            d = n * x.astype(kind) - np.array(sums, dtype=kind)
            deviation = pa.array((d * d).sum(axis=1).tolist(), pa.int64())
            rows = np.repeat(np.arange(len(x)), m)
            k = np.tile(np.arange(m), len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(pa.array(rows)), pa.array(k + 1, pa.int32()), pa.array(np.full(len(rows), n)),
                 deviation.take(pa.array(rows)), pa.array(w.ravel()), pa.array(np.array(explained)[k]), pa.array(np.full(len(rows), off))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return clean.mapInArrow(project, schema)
