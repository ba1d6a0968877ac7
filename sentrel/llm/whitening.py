"""Operator 11, whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers, ``floor(256 c)``; the fit list holds each distinct vector
once. Its covariance ``V`` is never formed. A block ``Q`` of a few more columns than wanted goes
through distributed passes, each of which sums ``(x - mean) ((x - mean)^T Q)`` over the rows
of the fit list. An outer step is

1. Rayleigh-Ritz: ``Q`` made orthonormal (QR), one pass gives ``V Q``; eigenvectors of the small ``Q^T V Q`` rotate both;
2. the residuals ``|V q - e q|`` of the wanted pairs: certified if all are under ``TOLERANCE`` times the greatest
   eigenvalue, i.e. as far as doubles go;
3. else the filter: ``degree`` passes of the Chebyshev recurrence, which damps the spectrum of the interval that
   holds the unwanted eigenvalues and lets the rest grow. It ends at the block's least Ritz value and begins
   as far below the mean of the eigenvalues outside the block (known from the trace) as that value is above it, times ``LOWER``; at 0
   as soon as a Ritz value lies below it. A poor interval costs passes, never exactness, as pairs are certified.

The block is doubled (up to all dimensions, where one Rayleigh-Ritz step is exact) when ``PATIENCE`` outer
steps have not certified it, so the iteration ends for every spectrum. Passes return one block per task, summed
by Spark; the driver holds blocks of dimension times columns, never rows.

The mean is the nearest double of ``S / n``, entries are centred before they are multiplied.

Defined results: rows with a null vector, or a null or non-finite entry, are left out. Vectors shorter than the
longest one are continued with zeros (an empty vector is all zero). Repeated vectors are in the fit list
once and all of their rows are returned; null and repeated ids stay. Components without variance (less than
``RANK`` of the trace) have no whitened value and are not returned: none is for a table that is empty or has one
distinct vector. Equal eigenvalues share their space: any orthonormal basis of it may come. Only the two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import written

TOLERANCE = 2e-14
RANK = 1e-12
PATIENCE = 10
LOWER = 0.9
ROWS = 8192
WHITENED = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def integers(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, x``: the rows with whole, finite vectors, their entries as integers."""
    c = F.col("_v")
    usable = c.isNotNull() & ~F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == math.inf))
    return (df.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("_v")).where(usable)
            .select("vec_id", F.transform("_v", lambda e: F.floor(e * 256)).alias("x")))


def _blocks(batches, dim: int):
    """Rows of the vectors, ``ROWS`` at a time, as 64-bit integers."""
    for b in batches:
        x = b.column("x")
        for lo in range(0, b.num_rows, ROWS):
            part = x.slice(lo, ROWS)
            yield b.slice(lo, ROWS), part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dim)


def summed(fit: DataFrame, dim: int, width: int, block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``fit`` (not empty) of what ``block`` gives for some rows, a matrix of ``width``
    columns: added up in each task, then by Spark cell by cell."""
    def run(batches):
        total = 0
        for _, x in _blocks(batches, dim):
            total = total + block(x)
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["cell", "v"])

    cells = fit.select("x").mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(cells))
    for cell, v in cells:
        out[cell] = v
    return out.reshape(-1, width)


def principal(apply: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, trace: float, spare: int = 28, degree: int = 6, seed: int = 7) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``wanted`` greatest eigenpairs of the operator ``Q -> V Q`` (positive semidefinite, with that
    trace), and how many passes were made. ``apply`` is only ever given blocks; see the module's text."""
    wanted = min(wanted, dim)
    width, passes, random = min(dim, wanted + spare), 0, np.random.default_rng(seed)
    q, low, trusted = random.standard_normal((dim, width)), 0.0, True
    while True:
        for _ in range(PATIENCE):
            q = np.linalg.qr(q)[0]
            vq = apply(q)
            passes += 1
            small = q.T @ vq
            e, u = np.linalg.eigh((small + small.T) / 2)
            e, u = e[::-1], u[:, ::-1]
            q, vq = q @ u, vq @ u
            residual = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * e[:wanted], axis=0)
            if width == dim or residual.max() <= TOLERANCE * max(e[0], 0):
                return np.maximum(e[:wanted], 0), q[:, :wanted], passes
            # the interval to damp: up to the least Ritz value that is not below the mean of the rest
            mean = max(0.0, trace - e.sum()) / (dim - width)
            high = e[wanted:][e[wanted:] >= mean].min(initial=e[wanted])
            trusted = trusted and e[-1] >= low
            low = max(0.0, LOWER * (2 * mean - high)) if trusted else 0.0
            half, centre = (high - low) / 2, (high + low) / 2
            if half <= 0 or e[0] <= high:
                break
            # the recurrence, scaled so that the greatest Ritz value keeps its size
            sigma = half / (e[0] - centre)
            tau = 2 / sigma
            before, now = q, (vq - centre * q) * (sigma / half)
            for _ in range(degree - 1):
                after = 1 / (tau - sigma)
                before, now = now, 2 * after / half * (apply(now) - centre * now) - sigma * after * before
                sigma = after
                passes += 1
            q = now
        more = min(dim, 2 * width) - width
        q, width = np.hstack([q, random.standard_normal((dim, more))]), width + more


def whitened(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 4) -> DataFrame:
    """One row per usable row and component (columns of ``WHITENED``). ``deviation`` is
    the exact sum over dimensions of ``(n x - S)^2``."""
    spark = df.sparkSession
    rows = written(integers(df, id_col, vec_col), "vectors")
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dim) - F.size("x"))))
    fit = written(rows.select("x").distinct(), "fit")
    empty = spark.createDataFrame([], WHITENED)
    if not dim:
        return empty

    parts = fit.mapInArrow(_exact_sums(dim), "i int, s decimal(38,0), n bigint")
    sums = {r.i: (int(r.s), r.n) for r in parts.groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("n").alias("n")).collect()}
    n, total = sums[0][1], [sums[i][0] for i in range(dim)]
    mean = np.array([s / n for s in total])  # Python divides integers to the nearest double
    square = summed(fit, dim, 1, lambda x: ((x - mean) ** 2).sum(axis=0)[:, None])
    trace = float(square.sum()) / n

    def apply(q):
        def block(x):
            c = x - mean
            return c.T @ (c @ q)
        return summed(fit, dim, q.shape[1], block) / n

    if trace <= 0:
        return empty
    e, v, _ = principal(apply, dim, components, trace)
    good = e > RANK * trace
    e, v = e[good], v[:, good]
    scaled = v / np.sqrt(e)

    def moments(x):  # of whitened rows, and their sums in a last row
        z = (x - mean) @ scaled
        return np.vstack([z.T @ z, z.sum(axis=0)])

    m = summed(fit, dim, len(e), moments) / n
    error = float(np.abs(m[:-1] - np.outer(m[-1], m[-1]) - np.eye(len(e))).max())
    return rows.mapInArrow(_project(dim, n, total, mean, scaled, e / trace, error), WHITENED)


def _exact_sums(dim: int):
    """Sums by dimension, as integers of any size."""
    def run(batches):
        total, n = [0] * dim, 0
        for _, x in _blocks(batches, dim):
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            total = [t + (h << 32) + w for t, h, w in zip(total, high, low)]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total, pa.decimal128(38, 0)), pa.array([n] * dim, pa.int64())], names=["i", "s", "n"])
    return run


def _project(dim: int, n: int, total: list[int], mean: np.ndarray, scaled: np.ndarray, explained: np.ndarray, error: float):
    k = len(explained)
    most = max(map(abs, total))

    def run(batches):
        s = np.array(total, object)
        for b, x in _blocks(batches, dim):
            if not len(x):
                continue
            # in 64 bits where no sum of squares can pass 2^62, else as integers of any size
            reach = n * max(abs(int(x.max())), abs(int(x.min()))) + most
            d = n * x - s.astype(np.int64) if dim * reach * reach < 1 << 62 else n * x.astype(object) - s
            deviation = (d * d).sum(axis=1).tolist()
            z = (x - mean) @ scaled
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.column("vec_id").to_pylist(), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 pa.array([v if abs(v) < 10**38 else None for v in deviation], pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=[f.split()[0] for f in WHITENED.split(", ")])
    return run


def as_long(deviation: str = "deviation") -> Column:
    """The deviation as a 64-bit integer; null where it does not fit (from some 10^8 distinct vectors on)."""
    return F.expr(f"try_cast({deviation} AS bigint)")
