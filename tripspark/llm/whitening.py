"""Operator 13: embedding whitening with eigenvectors from contour integration.

Entries become whole numbers, ``x = floor(64 * c) + 1000000``; each distinct x
vector counts once. Its sums and the scatter matrix (centred before it is
multiplied) are partial results per task, one row per entry, added up in Spark:
what a task sends does not depend on how many rows it has read. The covariance
is one d x d matrix for dimension d; its largest eigenvalues and vectors come
from :mod:`feast` (contour quadrature, Rayleigh-Ritz, inertia counts). The
projection of the rows is a map over the input.

Defined cases: rows whose vector is null or has a null, NaN or infinite entry
are dropped, and so are vectors of another length than most have (ties: the
longer) and those without entries. Entries beyond 2**46 in size count as
2**46. Components of no variance (below 1e-10 of the largest) have no whitened
value and no row; vectors that are all equal give no rows. A deviation beyond
the range of a long is null. Null ids and repeated rows are rows of their own.
An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm import feast, runtime

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LIMIT = 2.0 ** 46
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
LONG = (1 << 63) - 1


def rounded(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, size, x (little-endian longs) of the rows with whole vectors."""
    runtime.prepare(vectors.sparkSession)

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            flat = pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(size)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            ok = np.flatnonzero((size > 0) & (bad[ends[1:]] == bad[ends[:-1]]))
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.nan_to_num(np.clip(np.floor(SCALE * flat), -LIMIT, LIMIT)).astype("<i8") + SHIFT
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ok)), pa.array(size[ok].astype(np.int32)),
                                              pa.array([x[ends[i]:ends[i + 1]].tobytes() for i in ok], pa.binary())], ["vec_id", "size", "x"])

    frame = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    return frame.mapInArrow(run, "vec_id long, size int, x binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), -1)


def _totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension."""

    def run(batches):
        total, n = None, 0
        for batch in batches:
            x = _matrix(batch.column(0))
            n += len(x)
            if len(x):  # high and low halves: no sum leaves the range of a long
                sums = [(int(h) << 26) + int(low) for h, low in zip((x >> 26).sum(0), (x & ((1 << 26) - 1)).sum(0))]
                total = sums if total is None else [a + b for a, b in zip(total, sums)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(total))], pa.int32()),
                                              pa.array([n, *total], pa.decimal128(38))], ["i", "s"])

    rows = fit.select("x").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()
    by = {r["i"]: int(r["s"]) for r in rows}  # one row per dimension
    return by.pop(-1), [by[i] for i in range(len(by))]


def _scatter(fit: DataFrame, project: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over the fit list of y y^T, y = project(x) with ``size`` entries."""

    def run(batches):
        total, n = np.zeros((size, size)), 0
        for batch in batches:
            y = project(_matrix(batch.column(0)))
            total += y.T @ y
            n += len(y)
        if n:
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])

    rows = fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((size, size))
    for r in rows:  # size * (size + 1) / 2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def deviations(z: np.ndarray, n: int, offset: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * z - offset)^2, exact; None beyond a long."""
    most = n * float(np.abs(z).max(initial=0)) + float(np.abs(offset).max(initial=0))
    if most * most * max(z.shape[1], 1) < 2.0 ** 62:
        y = n * z - offset
        return (y * y).sum(1).tolist()
    sums = [sum((n * a - b) ** 2 for a, b in zip(row, offset.tolist())) for row in z.tolist()]
    return [s if s <= LONG else None for s in sums]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The whitened entries, one row per vector and component (``OUT``)."""
    spark = vectors.sparkSession
    rows = runtime.stored(rounded(vectors, id_col, vector_col), "vectors", compression="zstd")
    usual = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if usual is None:
        return spark.createDataFrame([], OUT)
    rows = rows.where(F.col("size") == usual["size"])
    fit = runtime.stored(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit", compression="zstd")
    n, sums = _totals(fit)
    # the nearest whole number to the mean leaves small exact numbers
    near = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    offset = np.array([s - n * int(c) for s, c in zip(sums, near)], np.int64)
    rest = offset / n
    covariance = _scatter(fit, lambda x: (x - near) - rest, len(sums)) / n
    values, u = feast.largest(covariance, components)
    if not len(values):
        return spark.createDataFrame([], OUT)
    project = u / np.sqrt(values)
    explained = values / np.trace(covariance)
    spread = _scatter(fit, lambda x: ((x - near) - rest) @ project, len(values)) / n
    error = float(np.abs(spread - np.eye(len(values))).max())
    k = len(values)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            z = x - near
            white = (z - rest) @ project
            m = len(x)
            take = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                pa.array(deviations(z, n, offset), pa.int64()).take(take), pa.array(white.ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error))], OUT.replace(" long", "").replace(" int", "").replace(" double", "").split(", "))

    return rows.select("vec_id", "x").mapInArrow(run, OUT)
