"""Approximate quantiles from stored sketches.

A KLL sketch of ``k`` holds a bounded sample of a column's ranks and merges
with others, so one sketch per group (month) and column is stored once and any
set of months is answered from a few kilobytes each, without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tripspark.schemas import REPORT_PROBS

DEFAULT_K = 1000


def rank_error(k: int = DEFAULT_K) -> float:
    """Twice the sketch's published rank error at 99 % confidence, which a
    quantile exceeds about once in ten million."""
    return 2 * 2.296 / k ** 0.9723


def sketch(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("ym",), k: int = DEFAULT_K) -> DataFrame:
    """One row per group and column: ``by``, column, n, sketch. One pass;
    null and NaN values are left out."""
    values = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols]
    wide = df.groupBy(*by).agg(*[F.struct(F.lit(c).alias("column"), F.count(v).alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch")).alias(f"_{i}")
                                 for i, (c, v) in enumerate(zip(cols, values))])
    return wide.select(*by, F.explode(F.array(*[f"_{i}" for i in range(len(cols))])).alias("s")).select(*by, "s.*").where("n > 0")


def merged(sketches: DataFrame, by: Sequence[str] = (), k: int = DEFAULT_K) -> DataFrame:
    """Sketches of the same column (and ``by`` group) merged into one."""
    return sketches.groupBy(*by, "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles(sketches: DataFrame, probs: Sequence[float] = tuple(REPORT_PROBS), by: Sequence[str] = (), k: int = DEFAULT_K) -> DataFrame:
    """``by``, column, prob, value, n; value's rank is within
    :func:`rank_error` of prob."""
    each = [F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probs]
    return merged(sketches, by, k).select(*by, "column", "n", F.explode(F.array(*each)).alias("q")).select(*by, "column", "q.prob", "q.value", "n")


def splits(sketches: DataFrame, column: str, n_buckets: int = 5, k: int = DEFAULT_K) -> list[float]:
    """M6: inner bucket edges of a column, equal ones once."""
    rows = quantiles(sketches.where(F.col("column") == column), [i / n_buckets for i in range(1, n_buckets)], k=k).collect()
    return sorted({r["value"] for r in rows})


__all__ = ["sketch", "merged", "quantiles", "splits", "rank_error"]
