"""Mergeable sufficient statistics.

One row per group (month) holds the count, the sums and the sums of products of
some columns. Rows add up, so the linear model, correlations and the errors of
any linear prediction come from stored rows of a few dozen numbers, without
reading the data again; a new month adds its own row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspark.schemas import FEATS


def _names(cols: Sequence[str]) -> dict[str, tuple[str, ...]]:
    out: dict[str, tuple[str, ...]] = {f"s_{a}": (a,) for a in cols}
    out.update((_product(a, b), (a, b)) for i, a in enumerate(cols) for b in cols[i:])
    return out


def _product(a: str, b: str) -> str:
    return "p_{}__{}".format(*sorted((a, b)))


def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("ym",)) -> DataFrame:
    """``by``, n, sums and sums of products of ``cols`` over the rows where none
    of them is null or NaN; one hash aggregate."""
    value = {c: F.col(c).cast("double") for c in cols}
    whole = df.where(" AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(cast(`{c}` AS double))" for c in cols))
    sums = [F.sum(value[ab[0]] * value[ab[1]] if len(ab) == 2 else value[ab[0]]).alias(name) for name, ab in _names(cols).items()]
    return whole.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums)


class Moments:
    """Merged moments as numpy arrays (one number per pair of columns)."""

    def __init__(self, rows: DataFrame, cols: Sequence[str]):
        names = _names(cols)
        r = rows.agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in names]).first()  # one row
        self.cols, self.n = list(cols), int(r["n"] or 0)
        self.mean = np.array([(r[f"s_{c}"] or 0.0) / max(self.n, 1) for c in cols])
        self.scatter = np.zeros((len(cols), len(cols)))  # sums of products of centred columns
        for i, a in enumerate(cols):
            for j, b in enumerate(cols[i:], i):
                self.scatter[i, j] = self.scatter[j, i] = (r[_product(a, b)] or 0.0) - self.n * self.mean[i] * self.mean[j]

    def at(self, names: Sequence[str]) -> list[int]:
        return [self.cols.index(c) for c in names]

    def fit(self, feats: Sequence[str], label: str) -> tuple[np.ndarray, float]:
        """Least squares with intercept: coefficients and intercept."""
        f, y = self.at(feats), self.cols.index(label)
        coef = np.linalg.lstsq(self.scatter[np.ix_(f, f)], self.scatter[f, y], rcond=None)[0]
        return coef, float(self.mean[y] - self.mean[f] @ coef)

    def std(self, names: Sequence[str]) -> np.ndarray:
        """Sample standard deviations."""
        return np.sqrt(np.maximum(np.diag(self.scatter)[self.at(names)], 0) / max(self.n - 1, 1))

    def errors(self, feats: Sequence[str], label: str, coef: np.ndarray, intercept: float) -> dict[str, float]:
        """RMSE and R² of a linear prediction on the rows behind the moments."""
        f, y = self.at(feats), self.cols.index(label)
        bias = self.mean[y] - self.mean[f] @ coef - intercept
        total = self.scatter[y, y]
        sse = total - 2 * coef @ self.scatter[f, y] + coef @ self.scatter[np.ix_(f, f)] @ coef + self.n * bias * bias
        return {"rmse": float(np.sqrt(max(sse, 0) / self.n)), "r2": float(1 - sse / total)}


def linear_coefficients(spark: SparkSession, rows: DataFrame, label: str = "label", feats: Sequence[str] = tuple(FEATS)) -> DataFrame:
    """M8 from stored moments: as ``ml.coefficients``, without a fit job."""
    m = Moments(rows, [*feats, label])
    coef, intercept = m.fit(feats, label)
    out = [(c, float(b * s), float(b)) for c, b, s in zip(feats, coef, m.std(feats))]
    return spark.createDataFrame([*out, ("intercept", intercept, intercept)], "feature string, coefficient double, coefficient_unscaled double")


def correlations(spark: SparkSession, rows: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """A10 from stored moments: column, corr."""
    m = Moments(rows, [*cols, target])
    sd = np.sqrt(np.diag(m.scatter))
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = m.scatter[:-1, -1] / (sd[:-1] * sd[-1])
    return spark.createDataFrame([(c, float(v)) for c, v in zip(cols, corr)], "column string, corr double")


__all__ = ["moments", "Moments", "linear_coefficients", "correlations"]
