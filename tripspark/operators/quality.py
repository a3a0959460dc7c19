"""Data-quality and prediction-error reports.

Each report is one aggregate plan (several statistics per pass), never a
job per column. Inputs are features or predictions DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tripspark.functions import bin_order, chain_distance_bin, right_open_distance_bin
from tripspark.operators.quantiles import DEFAULT_MAX_CANDIDATES, as_row, exact_quantiles
from tripspark.schemas import DIST_BIN_LABELS, REPORT_PROBS

# percentile_approx accuracy of the reports (relative error 1/accuracy).
DEFAULT_ACCURACY = 10000


def _r(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one pass, one output column per input column."""
    return df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def feature_profile(df: DataFrame, digits: int | None = None) -> DataFrame:
    """A5 + A8: row count and label / distance statistics in one pass."""
    return df.select(
        F.count(F.lit(1)).alias("rows"),
        _r(F.mean("label"), digits).alias("label_mean"),
        _r(F.stddev_samp("label"), digits).alias("label_std"),
        F.min("label").alias("label_min"),
        F.max("label").alias("label_max"),
        _r(F.mean("trip_distance"), digits).alias("dist_mean"),
        F.max("trip_distance").alias("dist_max"),
    )


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = tuple(REPORT_PROBS),
              accuracy: int = DEFAULT_ACCURACY, method: str = "approx",
              max_candidates: int = DEFAULT_MAX_CANDIDATES) -> DataFrame:
    """Quantiles of several columns, long as (column, prob, value).

    ``method="approx"``: ``percentile_approx`` in one pass; the sketch is
    merged on executors and its size is bounded by ``accuracy``.
    ``method="exact"``: the ceil(q*n)-th smallest value, found by bounded
    narrowing passes (``tripspark.operators.quantiles``).
    """
    if method == "exact":
        return exact_quantiles(df, cols, probs, accuracy=accuracy, max_candidates=max_candidates)
    if method != "approx":
        raise ValueError("method must be 'approx' or 'exact'")
    arr = F.array(*[F.lit(float(p)) for p in probs])
    wide = df.select(*[F.percentile_approx(c, arr, accuracy).alias(c) for c in cols])
    parts = [F.struct(F.lit(c).alias("column"), F.col(c).alias("vals")) for c in cols]
    return (wide.select(F.explode(F.array(*parts)).alias("q"))
            .select(F.col("q.column").alias("column"),
                    F.posexplode(F.arrays_zip(arr.alias("prob"), F.col("q.vals").alias("value"))))
            .select("column", F.col("col.prob").alias("prob"), F.col("col.value").alias("value")))


def correlations(df: DataFrame, target: str, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """A10: Pearson correlation of ``target`` with each present column, as
    (column, corr), computed in a single aggregate."""
    cols = [c for c in cols if c in df.columns]
    wide = df.select(*[_r(F.corr(target, c), digits).alias(c) for c in cols])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("corr")) for c in cols])).alias("r")
    ).select("r.column", "r.corr")


def top_rows(df: DataFrame, by: str, n: int, cols: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` largest ``by`` values with a deterministic tie-break
    (planned as TakeOrderedAndProject: a per-partition top-n, then a merge
    of at most n rows per partition)."""
    order = [F.col(by).desc()] + [F.col(c).asc() for c in tie_break]
    return df.orderBy(*order).select(*cols).limit(n)


def with_errors(pred: DataFrame, label: str = "label", prediction: str = "fare_pred") -> DataFrame:
    """``resid = label - prediction`` and ``abs_error``."""
    resid = F.col(label) - F.col(prediction)
    return pred.withColumn("resid", resid).withColumn("abs_error", F.abs(resid))


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "fare_pred",
                       digits: int | None = None, zero_variance: str = "nan") -> DataFrame:
    """RMSE, MAE and R² in one aggregate (not a job per metric).

    R² = 1 - SSE / SST with SST = n * population variance of the label.
    For a constant label (SST = 0): ``zero_variance="nan"`` gives NaN (the
    upload page's rule); ``"evaluator"`` gives what 1 - SSE/0 evaluates to
    in ``RegressionEvaluator`` (-inf, or NaN when SSE is 0 too).

    Rows without a label or a prediction take no part: ``n`` counts the
    rows with both, and every metric is over these.
    """
    agg = pred.select(*[c.alias(n) for n, c in error_sums(label, prediction).items()])
    rmse, mae, r2 = metrics_of(F.col, zero_variance)
    return agg.select("n", _r(rmse, digits).alias("rmse"), _r(mae, digits).alias("mae"), _r(r2, digits).alias("r2"))


def error_sums(label: str, prediction: str) -> dict[str, Column]:
    """The aggregates behind RMSE, MAE and R², over rows with both values."""
    err = F.col(label) - F.col(prediction)
    known = F.when(err.isNotNull(), F.col(label))
    return {"n": F.count(err), "sse": F.sum(err * err), "mae": F.avg(F.abs(err)), "sst": F.var_pop(known) * F.count(known)}


def metrics_of(get, zero_variance: str = "nan") -> tuple[Column, Column, Column]:
    """RMSE, MAE and R² from the aggregates, which ``get(name)`` returns."""
    if zero_variance == "nan":
        degenerate = F.lit(float("nan"))
    elif zero_variance == "evaluator":
        degenerate = F.when(get("sse") > 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    else:
        raise ValueError("zero_variance must be 'nan' or 'evaluator'")
    r2 = F.when(get("sst") > 0, 1 - get("sse") / get("sst")).otherwise(degenerate)
    return F.sqrt(F.try_divide(get("sse"), get("n"))), get("mae"), r2  # no row with both: null


def residual_summary(pred: DataFrame, probs: Sequence[float] = tuple(REPORT_PROBS),
                     accuracy: int = DEFAULT_ACCURACY, digits: int | None = None,
                     method: str = "approx", max_candidates: int = DEFAULT_MAX_CANDIDATES) -> DataFrame:
    """Residual mean, sample stddev and quantiles, one row."""
    df = with_errors(pred) if "resid" not in pred.columns else pred
    names = [f"resid_q{int(round(p * 100))}" for p in probs]
    moments = df.select(_r(F.mean("resid"), digits).alias("resid_mean"),
                        _r(F.stddev_samp("resid"), digits).alias("resid_std"))
    if method == "exact":
        qrow = as_row(exact_quantiles(df, ["resid"], probs, accuracy=accuracy, max_candidates=max_candidates), "resid", probs, names)
        return moments.crossJoin(qrow)  # two one-row aggregates
    q = F.percentile_approx("resid", F.array(*[F.lit(float(p)) for p in probs]), accuracy)
    out = df.select(_r(F.mean("resid"), digits).alias("resid_mean"),
                    _r(F.stddev_samp("resid"), digits).alias("resid_std"),
                    q.alias("_q"))
    return out.select("resid_mean", "resid_std", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def calibration(pred: DataFrame, digits: int | None = None) -> DataFrame:
    """corr(prediction, label), mean |resid|, sqrt(mean resid²)."""
    resid = F.col("label") - F.col("fare_pred")
    return pred.select(
        _r(F.corr("fare_pred", "label"), digits).alias("corr_pred_label"),
        _r(F.avg(F.abs(resid)), digits).alias("mae_agg"),
        _r(F.sqrt(F.avg(resid * resid)), digits).alias("rmse_agg"),
    )


def error_by(pred: DataFrame, key: Column | str, name: str | None = None, digits: int | None = None,
             extra: Sequence[Column] = ()) -> DataFrame:
    """N, MAE and bias (mean residual) per slice."""
    resid = F.col("label") - F.col("fare_pred")
    k = F.col(key) if isinstance(key, str) else key
    name = name or (key if isinstance(key, str) else "slice")
    return pred.groupBy(k.alias(name)).agg(
        F.count(F.lit(1)).alias("n"),
        *extra,
        _r(F.avg(F.abs(resid)), digits).alias("mae"),
        _r(F.avg(resid), digits).alias("bias"),
    )


def quantile_splits(df: DataFrame, col: str, n_buckets: int = 5, relative_error: float = 0.01,
                    accuracy: int = DEFAULT_ACCURACY, max_candidates: int = DEFAULT_MAX_CANDIDATES) -> DataFrame:
    """Interior split points of ``n_buckets`` quantile buckets, as a one-row
    DataFrame with an array column ``splits`` (computed on executors).
    ``relative_error=0`` gives exact splits (bounded narrowing passes, with
    ``accuracy`` and ``max_candidates``)."""
    if relative_error < 0:
        raise ValueError("relative_error must not be negative")
    probs = [i / n_buckets for i in range(1, n_buckets)]
    if relative_error == 0:
        long = exact_quantiles(df, [col], probs, accuracy, max_candidates)
        return long.agg(F.sort_array(F.collect_list("value")).alias("splits"))
    accuracy = max(1, int(round(1.0 / relative_error)))
    return df.select(F.percentile_approx(col, F.array(*[F.lit(p) for p in probs]), accuracy)
                     .alias("splits"))


def quantile_buckets(df: DataFrame, col: str, out: str = "dist_bucket", n_buckets: int = 5,
                     relative_error: float = 0.01, **search) -> DataFrame:
    """M6: quantile bucket index per row, as ``QuantileDiscretizer`` +
    ``Bucketizer`` assign it: equal split points collapse into one, and
    bucket ``i`` holds ``splits[i] <= x < splits[i+1]``.

    The splits are one row joined by broadcast (size fixed by
    ``n_buckets``), so rows never travel to the driver.
    """
    splits = quantile_splits(df, col, n_buckets, relative_error, **search).select(
        F.array_distinct(F.col("splits")).alias("_splits"))
    x = F.col(col)
    bucket = F.when(x.isNull(), F.lit(None)).otherwise(
        F.size(F.filter(F.col("_splits"), lambda s: s <= x)).cast("double"))
    return df.join(F.broadcast(splits), how="cross").withColumn(out, bucket).drop("_splits")


def error_by_quantile_bucket(pred: DataFrame, n_buckets: int = 5, relative_error: float = 0.01,
                             digits: int | None = None, **search) -> DataFrame:
    """Error slices by distance quantile bucket, with mean distance."""
    b = quantile_buckets(pred, "trip_distance", "dist_bucket", n_buckets, relative_error, **search)
    return error_by(b, "dist_bucket", digits=digits,
                    extra=[_r(F.avg("trip_distance"), digits).alias("avg_dist")])


def error_by_distance_bin(pred: DataFrame, digits: int | None = None) -> DataFrame:
    """MAE and n by the fixed ``when``-chain distance bin, with the
    bin's display position."""
    resid = F.col("label") - F.col("fare_pred")
    return (pred.groupBy(chain_distance_bin(F.col("trip_distance")).alias("dist_bin"))
            .agg(_r(F.avg(F.abs(resid)), digits).alias("mae"), F.count(F.lit(1)).alias("n"))
            .withColumn("bin_order", bin_order(F.col("dist_bin"))))


def bin_dimension(spark) -> DataFrame:
    """The six fixed distance bins as a tiny dimension table."""
    return spark.createDataFrame([(i, b) for i, b in enumerate(DIST_BIN_LABELS)],
                                 "bin_order int, dist_bin string")


def error_by_distance_bin_filled(pred: DataFrame, actual: str | None = "trip_fare",
                                 prediction: str = "fare_pred", digits: int | None = None) -> DataFrame:
    """Per right-open bin from 0, MAE when actuals exist, else the
    average prediction; all six bins are returned, empty ones with n = 0
    and a null value. Rows without a bin (null or negative distance) are
    left out. The aggregate (<= 6 rows) is joined to the broadcast bin
    dimension."""
    bin_col = right_open_distance_bin(F.col("trip_distance"))
    value = (F.avg(F.abs(F.col(actual) - F.col(prediction))) if actual
             else F.avg(F.col(prediction)))
    name = "mae" if actual else "avg_pred"
    agg = (pred.where(bin_col.isNotNull()).groupBy(bin_col.alias("dist_bin"))
           .agg(F.count(F.lit(1)).alias("n"), _r(value, digits).alias(name)))
    dim = bin_dimension(pred.sparkSession)
    # the aggregate has at most one row per bin label: broadcast it
    return (dim.join(F.broadcast(agg), "dist_bin", "left")
            .select("dist_bin", "bin_order", F.coalesce("n", F.lit(0)).alias("n"), name))


def avg_pred_by_hour(pred: DataFrame, digits: int | None = None) -> DataFrame:
    """Average prediction per hour."""
    return pred.groupBy("hour").agg(_r(F.avg("fare_pred"), digits).alias("avg_pred"))


def histogram(df: DataFrame, col: str, n_bins: int = 60, digits: int | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] of all rows.

    ``bin = least(floor((x - min) / width), n_bins - 1)``, so the maximum
    falls in the last bin (closed on the right, as numpy does). Every bin
    is returned, empty ones with count 0: the bin ids come from
    ``range(n_bins)``, whose size is the parameter, not the data.
    Null and NaN values take no part.
    """
    x = F.col(col)
    df = df.where(x.isNotNull() & ~F.isnan(x))
    bounds = df.select(F.min(x).alias("lo"), F.max(x).alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / n_bins).otherwise(F.lit(1.0))
    bounds = bounds.select("lo", "hi", width.alias("width"))
    binned = (df.join(F.broadcast(bounds), how="cross")
              .select(F.least(F.floor((x - F.col("lo")) / F.col("width")), F.lit(n_bins - 1))
                      .cast("int").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    return _all_bins(bounds, binned, n_bins, digits)


def _all_bins(bounds: DataFrame, binned: DataFrame, n_bins: int, digits: int | None) -> DataFrame:
    """Every bin with its edges; those without rows have count 0."""
    dim = bounds.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(bounds))
    return (dim.join(F.broadcast(binned), "bin", "left")  # at most n_bins rows
            .select("bin",
                    _r(F.col("lo") + F.col("bin") * F.col("width"), digits).alias("bin_lo"),
                    _r(F.col("lo") + (F.col("bin") + 1) * F.col("width"), digits).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def histogram_cells(df: DataFrame, col: str, by: Sequence[str] = ("ym",), resolution: float = 0.1) -> DataFrame:
    """A21 as a mergeable state: ``by``, cell, n, lo, hi. Rows are counted in
    cells of a fixed ``resolution``, whatever the bounds; one scan, and a new
    month adds its own rows. Null and NaN values take no part."""
    x = F.col(col)
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(*by, F.floor(x / resolution).alias("cell"), x.alias("_x"))
    return rows.groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))


def histogram_from_cells(cells: DataFrame, df: DataFrame, col: str, n_bins: int = 60, resolution: float = 0.1,
                         digits: int | None = None) -> DataFrame:
    """:func:`histogram` of ``df`` from its stored cells, exactly. The
    bounds come from the cells. A cell whose smallest and largest value share
    a bin counts there; only the rows of the others, at most ``n_bins - 1``
    cells with a bin's edge inside, are read again."""
    merged = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.min("lo").alias("first"), F.max("hi").alias("last"))
    bounds = cells.select(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / n_bins).otherwise(F.lit(1.0))
    bounds = bounds.select("lo", "hi", width.alias("width"))

    def bin_of(x: Column) -> Column:
        return F.least(F.floor((x - F.col("lo")) / F.col("width")), F.lit(n_bins - 1)).cast("int")

    placed = merged.join(F.broadcast(bounds), how="cross").select("cell", "n", bin_of(F.col("first")).alias("bin"), bin_of(F.col("last")).alias("to"))
    whole = placed.where("bin = to").select("bin", "n")
    edges = placed.where("bin <> to").select("cell")
    x = F.col(col)
    again = (df.where(x.isNotNull() & ~F.isnan(x)).select(F.floor(x / resolution).alias("cell"), x.alias("_x"))
             .join(F.broadcast(edges), "cell", "left_semi").join(F.broadcast(bounds), how="cross")  # at most n_bins - 1 cells; one row
             .groupBy(bin_of(F.col("_x")).alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    binned = whole.unionByName(again).groupBy("bin").agg(F.sum("n").alias("n"))
    return _all_bins(bounds, binned, n_bins, digits)
