"""Model fitting and comparison.

Fits are the only actions here. Training data is persisted for the
duration of a fit (the scaler, the least-squares pass and every tree level
rescan it) and released in ``finally``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tripspark.operators.features import _not_missing
from tripspark.operators.quality import error_sums, metrics_of, quantiles
from tripspark.operators.sampling import row_key
from tripspark.schemas import FEATS, SEED, TREE_MAX_DEPTH, TREE_MIN_INSTANCES


def assembler(handle_invalid: str = "error") -> VectorAssembler:
    """M1: the six features -> ``features_raw``. ``handle_invalid="skip"``
    drops rows with null/NaN features instead of failing the job."""
    return VectorAssembler(inputCols=FEATS, outputCol="features_raw", handleInvalid=handle_invalid)


def valid_rows(df: DataFrame, label: str | None = "label") -> DataFrame:
    """Rows the model can use: no null/NaN feature (nor label)."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    cols = FEATS + ([label] if label and label in df.columns else [])
    return df.where(_not_missing(cols, dtypes))


def reject_count(df: DataFrame, label: str | None = "label") -> DataFrame:
    """How many rows ``valid_rows`` would drop, one aggregate."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    cols = FEATS + ([label] if label and label in df.columns else [])
    return df.select(F.count(F.lit(1)).alias("rows"),
                     F.count_if(~_not_missing(cols, dtypes)).alias("rejected"))


def scaler() -> StandardScaler:
    """M2: divide by the sample stddev, no centring (zero variance -> 0.0)."""
    return StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=False)


def linear_pipeline(prediction_col: str = "prediction") -> Pipeline:
    """M1 + M2 + M3: ordinary least squares on scaled features."""
    # normal equations: one distributed pass builds the 6x6 Gram matrix
    lr = LinearRegression(featuresCol="features", labelCol="label", predictionCol=prediction_col,
                          regParam=0.0, elasticNetParam=0.0, solver="normal")
    return Pipeline(stages=[assembler(), scaler(), lr])


def tree_pipeline(prediction_col: str = "prediction", max_depth: int = TREE_MAX_DEPTH,
                  min_instances: int = TREE_MIN_INSTANCES, seed: int = SEED,
                  max_memory_mb: int = 512) -> Pipeline:
    """M1 + M4: regression tree on the raw (unscaled) features.

    ``cacheNodeIds`` keeps each row's node id on the executors instead of
    shipping the growing tree every level, and ``max_memory_mb`` lets one
    pass split more nodes; neither changes the fitted tree.
    """
    dt = DecisionTreeRegressor(featuresCol="features_raw", labelCol="label", predictionCol=prediction_col,
                               maxDepth=max_depth, minInstancesPerNode=min_instances, seed=seed,
                               cacheNodeIds=True, maxMemoryInMB=max_memory_mb)
    return Pipeline(stages=[assembler(), dt])


NODE_SCHEMA = ("node bigint, depth int, feature string, threshold double, left bigint, right bigint, "
               "gain double, rows bigint, prediction double")


def tree_nodes(model: PipelineModel) -> DataFrame:
    """M4: the fitted tree as a table, one row per node. The root is node 1,
    the children of node i are 2i and 2i + 1; a leaf has no feature. A row
    goes left where ``feature <= threshold``. At most 2 ** (depth + 1) - 1
    rows, whatever the training data."""
    features = model.stages[0].getInputCols()
    rows, todo = [], [(1, 0, model.stages[-1]._call_java("rootNode"))]
    while todo:
        number, depth, node = todo.pop()
        count, value = int(node.impurityStats().count()), float(node.prediction())
        if node.subtreeDepth() == 0:
            rows.append((number, depth, None, None, None, None, None, count, value))
            continue
        split = node.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError(f"node {number} splits a categorical feature")
        rows.append((number, depth, features[split.featureIndex()], float(split.threshold()), 2 * number, 2 * number + 1,
                     float(node.gain()), count, value))
        todo += [(2 * number, depth + 1, node.leftChild()), (2 * number + 1, depth + 1, node.rightChild())]
    return SparkSession.getActiveSession().createDataFrame(sorted(rows), NODE_SCHEMA)


def tree_columns(nodes: DataFrame) -> tuple[Column, Column]:
    """(leaf, prediction): a node table compiled into column expressions that
    stay inside code generation. A null or NaN feature on a row's way gives
    null for both, as no branch is taken."""
    at = {r.node: r for r in nodes.collect()}

    def value(number: int, of) -> Column:
        row = at[number]
        if row.feature is None:
            return of(row)
        x = F.col(row.feature).cast("double")
        return F.when(x <= row.threshold, value(row.left, of)).when((x > row.threshold) & ~F.isnan(x), value(row.right, of))

    return value(1, lambda r: F.lit(r.node)), value(1, lambda r: F.lit(r.prediction))


def split_gains(train: DataFrame, bins: int = 32, min_instances: int = TREE_MIN_INSTANCES,
                label: str = "label", **search) -> DataFrame:
    """M4: feature, threshold, rows_left, gain of every candidate for a first
    split: the exact i/bins quantiles of each feature that leave
    ``min_instances`` rows on both sides. The gain is the fall in the label's
    population variance.

    One scan after the quantiles: rows are counted per feature and bin, with
    partial sums on the map side, so at most ``6 * bins`` rows are summed up
    along the bins.
    """
    data = valid_rows(train).select(*[F.col(c).cast("double").alias(c) for c in FEATS], F.col(label).cast("double").alias("_label"))
    found = quantiles(data, FEATS, [i / bins for i in range(1, bins)], method="exact", **search)
    cuts: dict[str, list[float]] = {c: [] for c in FEATS}
    for r in found.where("value IS NOT NULL").select("column", "value").distinct().orderBy("column", "value").collect():
        cuts[r["column"]].append(r["value"])  # at most bins - 1 per feature

    def threshold(c: str) -> Column:  # the smallest cut that is not below the value
        out = F.lit(None).cast("double")
        for cut in reversed(cuts[c]):
            out = F.when(F.col(c) <= cut, cut).otherwise(out)
        return out

    long = data.select("_label", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), threshold(c).alias("threshold")) for c in FEATS])).alias("b"))
    per = long.groupBy("b.feature", "b.threshold").agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("s"))
    upto = Window.partitionBy("feature").orderBy(F.col("threshold").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("feature")
    sums = per.select("feature", "threshold", F.sum("n").over(upto).alias("nl"), F.sum("s").over(upto).alias("sl"),
                      F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).alias("s"))
    sums = sums.where(F.col("threshold").isNotNull() & (F.col("nl") >= min_instances) & (F.col("n") - F.col("nl") >= min_instances))
    mean, left = F.col("s") / F.col("n"), F.col("sl") / F.col("nl")
    right = (F.col("s") - F.col("sl")) / (F.col("n") - F.col("nl"))
    share = F.col("nl") / F.col("n")
    gain = share * (left - mean) * (left - mean) + (1 - share) * (right - mean) * (right - mean)
    return sums.select("feature", "threshold", F.col("nl").alias("rows_left"), gain.alias("gain"))


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit with the training rows persisted for the duration of the fit."""
    data = valid_rows(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(data)
    finally:
        data.unpersist()


def fit_linear(train: DataFrame, prediction_col: str = "prediction") -> PipelineModel:
    return fit(linear_pipeline(prediction_col), train)


def fit_tree(train: DataFrame, prediction_col: str = "prediction", **params) -> PipelineModel:
    return fit(tree_pipeline(prediction_col, **params), train)


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Apply a fitted pipeline; drop the vector columns from the result."""
    out = model.transform(df)
    keep = list(df.columns) if keep is None else list(keep)
    pred_col = model.stages[-1].getOrDefault("predictionCol")
    return out.select(*keep, pred_col)


def scaled_columns(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """The scaler's output as six ``<feature>_scaled`` double columns."""
    fitted_assembler, fitted_scaler = model.stages[0], model.stages[1]
    out = fitted_scaler.transform(fitted_assembler.transform(df))
    arr = vector_to_array(F.col("features"))
    keep = [row_key(df)] if keep is None else keep
    return out.select(*keep, *[arr[i].alias(f"{c}_scaled") for i, c in enumerate(FEATS)])


def fit_scaler_only(train: DataFrame) -> PipelineModel:
    return fit(Pipeline(stages=[assembler(), scaler()]), train)


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """M8: coefficient per feature on the scaled inputs, the same on the
    original units (``coef / std``) and the intercept as its own row.
    Seven numbers from the fitted model, not data."""
    std = list(model.stages[1].std)
    lr = model.stages[-1]
    rows = [(f, float(c), float(c / s) if s else 0.0) for f, c, s in zip(FEATS, lr.coefficients, std)]
    rows.append(("intercept", float(lr.intercept), float(lr.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double, coefficient_unscaled double")


def compare_models(models: dict[str, PipelineModel], splits: dict[str, DataFrame],
                   digits: int | None = None) -> DataFrame:
    """M7: RMSE, MAE and R² per (model, split), long: (model, split,
    metric, value). Every split is read once: all models score the same rows,
    and one aggregate by split holds the sums of all of them."""
    data = None
    for name, rows in splits.items():
        part = valid_rows(rows).select(*FEATS, "label", F.lit(name).alias("split"))
        data = part if data is None else data.unionByName(part)
    scored: list[str] = []
    for i, model in enumerate(models.values()):
        pred_col = model.stages[-1].getOrDefault("predictionCol")
        data = model.transform(data).select(*FEATS, "label", "split", *scored, F.col(pred_col).alias(f"p{i}"))
        scored.append(f"p{i}")
    sums = data.groupBy("split").agg(*[F.struct(*[c.alias(n) for n, c in error_sums("label", p).items()]).alias(p) for p in scored])
    rows = []
    for name, p in zip(models, scored):
        for metric, c in zip(("rmse", "mae", "r2"), metrics_of(lambda n, p=p: F.col(p)[n])):
            c = c if digits is None else F.round(c, digits)
            rows.append(F.struct(F.lit(name).alias("model"), F.lit(metric).alias("metric"), c.cast("double").alias("value")))
    return sums.select("split", F.explode(F.array(*rows)).alias("m")).select("m.model", "split", "m.metric", "m.value")


def save(model: PipelineModel, path: str) -> str:
    """M9/K7: overwrite-save a fitted pipeline."""
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
