"""Scoring (M5, M12, P12): saved pipeline -> predictions.

Scoring is map-only: the fitted coefficients travel inside the plan, so
every partition scores independently with no shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tripspark.operators import ml, rejects
from tripspark.operators.features import cast_features, raw_features, require_columns, resolve
from tripspark.schemas import FEATS
from tripspark.sources.readers import read_any
from tripspark.sources.sinks import check_format, write_table


def score(model: PipelineModel, feats: DataFrame, prediction_col: str = "fare_pred",
          invalid: str = "error") -> DataFrame:
    """M5: all input columns + the prediction, named ``prediction_col``.

    ``invalid="skip"`` leaves out rows with null/NaN features (the
    assembler would otherwise fail the job mid-run), ``"keep"`` keeps them
    with a null prediction; ``counted_score`` counts them in the same pass.
    """
    if invalid not in ("error", "skip", "keep"):
        raise ValueError(f"invalid must be error, skip or keep, got {invalid!r}")
    feats = cast_features(feats)
    if invalid == "skip":
        feats = ml.valid_rows(feats, label=None)
    columns = feats.columns
    pred = F.col(model.stages[-1].getOrDefault("predictionCol"))
    if invalid == "keep":  # the model sees zeros for what is missing, its answer is not used
        usable = F.lit(True)
        for _, present in rejects.feature_rules(feats):
            usable = usable & present
        as_is = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_as_is")
        filled = [F.when(present, F.col(c)).otherwise(F.lit(0)).alias(c) for c, (_, present) in zip(FEATS, rejects.feature_rules(feats))]
        out = model.transform(feats.select(as_is, usable.alias("_usable"), *filled))
        return out.select("_as_is.*", F.when(F.col("_usable"), pred).alias(prediction_col))
    return model.transform(feats).select(*columns, pred.alias(prediction_col))


def counted_score(model: PipelineModel, feats: DataFrame, prediction_col: str = "fare_pred", invalid: str = "skip"
                  ) -> tuple[DataFrame, Observation]:
    """:func:`score`, and an observation that counts rows in, rows that miss
    each feature (the first one missing) and rows with a prediction, when the
    result is written."""
    feats = cast_features(feats)
    feats, watch = rejects.observed(feats, rejects.feature_rules(feats), keep_all=True)
    return score(model, feats, prediction_col, invalid), watch


def features_for_scoring(df: DataFrame, mode: str = "features", as_of: dt.datetime | str | None = None
                         ) -> DataFrame:
    """The six features from either a prepared feature table or raw trips."""
    if mode == "features":
        require_columns(df, FEATS, "input in 'features' mode")
        renames = {resolve(df.columns, f): f for f in FEATS}
        return df.select(*[F.col(c).alias(renames.get(c, c)) for c in df.columns])
    if mode == "raw":
        return raw_features(df, as_of=as_of)
    raise ValueError(f"unknown input mode {mode!r}: a feature table is 'features', trips are 'raw'")


def score_batch(spark: SparkSession, input_path: str, output_path: str, model_path: str,
                mode: str = "features", fmt: str = "parquet", input_fmt: str | None = None,
                as_of: dt.datetime | str | None = None, invalid: str = "error", rejects_path: str | None = None) -> str:
    """Read -> features -> casts -> scale -> predict -> write.

    The output format is checked before anything is read. ``invalid`` as in
    :func:`score`; with ``rejects_path`` the counts of rows in, rejected per
    reason and scored are written there, gathered by the scoring pass itself.
    """
    check_format(fmt)
    raw = read_any(spark, input_path, input_fmt, infer_schema=True)  # CSV: columns passed through keep their types
    feats = features_for_scoring(raw, mode, as_of)
    scored, watch = counted_score(ml.load(model_path), feats, invalid=invalid)
    write_table(scored, output_path, fmt=fmt)
    if rejects_path:
        write_table(rejects.table(spark, watch.get), rejects_path)
    return output_path
