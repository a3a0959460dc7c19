"""Reject counts in the same pass as the work.

``DataFrame.observe`` metrics ride on the job that writes the good rows: no
second scan, no persisted copy. A row counts against the first rule it fails.
Observe in front of a write whose stages run once; a stage that is run again
after a lost executor may count its rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tripspark.operators.features import _not_missing
from tripspark.schemas import FEATS

SCHEMA = "step int, rule string, rows bigint"


def first_failures(rules: Sequence[tuple[str, Column]]) -> list[Column]:
    """Counts of the rows that fail each rule first; a null verdict fails."""
    out, passed = [], F.lit(True)
    for name, keep in rules:
        keep = F.coalesce(keep, F.lit(False))
        out.append(F.count_if(passed & ~keep).alias(name))
        passed = passed & keep
    return [F.count(F.lit(1)).alias("input"), *out, F.count_if(passed).alias("output")]


def observed(df: DataFrame, rules: Sequence[tuple[str, Column]], keep_all: bool = False) -> tuple[DataFrame, Observation]:
    """The rows that pass all rules (or all rows), and the observation that
    holds the counts once they have been written."""
    watch = Observation()
    df = df.observe(watch, *first_failures(rules))
    for _, keep in () if keep_all else rules:
        df = df.where(keep)
    return df, watch


def feature_rules(df: DataFrame) -> list[tuple[str, Column]]:
    """One rule per model feature: neither null nor NaN."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    return [(f"{c}_present", _not_missing([c], dtypes)) for c in FEATS]


def table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """step, rule, rows: a handful of rows, ``input`` first."""
    return spark.createDataFrame([(i, name, int(n)) for i, (name, n) in enumerate(counts.items())], SCHEMA)


__all__ = ["observed", "first_failures", "feature_rules", "table"]
