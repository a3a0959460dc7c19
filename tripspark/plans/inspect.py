"""Plan inspection helpers for tests and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The executed (physical) plan as text, without running the query."""
    return df._jdf.queryExecution().executedPlan().toString()


def explain_string(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
