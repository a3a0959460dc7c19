"""A third of all rows on one key: results stay whole and exact, and the
plans combine map-side before the shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripspark.operators import marts, quality
from tripspark.operators.silver import dedupe
from tripspark.plans.inspect import physical_plan


def _skewed(spark, n=30000):
    # rows with id % 3 == 0 all share one key (a third of the data)
    return spark.range(n).repartition(8).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 24).cast("int").alias("hour"),
        (F.col("id") % 1000 / 10.0).alias("trip_distance"),
        (F.col("id") % 777 / 7.0).alias("total_amount"),
    )


def test_hot_duplicate_group_keeps_one_row(spark):
    df = _skewed(spark)
    out = dedupe(df, ["k"], ["event_id"])
    assert out.count() == 30000 - 10000 + 1
    assert out.where("k = -1").first().event_id == 0
    plan = physical_plan(out)
    assert "partial_min" in plan


def test_hot_group_aggregates_are_whole(spark):
    df = _skewed(spark)
    hs = {r.hour: r.trips for r in marts.hourly_stats(df).collect()}
    assert sum(hs.values()) == 30000 and hs[5] > 10000
    plan = physical_plan(marts.hourly_stats(df))
    assert "partial_count" in plan and "partial_avg" in plan


def test_hot_value_quantile_is_exact(spark):
    from tripspark.operators.quantiles import exact_quantiles

    df = _skewed(spark).select(F.col("k").cast("double").alias("x"))
    vals = sorted(r.x for r in df.collect())
    got = {r.prob: r.value for r in exact_quantiles(df, ["x"], [0.1, 0.3, 0.5], accuracy=100,
                                                    max_candidates=500).collect()}
    import math
    assert got == {p: vals[math.ceil(p * len(vals)) - 1] for p in [0.1, 0.3, 0.5]}
    assert quality.quantiles(df, ["x"], [0.2], method="exact").first().value == -1.0
