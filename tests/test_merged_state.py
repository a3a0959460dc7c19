"""State that is stored per month and merged: sketches, moments, partial
marts; counts of rejected rows; the streaming dedupe."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripspark.operators import marts, ml, moments, quality, rejects, sampling, scoring, sketches
from tripspark.operators.silver import silver
from tripspark.plans import jobs
from tripspark.plans.catalog import bronze, features_df, silver_df
from tripspark.schemas import FEATS, FEATURE_COLUMNS
from tripspark.sources.readers import read_table
from tripspark.sources.sinks import ingest_listed, read_bronze, write_table
from tripspark.streaming.silver import run_silver

SF = "/root/testdata/sf0.001"


def _files(df) -> set[str]:
    """The files that the rows come from."""
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


# ------------------------------------------------------------------ sketches
def test_merged_sketches_hold_the_stated_rank_error(spark):
    df = spark.range(60_000).selectExpr("id % 7 AS part", "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 = 1 THEN double('NaN') ELSE double(id * 7919 % 60000) END AS v",
                                        "5 AS same")
    stored = sketches.sketch(df, ["v", "same"], by=["part"])
    assert stored.count() == 14
    values = np.sort([r.v for r in df.where("v IS NOT NULL AND NOT isnan(v)").collect()])
    for r in sketches.quantiles(stored, [0.01, 0.5, 0.99]).collect():
        assert r.n == (48_000 if r.column == "v" else 60_000)
        if r.column == "same":
            assert r.value == 5
        else:
            low, high = np.searchsorted(values, r.value, "left"), np.searchsorted(values, r.value, "right")
            assert low - 48_000 * sketches.rank_error() <= r.prob * 48_000 <= high + 48_000 * sketches.rank_error()
    assert sketches.splits(stored, "same") == [5.0]
    part = sketches.quantiles(stored, [0.5], by=["part"])
    assert part.count() == 14


def test_sketches_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "ym string, v double")
    assert sketches.quantiles(sketches.sketch(df, ["v"])).count() == 0


# ------------------------------------------------------------------ moments
def test_moments_equal_the_fitted_model_and_its_errors(spark, scratch):
    feats = features_df(spark, SF).withColumn("part", F.col("event_id") % 5)
    rows = moments.moments(feats, FEATURE_COLUMNS, by=["part"])
    model = ml.fit_linear(feats)
    want = {r.feature: (r.coefficient, r.coefficient_unscaled) for r in ml.coefficients(spark, model).collect()}
    for r in moments.linear_coefficients(spark, rows).collect():
        assert np.allclose((r.coefficient, r.coefficient_unscaled), want[r.feature], rtol=1e-6, atol=1e-7)
    m = moments.Moments(rows, FEATURE_COLUMNS)
    coef, intercept = m.fit(FEATS, "label")
    got = m.errors(FEATS, "label", coef, intercept)
    metrics = {r.metric: r.value for r in ml.compare_models({"m": model}, {"all": feats}).collect()}
    assert abs(got["rmse"] - metrics["rmse"]) < 1e-6 and abs(got["r2"] - metrics["r2"]) < 1e-6


def test_moments_skip_gaps_and_allow_constant_columns(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 1.0), ("a", 2.0, 4.0, 1.0), ("b", 3.0, 6.0, 1.0), ("b", None, 5.0, 1.0), ("b", float("nan"), 5.0, 1.0)],
                               "ym string, x double, y double, one double")
    m = moments.Moments(moments.moments(df, ["x", "one", "y"]), ["x", "one", "y"])
    assert m.n == 3
    coef, intercept = m.fit(["x", "one"], "y")
    assert np.allclose(coef, [2, 0]) and abs(intercept) < 1e-9
    corr = {r.column: r.corr for r in moments.correlations(spark, moments.moments(df, ["x", "one", "y"]), "y", ["x", "one"]).collect()}
    assert abs(corr["x"] - 1) < 1e-9 and math.isnan(corr["one"])


def test_adding_a_month_reads_that_month_only(spark, scratch):
    feats = features_df(spark, SF).withColumn("ym", F.concat(F.lit("2024-0"), (F.col("event_id") % 3 + 1).cast("string")))
    path = write_table(feats, scratch("f"), partition_by=["ym"])
    out = jobs.update_moments(spark, path, scratch("m"), months=["2024-01", "2024-02"])
    before = {r.ym: r.n for r in read_table(spark, out).collect()}
    jobs.update_moments(spark, path, out, months=["2024-03"])
    after = {r.ym: r.n for r in read_table(spark, out).collect()}
    assert len(before) == 2 and len(after) == 3 and all(after[k] == v for k, v in before.items())
    assert sum(after.values()) == feats.count()
    plan = read_table(spark, path, months=["2024-03"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-03" in plan.split("PartitionFilters")[1].split("]")[0]


# ------------------------------------------------------------------ marts by month
def _trip(i, month, total=10.0, day=5):
    t = dt.datetime(2024, month, day, i % 24)
    return (i % 2, t, t + dt.timedelta(minutes=10), 1.0, 2.0, i % 9, i % 5, 9.0, total)


def test_new_batches_rewrite_their_months_only(spark, scratch):
    from tripspark.schemas import BRONZE_SCHEMA

    src, path, silver_path, gold = scratch("src"), scratch("bronze"), scratch("silver"), scratch("gold")

    def arrive(name, rows):
        spark.createDataFrame(rows, BRONZE_SCHEMA).coalesce(1).write.parquet(f"{src}/{name}")
        from tripspark.sources.readers import listed_files

        ingest_listed(spark, listed_files(spark, src), path)
        return jobs.curate_new(spark, path, silver_path, gold)

    arrive("a", [_trip(i, 1) for i in range(40)] + [_trip(i, 2) for i in range(30)])
    january = _files(read_table(spark, silver_path, months=["2024-01"]))
    out = arrive("b", [_trip(i, 2, total=20.0, day=9) for i in range(30)] + [_trip(0, 2)])  # further rows and a copy
    assert _files(read_table(spark, silver_path, months=["2024-01"])) == january
    stored = silver(read_bronze(spark, path))
    for name, want in (("hourly_stats", marts.hourly_stats(stored)), ("top_pu_zones", marts.top_pickup_zones(stored)), ("wday_vs_wend", marts.weekday_vs_weekend(stored))):
        got = read_table(spark, out[name]).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), name
    assert read_table(spark, silver_path).count() == 100
    again = jobs.curate_new(spark, path, silver_path, gold)  # nothing new
    assert set(again) == set(out) and read_table(spark, silver_path).count() == 100


# ------------------------------------------------------------------ rejects
def test_counts_come_with_the_scored_rows(spark, scratch):
    feats = features_df(spark, SF).limit(50)
    model = ml.fit_linear(features_df(spark, SF))
    gaps = feats.withColumn("hour", F.when(F.col("hour") % 2 == 0, F.col("hour"))).withColumn(
        "trip_minutes", F.when(F.col("trip_distance") > 3, F.lit(float("nan"))).otherwise(F.col("trip_minutes")))
    path = write_table(gaps, scratch("gaps"))
    rows = read_table(spark, path)
    for mode in ("skip", "keep"):
        scored, watch = scoring.counted_score(model, rows, invalid=mode)
        out = read_table(spark, write_table(scored, scratch(mode)))
        counts = watch.get
        usable = rows.where("hour IS NOT NULL AND NOT isnan(trip_minutes)").count()
        assert counts["input"] == 50 and counts["output"] == usable and sum(counts.values()) == 100
        assert counts["trip_minutes_present"] == rows.where("isnan(trip_minutes)").count()
        assert out.count() == (usable if mode == "skip" else 50) and out.where("fare_pred IS NOT NULL").count() == usable
        assert out.columns == [*feats.columns, "fare_pred"]
    same = scoring.score(model, feats).select("event_id", "fare_pred")
    assert same.exceptAll(scoring.score(model, feats, invalid="keep").select("event_id", "fare_pred")).count() == 0
    with pytest.raises(ValueError):
        scoring.score(model, feats, invalid="drop")


def test_rejects_of_an_empty_table(spark, scratch):
    df, watch = rejects.observed(spark.createDataFrame([], "a int"), [("a_there", F.col("a").isNotNull())])
    write_table(df, scratch("none"))
    assert [tuple(r) for r in rejects.table(spark, watch.get).collect()] == [(0, "input", 0), (1, "a_there", 0), (2, "output", 0)]


def test_upload_keeps_rows_without_a_prediction_and_always_exports(spark, scratch):
    model = ml.save(ml.fit_linear(features_df(spark, SF)), scratch("model"))
    up = spark.createDataFrame([("2.5", "2024-01-01 10:00:00", "2024-01-01 10:20:00"), ("1.5", "2024-01-02 11:00:00", None), (None, "2024-01-02 11:00:00", "2024-01-02 11:09:00")],
                               "trip_distance string, pickup_datetime string, dropoff_datetime string")
    out = jobs.score_upload(spark, write_table(up, scratch("up"), fmt="csv"), model, scratch("out"), export_rows=2)
    pred = read_table(spark, out["predictions"])
    assert pred.count() == 3 and pred.where("fare_pred IS NOT NULL").count() == 1
    found = {r.rule: r["rows"] for r in read_table(spark, out["rejects"]).collect()}
    assert found["input"] == 3 and found["output"] == 1 and found["trip_distance_present"] == 1 and found["trip_minutes_present"] == 1
    assert spark.read.option("header", "true").csv(out["export"]).count() == 2


# ------------------------------------------------------------------ streaming dedupe
def test_stream_dedupe_survives_restarts_and_counts_late_rows(spark, scratch):
    b = bronze(spark, SF)
    src, out, ckpt = scratch("src"), scratch("out"), scratch("ckpt")
    parts = [b.where("event_id % 3 = 0"), b.where("event_id % 3 <> 0"), b.where("event_id % 2 = 0")]  # the last are all copies
    for i, part in enumerate(parts):
        part.write.parquet(f"{src}/{i}")
        assert run_silver(spark, src, out, ckpt, schema=b.schema, delay="1000 days") == 0
    got = read_table(spark, out)
    key = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "passenger_count", "trip_minutes"]
    want = silver_df(spark, SF).select(*key)
    assert got.count() == want.count() and want.exceptAll(got.select(*key)).count() == 0
    last = b.agg(F.max("tpep_pickup_datetime")).first()[0]
    old = b.limit(5).withColumn("tpep_pickup_datetime", F.lit(last - dt.timedelta(days=2000))).withColumn("tpep_dropoff_datetime", F.lit(last - dt.timedelta(days=2000) + dt.timedelta(minutes=9)))
    old.withColumn("trip_distance", F.lit(2.0)).withColumn("total_amount", F.lit(2.0)).coalesce(1).write.parquet(f"{src}/late")
    assert run_silver(spark, src, out, ckpt, schema=b.schema, delay="1000 days") > 0
    assert read_table(spark, out).count() == want.count()


def test_sample_states_merge(spark):
    """States of parts, of whatever partitioning, give the sample of the whole;
    weights act, and rows without one are never drawn."""
    from tripspark.operators import sampling

    rows = [(i, "m1" if i % 3 else "m2", float(i % 10) if i % 7 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "event_id long, part string, w double")
    one = sampling.sample_state(df.where("part = 'm1'").repartition(5), 50, ["part"], key="event_id", seed=7)
    two = sampling.sample_state(df.where("part = 'm2'").repartition(2), 50, ["part"], key="event_id", seed=7)
    assert (one.count(), two.count()) == (50, 50)
    ids = lambda d: sorted(r.event_id for r in d.collect())
    got = sampling.merged_sample(one.unionByName(two), 50, key="event_id")
    assert got.columns == df.columns
    assert ids(got) == ids(sampling.fixed_size_sample(df, 50, key="event_id", seed=7))
    state = sampling.sample_state(df, 5000, ["part"], key="event_id", weight="w")
    assert state.count() == sum(1 for _, _, w in rows if w)
    top = sampling.merged_sample(state, 300, key="event_id").collect()
    assert len(top) == 300 and sum(r.w for r in top) / 300 > 5.5  # 5.0 over the rows with a weight
    assert sampling.merged_sample(sampling.sample_state(df.limit(0), 5, ["part"], key="event_id"), 5, key="event_id").count() == 0


@pytest.mark.parametrize("resolution", [0.1, 7.0, 1000.0])
def test_histogram_from_cells(spark, resolution):
    """Cells finer and coarser than the bins, values on the edges, nulls."""
    rows = [(i % 3, float(i % 97) / 4 - 9) for i in range(700)] + [(1, None), (2, float("nan")), (0, 40.0)]
    df = spark.createDataFrame(rows, "part long, x double").repartition(4)
    cells = quality.histogram_cells(df, "x", ["part"], resolution)
    got = quality.histogram_from_cells(cells, df, "x", 14, resolution)
    want = quality.histogram(df, "x", 14)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
