"""Jobs end to end on the source's own columns, and the rules behind them."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripspark.operators import ml, quality, quantiles, sampling
from tripspark.operators.features import MissingColumnsError, raw_features
from tripspark.operators.scoring import score_batch
from tripspark.operators.silver import silver
from tripspark.plans import catalog, jobs
from tripspark.schemas import BRONZE_SCHEMA, FEATS, ROW_ID
from tripspark.session import clear_scratch, scratch_path
from tripspark.sources import readers as R
from tripspark.sources import sinks as K
from tripspark.sources.fixtures import upload_a_frame

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark):
    """Raw trips with the nine source columns only, through all layers."""
    at = lambda name: scratch_path(spark, name)
    raw = at("raw")
    catalog.bronze(spark, SF).select(*BRONZE_SCHEMA.fieldNames()).repartition(3).write.parquet(raw)
    bronze = jobs.ingest(spark, raw, at("bronze"))
    out = jobs.curate(spark, bronze, at("silver"), at("gold"))
    out["bronze"], out["features"] = bronze, jobs.features(spark, out["silver"], at("features"))
    out.update(jobs.train(spark, out["features"], at("artifacts")))
    return out


def test_whole_chain_without_a_source_id(spark, scratch, layers):
    assert R.read_table(spark, layers["silver"]).count() == 950
    feats = R.read_table(spark, layers["features"])
    assert feats.count() == 909 and ROW_ID in feats.columns and "event_id" not in feats.columns
    assert spark.read.json(layers["metrics"]).count() == 12
    pred = score_batch(spark, layers["features"], scratch("pred"), layers["LinearRegression"])
    reports = jobs.prediction_report(spark, pred, scratch("report"), scatter_percent=20)
    back = {name: R.read_csv(spark, p) for name, p in reports.items()}
    assert back["by_hour"].count() == 24 and back["top_errors"].count() == 20 and ROW_ID in back["top_errors"].columns
    assert 0 < back["scatter"].count() < 909 and back["scatter"].columns == ["trip_distance", "label", "fare_pred"]
    random = jobs.train(spark, layers["features"], scratch("artifacts"), split="random")
    assert spark.read.json(random["metrics"]).count() == 12


def test_dedupe_by_row_id_is_a_hash_aggregate(spark, layers):
    s = silver(K.read_bronze(spark, layers["bronze"]))
    s.collect()
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_random_split_is_whole_and_repeatable(spark, layers):
    feats = R.read_table(spark, layers["features"])
    a, b = sampling.random_split(feats, seed=5)
    again, _ = sampling.random_split(feats, seed=5)
    assert a.count() + b.count() == feats.count() and a.exceptAll(again).count() == 0
    assert a.select(ROW_ID).intersect(b.select(ROW_ID)).count() == 0
    with pytest.raises(MissingColumnsError):
        sampling.hash_split(feats.drop(ROW_ID))


def test_stored_marts_are_not_rounded(spark, layers):
    stored = R.read_table(spark, layers["silver"])
    want = {r.hour: r.a for r in stored.groupBy("hour").agg(F.avg("total_amount").alias("a")).collect()}
    got = {r.hour: r.avg_total for r in R.read_table(spark, layers["hourly_stats"]).collect()}
    assert got == pytest.approx(want, rel=1e-12) and any(v != round(v, 6) for v in got.values())


def test_curate_of_months_leaves_the_others(spark, scratch, layers):
    silver_path = scratch("silver")
    jobs.curate(spark, layers["bronze"], silver_path, scratch("gold"))
    months = sorted(r.ym for r in R.read_table(spark, silver_path).select(F.col("ym").cast("string").alias("ym")).distinct().collect())
    small = scratch("small")
    K.read_bronze(spark, layers["bronze"]).where(F.date_format("tpep_pickup_datetime", "yyyy-MM") == months[0]).limit(40).write.parquet(small)
    before = R.read_table(spark, silver_path).where(F.col("ym") != months[0]).count()
    jobs.curate(spark, small, silver_path, scratch("gold"), months=months[:1])
    after = R.read_table(spark, silver_path)
    assert after.where(F.col("ym") != months[0]).count() == before and 0 < after.where(F.col("ym") == months[0]).count() <= 40


def test_feature_qa_reports(spark, scratch, layers):
    out = jobs.feature_qa(spark, layers["features"], scratch("qa"), layers["silver"])
    rows = {name: R.read_csv(spark, p).count() for name, p in out.items()}
    assert rows == {"null_counts": 1, "profile": 1, "quantiles": 8, "correlations": 6, "top_fares": 5, "top_distances": 5,
                    "silver_quantiles": 8, "silver_correlations": 2}


@pytest.mark.parametrize("fare", [True, False])
def test_upload_and_score(spark, scratch, layers, fare):
    upload = upload_a_frame(catalog.bronze(spark, SF))
    path = K.write_table(upload if fare else upload.drop("trip_fare"), scratch("upload"), fmt="csv")
    out = jobs.score_upload(spark, path, layers["LinearRegression"], scratch("scored"), keep=["event_id"], export_rows=50)
    pred = R.read_table(spark, out["predictions"])
    rejected = {r.rule: r["rows"] for r in R.read_table(spark, out["rejects"]).collect()}
    assert pred.count() == rejected["input"] == upload.count() and ("abs_error" in pred.columns) == fare
    assert pred.where("fare_pred IS NOT NULL").count() == rejected["output"] < rejected["input"]
    export = R.read_csv(spark, out["export"], infer_schema=True)
    want = sorted(int(r.event_id) for r in pred.select("event_id").collect())[:50]
    assert sorted(r.event_id for r in export.collect()) == want
    assert ("metrics" in out) == fare and R.read_csv(spark, out["by_distance_bin"]).count() == 6


def test_raw_scoring_with_missing_pickups(spark, scratch, layers):
    trips = catalog.bronze(spark, SF).withColumn("tpep_pickup_datetime", F.when(F.col("event_id") % 5 > 0, F.col("tpep_pickup_datetime")))
    trips = trips.where("passenger_count IS NOT NULL")
    path = K.write_table(trips, scratch("trips"))
    out = R.read_table(spark, score_batch(spark, path, scratch("out"), layers["LinearRegression"], mode="raw"))
    assert out.count() == trips.count() and out.where("fare_pred IS NULL OR hour IS NULL").count() == 0
    assert {"pickup_ts", "dropoff_ts", "dow"} <= set(out.columns)
    hours = {r.hour for r in raw_features(trips).where("pickup_ts IS NULL").select("hour").distinct().collect()}
    assert len(hours) == 1  # one time for all rows


def test_scoring_csv_keeps_types(spark, scratch, layers):
    path = K.write_table(R.read_table(spark, layers["features"]), scratch("feats.csv"), fmt="csv")
    out = R.read_table(spark, score_batch(spark, path, scratch("out"), layers["LinearRegression"], input_fmt="csv"))
    types = dict(out.dtypes)
    assert types["label"] == "double" and types[ROW_ID] == "bigint"
    with pytest.raises(ValueError):
        score_batch(spark, path, scratch("out"), layers["LinearRegression"], fmt="xml")


# ------------------------------------------------------------------ rules
def test_quantiles_of_long_runs_with_default_settings(spark):
    df = spark.range(2_400_000).selectExpr("CAST(id % 2 AS DOUBLE) AS v")
    got = {r.prob: r.value for r in quantiles.exact_quantiles(df, ["v"], [0.25, 0.5, 0.5000001, 0.75], materialize=False).collect()}
    assert got == {0.25: 0.0, 0.5: 0.0, 0.5000001: 1.0, 0.75: 1.0}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.sampled_from([0.0, 0.01, 1.5, 2.0, 2.0, 7.25]), min_size=1, max_size=60), probs=st.lists(st.floats(0.01, 1.0), min_size=1, max_size=3))
def test_exact_quantiles_of_repeated_values(spark, values, probs):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.prob: r.value for r in quantiles.exact_quantiles(df, ["v"], probs, accuracy=5, max_candidates=3, materialize=False).collect()}
    import math
    for p in probs:
        assert got[p] == sorted(values)[max(1, math.ceil(p * len(values))) - 1]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.floats(-50, 50)), st.one_of(st.none(), st.floats(-50, 50))), min_size=1, max_size=12))
def test_rmse_is_never_below_mae(spark, rows):
    m = quality.regression_metrics(spark.createDataFrame(rows, "label double, fare_pred double")).first()
    known = [(a, b) for a, b in rows if a is not None and b is not None]
    assert m.n == len(known)
    if known:
        mae = sum(abs(a - b) for a, b in known) / len(known)
        assert m.mae == pytest.approx(mae, abs=1e-9) and m.rmse >= m.mae - 1e-9


def test_histogram_leaves_nan_out(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(float("nan"),), (None,)], "v double")
    rows = quality.histogram(df, "v", 3).orderBy("bin").collect()
    assert [r.n for r in rows] == [3, 3, 4] and rows[0].bin_lo == 0.0 and rows[-1].bin_hi == 9.0
    with pytest.raises(ValueError):
        quality.quantile_splits(df, "v", relative_error=-0.1)


def test_repeated_source_ids_do_not_decide(spark):
    """Two rows with one id: the survivor does not depend on their order."""
    row = "1L AS VendorID, TIMESTAMP '2024-01-01 10:00:00' AS tpep_pickup_datetime, TIMESTAMP '2024-01-01 10:10:00' AS tpep_dropoff_datetime, " \
          "1.0D AS passenger_count, 2.0D AS trip_distance, 1L AS PULocationID, 2L AS DOLocationID, {f}D AS fare_amount, 9.0D AS total_amount, 5L AS event_id"
    a, b = (spark.sql("SELECT " + row.format(f=f)) for f in ("7.0", "8.0"))
    assert silver(a.union(b)).first().fare_amount == silver(b.union(a)).first().fare_amount == 7.0


def test_scratch_is_cleared(spark):
    path = scratch_path(spark, "gone")
    spark.range(1).write.parquet(path)
    from tripspark import session

    kept, session._MADE[:] = list(session._MADE), [path]
    try:
        assert clear_scratch(spark) == 1 and not R.path_exists(spark, path)
    finally:
        session._MADE[:] = kept
    assert len(FEATS) == 6 and ml.valid_rows is not None
