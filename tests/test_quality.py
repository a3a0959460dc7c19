from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tripspark.operators import quality as Q
from tripspark.operators.quantiles import exact_quantiles


def _pred(spark, rows):
    return spark.createDataFrame(rows, "trip_distance double, label double, fare_pred double")


def test_chain_bins_put_null_last_and_negative_first(spark):
    rows = [(d, 10.0, 9.0) for d in (None, -1.0, 0.0, 0.99, 1.0, 3.0, 5.0, 10.0, 20.0, 25.0)]
    out = {r.dist_bin: (r.n, r.bin_order) for r in Q.error_by_distance_bin(_pred(spark, rows)).collect()}
    assert out == {"0–1": (3, 0), "1–3": (1, 1), "3–5": (1, 2), "5–10": (1, 3), "10–20": (1, 4), "20+": (3, 5)}


def test_open_bins_drop_null_and_negative_and_keep_empty_bins(spark):
    rows = [(d, 10.0, 9.0) for d in (None, -1.0, 0.0, 0.99, 1.0, 3.0, 5.0, 10.0, 20.0, 25.0)]
    p = _pred(spark, rows).withColumnRenamed("label", "trip_fare")
    out = {r.dist_bin: r.n for r in Q.error_by_distance_bin_filled(p).collect()}
    assert out == {"0–1": 2, "1–3": 1, "3–5": 1, "5–10": 1, "10–20": 1, "20+": 2}
    only_short = _pred(spark, [(0.2, 5.0, 4.0), (0.5, 6.0, 4.0)]).withColumnRenamed("label", "trip_fare")
    rows = sorted(Q.error_by_distance_bin_filled(only_short).collect(), key=lambda r: r.bin_order)
    assert [r.n for r in rows] == [2, 0, 0, 0, 0, 0]
    assert rows[0].mae == 1.5 and all(r.mae is None for r in rows[1:])
    avg = Q.error_by_distance_bin_filled(only_short, actual=None).collect()
    assert {r.dist_bin: r.avg_pred for r in avg}["0–1"] == 4.0


def test_metrics_constant_label_and_evaluator_equality(spark):
    const = _pred(spark, [(1.0, 5.0, 4.0), (2.0, 5.0, 6.0)])
    assert math.isnan(Q.regression_metrics(const).first().r2)
    assert Q.regression_metrics(const, zero_variance="evaluator").first().r2 == float("-inf")
    from pyspark.ml.evaluation import RegressionEvaluator

    rnd = random.Random(1)
    rows = [(float(i), rnd.uniform(0, 50), rnd.uniform(0, 50)) for i in range(200)]
    df = _pred(spark, rows)
    m = Q.regression_metrics(df, digits=None).first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="label", predictionCol="fare_pred", metricName=name).evaluate(df)
        assert getattr(m, name) == pytest.approx(ev, rel=1e-9)
    assert m.rmse >= m.mae


def test_histogram_covers_all_rows_and_bins(spark):
    rnd = random.Random(2)
    vals = [rnd.gauss(0, 3) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "resid double")
    h = Q.histogram(df, "resid", 60).collect()
    assert len(h) == 60 and sum(r.n for r in h) == 500
    last = max(h, key=lambda r: r.bin)
    assert last.n >= 1  # the maximum lands in the last bin
    const = spark.createDataFrame([(1.0,)] * 5, "resid double")
    assert sorted(r.n for r in Q.histogram(const, "resid", 4).collect()) == [0, 0, 0, 5]


def _brute(vals, p):
    s = sorted(vals)
    return s[max(1, math.ceil(p * len(s))) - 1]


@pytest.mark.parametrize("ties", [False, True])
def test_exact_quantiles_narrowing_equals_brute_force(spark, ties):
    rnd = random.Random(3)
    vals = [round(rnd.lognormvariate(1, 1), 3) for _ in range(3000)]
    if ties:
        vals += [4.2] * 1500  # one value holds a third of the rows
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    probs = [0.01, 0.2, 0.5, 0.9, 0.95, 0.99, 1.0]
    got = {r.prob: r.value for r in exact_quantiles(df, ["x"], probs, accuracy=50, max_candidates=40).collect()}
    assert got == {p: _brute(vals, p) for p in probs}


def test_quantile_buckets_collapse_equal_splits(spark):
    df = spark.createDataFrame([(2.0,)] * 9 + [(3.0,)] * 3, "trip_distance double")
    out = Q.quantile_buckets(df, "trip_distance", relative_error=0.0).collect()
    assert sorted({r.dist_bucket for r in out}) == [1.0, 2.0]  # splits [2.0, 2.0, 2.0, 3.0] -> 2 distinct
    const = spark.createDataFrame([(2.0,)] * 10, "trip_distance double")
    assert {r.dist_bucket for r in Q.quantile_buckets(const, "trip_distance").collect()} == {1.0}


def test_top_rows_break_ties_by_key(spark):
    df = spark.createDataFrame([(i, 5.0 if i < 4 else 1.0) for i in range(8)], "event_id bigint, label double")
    out = Q.top_rows(df, "label", 2, ["event_id", "label"], ["event_id"]).collect()
    assert [r.event_id for r in out] == [0, 1]


def test_null_counts_and_profile(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, "a")], "label double, s string")
    r = Q.null_counts(df).first()
    assert (r.label, r.s) == (1, 2)
    prof = Q.feature_profile(spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "label double, trip_distance double"))
    p = prof.first()
    assert (p.rows, p.label_mean, p.label_min, p.label_max, p.dist_max) == (2, 2.0, 1.0, 3.0, 4.0)
    assert p.label_std == pytest.approx(math.sqrt(2), abs=1e-6)


def test_correlations_long(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(-i)) for i in range(10)], "label double, a double, b double")
    out = {r.column: r.corr for r in Q.correlations(df, "label", ["a", "b", "missing"]).collect()}
    assert out == {"a": 1.0, "b": -1.0}


def test_residual_summary_exact_matches_approx_on_small_data(spark):
    df = _pred(spark, [(1.0, float(i), 0.0) for i in range(101)])
    exact = Q.residual_summary(df, method="exact").first()
    approx = Q.residual_summary(df, accuracy=100000).first()
    assert exact == approx
    assert exact.resid_q50 == 50.0


def test_smallest_n_threshold_path_equals_brute_force(spark):
    from tripspark.operators.quantiles import smallest_n

    rnd = random.Random(5)
    rows = [(i, float(rnd.randint(0, 300)) if i % 37 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "id bigint, v double").repartition(6)
    order = [F.col("v").asc(), F.col("id").asc()]
    got = [(r.id, r.v) for r in smallest_n(df, 1500, order, F.col("v"), direct_max=10).collect()]
    want = sorted(rows, key=lambda t: (t[1] is not None, t[1] if t[1] is not None else 0, t[0]))[:1500]
    assert got == want
    assert smallest_n(df, 10**6, order, F.col("v"), direct_max=10).count() == 4000


def test_quantile_buckets_equal_quantile_discretizer(spark):
    from pyspark.ml.feature import QuantileDiscretizer
    from tripspark.plans.catalog import predictions_df

    p = predictions_df(spark, "/root/testdata/sf0.001")
    ours = Q.quantile_buckets(p, "trip_distance", relative_error=0.0).select("event_id", "dist_bucket")
    qd = QuantileDiscretizer(numBuckets=5, inputCol="trip_distance", outputCol="dist_bucket", relativeError=0.0)
    theirs = qd.fit(p).transform(p).select("event_id", "dist_bucket")
    assert ours.exceptAll(theirs).count() == 0 and theirs.exceptAll(ours).count() == 0


def test_metrics_on_empty_input(spark):
    empty = _pred(spark, []).where("false")
    r = Q.regression_metrics(empty).first()
    assert r.n == 0 and r.rmse is None and r.mae is None
