from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripspark.operators import ml, sampling
from tripspark.operators.scoring import score
from tripspark.plans.catalog import features_df
from tripspark.schemas import FEATS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def feats(spark):
    return features_df(spark, SF).persist()


def test_hash_split_is_disjoint_and_complete(spark, feats):
    tr, te = sampling.hash_split(feats)
    assert (tr.count(), te.count()) == (7216, 1815)
    assert tr.join(te, "event_id").count() == 0


def test_linear_residuals_are_orthogonal_to_features(spark, feats):
    tr, _ = sampling.hash_split(feats)
    model = ml.fit_linear(tr)
    pred = ml.predict(model, tr).withColumn("r", F.col("label") - F.col("prediction"))
    sums = pred.agg(F.sum("r").alias("one"), *[F.sum(F.col("r") * F.col(c)).alias(c) for c in FEATS]).first()
    scale = pred.agg(F.sum(F.abs("label"))).first()[0]
    assert all(abs(sums[k]) < 1e-6 * scale * 100 for k in ["one"] + FEATS)


def test_tree_leaves_hold_min_instances_and_predict_means(spark, feats):
    tr, _ = sampling.hash_split(feats)
    model = ml.fit_tree(tr)
    pred = ml.predict(model, tr)
    leaves = pred.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("m")).collect()
    assert all(r.n >= 50 for r in leaves)
    assert all(abs(r.prediction - r.m) < 1e-6 for r in leaves)


def test_scaler_zero_variance_gives_zero(spark):
    df = spark.createDataFrame([(float(i), 1.0, float(i), 1, i % 24, i % 2, 3.0) for i in range(20)],
                               "trip_distance double, log_distance double, trip_minutes double, "
                               "passenger_count int, hour int, is_weekend int, label double")
    df = df.withColumn("event_id", F.monotonically_increasing_id())
    model = ml.fit_scaler_only(df)
    out = ml.scaled_columns(model, df).collect()
    assert all(r.log_distance_scaled == 0.0 for r in out)


def test_save_load_and_score(spark, feats, scratch):
    tr, te = sampling.hash_split(feats)
    model = ml.fit_linear(tr, prediction_col="fare_pred")
    path = ml.save(model, scratch("model"))
    a = score(model, te).select("event_id", "fare_pred")
    b = score(ml.load(path), te).select("event_id", "fare_pred")
    assert a.exceptAll(b).count() == 0 and a.count() == te.count()
    bad = te.limit(3).withColumn("trip_minutes", F.lit(None).cast("double"))
    assert score(model, bad, invalid="skip").count() == 0
    assert ml.reject_count(bad).first().rejected == 3


def test_coefficients_and_metrics_table(spark, feats):
    tr, te = sampling.hash_split(feats)
    lin = ml.fit_linear(tr)
    coef = ml.coefficients(spark, lin).collect()
    assert [r.feature for r in coef] == FEATS + ["intercept"]
    m = ml.compare_models({"lr": lin}, {"train": tr, "test": te}).collect()
    assert len(m) == 6
    vals = {(r.split, r.metric): r.value for r in m}
    assert vals[("test", "rmse")] >= vals[("test", "mae")]
    assert 0 < vals[("train", "r2")] <= 1


def test_rows_only_keys_are_consistent(spark):
    from tripspark.plans import catalog as C

    sf = "/root/testdata/sf0.001"
    both = {(r.model, r.split, r.metric): r.value for r in C.QUERIES["model_metrics"](spark, sf).collect()}
    lin = {(r.model, r.split, r.metric): r.value for r in C.QUERIES["lr_metrics"](spark, sf).collect()}
    assert len(both) == 12 and all(both[k] == v for k, v in lin.items())
    preds = C.QUERIES["dt_predictions"](spark, sf)
    assert preds.count() == C.QUERIES["split_hash"](spark, sf).where("NOT is_train").count()


def test_bernoulli_sample_is_a_subset_of_about_the_fraction(spark):
    from tripspark.plans import catalog as C

    sf = "/root/testdata/sf0.01"
    s = C.QUERIES["sample_bernoulli"](spark, sf)
    n, total = s.count(), C.predictions_df(spark, sf).count()
    assert 0.03 * total < n < 0.07 * total
    assert s.select("event_id").subtract(C.predictions_df(spark, sf).select("event_id")).count() == 0


def test_tree_as_a_node_table(spark):
    from tripspark.plans import catalog as C

    train, test = C._split(spark, "/root/testdata/sf0.001")
    model = ml.fit_tree(train)
    nodes = ml.tree_nodes(model)
    rows = {r.node: r for r in nodes.collect()}
    assert 1 in rows and rows[1].rows == train.count()
    for r in rows.values():
        if r.feature is None:
            assert r.rows >= 50
        else:  # both children are there and share the rows
            assert rows[r.left].rows + rows[r.right].rows == r.rows
    leaf, value = ml.tree_columns(nodes)
    got = train.select(leaf.alias("leaf")).groupBy("leaf").count().collect()
    assert {r["leaf"]: r["count"] for r in got} == {n: r.rows for n, r in rows.items() if r.feature is None}
    first = rows[1].feature
    for gap in (F.lit(None).cast("double"), F.lit(float("nan"))):
        r = test.limit(1).withColumn(first, gap).select(leaf.alias("leaf"), value.alias("value")).first()
        assert r.leaf is None and r.value is None


def test_split_gains_equal_brute_force(spark):
    import random

    rng = random.Random(4)
    data = [tuple(float(rng.randrange(1, 9 if i % 2 else 400)) for i in range(len(FEATS))) + (rng.gauss(0, 3),) for _ in range(300)]
    data += [data[0][:1] + (None,) + data[0][2:]]  # not usable
    train = spark.createDataFrame(data, ", ".join(f"{c} double" for c in FEATS) + ", label double").repartition(3)
    got = {(r.feature, r.threshold): (r.rows_left, r.gain) for r in ml.split_gains(train, bins=8, min_instances=20).collect()}
    want, data = {}, data[:300]
    var = lambda ys: sum((y - sum(ys) / len(ys)) ** 2 for y in ys) / len(ys)
    for i, c in enumerate(FEATS):
        xs = sorted(r[i] for r in data)
        for cut in {xs[-(-j * 300 // 8) - 1] for j in range(1, 8)}:
            left, right = [r[-1] for r in data if r[i] <= cut], [r[-1] for r in data if r[i] > cut]
            if min(len(left), len(right)) >= 20:
                want[c, cut] = (len(left), var([r[-1] for r in data]) - len(left) / 300 * var(left) - len(right) / 300 * var(right))
    assert got.keys() == want.keys()
    for k, (n, gain) in want.items():
        assert got[k][0] == n and got[k][1] == pytest.approx(gain, abs=1e-9)
    assert ml.split_gains(train.limit(0)).count() == 0
