from __future__ import annotations

import math

import pytest

from tripspark.operators import features as FT
from tripspark.operators.silver import derive


def _silver_rows(spark, rows):
    """rows: (fare, distance, minutes) -> a small Silver frame."""
    data = []
    for i, (fare, dist, mins) in enumerate(rows):
        data.append((i, fare, dist, mins))
    df = spark.createDataFrame(data, "event_id bigint, fare_amount double, trip_distance double, "
                                     "trip_minutes double")
    return df.selectExpr("*", "1 AS passenger_count", "10 AS hour", "'Sat' AS dow")


def test_bounds_are_exclusive_and_reject_null(spark):
    rows = [(1.0, 1.0, 10.0), (1.01, 1.0, 10.0), (199.99, 1.0, 10.0), (200.0, 1.0, 10.0), (None, 1.0, 10.0),
            (5.0, 0.1, 10.0), (5.0, 0.11, 10.0), (5.0, 49.99, 10.0), (5.0, 50.0, 10.0), (5.0, 0.0, 10.0),
            (5.0, 1.0, 1.0), (5.0, 1.0, 1.5), (5.0, 1.0, 179.0), (5.0, 1.0, 180.0), (5.0, 1.0, -3.0),
            (5.0, 1.0, 0.0)]
    out = FT.build_features(_silver_rows(spark, rows)).collect()
    assert sorted(r.event_id for r in out) == [1, 2, 6, 7, 11, 12]
    r = next(x for x in out if x.event_id == 6)
    assert r.log_distance == pytest.approx(math.log1p(0.11))
    assert r.is_weekend == 1 and r.label == 5.0


def test_nan_and_null_rows_are_dropped(spark):
    df = _silver_rows(spark, [(5.0, 1.0, float("nan")), (5.0, 1.0, 10.0)])
    df = df.selectExpr("event_id", "fare_amount", "trip_distance", "trip_minutes",
                       "CASE WHEN event_id = 1 THEN NULL ELSE 1 END AS passenger_count", "hour", "dow")
    assert FT.build_features(df).count() == 0


def test_raw_features_defaults_and_as_of(spark):
    df = spark.createDataFrame(
        [(1.0, None, None, 5.0), (2.0, "2024-01-07 08:00:00", "2024-01-07 08:30:00", 5.0),
         (3.0, "2024-01-08 09:00:00", None, None)],
        "trip_distance double, tpep_pickup_datetime string, tpep_dropoff_datetime string, trip_minutes double")
    out = {r.trip_distance: r for r in FT.raw_features(df, as_of="2024-06-01 23:00:00").collect()}
    assert out[1.0].trip_minutes == 5.0 and out[1.0].hour == 23 and out[1.0].is_weekend == 1  # Sat
    assert out[2.0].trip_minutes == 30.0 and out[2.0].is_weekend == 1  # Sunday
    assert out[3.0].trip_minutes == 12.0 and out[3.0].is_weekend == 0
    assert all(r.passenger_count == 1 for r in out.values())
    assert FT.raw_features(df).columns[:6] == FT.FEATS


def test_raw_features_precedence(spark):
    df = spark.createDataFrame([(1.0, "2024-01-07 08:00:00", "2024-01-07 08:30:00", 5.0)],
                               "trip_distance double, pickup_datetime string, dropoff_datetime string, "
                               "trip_minutes double")
    assert FT.raw_features(df).first().trip_minutes == 30.0
    assert FT.raw_features(df, prefer="supplied").first().trip_minutes == 5.0


def test_raw_features_requires_distance(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(FT.MissingColumnsError):
        FT.raw_features(df)


def test_upload_schema_a_mixed_case_no_dropoff(spark):
    df = spark.createDataFrame([("2.5", "2024-01-06 22:15:00", "11.0")],
                               "Trip_Distance string, PICKUP_TS string, TRIP_FARE string")
    r = FT.upload_features(df).first()
    assert (r.trip_distance, r.trip_minutes, r.passenger_count, r.hour, r.is_weekend, r.trip_fare) == \
        (2.5, 12.0, 1, 22, 1, 11.0)


def test_upload_schema_b_supplied_values_win(spark):
    df = spark.createDataFrame([("2.5", "7", "3", "4", "0", "2024-01-06 22:15:00")],
                               "trip_distance string, trip_minutes string, passenger_count string, "
                               "hour string, is_weekend string, pickup_datetime string")
    r = FT.upload_features(df).first()
    assert (r.trip_minutes, r.passenger_count, r.hour, r.is_weekend) == (7.0, 3, 4, 0)
    assert "trip_fare" not in FT.upload_features(df).columns


def test_upload_errors(spark):
    with pytest.raises(FT.MissingColumnsError):
        FT.upload_features(spark.createDataFrame([(1.0,)], "trip_distance double"))
    with pytest.raises(FT.MissingColumnsError):
        FT.upload_features(spark.createDataFrame([(1.0, 2.0)], "trip_distance double, TRIP_DISTANCE double"))


def test_weekend_encodings_agree(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'2024-01-01 12:00:00', timestamp'2024-01-14 12:00:00', "
                   "interval 1 day)) AS t")
    from pyspark.sql import functions as F
    from tripspark.functions import day_name, day_of_week, weekend_from_day_name, weekend_from_day_number

    rows = df.select(weekend_from_day_name(day_name(F.col("t"))).alias("a"),
                     weekend_from_day_number(day_of_week(F.col("t"))).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and sum(r.a for r in rows) == 4


def test_cast_features_text(spark):
    df = spark.createDataFrame([("1.5", "x", "2.0", "n/a", "7", "1")], ",".join(
        f"{c} string" for c in FT.FEATS))
    r = FT.cast_features(df).first()
    assert (r.trip_distance, r.log_distance, r.trip_minutes, r.passenger_count, r.hour, r.is_weekend) == \
        (1.5, None, 2.0, None, 7, 1)


def test_derive_columns(spark):
    df = spark.createDataFrame([("2024-03-31 23:59:59", "2024-04-01 00:01:00")], "a string, b string")
    df = df.selectExpr("cast(a as timestamp) AS tpep_pickup_datetime", "cast(b as timestamp) AS tpep_dropoff_datetime")
    r = derive(df).first()
    assert (r.trip_minutes, r.hour, r.dow, r.ym) == (61 / 60.0, 23, "Sun", "2024-03")
