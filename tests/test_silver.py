from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tripspark.operators import silver as S

BRONZE_DDL = ("VendorID bigint, tpep_pickup_datetime string, tpep_dropoff_datetime string, "
              "passenger_count string, trip_distance double, PULocationID bigint, DOLocationID bigint, "
              "fare_amount double, total_amount double, event_id bigint")


def _bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_DDL)


def test_harmonize_renames_only_when_canonical_absent(spark):
    a = spark.createDataFrame([(1, 2)], "vendor_id bigint, x int")
    assert S.harmonize_names(a).columns == ["VendorID", "x"]
    b = spark.createDataFrame([(1, 2)], "vendor_id bigint, VendorID bigint")
    assert S.harmonize_names(b).columns == ["vendor_id", "VendorID"]


def test_typed_turns_malformed_values_into_null(spark):
    df = _bronze(spark, [
        (1, "abc", "2024-01-01 10:05:00", "n/a", 1.0, 1, 2, 5.0, 6.0, 1),
        (1, "2024-01-01 10:00:00", "2024-01-01 10:05:00", "NaN", 1.0, 1, 2, 5.0, 6.0, 2),
        (1, "2024-01-01 10:00:00", "2024-01-01 10:05:00", "2.0", 1.0, 1, 2, 5.0, 6.0, 3),
    ])
    rows = {r.event_id: r for r in S.typed(df).collect()}
    assert rows[1].tpep_pickup_datetime is None and rows[1].passenger_count is None
    assert rows[2].passenger_count is None  # NaN is not a count (null, not 0)
    assert rows[3].passenger_count == 2
    assert rows[3].tpep_pickup_datetime == dt.datetime(2024, 1, 1, 10, 0)


def test_silver_filters_and_minutes(spark):
    t0 = "2024-01-06 10:00:00.900000"
    df = _bronze(spark, [
        (1, t0, None, "1", 1.0, 1, 2, 5.0, 6.0, 1),                       # no dropoff
        (1, t0, "2024-01-06 10:05:00", "1", 0.0, 1, 2, 5.0, 6.0, 2),       # zero distance
        (1, t0, "2024-01-06 10:05:00", "1", 1.0, 1, 2, 5.0, None, 3),      # no total
        (1, t0, "2024-01-06 10:00:00.950000", "1", 1.0, 1, 2, 5.0, 6.0, 4),  # same second: 0 min
        (1, t0, "2024-01-06 09:59:00", "1", 1.0, 1, 2, 5.0, 6.0, 5),       # negative
        (1, t0, "2024-01-06 10:05:00.100000", "1", 1.0, 1, 2, 5.0, 6.0, 6),  # kept
    ])
    out = S.silver(df).collect()
    assert [r.event_id for r in out] == [6]
    r = out[0]
    assert r.trip_minutes == 5.0  # whole seconds: 10:05:00 - 10:00:00
    assert (r.hour, r.dow, r.ym) == (10, "Sat", "2024-01")


def test_dedupe_keeps_lowest_order_and_treats_null_keys_as_equal(spark):
    base = ("2024-01-01 10:00:00", "2024-01-01 10:10:00")
    df = _bronze(spark, [
        (1, *base, None, 1.0, 1, 2, 9.0, 10.0, 7),
        (1, *base, None, 2.0, 1, 2, 8.0, 11.0, 3),   # same key (null passengers): survivor
        (1, *base, "1", 1.0, 1, 2, 9.0, 10.0, 5),
        (2, *base, "1", 1.0, 1, 2, 9.0, 10.0, 4),
    ])
    def rows():
        return sorted(((r.VendorID, r.passenger_count, r.event_id, r.fare_amount)
                       for r in S.silver(df).collect()), key=lambda t: (t[0], t[1] or -1))

    out = rows()
    assert out == [(1, None, 3, 8.0), (1, 1, 5, 9.0), (2, 1, 4, 9.0)]
    assert rows() == out


def test_dedupe_without_order_is_still_deterministic(spark):
    df = spark.createDataFrame([(1, 3.0, "b"), (1, 2.0, "z"), (2, 1.0, "a")], "k int, v double, s string")
    out = sorted(tuple(r) for r in S.dedupe(df, ["k"], []).collect())
    assert out == [(1, 2.0, "z"), (2, 1.0, "a")]


def test_rejection_audit_counts_first_failing_rule(spark):
    df = _bronze(spark, [
        (1, "2024-01-01 10:00:00", None, "1", 0.0, 1, 2, 5.0, None, 1),   # fails all: counted once
        (1, "2024-01-01 10:00:00", "2024-01-01 10:05:00", "1", 0.0, 1, 2, 5.0, 6.0, 2),
        (1, "2024-01-01 10:00:00", "2024-01-01 10:05:00", "1", 1.0, 1, 2, 5.0, 6.0, 3),
    ])
    r = S.rejection_audit(df).first()
    assert (r.input_rows, r.timestamps_present, r.positive_distance, r.total_present,
            r.positive_minutes, r.kept_rows) == (3, 1, 1, 0, 0, 1)


def test_fixture_row_counts(spark):
    from tripspark.plans.catalog import bronze, features_df, silver_df

    sf = "/root/testdata/sf0.01"
    assert bronze(spark, sf).count() == 10200
    s = silver_df(spark, sf)
    assert s.count() == 9507
    by_month = {r.ym: r["count"] for r in s.groupBy("ym").count().collect()}
    assert by_month == {"2024-01": 3168, "2024-02": 3065, "2024-03": 3169, "2024-04": 105}
    assert features_df(spark, sf).count() == 9031
    assert S.silver(bronze(spark, sf)).where(F.col("event_id") >= 1_000_000_000).count() == 0


def test_dedupe_paths_agree(spark):
    from tripspark.plans.catalog import bronze
    from tripspark.plans.inspect import physical_plan

    b = S.clean(S.typed(bronze(spark, "/root/testdata/sf0.001")))
    by_struct = S.dedupe(b, S.SILVER_KEY, ["event_id"])
    by_id = S.dedupe(b, S.SILVER_KEY, ["event_id"], unique_order=True)
    assert by_struct.exceptAll(by_id).count() == 0 and by_id.exceptAll(by_struct).count() == 0
    assert "HashAggregate" in physical_plan(by_id) and "partial_min_by" in physical_plan(by_id)
