from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripspark.sources import readers as R
from tripspark.sources import sinks as K
from tripspark.plans import jobs


def _write(spark, path, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(path)


def test_ingest_handles_schema_drift(spark, scratch):
    src = scratch("drift")
    ts = "cast('2024-01-01 10:00:00' as timestamp)"
    spark.sql(f"SELECT 1L AS VendorID, {ts} AS tpep_pickup_datetime, 3L AS passenger_count, 1.5D AS trip_distance") \
        .coalesce(1).write.parquet(f"{src}/a_2024-01")
    spark.sql(f"SELECT 2L AS VendorID, {ts} AS tpep_pickup_datetime, 2.0D AS passenger_count, 2.5D AS trip_distance, "
              "1.25D AS airport_fee").coalesce(1).write.parquet(f"{src}/b_2024-02")
    spark.sql(f"SELECT 2 AS vendor_id, {ts} AS tpep_pickup_datetime, 4 AS passenger_count, 3.5D AS trip_distance") \
        .coalesce(1).write.parquet(f"{src}/c_2024-03")
    bronze = scratch("bronze")
    batches = K.ingest_folder(spark, src, bronze, files_per_batch=2)
    assert batches == [0, 1]
    df = K.read_bronze(spark, bronze)
    types = dict(df.dtypes)
    assert types["passenger_count"] == "double" and types["VendorID"] == "bigint"
    rows = sorted((r.VendorID, r.passenger_count, r.airport_fee, r.ingest_batch) for r in df.collect())
    assert rows == [(1, 3.0, None, 0), (2, 2.0, 1.25, 0), (2, 4.0, None, 1)]


def test_ingest_refuses_incompatible_types_naming_the_file(spark, scratch):
    src = scratch("bad")
    spark.sql("SELECT array(1) AS trip_distance").write.parquet(f"{src}/x")
    with pytest.raises(TypeError, match="trip_distance"):
        K.ingest_folder(spark, src, scratch("bronze"))


def test_ingest_empty_folder_fails(spark, scratch):
    with pytest.raises(FileNotFoundError):
        R.plan_batches([], 4)


def test_plan_batches_sorted():
    assert R.plan_batches(["c", "a", "b", "e", "d"], 2) == [["a", "b"], ["c", "d"], ["e"]]


def test_write_validates_format_before_running(spark, scratch):
    with pytest.raises(ValueError):
        K.write_table(spark.range(3), scratch("x"), fmt="orc")


def test_read_any_dispatch_and_csv_roundtrip(spark, scratch):
    df = spark.createDataFrame([(1, 2.5, "a")], "i int, d double, s string")
    base = scratch("csv")
    p = K.write_report_csv(df, base + ".csv")
    back = R.read_any(spark, p, schema=df.schema)
    assert back.collect() == df.collect()
    txt = R.read_any(spark, p)
    assert dict(txt.dtypes) == {"i": "string", "d": "string", "s": "string"}
    pq = K.write_table(df, scratch("pq"))
    assert R.read_any(spark, pq).collect() == df.collect()


def test_dynamic_overwrite_replaces_only_present_months(spark, scratch):
    path = scratch("silver")
    a = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "x int, ym string")
    K.write_table(a, path, partition_by=["ym"])
    b = spark.createDataFrame([(9, "2024-02")], "x int, ym string")
    K.write_table(b, path, partition_by=["ym"], dynamic_overwrite=True)
    got = sorted((r.x, r.ym) for r in R.read_table(spark, path).collect())
    assert got == [(1, "2024-01"), (9, "2024-02")]
    assert R.read_table(spark, path, months=["2024-01"]).count() == 1


def test_export_is_capped_and_keyed(spark, scratch):
    df = spark.range(50).select(F.col("id").alias("event_id"), (F.col("id") * 2).alias("v"))
    p = K.export_predictions(df, scratch("exp"), key="event_id", n=10)
    back = R.read_csv(spark, p, schema=df.schema).collect()
    assert [r.event_id for r in back] == list(range(10))


def test_jobs_end_to_end(spark, scratch):
    from tripspark.plans.catalog import _write_raw_files

    files = _write_raw_files(spark, "/root/testdata/sf0.001")
    src = files[0].split("/src_month=")[0]
    bronze = jobs.ingest(spark, src, scratch("bronze"))
    cur = jobs.curate(spark, bronze, scratch("silver"), scratch("gold"))
    assert R.read_table(spark, cur["hourly_stats"]).count() == 24
    assert R.read_table(spark, cur["silver"]).count() == 950
    feats = jobs.features(spark, cur["silver"], scratch("features"))
    assert R.read_table(spark, feats).count() == 909
    arts = jobs.train(spark, feats, scratch("artifacts"))
    assert spark.read.json(arts["metrics"]).count() == 12
    from tripspark.operators.scoring import score_batch

    pred = score_batch(spark, feats, scratch("pred"), arts["LinearRegression"])
    rep = jobs.prediction_report(spark, pred, scratch("report"))
    assert R.read_csv(spark, rep["by_hour"]).count() == 24
    assert R.read_csv(spark, rep["by_distance_bin_filled"]).count() == 6
    assert R.read_csv(spark, rep["top_errors"]).count() == 20
    assert jobs.smoke(spark, scratch("smoke")) == 5


def test_register_view(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    K.register_view(df, "trips_view_test")
    assert spark.sql("SELECT count(*) AS n FROM trips_view_test").first().n == 2


def test_rebalanced_partitioned_write_and_sorted_report(spark, scratch):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id < 700 THEN '2024-01' ELSE '2024-02' END AS ym")
    path = K.write_table(df, scratch("reb"), partition_by=["ym"], rebalance=True)
    counts = {r.ym: r["count"] for r in R.read_table(spark, path).groupBy("ym").count().collect()}
    assert counts == {"2024-01": 700, "2024-02": 300}
    rep = K.write_report_csv(spark.createDataFrame([(3,), (1,), (2,)], "h int"), scratch("rep"), order_by=["h"])
    assert [r.h for r in R.read_csv(spark, rep, schema="h int").collect()] == [1, 2, 3]


def test_ingest_merges_alias_columns_within_one_batch(spark, scratch):
    src = scratch("alias")
    spark.sql("SELECT 1L AS VendorID, 1.0D AS trip_distance").coalesce(1).write.parquet(f"{src}/a")
    spark.sql("SELECT 2L AS vendor_id, 2.0D AS trip_distance").coalesce(1).write.parquet(f"{src}/b")
    bronze = scratch("bronze")
    assert K.ingest_folder(spark, src, bronze, files_per_batch=4) == [0]
    df = K.read_bronze(spark, bronze)
    assert "vendor_id" not in df.columns
    assert sorted((r.VendorID, r.trip_distance) for r in df.collect()) == [(1, 1.0), (2, 2.0)]


def test_batch_ingest_rerun_is_idempotent(spark, scratch):
    src = scratch("rerun")
    for m in range(3):
        spark.range(10).selectExpr(f"id + {m * 10} AS VendorID").coalesce(1).write.parquet(f"{src}/m{m}")
    bronze = scratch("bronze")
    K.ingest_folder(spark, src, bronze, files_per_batch=2)
    K.ingest_folder(spark, src, bronze, files_per_batch=2)
    df = K.read_bronze(spark, bronze)
    assert df.count() == 30 and df.select("VendorID").distinct().count() == 30
    assert sorted(r.ingest_batch for r in df.select("ingest_batch").distinct().collect()) == [0, 1]


def test_scale_conf_sizes_partitions():
    from tripspark.session import scale_conf

    c = scale_conf(100 * 2**40)  # 100 TiB
    assert int(c["spark.sql.shuffle.partitions"]) == 20_000  # the driver tracks map tasks x partitions
    assert scale_conf(10 << 20)["spark.sql.shuffle.partitions"] == "200"


def test_tune_for_reads_input_size(spark, scratch):
    from tripspark.session import input_bytes, tune_for

    p = K.write_table(spark.range(1000), scratch("size"))
    assert input_bytes(spark, p) > 0
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert tune_for(spark, p)["spark.sql.shuffle.partitions"] == old
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_curate_with_tuning(spark, scratch):
    from tripspark.plans.catalog import _write_raw_files
    from tripspark.session import scale_conf

    keys = list(scale_conf(1))
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        files = _write_raw_files(spark, "/root/testdata/sf0.001")
        bronze = jobs.ingest(spark, files[0].split("/src_month=")[0], scratch("bronze"))
        out = jobs.curate(spark, bronze, scratch("silver"), scratch("gold"), tune=True)
        assert spark.conf.get("spark.sql.shuffle.partitions") == saved["spark.sql.shuffle.partitions"]
        assert R.read_table(spark, out["silver"]).count() == 950
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_csv_rejects_one_by_one(spark, scratch):
    lines = ["id,fare,note", "1,2.5,plain", '2,3.5,"a,b"', "3,4.5", "4,5.5,x,more", "5,cheap,y", "6,,", '7,1,"say ""hi"""', "", "x9,1,z", '8,"open,z', '9,1,"last']
    path = scratch("csv-checked")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    got = R.read_csv_checked(spark, path, "id long, fare double, note string")
    assert got.columns == ["id", "fare", "note", "reject_reason", "record"]
    assert [tuple(r) for r in got.orderBy(F.coalesce("id", F.lit(99))).collect()] == [
        (1, 2.5, "plain", None, None), (2, 3.5, "a,b", None, None), (3, 4.5, None, "short line", "3,4.5"),
        (4, 5.5, "x", "long line", "4,5.5,x,more"), (5, None, "y", "bad value: fare", "5,cheap,y"), (6, None, None, None, None),
        (7, 1.0, 'say "hi"', None, None), (8, None, None, "open quote", '8,"open,z'), (9, 1.0, "last", None, None), (None, 1.0, "z", "bad value: id", "x9,1,z")]
    assert got.groupBy("reject_reason").count().where("reject_reason = 'short line'").first()["count"] == 1
    with pytest.raises(ValueError, match="record"):
        R.read_csv_checked(spark, path, "id long, record string")
