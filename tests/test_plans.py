"""Plan checks: built-in expressions only, top-k as TakeOrderedAndProject,
partial aggregation before shuffles, pushdown and partition pruning."""

from __future__ import annotations

import pytest

from tripspark.plans import catalog as C
from tripspark.plans.inspect import physical_plan
from tripspark.sources.readers import read_table
from tripspark.sources.sinks import write_table

SF = "/root/testdata/sf0.001"
# queries that only plan (the others write scratch tables while building)
PURE = ["silver", "features", "hourly_stats", "top_pu_zones", "wday_vs_wend", "vendor_counts",
        "null_counts", "feature_profile", "label_correlations", "calibration", "error_by_hour",
        "error_by_distance_bin", "error_by_distance_bin_filled", "residual_histogram", "top_errors",
        "sample_fixed_n", "split_hash", "raw_features", "prediction_errors", "regression_metrics"]
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonMapInArrow", "ExternalRDD")


@pytest.mark.parametrize("key", PURE)
def test_no_python_in_plan(spark, key):
    plan = physical_plan(C.QUERIES[key](spark, SF))
    assert not any(n in plan for n in PYTHON_NODES), plan


@pytest.mark.parametrize("key", ["top_pu_zones", "top_fares", "top_errors", "sample_fixed_n"])
def test_top_k_is_take_ordered(spark, key):
    assert "TakeOrderedAndProject" in physical_plan(C.QUERIES[key](spark, SF))


def test_dedupe_aggregates_before_the_shuffle(spark):
    plan = physical_plan(C.QUERIES["silver"](spark, SF))
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")  # partial is below (later in text)
    assert "SortAggregate" not in plan  # row-id dedupe: hash aggregate, no per-partition sort


def test_month_filter_prunes_partitions_and_filters_push_down(spark, scratch):
    path = write_table(C.silver_df(spark, SF), scratch("silver"), partition_by=["ym"])
    plan = physical_plan(read_table(spark, path, months=["2024-02"]).where("fare_amount > 1"))
    assert "PartitionFilters: [isnotnull(ym" in plan and "2024-02" in plan
    assert "PushedFilters: [IsNotNull(fare_amount), GreaterThan(fare_amount,1.0)]" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = physical_plan(C.QUERIES["vendor_counts"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint>" in plan


def test_feature_bounds_push_down_to_stored_silver(spark, scratch):
    from tripspark.operators.features import build_features

    path = write_table(C.silver_df(spark, SF), scratch("silver"), partition_by=["ym"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # plan text is cut at 100 by default
    try:
        plan = physical_plan(build_features(read_table(spark, path, months=["2024-02"])))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    for f in ("GreaterThan(fare_amount,1.0)", "LessThan(fare_amount,200.0)", "GreaterThan(trip_distance,0.1)",
              "LessThan(trip_distance,50.0)", "GreaterThan(trip_minutes,1.0)", "LessThan(trip_minutes,180.0)"):
        assert f in pushed, plan
    assert "PartitionFilters: [isnotnull(ym" in plan
