"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
key of SURVEY section 7.5. Every query starts from the driver tables
(``events`` mapped to trips by Spark) and runs over all rows.

Double columns that two engines may sum in a different order are rounded
in the output (6 decimals for statistics, 4 for model predictions, 10 for
``log_distance``), identically in the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspark.operators import marts, ml, moments, quality, sampling, sketches
from tripspark.operators.features import (
    build_features, cast_features, feature_predicates, raw_features, upload_features, usable_feature_row,
)
from tripspark.operators.scoring import score_batch
from tripspark.operators.silver import harmonize_names, rejection_audit, silver, typed
from tripspark.schemas import FEATS, ROW_ID
from tripspark.session import checkpointed, scratch_path
from tripspark.sources.fixtures import (
    bronze_trips, upload_a_frame, upload_b_frame, with_fixed_prediction,
)
from tripspark.sources.readers import list_files, read_csv, read_csv_checked, read_table
from tripspark.sources.sinks import (
    export_predictions, ingest_files, read_bronze, write_report_csv, write_table,
)

AS_OF = "2024-06-01 00:00:00"
RAW_FILES_PER_BATCH = 4
DIGITS = 6  # reports are rounded here, never in the library
# small enough that the check data goes through the narrowing search
SEARCH = {"accuracy": 500, "max_candidates": 200}
# Source files per month: a month's rows are spread over this many files
# (by event_id), so no single write task holds a whole (possibly hot) month.
RAW_PARTS_PER_MONTH = 4
# Rows per file of the Silver stream's source.
STREAM_FILE_ROWS = 250_000


# ------------------------------------------------------------------ base frames
def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_trips(spark, sf_dir)


def silver_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the fixture's event_id is unique
    return silver(bronze(spark, sf_dir), order=("event_id",), unique_order=True)


def features_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(silver_df(spark, sf_dir))


def predictions_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fixed_prediction(features_df(spark, sf_dir))


def _round_log(df: DataFrame) -> DataFrame:
    return df.withColumn("log_distance", F.round("log_distance", 10))


def _write_raw_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Monthly trip files, as a drop folder would hold them: one file per
    (month, part); part = event_id % RAW_PARTS_PER_MONTH."""
    raw = scratch_path(spark, "raw-trips")
    b = bronze(spark, sf_dir)
    (b.withColumn("src_month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
      .withColumn("src_part", F.col("event_id") % RAW_PARTS_PER_MONTH)
      .repartition("src_month", "src_part")
      .write.partitionBy("src_month", "src_part").parquet(raw))
    return list_files(spark, raw)


def _write_drift_files(spark: SparkSession, sf_dir: str) -> str:
    """Monthly files whose schemas drift, as FIXTURES.md's drift frame:
    by month rank r, r % 4 == 0 stores passenger_count as bigint, 1 adds
    an ``airport_fee`` column, 2 stores passenger_count as int and names
    the vendor column ``vendor_id``, 3 is unchanged. Each month is spread
    over RAW_PARTS_PER_MONTH files. The month list (a handful of values)
    is the only thing collected."""
    raw = scratch_path(spark, "raw-drift")
    b = (bronze(spark, sf_dir)
         .withColumn("src_month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
         .withColumn("src_part", F.col("event_id") % RAW_PARTS_PER_MONTH))
    months = sorted(r.src_month for r in b.select("src_month").distinct().collect())
    for group in range(4):  # one write for all months of a kind
        m = b.where(F.col("src_month").isin(months[group::4]))
        if group == 0:
            m = m.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        elif group == 1:
            m = m.withColumn("airport_fee", (F.col("event_id") % 3).cast("double") * 1.25)
        elif group == 2:
            m = (m.withColumn("passenger_count", F.col("passenger_count").cast("int"))
                 .withColumn("VendorID", F.col("VendorID").cast("int"))
                 .withColumnRenamed("VendorID", "vendor_id"))
        m.repartition("src_month", "src_part").write.partitionBy("src_month", "src_part").parquet(f"{raw}/kind={group}")
    return raw


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _write_raw_files(spark, sf_dir)
    path = scratch_path(spark, "bronze")
    ingest_files(spark, files, path, files_per_batch=RAW_FILES_PER_BATCH)
    return read_bronze(spark, path)


def _feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature layer, checkpointed to the shared folder: model fits and
    evaluations scan it several times, and should not redo the Silver
    shuffle (or go back to the source after a lost executor) each time."""
    return checkpointed(features_df(spark, sf_dir))


def _split(spark: SparkSession, sf_dir: str):
    return sampling.hash_split(_feature_table(spark, sf_dir))


def _linear_model(spark: SparkSession, sf_dir: str, prediction_col: str = "prediction"):
    train, _ = _split(spark, sf_dir)
    return ml.fit_linear(train, prediction_col)


# ---------------------------------------------------------------- sources/sinks
def q_bronze_ingest(spark, sf_dir):
    return _ingested(spark, sf_dir)


def q_bronze_ingest_drift(spark, sf_dir):
    """S1 with schema drift inside one batch: bigint/int/double passenger
    counts, a new column and a renamed vendor column, conformed to the
    declared Bronze schema (the new column kept)."""
    raw = _write_drift_files(spark, sf_dir)
    path = scratch_path(spark, "bronze-drift")
    ingest_files(spark, list_files(spark, raw), path, files_per_batch=64)
    return read_bronze(spark, path)


def q_ingest_batch_counts(spark, sf_dir):
    return marts.batch_counts(_ingested(spark, sf_dir))


def q_silver_partition_counts(spark, sf_dir):
    path = write_table(silver_df(spark, sf_dir), scratch_path(spark, "silver"), partition_by=["ym"],
                       rebalance=True)
    return (read_table(spark, path).groupBy(F.col("ym").cast("string").alias("ym"))
            .agg(F.count(F.lit(1)).alias("trips")))


def q_silver_scan(spark, sf_dir):
    path = write_table(silver_df(spark, sf_dir), scratch_path(spark, "silver"), partition_by=["ym"],
                       rebalance=True)
    return read_table(spark, path).withColumn("ym", F.col("ym").cast("string"))


def q_csv_roundtrip(spark, sf_dir):
    report = marts.hourly_stats(silver_df(spark, sf_dir), digits=DIGITS)
    path = write_report_csv(report, scratch_path(spark, "hourly-csv"))
    return read_csv(spark, path, schema=report.schema)


def q_csv_rejects(spark, sf_dir):
    """Trips as CSV lines, some short, long, with text for a zone or
    with a line break inside quotes; all records with the reason of rejects."""
    e = F.col("event_id")
    note = F.when(e % 47 == 0, F.lit('"two\nlines, ""quoted"""')).otherwise(F.concat(F.lit("trip "), e))
    line = (F.when(e % 37 == 0, F.concat_ws(",", e, "PULocationID"))
            .when(e % 41 == 0, F.concat_ws(",", e, "PULocationID", "DOLocationID", note, F.lit("more")))
            .when(e % 43 == 0, F.concat_ws(",", e, "PULocationID", F.lit("n/a"), note))
            .otherwise(F.concat_ws(",", e, "PULocationID", "DOLocationID", note)))
    path = scratch_path(spark, "csv-lines")
    bronze(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_csv_checked(spark, path, "event_id bigint, pickup_zone int, dropoff_zone int, note string", header=False, multi_line=True)


def q_parquet_roundtrip(spark, sf_dir):
    path = write_table(features_df(spark, sf_dir), scratch_path(spark, "features"))
    return _round_log(read_table(spark, path))


def q_prediction_export(spark, sf_dir):
    p = quality.with_errors(predictions_df(spark, sf_dir).withColumnRenamed("label", "trip_fare"),
                            label="trip_fare")
    out = p.select(*FEATS, "trip_fare", "fare_pred", "abs_error", "event_id")
    path = export_predictions(out, scratch_path(spark, "export"), key="event_id", n=10000)
    return _round_log(read_csv(spark, path, schema=out.schema))


def q_prediction_export_capped(spark, sf_dir):
    """An export smaller than its input."""
    p = predictions_df(spark, sf_dir).select("event_id", "trip_distance", "fare_pred")
    path = export_predictions(p, scratch_path(spark, "export-capped"), key="event_id", n=2000)
    return read_csv(spark, path, schema=p.schema)


def q_bronze_stream(spark, sf_dir):
    """S1 as a file stream (4 files per micro-batch, availableNow)."""
    from tripspark.streaming.ingest import run_ingest

    files = _write_raw_files(spark, sf_dir)
    source = files[0].split("/src_month=")[0]
    path = run_ingest(spark, source, scratch_path(spark, "bronze-stream"),
                      scratch_path(spark, "bronze-stream-ckpt"), files_per_trigger=RAW_FILES_PER_BATCH)
    return read_bronze(spark, path).drop("ingest_batch")


def q_bronze_ingest_incremental(spark, sf_dir):
    """K1: half of the files, the other half, then all of them again with
    another batch size: every row once."""
    files = _write_raw_files(spark, sf_dir)
    path = scratch_path(spark, "bronze-incremental")
    half = len(files) // 2
    for part, size in ((files[:half], 4), (files[half:], 4), (files, 3)):
        ingest_files(spark, part, path, files_per_batch=size)
    return read_bronze(spark, path).drop("ingest_batch")


def q_bronze_batch_then_stream(spark, sf_dir):
    """History by the batch job, then a stream over the same folder: the
    stream adds the files the table does not hold, and overwrites nothing."""
    from tripspark.streaming.ingest import run_ingest

    files = _write_raw_files(spark, sf_dir)
    path = scratch_path(spark, "bronze-mixed")
    ingest_files(spark, files[:len(files) // 2], path)
    run_ingest(spark, files[0].split("/src_month=")[0], path, scratch_path(spark, "bronze-mixed-ckpt"))
    return read_bronze(spark, path).drop("ingest_batch")


def q_bronze_extra_columns(spark, sf_dir):
    """Two undeclared columns: ``tip`` is in some files only, ``rate`` is a
    bigint in one batch and a double in the next."""
    b = bronze(spark, sf_dir)
    raw = scratch_path(spark, "raw-extra")
    even, odd = b.where("event_id % 2 = 0"), b.where("event_id % 2 = 1")
    even.withColumn("rate", F.col("event_id") % 6).write.parquet(f"{raw}/a")
    odd.withColumn("rate", (F.col("event_id") % 6) / 2).withColumn("tip", F.col("event_id") % 9 / 4).write.parquet(f"{raw}/b")
    path = scratch_path(spark, "bronze-extra")
    for part in ("a", "b"):
        ingest_files(spark, list_files(spark, f"{raw}/{part}"), path, files_per_batch=64)
    return read_bronze(spark, path).drop("ingest_batch")


def q_silver_without_source_id(spark, sf_dir):
    """A22 on trips without an id of their own: the ingest's row id picks the
    survivor, which the fare tells apart. The files are in a fixed order, so
    that the same row comes first everywhere."""
    raw = scratch_path(spark, "raw-noid")
    bronze(spark, sf_dir).orderBy("event_id").drop("event_id").write.parquet(raw)
    path = scratch_path(spark, "bronze-noid")
    ingest_files(spark, list_files(spark, raw), path, files_per_batch=64, row_id=ROW_ID)
    return silver(read_bronze(spark, path)).drop(ROW_ID, "ingest_batch")


def q_silver_rerun(spark, sf_dir):
    """K2: curate, then again from a Bronze without its last month: Silver
    holds the months of the second Bronze."""
    from tripspark.plans import jobs

    b = bronze(spark, sf_dir)
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    last = b.agg(F.max(month)).first()[0]
    silver_path, gold = scratch_path(spark, "silver-rerun"), scratch_path(spark, "gold-rerun")
    for frame in (b, b.where(month < F.lit(last))):
        path = write_table(frame, scratch_path(spark, "bronze-rerun"))
        jobs.curate(spark, path, silver_path, gold)
    return read_table(spark, silver_path).withColumn("ym", F.col("ym").cast("string"))


def q_silver_stream_dedupe(spark, sf_dir):
    """A22 as a stream: per month the trips arrive first, their copies in later
    files; the stream takes up each arrival before the next one. Files hold up
    to STREAM_FILE_ROWS rows and a micro-batch many files, so the number of
    micro-batches, each with its own commit of all state, hardly grows."""
    from tripspark.sources.fixtures import DUPLICATE_ID_OFFSET
    from tripspark.streaming.silver import run_silver

    b = bronze(spark, sf_dir)
    rows = (b.withColumn("m", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
            .withColumn("again", F.col("event_id") >= DUPLICATE_ID_OFFSET))
    staged = scratch_path(spark, "stream-arrivals")  # the source is scanned once, not once for each arrival
    rows.write.partitionBy("m", "again").parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    arrivals = sorted(rows.groupBy("m", "again").count().collect(), key=lambda r: (r["m"] is None, r["m"] or "", bool(r["again"])))
    raw, out, ckpt = (scratch_path(spark, f"{name}-stream-silver") for name in ("raw", "out", "ckpt"))
    for i, r in enumerate(arrivals):
        part = rows.where(F.col("m").eqNullSafe(F.lit(r["m"])) & F.col("again").eqNullSafe(F.lit(r["again"]))).select(*b.columns)
        part.repartition(-(-r["count"] // STREAM_FILE_ROWS)).write.parquet(f"{raw}/{i}")
        run_silver(spark, raw, out, ckpt, schema=b.schema)
    return read_table(spark, out).withColumn("ym", F.col("ym").cast("string"))


def q_curate_rejects(spark, sf_dir):
    """what the curate job counts while it writes Silver."""
    from tripspark.plans import jobs

    path = write_table(bronze(spark, sf_dir), scratch_path(spark, "bronze-rejects"))
    out = jobs.curate(spark, path, scratch_path(spark, "silver-rejects"), scratch_path(spark, "gold-rejects"))
    return read_table(spark, out["rejects"]).select("rule", "rows")


def q_stream_scores(spark, sf_dir):
    """M12 in micro-batches: a saved model scores a feature stream."""
    from tripspark.streaming.scoring import run_scoring

    in_path = write_table(features_df(spark, sf_dir), scratch_path(spark, "stream-in"))
    train, _ = sampling.hash_split(read_table(spark, in_path))
    model_path = ml.save(ml.fit_linear(train), scratch_path(spark, "linreg-model"))
    schema = read_table(spark, in_path).schema
    out = run_scoring(spark, in_path, schema, model_path, scratch_path(spark, "stream-out"),
                      scratch_path(spark, "stream-ckpt"))
    return _round_log(read_table(spark, out)).withColumn("fare_pred", F.round("fare_pred", 4))


# ------------------------------------------------------------------ silver/marts
def q_silver_typed(spark, sf_dir):
    return typed(harmonize_names(bronze(spark, sf_dir)))


def q_silver(spark, sf_dir):
    return silver_df(spark, sf_dir)


def q_hourly_stats(spark, sf_dir):
    return marts.hourly_stats(silver_df(spark, sf_dir), digits=DIGITS)


def q_top_pu_zones(spark, sf_dir):
    return marts.top_pickup_zones(silver_df(spark, sf_dir), 50)


def q_wday_vs_wend(spark, sf_dir):
    return marts.weekday_vs_weekend(silver_df(spark, sf_dir), digits=DIGITS)


def q_marts_incremental(spark, sf_dir):
    """A1-A3, K2: marts brought up to date after each of two ingests; the second
    one brings further files of a month that is there already."""
    from tripspark.plans import jobs

    files = _write_raw_files(spark, sf_dir)
    path, silver_path, gold = (scratch_path(spark, f"{x}-inc") for x in ("bronze", "silver", "gold"))
    cut = len(files) // 2 + 1
    for part in (files[:cut], files[cut:]):
        ingest_files(spark, part, path)
        out = jobs.curate_new(spark, path, silver_path, gold)
    long = None
    for name, key in marts.PARTIAL_KEYS.items():
        df = read_table(spark, out[name])
        avg = [F.round(c, DIGITS).alias(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in ("avg_distance", "avg_total")]
        df = df.select(F.lit(name).alias("mart"), F.col(key).cast("string").alias("key"), "trips", *avg)
        long = df if long is None else long.unionByName(df)
    return long


def q_vendor_counts(spark, sf_dir):
    return marts.vendor_counts(bronze(spark, sf_dir))


def q_filter_audit(spark, sf_dir):
    """Rows in, rows dropped per rule (first failing rule), rows out.

    Two aggregates: one over the typed Bronze rows (Silver rules) and one
    over Silver (its row count, the feature rules and the rows kept)."""
    b = bronze(spark, sf_dir)
    s = silver(b, order=("event_id",), unique_order=True)
    stage1 = rejection_audit(b)
    passed, aggs = None, []
    for name, keep in feature_predicates():
        keep = F.coalesce(keep, F.lit(False))
        fails = ~keep if passed is None else passed & ~keep
        aggs.append(F.count_if(fails).alias(name))
        passed = keep if passed is None else passed & keep
    stage2 = s.agg(F.count(F.lit(1)).alias("silver_rows"), *aggs, F.count_if(passed).alias("in_range"),
                   F.count_if(F.coalesce(usable_feature_row(s), F.lit(False))).alias("feature_rows"))
    wide = stage1.crossJoin(stage2)  # two one-row aggregates side by side
    steps = [("input", F.col("input_rows")),
             ("timestamps_present", F.col("timestamps_present")),
             ("positive_distance", F.col("positive_distance")),
             ("total_present", F.col("total_present")),
             ("positive_minutes", F.col("positive_minutes")),
             ("duplicate_key", F.col("kept_rows") - F.col("silver_rows")),
             ("fare_amount_in_range", F.col("fare_amount_in_range")),
             ("trip_distance_in_range", F.col("trip_distance_in_range")),
             ("trip_minutes_in_range", F.col("trip_minutes_in_range")),
             ("missing_values", F.col("in_range") - F.col("feature_rows")),
             ("output", F.col("feature_rows"))]
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(n).alias("rule"), c.cast("bigint").alias("rows"))
        for i, (n, c) in enumerate(steps)])).alias("r")).select("r.step", "r.rule", "r.rows")


# ------------------------------------------------------------------ features
def q_features(spark, sf_dir):
    return _round_log(features_df(spark, sf_dir))


def q_raw_features(spark, sf_dir):
    return _round_log(raw_features(bronze(spark, sf_dir), as_of=AS_OF))


def q_raw_features_as_of(spark, sf_dir):
    """M10 with missing pickups (every 7th trip's pickup blanked): hour and
    weekend come from ``as_of``, minutes fall back to 12.0 (D7, D9)."""
    b = bronze(spark, sf_dir).withColumn(
        "tpep_pickup_datetime",
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("tpep_pickup_datetime")))
    return _round_log(raw_features(b, as_of=AS_OF))


def q_upload_features_a_no_dropoff(spark, sf_dir):
    """M11 schema A without a dropoff column: the whole column of minutes is
    the 12.0 default (the page's per-column rule)."""
    text = _via_csv(spark, upload_a_frame(bronze(spark, sf_dir)).drop("dropoff_datetime"), "upload-a-nodrop")
    out = upload_features(text, keep=["event_id"])
    return _round_log(out.withColumn("event_id", F.col("event_id").try_cast("bigint")))


def q_score_features_cast(spark, sf_dir):
    path = write_table(features_df(spark, sf_dir), scratch_path(spark, "features-csv"), fmt="csv")
    text = read_csv(spark, path)  # every column as text
    out = cast_features(text).withColumn("label", F.col("label").try_cast("double")) \
        .withColumn("event_id", F.col("event_id").try_cast("bigint"))
    return _round_log(out)


def _via_csv(spark, df: DataFrame, name: str) -> DataFrame:
    path = write_table(df, scratch_path(spark, name), fmt="csv")
    return read_csv(spark, path)


def q_upload_features_a(spark, sf_dir):
    text = _via_csv(spark, upload_a_frame(bronze(spark, sf_dir)), "upload-a")
    out = upload_features(text, keep=["event_id"])
    return _round_log(out.withColumn("event_id", F.col("event_id").try_cast("bigint")))


def q_upload_features_b(spark, sf_dir):
    text = _via_csv(spark, upload_b_frame(features_df(spark, sf_dir)), "upload-b")
    out = upload_features(text, keep=["event_id"])
    return _round_log(out.withColumn("event_id", F.col("event_id").try_cast("bigint")))


# ------------------------------------------------------------------ profiling
def q_null_counts(spark, sf_dir):
    return quality.null_counts(bronze(spark, sf_dir))


def q_feature_profile(spark, sf_dir):
    return quality.feature_profile(features_df(spark, sf_dir), digits=DIGITS)


def q_feature_quantiles(spark, sf_dir):
    return quality.quantiles(features_df(spark, sf_dir), ["label", "trip_distance"], method="exact", **SEARCH)


def q_silver_quantiles(spark, sf_dir):
    return quality.quantiles(silver_df(spark, sf_dir), ["fare_amount", "trip_minutes"], method="exact", **SEARCH)


def q_label_correlations(spark, sf_dir):
    cols = ["trip_distance", "passenger_count", "hour", "is_weekend", "trip_minutes", "log_distance"]
    return quality.correlations(features_df(spark, sf_dir), "label", cols, digits=DIGITS)


def q_silver_correlations(spark, sf_dir):
    return quality.correlations(silver_df(spark, sf_dir), "fare_amount", ["trip_distance", "trip_minutes"], digits=DIGITS)


_TOP_COLS = ["label", "trip_distance", "passenger_count", "hour", "is_weekend", "event_id"]


def q_top_fares(spark, sf_dir):
    return quality.top_rows(features_df(spark, sf_dir), "label", 5, _TOP_COLS, ["event_id"])


def q_top_distances(spark, sf_dir):
    return quality.top_rows(features_df(spark, sf_dir), "trip_distance", 5, _TOP_COLS, ["event_id"])


# ------------------------------------------------------------------ error reports
def q_prediction_errors(spark, sf_dir):
    return _round_log(quality.with_errors(predictions_df(spark, sf_dir)))


def q_regression_metrics(spark, sf_dir):
    return quality.regression_metrics(predictions_df(spark, sf_dir), zero_variance="evaluator", digits=DIGITS)


def q_regression_metrics_formula(spark, sf_dir):
    p = predictions_df(spark, sf_dir).withColumnRenamed("label", "trip_fare")
    return quality.regression_metrics(p, label="trip_fare", zero_variance="nan", digits=DIGITS)


def q_residual_summary(spark, sf_dir):
    return quality.residual_summary(predictions_df(spark, sf_dir), method="exact", digits=DIGITS, **SEARCH)


def q_calibration(spark, sf_dir):
    return quality.calibration(predictions_df(spark, sf_dir), digits=DIGITS)


def q_error_by_hour(spark, sf_dir):
    return quality.error_by(predictions_df(spark, sf_dir), "hour", digits=DIGITS)


def q_error_by_weekend(spark, sf_dir):
    return quality.error_by(predictions_df(spark, sf_dir), "is_weekend", digits=DIGITS)


def q_quantile_buckets(spark, sf_dir):
    b = quality.quantile_buckets(predictions_df(spark, sf_dir), "trip_distance",
                                 relative_error=0.0, **SEARCH)
    return b.select("event_id", "trip_distance", "dist_bucket")


def q_error_by_quantile_bucket(spark, sf_dir):
    return quality.error_by_quantile_bucket(predictions_df(spark, sf_dir),
                                            relative_error=0.0, digits=DIGITS, **SEARCH)


def q_error_by_distance_bin(spark, sf_dir):
    return quality.error_by_distance_bin(predictions_df(spark, sf_dir), digits=DIGITS)


def q_error_by_distance_bin_filled(spark, sf_dir):
    p = predictions_df(spark, sf_dir).withColumnRenamed("label", "trip_fare")
    return quality.error_by_distance_bin_filled(p, actual="trip_fare", digits=DIGITS)


def q_avg_pred_by_distance_bin(spark, sf_dir):
    """A17 without actual fares: average prediction per right-open bin,
    all six bins kept."""
    p = predictions_df(spark, sf_dir).drop("label")
    return quality.error_by_distance_bin_filled(p, actual=None, digits=DIGITS)


def q_avg_pred_by_hour(spark, sf_dir):
    return quality.avg_pred_by_hour(predictions_df(spark, sf_dir), digits=DIGITS)


def q_residual_histogram(spark, sf_dir):
    return quality.histogram(quality.with_errors(predictions_df(spark, sf_dir)), "resid", 60, digits=DIGITS)


def q_histogram_merged(spark, sf_dir):
    """A21 from cells stored per group: the rows of residual_histogram."""
    rows = checkpointed(quality.with_errors(predictions_df(spark, sf_dir)).select("resid", F.col("hour").alias("part")))
    cells = checkpointed(quality.histogram_cells(rows, "resid", ["part"]))
    return quality.histogram_from_cells(cells, rows, "resid", 60, digits=DIGITS)


def q_quantiles_repeated_values(spark, sf_dir):
    """A9 where values repeat: a two-valued column, cent amounts, and ranks
    at the very edge of a run of equal values."""
    f = features_df(spark, sf_dir).select(
        (F.col("event_id") % 2).cast("double").alias("two_valued"),
        F.floor(F.col("label")).cast("double").alias("whole_fare"))
    return quality.quantiles(f, ["two_valued", "whole_fare"], probs=[0.25, 0.5, 0.501, 0.75, 0.99], method="exact", **SEARCH)


def q_quantile_sketch_bounds(spark, sf_dir):
    """Quantiles from sketches stored per month and merged; the
    true rank of each value lies within the stated error."""
    cols = ["label", "trip_distance", "resid"]
    rows = checkpointed(quality.with_errors(predictions_df(spark, sf_dir)).select("event_id", *cols, F.col("hour").alias("part")))
    stored = checkpointed(sketches.sketch(rows, cols, by=["part"]))
    found = sketches.quantiles(stored)
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in cols])).alias("r")).select("r.*")
    ranks = long.join(F.broadcast(found), "column").groupBy("column", "prob", "n").agg(  # a dozen quantiles
        F.count_if(F.col("v") < F.col("value")).alias("below"), F.count_if(F.col("v") <= F.col("value")).alias("upto"))
    error = sketches.rank_error() * F.col("n")
    within = (F.col("below") <= F.col("prob") * F.col("n") + error) & (F.col("upto") >= F.col("prob") * F.col("n") - error)
    return ranks.select("column", "prob", "n", within.alias("within_bound"))


def _with_gaps(spark, sf_dir):
    """Predictions with missing labels (every 5th row) and predictions
    (every 7th)."""
    p = predictions_df(spark, sf_dir)
    blank = lambda c, k: F.when(F.col("event_id") % k != 0, F.col(c)).alias(c)
    return p.select("event_id", blank("label", 5), blank("fare_pred", 7))


def q_regression_metrics_nulls(spark, sf_dir):
    return quality.regression_metrics(_with_gaps(spark, sf_dir), digits=DIGITS)


def q_residual_histogram_nan(spark, sf_dir):
    """A21 with null and NaN residuals in the input."""
    p = quality.with_errors(_with_gaps(spark, sf_dir))
    p = p.withColumn("resid", F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("resid")))
    return quality.histogram(p, "resid", 20, digits=DIGITS)


def q_top_errors(spark, sf_dir):
    p = quality.with_errors(predictions_df(spark, sf_dir).withColumnRenamed("label", "trip_fare"),
                            label="trip_fare")
    cols = ["trip_distance", "trip_minutes", "passenger_count", "hour", "is_weekend",
            "trip_fare", "fare_pred", "abs_error", "event_id"]
    return quality.top_rows(p, "abs_error", 20, cols, ["event_id"])


# ------------------------------------------------------------------ sampling
def q_split_hash(spark, sf_dir):
    return sampling.split_flag(features_df(spark, sf_dir)).select("event_id", "is_train")


def q_sample_hash(spark, sf_dir):
    return _round_log(sampling.hash_sample(predictions_df(spark, sf_dir), 5, seed=42))


def q_sample_bernoulli(spark, sf_dir):
    return sampling.bernoulli_sample(predictions_df(spark, sf_dir), 0.05, seed=42)


def q_scatter_feed(spark, sf_dir):
    p = predictions_df(spark, sf_dir).select("event_id", "trip_distance", "label", "fare_pred")
    return sampling.hash_sample(p, 1, seed=7)


def q_sample_fixed_n(spark, sf_dir):
    return _round_log(sampling.fixed_size_sample(predictions_df(spark, sf_dir), 3000, seed=7))


def q_sample_bottom_k(spark, sf_dir):
    """X4 from a stored state per group, merged: the rows of sample_fixed_n."""
    state = checkpointed(sampling.sample_state(predictions_df(spark, sf_dir), 3000, ["is_weekend"], seed=7))
    return _round_log(sampling.merged_sample(state, 3000))


def q_sample_weighted(spark, sf_dir):
    """X4 with the trip distance as weight, from a stored state per group."""
    rows = predictions_df(spark, sf_dir).select("event_id", "trip_distance", "is_weekend")
    state = checkpointed(sampling.sample_state(rows, 1000, ["is_weekend"], seed=7, weight="trip_distance"))
    return sampling.merged_sample(state, 1000)


# ------------------------------------------------------------------ models
def q_scaled_features(spark, sf_dir):
    feats = _feature_table(spark, sf_dir)
    train, _ = sampling.hash_split(feats)
    model = ml.fit_scaler_only(train)
    out = ml.scaled_columns(model, feats)
    return out.select("event_id", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in FEATS])


def q_lr_predictions(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = ml.fit_linear(train)
    return ml.predict(model, test, keep=["event_id", "label"]) \
        .select("event_id", "label", F.round("prediction", 4).alias("prediction"))


def _moment_rows(spark, sf_dir, train: bool) -> DataFrame:
    """Moments of the features, stored by month: all months but the last first,
    then the last one added."""
    from tripspark.plans import jobs

    feats = build_features(silver_df(spark, sf_dir), keep=("event_id", "ym"))
    if train:
        feats = sampling.hash_split(feats)[0]
    path = write_table(feats, scratch_path(spark, "features-by-month"), partition_by=["ym"])
    months = sorted(r.ym for r in read_table(spark, path).select(F.col("ym").cast("string").alias("ym")).distinct().collect())
    out = scratch_path(spark, "moments")
    for part in (months[:-1], months[-1:]):
        if part:
            jobs.update_moments(spark, path, out, months=part)
    return read_table(spark, out)


def q_lr_from_moments(spark, sf_dir):
    """M3, M8: the linear model from moment rows per month."""
    coef = moments.linear_coefficients(spark, _moment_rows(spark, sf_dir, train=True))
    return coef.select("feature", F.round("coefficient", 4).alias("coefficient"), F.round("coefficient_unscaled", 4).alias("coefficient_unscaled"))


def q_correlations_from_moments(spark, sf_dir):
    """A10 from moment rows per month."""
    cols = ["trip_distance", "passenger_count", "hour", "is_weekend", "trip_minutes", "log_distance"]
    return moments.correlations(spark, _moment_rows(spark, sf_dir, train=False), "label", cols).withColumn("corr", F.round("corr", DIGITS))


def q_score_batch(spark, sf_dir):
    in_path = write_table(features_df(spark, sf_dir), scratch_path(spark, "score-in"))
    train, _ = sampling.hash_split(read_table(spark, in_path))
    model_path = ml.save(ml.fit_linear(train), scratch_path(spark, "linreg-model"))
    out_path = score_batch(spark, in_path, scratch_path(spark, "score-out"), model_path,
                           mode="features", fmt="parquet")
    return _round_log(read_table(spark, out_path)).withColumn("fare_pred", F.round("fare_pred", 4))


def _saved_model(spark, sf_dir) -> str:
    return ml.save(_linear_model(spark, sf_dir), scratch_path(spark, "linreg-model"))


def q_score_rejects(spark, sf_dir):
    """Rows in, rejected per missing feature, scored; features are
    blanked in every 11th and 13th row."""
    feats = features_df(spark, sf_dir)
    blank = lambda c, k, v: F.when(F.col("event_id") % k == 0, F.lit(v)).otherwise(F.col(c)).alias(c)
    gaps = {"trip_distance": (11, float("nan")), "hour": (13, None)}
    path = write_table(feats.select(*[blank(c, *gaps[c]) if c in gaps else c for c in feats.columns]), scratch_path(spark, "score-gaps"))
    found = scratch_path(spark, "score-rejects")
    score_batch(spark, path, scratch_path(spark, "score-kept"), _saved_model(spark, sf_dir), invalid="skip", rejects_path=found)
    return read_table(spark, found)


def q_score_batch_raw(spark, sf_dir):
    """M12 on raw trips: missing pickups take ``as_of``, missing dropoffs the
    default duration, and rows without a passenger count no prediction."""
    b = bronze(spark, sf_dir).withColumn("tpep_pickup_datetime", F.when(F.col("event_id") % 7 != 0, F.col("tpep_pickup_datetime")))
    path = write_table(b, scratch_path(spark, "score-raw"))
    out = score_batch(spark, path, scratch_path(spark, "score-raw-out"), _saved_model(spark, sf_dir), mode="raw", as_of=AS_OF, invalid="keep")
    return _round_log(read_table(spark, out)).select("event_id", *FEATS, F.round("fare_pred", 4).alias("fare_pred"))


def _scored_upload(spark, sf_dir, frame: DataFrame, name: str) -> DataFrame:
    from tripspark.plans import jobs

    path = write_table(frame, scratch_path(spark, name), fmt="csv")
    out = jobs.score_upload(spark, path, _saved_model(spark, sf_dir), scratch_path(spark, f"{name}-out"), keep=["event_id"])
    rows = _round_log(read_table(spark, out["predictions"]))
    return rows.select(F.col("event_id").try_cast("bigint").alias("event_id"), *FEATS, "trip_fare", F.round("fare_pred", 4).alias("fare_pred"))


def q_upload_scored_a(spark, sf_dir):
    """An upload of schema A, scored; rows without a dropoff have no
    duration and no prediction."""
    return _scored_upload(spark, sf_dir, upload_a_frame(bronze(spark, sf_dir)), "upload-scored-a")


def q_upload_scored_b(spark, sf_dir):
    return _scored_upload(spark, sf_dir, upload_b_frame(features_df(spark, sf_dir)), "upload-scored-b")


def q_lr_coefficients(spark, sf_dir):
    coef = ml.coefficients(spark, _linear_model(spark, sf_dir))
    return coef.select("feature", F.round("coefficient", 4).alias("coefficient"),
                       F.round("coefficient_unscaled", 4).alias("coefficient_unscaled"))


def q_dt_predictions(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = ml.fit_tree(train)
    return ml.predict(model, test, keep=["event_id", "label"])


def q_lr_metrics(spark, sf_dir):
    """M7 for the linear model alone: RMSE, MAE, R² on train and test."""
    train, test = _split(spark, sf_dir)
    return ml.compare_models({"LinearRegression": ml.fit_linear(train)}, {"train": train, "test": test}, digits=DIGITS)


def q_model_metrics(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    models = {"DecisionTreeRegressor": ml.fit_tree(train), "LinearRegression": ml.fit_linear(train)}
    return ml.compare_models(models, {"train": train, "test": test}, digits=DIGITS)


def q_dt_invariants(spark, sf_dir):
    """M4, checked by what a regression tree must fulfil: its leaves hold at
    least 50 training rows each and predict their mean."""
    train, _ = _split(spark, sf_dir)
    model = ml.fit_tree(train)
    model.stages[-1].setLeafCol("leaf")
    leaves = model.transform(train).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean"), F.min("prediction").alias("low"), F.max("prediction").alias("high"))
    return leaves.agg(F.sum("n").alias("train_rows"), (F.min("n") >= 50).alias("leaves_large"),
                      (F.max(F.abs(F.col("mean") - F.col("low"))) < 1e-6).alias("leaves_predict_mean"),
                      (F.max(F.col("high") - F.col("low")) == 0).alias("one_value_per_leaf"))


def q_dt_node_predictions(spark, sf_dir):
    """M4 as a node table: its compiled predictions against the model's."""
    train, test = _split(spark, sf_dir)
    model = ml.fit_tree(train)
    _, value = ml.tree_columns(ml.tree_nodes(model))
    out = ml.predict(model, test).withColumn("by_nodes", value)
    return out.select("event_id", "label", (F.col("by_nodes") == F.col("prediction")).alias("same_prediction"))


def q_dt_root_split(spark, sf_dir):
    """M4: gains of all candidates for the first split, and whether the fitted
    root, with thresholds of its own, comes within 2 % of each."""
    train, _ = _split(spark, sf_dir)
    train = checkpointed(train)
    root = ml.tree_nodes(ml.fit_tree(train)).where("node = 1").first()
    gains = ml.split_gains(train)
    return gains.select("feature", "threshold", "rows_left", F.round("gain", 6).alias("gain"),
                        (F.col("gain") * 0.98 <= root.gain).alias("root_not_worse"))


def q_model_metrics_invariants(spark, sf_dir):
    """M7: twelve values, RMSE at least MAE for each model and split."""
    m = q_model_metrics(spark, sf_dir)
    wide = m.groupBy("model", "split").pivot("metric", ["rmse", "mae", "r2"]).agg(F.first("value"))
    return wide.agg(F.count(F.lit(1)).alias("model_splits"), F.min(F.col("rmse") >= F.col("mae")).alias("rmse_not_below_mae"),
                    F.min(F.col("r2") <= 1).alias("r2_at_most_one"))


def q_sample_bernoulli_invariants(spark, sf_dir):
    """A subset without repeats, of about the wanted share (within six
    standard deviations)."""
    p = predictions_df(spark, sf_dir).select("event_id")
    part = sampling.bernoulli_sample(p, 0.05, seed=42)
    n = p.count()
    outside = part.join(p, "event_id", "left_anti").count()
    spread = 6 * (0.05 * 0.95 * n) ** 0.5
    return part.agg((F.count(F.lit(1)) == F.count_distinct("event_id")).alias("no_repeats"), F.lit(outside == 0).alias("subset"),
                    (F.abs(F.count(F.lit(1)) - F.lit(0.05 * n)) <= F.lit(spread)).alias("share_fits"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# Keys checked by row count only (no SQL equal: model fits and Bernoulli
# sampling).
ROWS_ONLY = {"dt_predictions", "model_metrics", "sample_bernoulli"}

__all__ = ["QUERIES", "ROWS_ONLY", "bronze", "silver_df", "features_df", "predictions_df"]
