"""End-to-end jobs: operators composed with sinks.

Each job reads its input table, writes its outputs to new or overwritten
folders and returns their paths. Lineage is cut at every layer by the
written table (the next job reads files, not a recomputed plan), so a lost
executor re-runs at most one layer's tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Observation, SparkSession, functions as F

from tripspark.operators import marts, ml, moments, quality, rejects, sampling
from tripspark.operators.features import build_features, upload_features
from tripspark.operators.scoring import counted_score
from tripspark.operators.silver import clean, derive, harmonize_names, silver, typed
from tripspark.schemas import FEATS, FEATURE_COLUMNS, ROW_ID, SEED
from tripspark.session import restore, tune_for
from tripspark.sources.readers import path_exists, read_csv, read_table
from tripspark.sources.sinks import capped, ingest_folder, read_bronze, write_report_csv, write_table


def ingest(spark: SparkSession, pattern: str, bronze_path: str, files_per_batch: int = 4) -> str:
    """Monthly files -> Bronze, in batches (see also the streaming form).
    Files the table already holds are skipped; every row gets a row id."""
    ingest_folder(spark, pattern, bronze_path, files_per_batch, row_id=ROW_ID)
    return bronze_path


def curate(spark: SparkSession, bronze_path: str, silver_path: str, gold_dir: str,
           top_zones: int = 50, tune: bool = False, months: Sequence[str] | None = None) -> dict[str, str]:
    """Bronze -> Silver (partitioned by month) -> marts.

    Silver is replaced as a whole, so it never holds a month that Bronze no
    longer has. ``months`` rewrites these months alone and leaves the others.
    Marts are computed from the stored Silver, so they agree with it. What the
    rules and the key took away is counted by the writing pass itself, over all
    of Bronze, and stored as ``rejects`` (step, rule, rows).
    ``tune`` sizes the shuffle settings from the Bronze size first and puts
    the old ones back afterwards.
    """
    before = tune_for(spark, bronze_path) if tune else {}
    try:
        cleaned, kept = Observation(), Observation()
        s = silver(read_bronze(spark, bronze_path), watch=cleaned).observe(kept, F.count(F.lit(1)).alias("rows"))
        if months:
            s = s.where(F.col("ym").isin(list(months)))
        write_table(s, silver_path, partition_by=["ym"], dynamic_overwrite=bool(months), rebalance=True)
        stored = read_table(spark, silver_path, merge_schema=True)
        counts = dict(cleaned.get)
        counts = {"input": counts.pop("input_rows"), **counts, "output": kept.get["rows"]}
        counts["duplicate_key"] = counts.pop("kept_rows") - counts["output"]
        counts["output"] = counts.pop("output")  # last
        out = {"silver": silver_path, "rejects": write_table(rejects.table(spark, counts), f"{gold_dir}/rejects")}
        for name, df in (("hourly_stats", marts.hourly_stats(stored)),
                         ("top_pu_zones", marts.top_pickup_zones(stored, top_zones)),
                         ("wday_vs_wend", marts.weekday_vs_weekend(stored))):
            out[name] = write_table(df, f"{gold_dir}/{name}")
        return out
    finally:
        restore(spark, before)


def curate_new(spark: SparkSession, bronze_path: str, silver_path: str, gold_dir: str, top_zones: int = 50) -> dict[str, str]:
    """Bring Silver and the marts up to date after an ingest.

    The batches behind the last one handled say which months they touch; these
    months of Silver, and their rows of the partial marts, are made anew from
    all of their Bronze rows and replaced (dynamic partition overwrite). Other
    months are neither read from Silver nor written. The marts are the sums of
    the partial rows. The handled batch is recorded last, so that a run that
    died is done over.
    """
    progress = f"{gold_dir}/progress"
    since = read_table(spark, progress).agg(F.max("batch")).first()[0] if path_exists(spark, progress) else -1
    bronze = read_bronze(spark, bronze_path)
    pickup = F.col("tpep_pickup_datetime")
    touched = (derive(clean(typed(harmonize_names(bronze.where(F.col("ingest_batch") > since)))))
               .groupBy("ym").agg(F.min(F.trunc(pickup, "month")).alias("first")).collect())  # a row per month
    last = bronze.agg(F.max("ingest_batch")).first()[0]
    out = {"silver": silver_path, "progress": progress}
    if touched:
        months = [r["ym"] for r in touched]
        inside = None  # plain bounds on the stored column, which reach the scan
        for r in touched:
            start = F.lit(r["first"]).cast("timestamp")
            here = (pickup >= start) & (pickup < F.add_months(F.lit(r["first"]), 1).cast("timestamp"))
            inside = here if inside is None else inside | here
        write_table(silver(bronze.where(inside)).drop("ingest_batch"), silver_path, partition_by=["ym"], dynamic_overwrite=True, rebalance=True)
        stored = read_table(spark, silver_path, months=months, merge_schema=True)
        for name in marts.PARTIAL_KEYS:
            write_table(marts.partial_mart(stored, name), f"{gold_dir}/partial/{name}", partition_by=["ym"], dynamic_overwrite=True)
    for name in marts.PARTIAL_KEYS:
        if path_exists(spark, f"{gold_dir}/partial/{name}"):
            out[name] = write_table(marts.mart_from_partials(read_table(spark, f"{gold_dir}/partial/{name}"), name, top_zones), f"{gold_dir}/{name}")
    write_table(spark.createDataFrame([(last,)], "batch bigint"), progress)
    return out


def update_moments(spark: SparkSession, features_path: str, moments_path: str, months: Sequence[str] | None = None) -> str:
    """Moment rows of a feature table stored by month (``ym``); with ``months``
    only these months are read and only their rows are replaced."""
    rows = moments.moments(read_table(spark, features_path, months=months), FEATURE_COLUMNS)
    return write_table(rows, moments_path, partition_by=["ym"], dynamic_overwrite=bool(months))


def features(spark: SparkSession, silver_path: str, out_path: str,
             months: Sequence[str] | None = None) -> str:
    """Silver (optionally some months: partition pruning) -> feature table."""
    return write_table(build_features(read_table(spark, silver_path, months=months, merge_schema=True)), out_path)


def train(spark: SparkSession, features_path: str, artifacts_dir: str, split: str = "hash") -> dict[str, str]:
    """Fit the linear pipeline and the tree, save both, write the metrics
    table (model, split, metric, value) as JSON."""
    df = read_table(spark, features_path)
    if split == "hash":
        tr, te = sampling.hash_split(df)
    else:
        tr, te = sampling.random_split(df, seed=SEED)
    tr = tr.persist(StorageLevel.MEMORY_AND_DISK)
    te = te.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = {"LinearRegression": ml.fit_linear(tr), "DecisionTreeRegressor": ml.fit_tree(tr)}
        paths = {name: ml.save(m, f"{artifacts_dir}/models/{name}") for name, m in models.items()}
        metrics = ml.compare_models(models, {"train": tr, "test": te})
        paths["metrics"] = f"{artifacts_dir}/metrics"
        metrics.coalesce(1).write.mode("overwrite").json(paths["metrics"])  # 12 rows
        return paths
    finally:
        tr.unpersist()
        te.unpersist()


TOP_ERROR_COLUMNS = [ROW_ID, "event_id", "trip_distance", "trip_minutes", "passenger_count", "hour", "is_weekend",
                     "label", "fare_pred"]


def prediction_report(spark: SparkSession, predictions_path: str, out_dir: str,
                      sample_fraction: float | None = None, seed: int = SEED, scatter_percent: float = 1) -> dict[str, str]:
    """Error slices of a predictions table, each a small single-file CSV,
    and the chart feed: a sample of ``scatter_percent`` of the rows.

    ``sample_fraction`` keeps the option to report on a sample; by default
    every row is used. The predictions are persisted for the several
    reports and released afterwards.
    """
    pred = read_table(spark, predictions_path)
    if sample_fraction is not None:
        pred = sampling.bernoulli_sample(pred, sample_fraction, seed)
    pred = pred.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        reports = {
            "overall": (quality.regression_metrics(pred), None),
            "residuals": (quality.residual_summary(pred), None),
            "calibration": (quality.calibration(pred), None),
            "by_hour": (quality.error_by(pred, "hour"), ["hour"]),
            "by_weekend": (quality.error_by(pred, "is_weekend"), ["is_weekend"]),
            "by_distance": (quality.error_by_quantile_bucket(pred), ["dist_bucket"]),
            "by_distance_bin": (quality.error_by_distance_bin(pred), ["bin_order"]),
            "residual_histogram": (quality.histogram(quality.with_errors(pred), "resid", 60), ["bin"]),
            "scatter": (sampling.hash_sample(pred, scatter_percent, seed=seed)
                        .select("trip_distance", "label", "fare_pred"), None),
            "avg_pred_by_hour": (quality.avg_pred_by_hour(pred), ["hour"]),
            "by_distance_bin_filled": (quality.error_by_distance_bin_filled(pred, actual="label"),
                                       ["bin_order"]),
            "top_errors": (quality.top_rows(
                quality.with_errors(pred), "abs_error", 20,
                [c for c in TOP_ERROR_COLUMNS if c in pred.columns] + ["abs_error"],
                [c for c in (ROW_ID, "event_id", "trip_distance", "trip_minutes") if c in pred.columns]), None),
        }
        return {name: write_report_csv(df, f"{out_dir}/{name}", order_by=order)
                for name, (df, order) in reports.items()}
    finally:
        pred.unpersist()


def feature_qa(spark: SparkSession, features_path: str, out_dir: str, silver_path: str | None = None) -> dict[str, str]:
    """Quality report of a feature table (and of Silver, if given): nulls,
    profile, quantiles, correlations and the extreme rows."""
    feats = read_table(spark, features_path)
    keys = [c for c in (ROW_ID, "event_id") if c in feats.columns]
    show = [*FEATURE_COLUMNS, *keys]
    reports = {
        "null_counts": quality.null_counts(feats),
        "profile": quality.feature_profile(feats),
        "quantiles": quality.quantiles(feats, ["label", "trip_distance"]),
        "correlations": quality.correlations(feats, "label", [c for c in FEATURE_COLUMNS if c != "label"]),
        "top_fares": quality.top_rows(feats, "label", 5, show, keys),
        "top_distances": quality.top_rows(feats, "trip_distance", 5, show, keys),
    }
    if silver_path is not None:
        trips = read_table(spark, silver_path, merge_schema=True)
        reports["silver_quantiles"] = quality.quantiles(trips, ["fare_amount", "trip_minutes"])
        reports["silver_correlations"] = quality.correlations(trips, "fare_amount", ["trip_distance", "trip_minutes"])
    return {name: write_report_csv(df, f"{out_dir}/{name}") for name, df in reports.items()}


def score_upload(spark: SparkSession, upload_path: str, model_path: str, out_dir: str, keep: Sequence[str] = (),
                 export_rows: int = 10000, key: str | None = None) -> dict[str, str]:
    """An uploaded CSV -> features -> saved model -> predictions, a capped
    export and the page's reports. With a ``trip_fare`` column the reports
    hold errors against it, without one average predictions only.

    Rows that miss a feature stay in the predictions, with none, and are
    counted by reason in ``rejects``. Reports are over all rows with a
    prediction; the cap is the export's alone. ``key`` orders the export
    (default: its first column in ``keep``, else a hash of the row).
    """
    rows = upload_features(read_csv(spark, upload_path), keep=keep)
    out = {"predictions": f"{out_dir}/predictions", "rejects": f"{out_dir}/rejects"}
    scored, watch = counted_score(ml.load(model_path), rows, invalid="keep")
    has_fare = "trip_fare" in scored.columns
    if has_fare:
        scored = scored.withColumn("abs_error", F.abs(F.col("trip_fare") - F.col("fare_pred")))
    write_table(scored, out["predictions"])
    write_table(rejects.table(spark, watch.get), out["rejects"])
    stored = read_table(spark, out["predictions"])
    key = key or (keep[0] if keep else None)
    by = F.col(key).try_cast("double") if key else F.shiftright(F.xxhash64(*stored.columns), 11).cast("double")
    out["export"] = write_report_csv(capped(stored.withColumn("_key", by), "_key", export_rows).drop("_key"), f"{out_dir}/export")
    stored = stored.where("fare_pred IS NOT NULL")
    reports = {"avg_pred_by_hour": quality.avg_pred_by_hour(stored),
               "by_distance_bin": quality.error_by_distance_bin_filled(stored, actual="trip_fare" if has_fare else None)}
    if has_fare:
        reports["metrics"] = quality.regression_metrics(stored, label="trip_fare")
        reports["top_errors"] = quality.top_rows(stored.where("abs_error IS NOT NULL"), "abs_error", 20, stored.columns, list(FEATS))
    out.update({name: write_report_csv(df, f"{out_dir}/{name}") for name, df in reports.items()})
    return out


def smoke(spark: SparkSession, path: str, n: int = 5) -> int:
    """S7 + K4: the session starts and a table round-trips."""
    write_table(spark.range(n), path)
    return read_table(spark, path).agg(F.count(F.lit(1))).first()[0]
