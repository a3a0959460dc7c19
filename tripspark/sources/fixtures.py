"""Trip-shaped inputs derived by Spark from the driver tables.

The driver ships an ``events`` table, not trip files; this module maps it
to Bronze trips (rules in FIXTURES.md section 2) and shapes upload-style
frames from the result. Everything stays a lazy, map-only projection of the
scan, so it scales with ``events`` and never leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspark.functions import hash_percent

# ---------------------------------------------------------------- fixed values
# Row-selection moduli of the events -> trips mapping (FIXTURES.md section 2).
ZERO_SECONDS_MOD = 89
NULL_DROPOFF_MOD = 97
NULL_PASSENGERS_MOD = 53
ZERO_DISTANCE_MOD = 83
OUTLIER_FARE_MOD = 71
NULL_TOTAL_MOD = 61
DUPLICATE_MOD = 50
DUPLICATE_ID_OFFSET = 1_000_000_000
MONTH_SHIFT_DAYS = 31
ZONES = 265
# -----------------------------------------------------------------------------


# Declared schemas of the driver tables used here: a declared schema skips
# the footer-reading job that schema inference starts on every read.
DRIVER_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze trips (+ ``event_id`` row key) from the events table.

    The conflicting duplicates are produced by ``explode`` of a one- or
    two-element sequence, so ``events`` is scanned once (no self-union).
    Time shifts are whole days or seconds, added as microseconds (the same
    instant as adding a day-time interval, without decimal arithmetic).
    """
    e = F.col("event_id")
    v = F.floor(F.col("value") * 100 + 0.5).cast("bigint")
    base = events.select(
        e.alias("event_id"),
        F.col("user_id"),
        v.alias("v"),
        F.when(e % ZERO_SECONDS_MOD == 0, F.lit(0).cast("bigint"))
         .otherwise(60 + F.floor(v * 12 / 100) + (e % 7) * 60).alias("secs"),
        (F.unix_micros(F.col("ts").cast("timestamp"))
         + MONTH_SHIFT_DAYS * (e % 3) * 86_400_000_000).alias("pickup_us"),
        F.explode(F.sequence(F.lit(0), F.when(e % DUPLICATE_MOD == 0, 1).otherwise(0))).alias("copy"),
    )
    e = F.col("event_id")
    v = F.col("v")
    secs = F.col("secs")
    pickup = F.timestamp_micros(F.col("pickup_us"))
    fare = (250 + F.floor(v / 4) + F.floor(secs * 5 / 6) + (e % 11 - 5) * 10) / 100
    return base.select(
        (e % 2 + 1).alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        F.when(e % NULL_DROPOFF_MOD == 0, F.lit(None).cast("timestamp"))
         .otherwise(F.timestamp_micros(F.col("pickup_us") + secs * 1_000_000)).alias("tpep_dropoff_datetime"),
        F.when(e % NULL_PASSENGERS_MOD == 0, F.lit(None).cast("double"))
         .otherwise((F.col("user_id") % 6 + 1).cast("double")).alias("passenger_count"),
        F.when(e % ZERO_DISTANCE_MOD == 0, F.lit(0.0)).otherwise(v / 1000).alias("trip_distance"),
        (F.col("user_id") % ZONES + 1).alias("PULocationID"),
        (e % ZONES + 1).alias("DOLocationID"),
        (F.when(e % OUTLIER_FARE_MOD == 0, F.lit(250.0)).otherwise(fare) + F.col("copy")).alias("fare_amount"),
        F.when(e % NULL_TOTAL_MOD == 0, F.lit(None).cast("double"))
         .otherwise((350 + F.floor(v * 3 / 10) + secs) / 100).alias("total_amount"),
        (e + F.col("copy") * DUPLICATE_ID_OFFSET).alias("event_id"),
    )


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_events(read_driver_table(spark, sf_dir, "events"))


def upload_a_frame(bronze: DataFrame) -> DataFrame:
    """Upload schema A as text, the way a CSV arrives: mixed-case names,
    no passenger_count, pickup/dropoff as strings and an actual fare."""
    return bronze.select(
        F.col("trip_distance").cast("string").alias("Trip_Distance"),
        F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("PICKUP_DATETIME"),
        F.date_format("tpep_dropoff_datetime", "yyyy-MM-dd HH:mm:ss").alias("dropoff_datetime"),
        F.col("fare_amount").cast("string").alias("trip_fare"),
        F.col("event_id").cast("string").alias("event_id"),
    )


def upload_b_frame(features: DataFrame) -> DataFrame:
    """Upload schema B as text: the five stored features and the fare."""
    return features.select(
        *[F.col(c).cast("string").alias(c) for c in
          ["trip_distance", "trip_minutes", "passenger_count", "hour", "is_weekend"]],
        F.col("label").cast("string").alias("trip_fare"),
        F.col("event_id").cast("string").alias("event_id"),
    )


def with_fixed_prediction(features: DataFrame) -> DataFrame:
    """Predictions from a fixed formula, for error reports whose oracle
    should not depend on a model fit."""
    return features.withColumn(
        "fare_pred", 2.5 + 2.5 * F.col("trip_distance") + 0.5 * F.col("trip_minutes"))


__all__ = ["bronze_from_events", "bronze_trips", "read_driver_table", "upload_a_frame",
           "upload_b_frame", "with_fixed_prediction", "hash_percent"]
