"""Declared layer schemas and fixed values.

The values under "fixed values" must stay exactly as written for results to
agree with the behaviour this library reproduces.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Model feature order (the assembler and every saved model depend on it).
FEATS = ["trip_distance", "log_distance", "trip_minutes", "passenger_count", "hour", "is_weekend"]
DOUBLE_FEATS = ["trip_distance", "log_distance", "trip_minutes"]
INT_FEATS = ["passenger_count", "hour", "is_weekend"]

# Silver de-duplication key.
SILVER_KEY = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
              "PULocationID", "DOLocationID", "passenger_count"]

# Weekend encodings: short day names, and dayofweek numbers (1 = Sunday).
WEEKEND_DAY_NAMES = ["Sat", "Sun"]
WEEKEND_DAY_NUMBERS = [1, 7]

# Feature-table bounds, all exclusive: (column, low, high).
FEATURE_BOUNDS = [("fare_amount", 1.0, 200.0), ("trip_distance", 0.1, 50.0), ("trip_minutes", 1.0, 180.0)]

# Duration used when no duration can be derived.
DEFAULT_TRIP_MINUTES = 12.0
# Passenger count used when the column is absent.
DEFAULT_PASSENGER_COUNT = 1

# Fixed distance bins (miles): labels and lower edges; the last bin is open.
DIST_BIN_LABELS = ["0–1", "1–3", "3–5", "5–10", "10–20", "20+"]
DIST_BIN_EDGES = [0.0, 1.0, 3.0, 5.0, 10.0, 20.0]

# Quantile probabilities of the quality reports.
REPORT_PROBS = [0.5, 0.9, 0.95, 0.99]

# Candidate source names, in order of preference.
PICKUP_CANDIDATES = ["tpep_pickup_datetime", "pickup_datetime", "pickup_ts"]
DROPOFF_CANDIDATES = ["tpep_dropoff_datetime", "dropoff_datetime", "dropoff_ts"]
# Source column aliases harmonised at ingest: alias -> canonical name.
BRONZE_ALIASES = {"vendor_id": "VendorID"}

# Decision-tree settings and split seed of the training job.
TREE_MAX_DEPTH = 12
TREE_MIN_INSTANCES = 50
SEED = 42
TRAIN_PERCENT = 80
# -----------------------------------------------------------------------------

# Row id that the Bronze ingest assigns (file number and row number), carried
# through the layers.
ROW_ID = "row_id"

BRONZE_SCHEMA = T.StructType([
    T.StructField("VendorID", T.LongType()),
    T.StructField("tpep_pickup_datetime", T.TimestampType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("PULocationID", T.LongType()),
    T.StructField("DOLocationID", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])

# Silver: Bronze with casts + derived columns; `ym` is the partition column.
SILVER_TYPES = {
    "VendorID": "bigint",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "passenger_count": "int",
    "trip_distance": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
    "fare_amount": "double",
    "total_amount": "double",
}
SILVER_DERIVED = ["trip_minutes", "hour", "dow", "ym"]

FEATURE_COLUMNS = FEATS + ["label"]
