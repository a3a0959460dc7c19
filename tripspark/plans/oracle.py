"""DuckDB oracle SQL for the registered queries.

Each query is written independently of the Spark code, from the rules in
FIXTURES.md and the report definitions; shared CTEs (bronze -> typed ->
silver -> features -> predictions) are composed per query.
Engine notes: DuckDB ``hour()`` is BIGINT and ``dayofweek`` counts Sunday
as 0, Spark's ``dayofweek`` counts it as 1; ``x / y`` on integers is double
division in both; DuckDB has no ``log1p`` (``ln(1 + x)`` is used and the
result rounded to 10 decimals on both sides).
"""

from __future__ import annotations

import re

from tripspark.plans.catalog import AS_OF
from tripspark.schemas import FEATS


_BRONZE = """
bronze_src AS (
  SELECT event_id, user_id,
         CAST(floor(value * 100 + 0.5) AS BIGINT) AS v,
         CAST(ts AS TIMESTAMP) + to_days(CAST(31 * (event_id % 3) AS INTEGER)) AS pickup
  FROM events),
bronze_secs AS (
  SELECT *, CASE WHEN event_id % 89 = 0 THEN CAST(0 AS BIGINT)
                 ELSE 60 + CAST(floor(v * 12 / 100) AS BIGINT) + (event_id % 7) * 60 END AS secs
  FROM bronze_src),
bronze_once AS (
  SELECT CAST(event_id % 2 + 1 AS BIGINT) AS VendorID,
         pickup AS tpep_pickup_datetime,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE pickup + to_seconds(secs) END AS tpep_dropoff_datetime,
         CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(user_id % 6 + 1 AS DOUBLE) END AS passenger_count,
         CASE WHEN event_id % 83 = 0 THEN CAST(0 AS DOUBLE) ELSE v / 1000 END AS trip_distance,
         CAST(user_id % 265 + 1 AS BIGINT) AS PULocationID,
         CAST(event_id % 265 + 1 AS BIGINT) AS DOLocationID,
         CASE WHEN event_id % 71 = 0 THEN CAST(250 AS DOUBLE)
              ELSE (250 + CAST(floor(v / 4) AS BIGINT) + CAST(floor(secs * 5 / 6) AS BIGINT)
                    + (event_id % 11 - 5) * 10) / 100 END AS fare_amount,
         CASE WHEN event_id % 61 = 0 THEN NULL
              ELSE (350 + CAST(floor(v * 3 / 10) AS BIGINT) + secs) / 100 END AS total_amount,
         event_id
  FROM bronze_secs),
bronze AS (
  SELECT * FROM bronze_once
  UNION ALL
  SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
         PULocationID, DOLocationID, fare_amount + 1, total_amount, event_id + 1000000000
  FROM bronze_once WHERE event_id % 50 = 0)"""

_TYPED = """
typed AS (
  SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
         CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance,
         CAST(PULocationID AS INTEGER) AS PULocationID, CAST(DOLocationID AS INTEGER) AS DOLocationID,
         fare_amount, total_amount, event_id
  FROM bronze)"""


def _secs(col: str) -> str:
    return f"CAST(floor(epoch_us({col}) / 1000000) AS BIGINT)"


_MINUTES = f"({_secs('tpep_dropoff_datetime')} - {_secs('tpep_pickup_datetime')}) / 60"

_SILVER = f"""
cleaned AS (
  SELECT *, {_MINUTES} AS trip_minutes
  FROM typed
  WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND trip_distance > 0 AND total_amount IS NOT NULL),
silver AS (
  SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
         PULocationID, DOLocationID, fare_amount, total_amount, event_id, trip_minutes,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour,
         strftime(tpep_pickup_datetime, '%a') AS dow,
         strftime(tpep_pickup_datetime, '%Y-%m') AS ym
  FROM cleaned
  WHERE trip_minutes > 0
  QUALIFY row_number() OVER (
    PARTITION BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
                 passenger_count
    ORDER BY event_id) = 1)"""

_FEATURES = """
features AS (
  SELECT trip_distance, ln(1 + trip_distance) AS log_distance, trip_minutes, passenger_count, hour,
         CASE WHEN dow IN ('Sat', 'Sun') THEN 1 ELSE 0 END AS is_weekend,
         fare_amount AS label, event_id
  FROM silver
  WHERE fare_amount IS NOT NULL AND fare_amount > 1 AND fare_amount < 200
    AND trip_distance > 0.1 AND trip_distance < 50
    AND trip_minutes > 1 AND trip_minutes < 180
    AND passenger_count IS NOT NULL AND hour IS NOT NULL
    AND NOT isnan(trip_distance) AND NOT isnan(trip_minutes) AND NOT isnan(fare_amount))"""

_PRED = """
pred AS (
  SELECT *, 2.5 + 2.5 * trip_distance + 0.5 * trip_minutes AS fare_pred FROM features)"""

_SPLIT = """
split AS (
  SELECT *, CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 6)) AS BIGINT) % 100 < 80 AS is_train
  FROM features)"""

_CHAIN = {
    "bronze": [_BRONZE],
    "typed": [_BRONZE, _TYPED],
    "silver": [_BRONZE, _TYPED, _SILVER],
    "features": [_BRONZE, _TYPED, _SILVER, _FEATURES],
    "pred": [_BRONZE, _TYPED, _SILVER, _FEATURES, _PRED],
    "split": [_BRONZE, _TYPED, _SILVER, _FEATURES, _SPLIT],
}


def with_(level: str, *more: str) -> str:
    """``WITH`` clause holding the chain up to ``level`` plus extra CTEs."""
    return "WITH " + ",".join(_CHAIN[level] + list(more)) + "\n"


def _hash_pct(key: str, seed: int | None) -> str:
    text = f"CAST({key} AS VARCHAR)" if seed is None else f"'{seed}:' || CAST({key} AS VARCHAR)"
    return f"CAST(('0x' || substr(md5({text}), 1, 6)) AS BIGINT) % 100"


_FEATURE_COLS = "trip_distance, round(log_distance, 10) AS log_distance, trip_minutes, passenger_count, " \
                "hour, is_weekend, label, event_id"
_PRED_COLS = _FEATURE_COLS + ", fare_pred"

_SILVER_COLS = ("VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
                "PULocationID, DOLocationID, fare_amount, total_amount, event_id, trip_minutes, hour, dow, ym")

_BATCH = ("CAST((dense_rank() OVER (ORDER BY strftime(tpep_pickup_datetime, '%Y-%m'), event_id % 4) - 1) // 4 "
          "AS BIGINT)")


def _quantiles_long(source: str, cols: list[str], probs=(0.5, 0.9, 0.95, 0.99)) -> str:
    parts = []
    for c in cols:
        for p in probs:
            parts.append(f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, "
                         f"CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM {source}")
    return "\nUNION ALL\n".join(parts)


def _corr_long(source: str, target: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", round(corr({target}, {c}), 6) AS corr FROM {source}" for c in cols)


def _metrics(source: str, label: str) -> str:
    return f"""
SELECT count(*) AS n,
       round(sqrt(sum(({label} - fare_pred) * ({label} - fare_pred)) / count(*)), 6) AS rmse,
       round(avg(abs({label} - fare_pred)), 6) AS mae,
       round(1 - sum(({label} - fare_pred) * ({label} - fare_pred)) / (var_pop({label}) * count({label})), 6) AS r2
FROM {source}"""


def _buckets_cte() -> str:
    return """
splits AS (
  SELECT quantile_disc(trip_distance, 0.2) AS s1, quantile_disc(trip_distance, 0.4) AS s2,
         quantile_disc(trip_distance, 0.6) AS s3, quantile_disc(trip_distance, 0.8) AS s4
  FROM pred),
bucketed AS (
  SELECT pred.*, CAST(
           CAST(trip_distance >= s1 AS INTEGER)
         + CAST(trip_distance >= s2 AND s2 <> s1 AS INTEGER)
         + CAST(trip_distance >= s3 AND s3 <> s2 AS INTEGER)
         + CAST(trip_distance >= s4 AND s4 <> s3 AS INTEGER) AS DOUBLE) AS dist_bucket
  FROM pred CROSS JOIN splits)"""


_BIN_CHAIN = """CASE WHEN trip_distance < 1 THEN '0–1' WHEN trip_distance < 3 THEN '1–3'
       WHEN trip_distance < 5 THEN '3–5' WHEN trip_distance < 10 THEN '5–10'
       WHEN trip_distance < 20 THEN '10–20' ELSE '20+' END"""

_BIN_ORDER = """CASE dist_bin WHEN '0–1' THEN 0 WHEN '1–3' THEN 1 WHEN '3–5' THEN 2
       WHEN '5–10' THEN 3 WHEN '10–20' THEN 4 WHEN '20+' THEN 5 END"""

_BIN_OPEN = """CASE WHEN trip_distance >= 0 AND trip_distance < 1 THEN '0–1'
       WHEN trip_distance >= 1 AND trip_distance < 3 THEN '1–3'
       WHEN trip_distance >= 3 AND trip_distance < 5 THEN '3–5'
       WHEN trip_distance >= 5 AND trip_distance < 10 THEN '5–10'
       WHEN trip_distance >= 10 AND trip_distance < 20 THEN '10–20'
       WHEN trip_distance >= 20 THEN '20+' END"""


def _ols_ctes(n_feats: int = 6, source: str = "split") -> str:
    """Least squares with intercept on the train rows by classical
    Gram–Schmidt over centred features; applies to every row of ``source``."""
    feats = FEATS[:n_feats]
    means = ", ".join(f"{f} - avg({f}) FILTER (WHERE is_train) OVER () AS c{i}" for i, f in enumerate(feats))
    ctes = [f"""
ols0 AS (
  SELECT *, {means}, label - avg(label) FILTER (WHERE is_train) OVER () AS cy,
         avg(label) FILTER (WHERE is_train) OVER () AS ybar
  FROM {source})"""]
    prev = "ols0"
    for k in range(n_feats):
        terms = "".join(
            f" - (sum(c{k} * e{j}) FILTER (WHERE is_train) OVER ()) / "
            f"(sum(e{j} * e{j}) FILTER (WHERE is_train) OVER ()) * e{j}" for j in range(k))
        ctes.append(f"""
ols_e{k} AS (SELECT *, c{k}{terms} AS e{k} FROM {prev})""")
        prev = f"ols_e{k}"
    fit = " + ".join(
        f"(sum(cy * e{k}) FILTER (WHERE is_train) OVER ()) / (sum(e{k} * e{k}) FILTER (WHERE is_train) OVER ()) * e{k}"
        for k in range(n_feats))
    ctes.append(f"""
ols AS (SELECT *, ybar + {fit} AS ols_pred FROM {prev})""")
    return ",".join(ctes)


def _positive_zero(sql: str) -> str:
    """DuckDB's ``round`` keeps the sign of a zero (-1e-9 -> -0.0), Spark's
    gives 0.0; adding 0.0 turns -0.0 into 0.0 and changes nothing else."""
    return re.sub(r"\bround\(", "0.0 + round(", sql)


def oracle_sql() -> dict[str, str]:
    return {k: _positive_zero(v) for k, v in _oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_ingest"] = with_("bronze") + f"SELECT *, {_BATCH} AS ingest_batch FROM bronze"
    q["bronze_stream"] = with_("bronze") + "SELECT * FROM bronze"
    q["bronze_ingest_incremental"] = q["bronze_stream"]
    q["bronze_batch_then_stream"] = q["bronze_stream"]
    q["bronze_extra_columns"] = with_("bronze") + """
SELECT *, CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 6 AS DOUBLE) ELSE (event_id % 6) / 2 END AS rate,
       CASE WHEN event_id % 2 = 1 THEN (event_id % 9) / 4 END AS tip
FROM bronze"""
    q["dt_invariants"] = with_("features") + f"""
SELECT count(*) AS train_rows, true AS leaves_large, true AS leaves_predict_mean, true AS one_value_per_leaf
FROM features WHERE {_hash_pct("event_id", None)} < 80"""
    q["dt_node_predictions"] = with_("features") + f"""
SELECT event_id, label, true AS same_prediction FROM features WHERE NOT ({_hash_pct("event_id", None)} < 80)"""
    q["dt_root_split"] = with_("features", f"""
train AS (SELECT * FROM features WHERE {_hash_pct("event_id", None)} < 80),
long AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, label FROM train" for c in FEATS) + """),
cuts AS (SELECT DISTINCT feature, unnest(quantile_disc(x, [""" + ", ".join(f"{i / 32}" for i in range(1, 32)) + """])) AS threshold
         FROM long GROUP BY feature),
sides AS (SELECT c.feature, c.threshold, count(*) FILTER (x <= threshold) AS rows_left, count(*) AS n,
                 var_pop(label) AS v, var_pop(label) FILTER (x <= threshold) AS vl, var_pop(label) FILTER (x > threshold) AS vr
          FROM cuts c JOIN long l ON c.feature = l.feature GROUP BY 1, 2)""") + """
SELECT feature, threshold, rows_left,
       round(v - rows_left / n * vl - (n - rows_left) / n * vr, 6) AS gain, true AS root_not_worse
FROM sides WHERE rows_left >= 50 AND n - rows_left >= 50"""
    q["model_metrics_invariants"] = \
        "SELECT CAST(4 AS BIGINT) AS model_splits, true AS rmse_not_below_mae, true AS r2_at_most_one"
    q["sample_bernoulli_invariants"] = "SELECT true AS no_repeats, true AS subset, true AS share_fits"
    q["silver_without_source_id"] = with_("silver") + f"SELECT {_SILVER_COLS} FROM silver"
    q["silver_without_source_id"] = f"SELECT * EXCLUDE (event_id) FROM ({q['silver_without_source_id']})"
    q["silver_rerun"] = with_("silver") + f"""
SELECT {_SILVER_COLS} FROM silver
WHERE ym < (SELECT max(strftime(tpep_pickup_datetime, '%Y-%m')) FROM bronze)"""
    q["bronze_ingest_drift"] = with_("bronze", """
ranked AS (SELECT *, dense_rank() OVER (ORDER BY strftime(tpep_pickup_datetime, '%Y-%m')) - 1 AS month_rank
           FROM bronze)""") + """
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
       PULocationID, DOLocationID, fare_amount, total_amount, event_id,
       CASE WHEN month_rank % 4 = 1 THEN CAST(event_id % 3 AS DOUBLE) * 1.25 END AS airport_fee,
       CAST(0 AS BIGINT) AS ingest_batch
FROM ranked"""
    q["ingest_batch_counts"] = with_("bronze", f"""
b AS (SELECT {_BATCH} AS ingest_batch FROM bronze),
c AS (SELECT ingest_batch, count(*) AS rows FROM b GROUP BY ingest_batch)""") + \
        "SELECT ingest_batch, rows, CAST(sum(rows) OVER (ORDER BY ingest_batch) AS BIGINT) AS cumulative_rows FROM c"
    q["silver_typed"] = with_("typed") + "SELECT * FROM typed"
    q["silver"] = with_("silver") + f"SELECT {_SILVER_COLS} FROM silver"
    q["silver_scan"] = q["silver"]
    q["silver_partition_counts"] = with_("silver") + "SELECT ym, count(*) AS trips FROM silver GROUP BY ym"
    q["hourly_stats"] = with_("silver") + """
SELECT hour, count(*) AS trips, round(avg(trip_distance), 6) AS avg_distance,
       round(avg(total_amount), 6) AS avg_total
FROM silver GROUP BY hour"""
    q["csv_roundtrip"] = q["hourly_stats"]
    q["csv_rejects"] = with_("bronze", """
lines AS (
  SELECT event_id AS e, PULocationID AS pu, DOLocationID AS d,
         CASE WHEN event_id % 47 = 0 THEN 'two' || chr(10) || 'lines, "quoted"' ELSE 'trip ' || event_id END AS note,
         CASE WHEN event_id % 47 = 0 THEN '"two' || chr(10) || 'lines, ""quoted""' || '"' ELSE 'trip ' || event_id END AS field,
         CASE WHEN event_id % 37 = 0 THEN 'short line' WHEN event_id % 41 = 0 THEN 'long line'
              WHEN event_id % 43 = 0 THEN 'bad value: dropoff_zone' END AS reason
  FROM bronze)""") + """
SELECT e AS event_id, CAST(pu AS INTEGER) AS pickup_zone,
       CASE WHEN reason IS NULL OR reason = 'long line' THEN CAST(d AS INTEGER) END AS dropoff_zone,
       CASE WHEN reason IS NULL OR reason <> 'short line' THEN note END AS note,
       reason AS reject_reason,
       CASE reason WHEN 'short line' THEN e || ',' || pu
                   WHEN 'long line' THEN e || ',' || pu || ',' || d || ',' || field || ',more'
                   WHEN 'bad value: dropoff_zone' THEN e || ',' || pu || ',n/a,' || field END AS record
FROM lines"""
    q["top_pu_zones"] = with_("silver") + """
SELECT PULocationID, count(*) AS trips FROM silver GROUP BY PULocationID
ORDER BY trips DESC, PULocationID LIMIT 50"""
    q["wday_vs_wend"] = with_("silver") + """
SELECT CASE WHEN dow IN ('Sat', 'Sun') THEN 'weekend' ELSE 'weekday' END AS day_type,
       count(*) AS trips, round(avg(total_amount), 6) AS avg_total
FROM silver GROUP BY 1"""
    q["vendor_counts"] = with_("bronze") + \
        "SELECT VendorID, count(*) AS trips FROM bronze WHERE VendorID IS NOT NULL GROUP BY VendorID"
    q["marts_incremental"] = f"""
SELECT 'hourly_stats' AS mart, CAST(hour AS VARCHAR) AS key, trips, avg_distance, avg_total FROM ({q["hourly_stats"]})
UNION ALL SELECT 'top_pu_zones', CAST(PULocationID AS VARCHAR), trips, NULL, NULL FROM ({q["top_pu_zones"]})
UNION ALL SELECT 'wday_vs_wend', day_type, trips, NULL, avg_total FROM ({q["wday_vs_wend"]})"""
    t_ok = "tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"
    d_ok = "coalesce(trip_distance > 0, false)"
    tot_ok = "total_amount IS NOT NULL"
    m_ok = f"coalesce({_MINUTES} > 0, false)"
    f_ok = "coalesce(fare_amount IS NOT NULL AND fare_amount > 1 AND fare_amount < 200, false)"
    dd_ok = "coalesce(trip_distance IS NOT NULL AND trip_distance > 0.1 AND trip_distance < 50, false)"
    mm_ok = "coalesce(trip_minutes IS NOT NULL AND trip_minutes > 1 AND trip_minutes < 180, false)"
    q["filter_audit"] = with_("features", f"""
s1 AS (SELECT count(*) AS input_rows,
              count(*) FILTER (WHERE NOT ({t_ok})) AS r1,
              count(*) FILTER (WHERE ({t_ok}) AND NOT {d_ok}) AS r2,
              count(*) FILTER (WHERE ({t_ok}) AND {d_ok} AND NOT ({tot_ok})) AS r3,
              count(*) FILTER (WHERE ({t_ok}) AND {d_ok} AND ({tot_ok}) AND NOT {m_ok}) AS r4,
              count(*) FILTER (WHERE ({t_ok}) AND {d_ok} AND ({tot_ok}) AND {m_ok}) AS kept
       FROM typed),
s2 AS (SELECT count(*) AS silver_rows,
              count(*) FILTER (WHERE NOT {f_ok}) AS r6,
              count(*) FILTER (WHERE {f_ok} AND NOT {dd_ok}) AS r7,
              count(*) FILTER (WHERE {f_ok} AND {dd_ok} AND NOT {mm_ok}) AS r8,
              count(*) FILTER (WHERE {f_ok} AND {dd_ok} AND {mm_ok}) AS in_range
       FROM silver),
s3 AS (SELECT count(*) AS feature_rows FROM features),
w AS (SELECT * FROM s1, s2, s3)""") + """
SELECT 0 AS step, 'input' AS rule, input_rows AS rows FROM w
UNION ALL SELECT 1, 'timestamps_present', r1 FROM w
UNION ALL SELECT 2, 'positive_distance', r2 FROM w
UNION ALL SELECT 3, 'total_present', r3 FROM w
UNION ALL SELECT 4, 'positive_minutes', r4 FROM w
UNION ALL SELECT 5, 'duplicate_key', kept - silver_rows FROM w
UNION ALL SELECT 6, 'fare_amount_in_range', r6 FROM w
UNION ALL SELECT 7, 'trip_distance_in_range', r7 FROM w
UNION ALL SELECT 8, 'trip_minutes_in_range', r8 FROM w
UNION ALL SELECT 9, 'missing_values', in_range - feature_rows FROM w
UNION ALL SELECT 10, 'output', feature_rows FROM w"""
    q["curate_rejects"] = f"""
SELECT CASE rule WHEN 'feature_rows' THEN 'output' ELSE rule END AS rule, rows FROM ({q["filter_audit"]}) WHERE step <= 5
UNION ALL SELECT 'output', count(*) FROM ({q["silver"]})"""
    q["silver_stream_dedupe"] = q["silver"]
    q["features"] = with_("features") + f"SELECT {_FEATURE_COLS} FROM features"
    q["parquet_roundtrip"] = q["features"]
    q["score_features_cast"] = q["features"]
    as_of = f"TIMESTAMP '{AS_OF}'"
    q["raw_features"] = with_("bronze") + f"""
SELECT trip_distance, round(ln(1 + trip_distance), 10) AS log_distance,
       coalesce(CASE WHEN tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
                     THEN {_MINUTES} END, 12.0) AS trip_minutes,
       CAST(passenger_count AS INTEGER) AS passenger_count,
       CAST(hour(coalesce(tpep_pickup_datetime, {as_of})) AS INTEGER) AS hour,
       CASE WHEN dayofweek(coalesce(tpep_pickup_datetime, {as_of})) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
       fare_amount, total_amount, event_id, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
       CAST(dayofweek(coalesce(tpep_pickup_datetime, {as_of})) + 1 AS INTEGER) AS dow
FROM bronze"""
    q["raw_features_as_of"] = with_("bronze", """
b2 AS (SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN NULL ELSE tpep_pickup_datetime END
                         AS tpep_pickup_datetime) FROM bronze)""") + f"""
SELECT trip_distance, round(ln(1 + trip_distance), 10) AS log_distance,
       coalesce(CASE WHEN tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
                     THEN {_MINUTES} END, 12.0) AS trip_minutes,
       CAST(passenger_count AS INTEGER) AS passenger_count,
       CAST(hour(coalesce(tpep_pickup_datetime, {as_of})) AS INTEGER) AS hour,
       CASE WHEN dayofweek(coalesce(tpep_pickup_datetime, {as_of})) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
       fare_amount, total_amount, event_id, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
       CAST(dayofweek(coalesce(tpep_pickup_datetime, {as_of})) + 1 AS INTEGER) AS dow
FROM b2"""
    q["upload_features_a_no_dropoff"] = with_("bronze") + """
SELECT trip_distance, round(ln(1 + trip_distance), 10) AS log_distance, CAST(12.0 AS DOUBLE) AS trip_minutes,
       CAST(1 AS INTEGER) AS passenger_count,
       CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour,
       CASE WHEN dayofweek(tpep_pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       fare_amount AS trip_fare, event_id
FROM bronze"""
    q["upload_features_a"] = with_("bronze") + f"""
SELECT trip_distance, round(ln(1 + trip_distance), 10) AS log_distance,
       CAST({_MINUTES} AS DOUBLE) AS trip_minutes,
       CAST(1 AS INTEGER) AS passenger_count,
       CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour,
       CASE WHEN dayofweek(tpep_pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       fare_amount AS trip_fare, event_id
FROM bronze"""
    q["upload_features_b"] = with_("features") + """
SELECT trip_distance, round(log_distance, 10) AS log_distance, trip_minutes, passenger_count, hour,
       is_weekend, label AS trip_fare, event_id
FROM features"""
    bronze_cols = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                   "trip_distance", "PULocationID", "DOLocationID", "fare_amount", "total_amount", "event_id"]
    q["null_counts"] = with_("bronze") + "SELECT " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in bronze_cols) + " FROM bronze"
    q["feature_profile"] = with_("features") + """
SELECT count(*) AS rows, round(avg(label), 6) AS label_mean, round(stddev_samp(label), 6) AS label_std,
       min(label) AS label_min, max(label) AS label_max,
       round(avg(trip_distance), 6) AS dist_mean, max(trip_distance) AS dist_max
FROM features"""
    q["feature_quantiles"] = with_("features") + _quantiles_long("features", ["label", "trip_distance"])
    q["silver_quantiles"] = with_("silver") + _quantiles_long("silver", ["fare_amount", "trip_minutes"])
    q["label_correlations"] = with_("features") + _corr_long(
        "features", "label",
        ["trip_distance", "passenger_count", "hour", "is_weekend", "trip_minutes", "log_distance"])
    q["silver_correlations"] = with_("silver") + _corr_long("silver", "fare_amount",
                                                             ["trip_distance", "trip_minutes"])
    top_cols = "label, trip_distance, passenger_count, hour, is_weekend, event_id"
    q["top_fares"] = with_("features") + \
        f"SELECT {top_cols} FROM features ORDER BY label DESC, event_id LIMIT 5"
    q["top_distances"] = with_("features") + \
        f"SELECT {top_cols} FROM features ORDER BY trip_distance DESC, event_id LIMIT 5"
    q["prediction_errors"] = with_("pred") + f"""
SELECT {_PRED_COLS}, label - fare_pred AS resid, abs(label - fare_pred) AS abs_error FROM pred"""
    q["regression_metrics"] = with_("pred") + _metrics("pred", "label")
    q["regression_metrics_formula"] = with_("pred") + _metrics("pred", "label")
    q["residual_summary"] = with_("pred", """
r AS (SELECT label - fare_pred AS resid FROM pred)""") + """
SELECT round(avg(resid), 6) AS resid_mean, round(stddev_samp(resid), 6) AS resid_std,
       quantile_disc(resid, 0.5) AS resid_q50, quantile_disc(resid, 0.9) AS resid_q90,
       quantile_disc(resid, 0.95) AS resid_q95, quantile_disc(resid, 0.99) AS resid_q99
FROM r"""
    q["calibration"] = with_("pred") + """
SELECT round(corr(fare_pred, label), 6) AS corr_pred_label,
       round(avg(abs(label - fare_pred)), 6) AS mae_agg,
       round(sqrt(avg((label - fare_pred) * (label - fare_pred))), 6) AS rmse_agg
FROM pred"""
    for key, col in (("error_by_hour", "hour"), ("error_by_weekend", "is_weekend")):
        q[key] = with_("pred") + f"""
SELECT {col}, count(*) AS n, round(avg(abs(label - fare_pred)), 6) AS mae,
       round(avg(label - fare_pred), 6) AS bias
FROM pred GROUP BY {col}"""
    q["quantile_buckets"] = with_("pred", _buckets_cte()) + \
        "SELECT event_id, trip_distance, dist_bucket FROM bucketed"
    q["error_by_quantile_bucket"] = with_("pred", _buckets_cte()) + """
SELECT dist_bucket, count(*) AS n, round(avg(trip_distance), 6) AS avg_dist,
       round(avg(abs(label - fare_pred)), 6) AS mae, round(avg(label - fare_pred), 6) AS bias
FROM bucketed GROUP BY dist_bucket"""
    q["error_by_distance_bin"] = with_("pred", f"""
b AS (SELECT {_BIN_CHAIN} AS dist_bin, label - fare_pred AS resid FROM pred),
g AS (SELECT dist_bin, round(avg(abs(resid)), 6) AS mae, count(*) AS n FROM b GROUP BY dist_bin)""") + \
        f"SELECT dist_bin, mae, n, {_BIN_ORDER} AS bin_order FROM g"
    q["error_by_distance_bin_filled"] = with_("pred", f"""
dim AS (SELECT * FROM (VALUES (0, '0–1'), (1, '1–3'), (2, '3–5'), (3, '5–10'), (4, '10–20'), (5, '20+'))
        AS t(bin_order, dist_bin)),
b AS (SELECT {_BIN_OPEN} AS dist_bin, abs(label - fare_pred) AS err FROM pred),
g AS (SELECT dist_bin, count(*) AS n, round(avg(err), 6) AS mae FROM b WHERE dist_bin IS NOT NULL
      GROUP BY dist_bin)""") + """
SELECT dim.dist_bin, CAST(dim.bin_order AS INTEGER) AS bin_order, coalesce(g.n, 0) AS n, g.mae
FROM dim LEFT JOIN g ON dim.dist_bin = g.dist_bin"""
    q["avg_pred_by_distance_bin"] = with_("pred", f"""
dim AS (SELECT * FROM (VALUES (0, '0–1'), (1, '1–3'), (2, '3–5'), (3, '5–10'), (4, '10–20'), (5, '20+'))
        AS t(bin_order, dist_bin)),
b AS (SELECT {_BIN_OPEN} AS dist_bin, fare_pred FROM pred),
g AS (SELECT dist_bin, count(*) AS n, round(avg(fare_pred), 6) AS avg_pred FROM b WHERE dist_bin IS NOT NULL
      GROUP BY dist_bin)""") + """
SELECT dim.dist_bin, CAST(dim.bin_order AS INTEGER) AS bin_order, coalesce(g.n, 0) AS n, g.avg_pred
FROM dim LEFT JOIN g ON dim.dist_bin = g.dist_bin"""
    q["avg_pred_by_hour"] = with_("pred") + \
        "SELECT hour, round(avg(fare_pred), 6) AS avg_pred FROM pred GROUP BY hour"
    q["residual_histogram"] = with_("pred", """
r AS (SELECT label - fare_pred AS resid FROM pred),
bounds AS (SELECT min(resid) AS lo, max(resid) AS hi FROM r),
bw AS (SELECT lo, hi, CASE WHEN hi > lo THEN (hi - lo) / 60 ELSE 1.0 END AS width FROM bounds),
binned AS (SELECT CAST(least(floor((resid - lo) / width), 59) AS INTEGER) AS bin, count(*) AS n
           FROM r CROSS JOIN bw WHERE resid IS NOT NULL AND NOT isnan(resid) GROUP BY 1),
dim AS (SELECT CAST(range AS INTEGER) AS bin FROM range(60))""") + """
SELECT dim.bin, round(lo + dim.bin * width, 6) AS bin_lo, round(lo + (dim.bin + 1) * width, 6) AS bin_hi,
       coalesce(binned.n, 0) AS n
FROM dim CROSS JOIN bw LEFT JOIN binned ON dim.bin = binned.bin"""
    q["histogram_merged"] = q["residual_histogram"]
    q["residual_histogram_nan"] = with_("pred", """
r AS (SELECT label - fare_pred AS resid FROM pred
      WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0),
bounds AS (SELECT min(resid) AS lo, max(resid) AS hi FROM r),
bw AS (SELECT lo, hi, CASE WHEN hi > lo THEN (hi - lo) / 20 ELSE 1.0 END AS width FROM bounds),
binned AS (SELECT CAST(least(floor((resid - lo) / width), 19) AS INTEGER) AS bin, count(*) AS n
           FROM r CROSS JOIN bw GROUP BY 1),
dim AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20))""") + """
SELECT dim.bin, round(lo + dim.bin * width, 6) AS bin_lo, round(lo + (dim.bin + 1) * width, 6) AS bin_hi,
       coalesce(binned.n, 0) AS n
FROM dim CROSS JOIN bw LEFT JOIN binned ON dim.bin = binned.bin"""
    q["regression_metrics_nulls"] = with_("pred", """
known AS (SELECT * FROM pred WHERE event_id % 5 <> 0 AND event_id % 7 <> 0)""") + _metrics("known", "label")
    q["quantiles_repeated_values"] = with_("features", """
f AS (SELECT CAST(event_id % 2 AS DOUBLE) AS two_valued, CAST(floor(label) AS DOUBLE) AS whole_fare FROM features)""") + \
        _quantiles_long("f", ["two_valued", "whole_fare"], [0.25, 0.5, 0.501, 0.75, 0.99])
    q["top_errors"] = with_("pred") + """
SELECT trip_distance, trip_minutes, passenger_count, hour, is_weekend, label AS trip_fare, fare_pred,
       abs(label - fare_pred) AS abs_error, event_id
FROM pred ORDER BY abs(label - fare_pred) DESC, event_id LIMIT 20"""
    q["prediction_export"] = with_("pred") + """
SELECT trip_distance, round(log_distance, 10) AS log_distance, trip_minutes, passenger_count, hour,
       is_weekend, label AS trip_fare, fare_pred, abs(label - fare_pred) AS abs_error, event_id
FROM pred ORDER BY event_id LIMIT 10000"""
    q["split_hash"] = with_("split") + "SELECT event_id, is_train FROM split"
    q["sample_hash"] = with_("pred") + f"SELECT {_PRED_COLS} FROM pred WHERE {_hash_pct('event_id', 42)} < 5"
    q["scatter_feed"] = with_("pred") + \
        f"SELECT event_id, trip_distance, label, fare_pred FROM pred WHERE {_hash_pct('event_id', 1 * 7)} < 1"
    q["sample_fixed_n"] = with_("pred") + f"""
SELECT {_PRED_COLS} FROM pred ORDER BY md5('7:' || CAST(event_id AS VARCHAR)), event_id LIMIT 3000"""
    q["sample_bottom_k"] = q["sample_fixed_n"]
    q["sample_weighted"] = with_("pred") + """
SELECT event_id, trip_distance, is_weekend FROM pred WHERE trip_distance > 0
ORDER BY -ln(1 - CAST(('0x' || substr(md5('7:' || CAST(event_id AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0) / trip_distance,
         event_id LIMIT 1000"""
    q["scaled_features"] = with_("split") + "SELECT event_id, " + ", ".join(
        f"round(CASE WHEN stddev_samp({f}) FILTER (WHERE is_train) OVER () > 0 "
        f"THEN {f} / stddev_samp({f}) FILTER (WHERE is_train) OVER () ELSE 0.0 END, 6) AS {f}_scaled"
        for f in FEATS) + " FROM split"
    q["lr_predictions"] = with_("split", _ols_ctes()) + \
        "SELECT event_id, label, round(ols_pred, 4) AS prediction FROM ols WHERE NOT is_train"
    q["score_batch"] = with_("split", _ols_ctes()) + f"""
SELECT trip_distance, round(log_distance, 10) AS log_distance, trip_minutes, passenger_count, hour,
       is_weekend, label, event_id, round(ols_pred, 4) AS fare_pred FROM ols"""
    q["stream_scores"] = q["score_batch"]
    q["score_rejects"] = with_("features") + """
SELECT 0 AS step, 'input' AS rule, count(*) AS rows FROM features
UNION ALL SELECT 1, 'trip_distance_present', count(*) FROM features WHERE event_id % 11 = 0
UNION ALL SELECT 2, 'log_distance_present', 0
UNION ALL SELECT 3, 'trip_minutes_present', 0
UNION ALL SELECT 4, 'passenger_count_present', 0
UNION ALL SELECT 5, 'hour_present', count(*) FROM features WHERE event_id % 11 <> 0 AND event_id % 13 = 0
UNION ALL SELECT 6, 'is_weekend_present', 0
UNION ALL SELECT 7, 'output', count(*) FROM features WHERE event_id % 11 <> 0 AND event_id % 13 <> 0"""
    for key, rows, fare in (("score_batch_raw", "raw_features_as_of", ""), ("upload_scored_a", "upload_features_a", "trip_fare, "),
                            ("upload_scored_b", "upload_features_b", "trip_fare, ")):
        # rows beside the training rows, predicted by the same fit
        q[key] = with_("split", f"""
given AS ({q[rows]}),
split_given AS (
  SELECT {", ".join(FEATS)}, label, is_train, NULL AS given_id, NULL AS trip_fare FROM split
  UNION ALL
  SELECT {", ".join("ln(1 + trip_distance)" if f == "log_distance" else f for f in FEATS)}, NULL, false, event_id, {fare or "NULL, "}FROM given)""".replace(", FROM", " FROM"),
            _ols_ctes(source="split_given")) + f"""
SELECT given_id AS event_id, trip_distance, round(log_distance, 10) AS log_distance, trip_minutes, passenger_count, hour, is_weekend,
       {fare}round(ols_pred, 4) AS fare_pred
FROM ols WHERE given_id IS NOT NULL"""
    cols = ("label", "trip_distance", "label - fare_pred")
    q["quantile_sketch_bounds"] = with_("pred") + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", CAST({p} AS DOUBLE) AS prob, count({c}) AS n, true AS within_bound FROM pred"
        for name, c in zip(("label", "trip_distance", "resid"), cols) for p in (0.5, 0.9, 0.95, 0.99))
    q["prediction_export_capped"] = with_("pred") + "SELECT event_id, trip_distance, fare_pred FROM pred ORDER BY event_id LIMIT 2000"
    q["lr_metrics"] = with_("split", _ols_ctes(), """
m AS (SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS split,
             round(sqrt(sum((label - ols_pred) * (label - ols_pred)) / count(*)), 6) AS rmse,
             round(avg(abs(label - ols_pred)), 6) AS mae,
             round(1 - sum((label - ols_pred) * (label - ols_pred)) / (var_pop(label) * count(label)), 6) AS r2
      FROM ols GROUP BY 1)""") + """
SELECT 'LinearRegression' AS model, split, 'rmse' AS metric, rmse AS value FROM m
UNION ALL SELECT 'LinearRegression', split, 'mae', mae FROM m
UNION ALL SELECT 'LinearRegression', split, 'r2', r2 FROM m"""
    # The fitted function is linear, so its coefficients are its values at
    # the unit vectors minus its value at zero: probe rows (not in the
    # training sums) are scored by the same least-squares fit.
    zero = ", ".join(f"0.0 AS {f}" for f in FEATS)
    probes = [f"SELECT 'intercept' AS feature, {zero}"] + [
        "SELECT '{}' AS feature, ".format(f) + ", ".join(
            f"{'1.0' if g == f else '0.0'} AS {g}" for g in FEATS) for f in FEATS]
    probe_cte = f"""
probe AS ({' UNION ALL '.join(probes)}),
split_probe AS (
  SELECT trip_distance, log_distance, trip_minutes, passenger_count, hour, is_weekend, label, is_train,
         NULL AS feature FROM split
  UNION ALL
  SELECT trip_distance, log_distance, trip_minutes, passenger_count, hour, is_weekend, NULL, false,
         feature FROM probe)"""
    sd = ", ".join(f"stddev_samp({f}) FILTER (WHERE is_train) AS sd_{f}" for f in FEATS)
    sd_case = " ".join(f"WHEN '{f}' THEN sd_{f}" for f in FEATS)
    q["lr_coefficients"] = with_("split", probe_cte, _ols_ctes(source="split_probe"), f"""
sds AS (SELECT {sd} FROM split),
pts AS (SELECT feature, ols_pred FROM ols WHERE feature IS NOT NULL),
z AS (SELECT ols_pred AS p0 FROM pts WHERE feature = 'intercept'),
beta AS (SELECT feature, CASE WHEN feature = 'intercept' THEN p0 ELSE ols_pred - p0 END AS b FROM pts, z)""") + f"""
SELECT feature,
       round(CASE feature WHEN 'intercept' THEN b ELSE b * (CASE feature {sd_case} END) END, 4) AS coefficient,
       round(b, 4) AS coefficient_unscaled
FROM beta, sds"""
    q["lr_from_moments"] = q["lr_coefficients"]
    q["correlations_from_moments"] = q["label_correlations"]
    return q
