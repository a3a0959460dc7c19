"""Feature tables (F5-F8, D6, D8, P10), raw-input features (M10), upload
features (M11) and the scoring casts (P4, P9)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tripspark.functions import (
    as_timestamp, day_of_week, hour_of_day, minutes_between, weekend_from_day_name,
    weekend_from_day_number,
)
from tripspark.schemas import (
    DEFAULT_PASSENGER_COUNT, DEFAULT_TRIP_MINUTES, DOUBLE_FEATS, DROPOFF_CANDIDATES, FEATS,
    FEATURE_BOUNDS, INT_FEATS, PICKUP_CANDIDATES, ROW_ID,
)


class MissingColumnsError(ValueError):
    """Raised while planning, before any job runs, naming what is missing."""


def feature_predicates() -> list[tuple[str, Column]]:
    """F5-F7 as (rule name, keep condition); all bounds are exclusive and
    null-rejecting."""
    return [(f"{c}_in_range", F.col(c).isNotNull() & (F.col(c) > lo) & (F.col(c) < hi))
            for c, lo, hi in FEATURE_BOUNDS]


def _not_missing(cols: Sequence[str], dtypes: dict[str, T.DataType]) -> Column:
    """``na.drop('any')`` as a predicate: no null, and no NaN in floats."""
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull()
        if isinstance(dtypes[c], (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return cond


def feature_columns() -> dict[str, Column]:
    """The feature table's columns as expressions over Silver columns."""
    return {
        "trip_distance": F.col("trip_distance"),
        "log_distance": F.log1p("trip_distance"),
        "trip_minutes": F.col("trip_minutes"),
        "passenger_count": F.col("passenger_count"),
        "hour": F.col("hour"),
        "is_weekend": weekend_from_day_name(F.col("dow")),
        "label": F.col("fare_amount"),
    }


def usable_feature_row(silver: DataFrame) -> Column:
    """True for a Silver row that the feature table keeps: inside every
    bound (F5-F7) and with no null or NaN feature (F8). Null-valued rows
    give null (a filter drops them); the conjunction is left bare so the
    bounds on stored columns push down into the Parquet scan."""
    cond = None
    for _, keep_rule in feature_predicates():
        cond = keep_rule if cond is None else cond & keep_rule
    exprs = feature_columns()
    typed = silver.select(*[e.alias(n) for n, e in exprs.items()]).schema
    for field in typed.fields:
        ok = exprs[field.name].isNotNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(exprs[field.name])
        cond = cond & ok
    return cond


def build_features(silver: DataFrame, keep: Sequence[str] = (ROW_ID, "event_id")) -> DataFrame:
    """Silver -> feature table: bounds, weekend flag, log distance, label.

    ``keep`` passes row keys through (absent ones are ignored). Rows with a
    null or NaN in any output column are dropped, as ``na.drop()`` does.
    """
    keep = [c for c in keep if c in silver.columns]
    return silver.where(usable_feature_row(silver)).select(
        *[e.alias(n) for n, e in feature_columns().items()], *keep)


def resolve(columns: Sequence[str], name: str) -> str | None:
    """Case-insensitive lookup of ``name`` among ``columns``."""
    for c in columns:
        if c.lower() == name.lower():
            return c
    return None


def first_present(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """The first candidate present in ``columns`` (case-insensitive)."""
    for cand in candidates:
        found = resolve(columns, cand)
        if found is not None:
            return found
    return None


def cast_features(df: DataFrame) -> DataFrame:
    """The six features to double/int; malformed values become null.

    Text such as "2.0" is a valid integer feature, so text goes through
    double first. Other columns pass through.
    """
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for c in df.columns:
        if c in DOUBLE_FEATS:
            cols.append(F.col(c).try_cast("double").alias(c))
        elif c in INT_FEATS:
            src = F.col(c).try_cast("double") if isinstance(dtypes[c], T.StringType) else F.col(c)
            cols.append(src.try_cast("int").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def require_columns(df: DataFrame, needed: Sequence[str], what: str) -> None:
    """Fail before execution when ``needed`` columns are absent
    (matched case-insensitively)."""
    missing = [c for c in needed if resolve(df.columns, c) is None]
    if missing:
        raise MissingColumnsError(f"{what} must contain columns {list(needed)}; missing {missing}")


def raw_features(df: DataFrame, as_of: dt.datetime | str | None = None,
                 prefer: str = "timestamps") -> DataFrame:
    """Features from typical raw trip columns (batch scoring rules).

    * pickup/dropoff: row-wise first non-null over the *present* candidate
      columns (P8);
    * ``trip_minutes``: from the timestamps when both exist, else a supplied
      ``trip_minutes`` column (``prefer="timestamps"``); ``prefer="supplied"``
      reverses that; null after both -> 12.0 (D9, per row);
    * hour / weekend from pickup, or from ``as_of`` when pickup is null (D7).
      Without ``as_of`` the time of the call is taken, once for all rows; give
      it where reruns have to agree;
    * absent ``passenger_count`` -> 1 (P6).

    Output: the six features first, then every other input column, then the
    derived ``pickup_ts``, ``dropoff_ts`` and ``dow`` (1 = Sunday) (P11).
    """
    require_columns(df, ["trip_distance"], "raw input")
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    picks = [c for c in PICKUP_CANDIDATES if c in df.columns]
    drops = [c for c in DROPOFF_CANDIDATES if c in df.columns]
    pick = F.coalesce(*[as_timestamp(c, dtypes[c]) for c in picks]) if picks else F.lit(None).cast("timestamp")
    drop = F.coalesce(*[as_timestamp(c, dtypes[c]) for c in drops]) if drops else F.lit(None).cast("timestamp")
    from_ts = F.when(pick.isNotNull() & drop.isNotNull(), minutes_between(pick, drop))
    supplied = F.col("trip_minutes").try_cast("double") if "trip_minutes" in df.columns else F.lit(None).cast("double")
    minutes = F.coalesce(from_ts, supplied) if prefer == "timestamps" else F.coalesce(supplied, from_ts)
    minutes = F.coalesce(minutes, F.lit(DEFAULT_TRIP_MINUTES))
    as_of = dt.datetime.now(dt.timezone.utc) if as_of is None else as_of
    fallback = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else F.lit(as_of)
    when = F.coalesce(pick, fallback)
    passengers = (F.col("passenger_count") if "passenger_count" in df.columns
                  else F.lit(DEFAULT_PASSENGER_COUNT))
    feats = {
        "trip_distance": F.col("trip_distance"),
        "log_distance": F.log1p(F.col("trip_distance").try_cast("double")),
        "trip_minutes": minutes,
        "passenger_count": passengers,
        "hour": hour_of_day(when),
        "is_weekend": weekend_from_day_number(day_of_week(when)),
    }
    derived = {"pickup_ts": pick, "dropoff_ts": drop, "dow": day_of_week(when)}
    rest = [F.col(c) for c in df.columns if c not in FEATS and c not in derived]
    return cast_features(df.select(*[e.alias(n) for n, e in feats.items()], *rest, *[e.alias(n) for n, e in derived.items()]))


def upload_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Features from an uploaded table of schema A or B.

    * all names lower-cased (P2); names that collide after lower-casing are
      an error;
    * hour/is_weekend supplied (schema B) or derived from the first present
      pickup column (schema A); neither -> error (P9);
    * trip_minutes: supplied, else from pickup and dropoff, else 12.0 for
      the whole column (page rules: supplied value wins);
    * optional ``trip_fare`` passes through as double (P5).
    Output: the six features, ``trip_fare`` if present, then ``keep``.
    """
    lowered = [c.lower() for c in df.columns]
    dupes = sorted({c for c in lowered if lowered.count(c) > 1})
    if dupes:
        raise MissingColumnsError(f"column names collide after lower-casing: {dupes}")
    df = df.toDF(*lowered)
    cols = set(lowered)
    require_columns(df, ["trip_distance"], "upload")
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    pick_col = first_present(lowered, PICKUP_CANDIDATES)
    drop_col = first_present(lowered, DROPOFF_CANDIDATES)
    pick = as_timestamp(pick_col, dtypes[pick_col]) if pick_col else None
    drop = as_timestamp(drop_col, dtypes[drop_col]) if drop_col else None

    if "hour" in cols and "is_weekend" in cols:
        hour, weekend = F.col("hour"), F.col("is_weekend")
    elif pick is not None:
        hour, weekend = hour_of_day(pick), weekend_from_day_number(day_of_week(pick))
    else:
        raise MissingColumnsError(
            f"the upload has neither hour and is_weekend nor one of the pickup columns {PICKUP_CANDIDATES}")

    if "trip_minutes" in cols:
        minutes = F.col("trip_minutes")
    elif pick is not None and drop is not None:
        minutes = minutes_between(pick, drop)
    else:
        minutes = F.lit(DEFAULT_TRIP_MINUTES)
    passengers = F.col("passenger_count") if "passenger_count" in cols else F.lit(DEFAULT_PASSENGER_COUNT)
    distance = F.col("trip_distance").try_cast("double")
    out = [
        distance.alias("trip_distance"),
        F.log1p(distance).alias("log_distance"),
        minutes.alias("trip_minutes"),
        passengers.alias("passenger_count"),
        hour.alias("hour"),
        weekend.alias("is_weekend"),
    ]
    if "trip_fare" in cols:
        out.append(F.col("trip_fare").try_cast("double").alias("trip_fare"))
    out += [F.col(k.lower()) for k in keep if k.lower() in cols]
    return cast_features(df.select(*out))
