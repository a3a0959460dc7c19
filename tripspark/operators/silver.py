"""Silver layer: typed, cleaned and reproducibly de-duplicated trips.

P1 (aliases), P3 (casts), F1-F4 (filters), D1-D4 (derived columns),
A22 (de-duplication), F10 (rejection accounting).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tripspark.functions import as_timestamp, day_name, hour_of_day, minutes_between, year_month
from tripspark.schemas import BRONZE_ALIASES, ROW_ID, SILVER_DERIVED, SILVER_KEY, SILVER_TYPES

TIMESTAMP_COLUMNS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")


def harmonize_names(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Rename ``alias -> canonical`` only when the alias is present and the
    canonical name is not; one ``select``, no chain of renames."""
    aliases = BRONZE_ALIASES if aliases is None else aliases
    present = set(df.columns)
    renames = {a: c for a, c in aliases.items() if a in present and c not in present}
    if not renames:
        return df
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in df.columns])


def typed(bronze: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Silver casts in one projection. Malformed values become null.

    Columns not named in ``types`` pass through unchanged.
    """
    types = SILVER_TYPES if types is None else types
    dtypes = {f.name: f.dataType for f in bronze.schema.fields}
    cols = []
    for name in bronze.columns:
        if name not in types:
            cols.append(F.col(name))
        elif types[name] == "timestamp":
            cols.append(as_timestamp(name, dtypes[name]).alias(name))
        elif types[name] in ("int", "bigint") and dtypes[name].simpleString() == "string":
            # text such as "1.0" is a valid count; read it as a number first
            cols.append(F.col(name).try_cast("double").try_cast(types[name]).alias(name))
        else:
            cols.append(F.col(name).try_cast(types[name]).alias(name))
    return bronze.select(*cols)


def silver_predicates():
    """(rule name, keep condition) pairs, applied in order."""
    pick, drop = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return [
        ("timestamps_present", pick.isNotNull() & drop.isNotNull()),
        ("positive_distance", F.col("trip_distance") > 0),
        ("total_present", F.col("total_amount").isNotNull()),
        ("positive_minutes", minutes_between(pick, drop) > 0),
    ]


def clean(typed_df: DataFrame) -> DataFrame:
    """F1-F4. Filters stay on stored columns (plus a pure function of them)
    so they run before the de-duplication shuffle."""
    cond = None
    for _, keep in silver_predicates():
        cond = keep if cond is None else cond & keep
    return typed_df.filter(cond)


def dedupe(df: DataFrame, key: Sequence[str], order: Sequence[str], unique_order: bool = False) -> DataFrame:
    """Keep one row per ``key``: the smallest by ``order`` then the remaining
    columns (a total order, so reruns pick the same survivor).

    Written as ``min(struct(...))`` per key: the aggregate has a map-side
    partial step, so a hot key holding a large share of rows collapses to
    one row per map task before the shuffle (a ``row_number`` window would
    sort the whole hot group in one task). Null key values form one group.

    ``unique_order=True`` declares ``order`` to be one non-null column that
    is unique per row (a row id): then ``min_by(column, id)`` per column
    picks the same single row, and with primitive columns the aggregate is
    a hash aggregate (no per-partition sort).
    """
    key = list(key)
    if unique_order and len(order) == 1:
        (oid,) = order
        others = [c for c in df.columns if c not in key and c != oid]
        out = df.groupBy(*key).agg(F.min(oid).alias(oid), *[F.min_by(c, oid).alias(c) for c in others])
        return out.select(*df.columns)
    rest = [c for c in df.columns if c not in key]
    ordered = list(order) + [c for c in rest if c not in order]
    out = df.groupBy(*key).agg(F.min(F.struct(*ordered)).alias("_keep"))
    return out.select(*[F.col(k) for k in key], *[F.col(f"_keep.{c}").alias(c) for c in ordered]) \
        .select(*df.columns)


def derive(df: DataFrame) -> DataFrame:
    """trip_minutes, hour, dow, ym from the two timestamps."""
    pick, drop = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return df.select(
        *df.columns,
        minutes_between(pick, drop).alias("trip_minutes"),
        hour_of_day(pick).alias("hour"),
        day_name(pick).alias("dow"),
        year_month(pick).alias("ym"),
    )


def silver(bronze: DataFrame, key: Sequence[str] = tuple(SILVER_KEY),
           order: Sequence[str] = (ROW_ID, "event_id"), unique_order: bool | None = None,
           watch: Observation | None = None) -> DataFrame:
    """Bronze -> Silver: harmonize, cast, filter, de-duplicate, derive.

    ``order`` names the tie-break columns that pick the surviving duplicate;
    columns in it that are absent are ignored (the remaining columns still
    make the choice deterministic). ``unique_order`` says that ``order`` is
    one column without nulls or repeats. By default that holds for the row id
    that the ingest assigns, and for nothing else: a column of the source may
    well be called an id and repeat, and then a total order over all columns
    decides. ``watch`` gets the counts of :func:`rejection_audit` from the pass
    that computes the result.
    """
    df = typed(harmonize_names(bronze))
    if watch is not None:
        df = df.observe(watch, *_audit_counts())
    df = clean(df)
    order = [c for c in order if c in df.columns]
    if unique_order is None:
        unique_order = order[:1] == [ROW_ID]
        order = order[:1] if unique_order else order
    return derive(dedupe(df, key, order, unique_order=unique_order and len(order) == 1))


def rejection_audit(bronze: DataFrame) -> DataFrame:
    """F10 for the Silver stage: rows dropped by each rule, in rule order
    (a row counts against the first rule it fails), in one pass."""
    return typed(harmonize_names(bronze)).agg(*_audit_counts())


def _audit_counts() -> list[Column]:
    aggs, passed = [], None
    for name, keep in silver_predicates():
        keep = F.coalesce(keep, F.lit(False))
        fails = ~keep if passed is None else passed & ~keep
        aggs.append(F.count_if(fails).alias(name))
        passed = keep if passed is None else passed & keep
    aggs.insert(0, F.count(F.lit(1)).alias("input_rows"))
    aggs.append(F.count_if(passed).alias("kept_rows"))
    return aggs


__all__ = ["harmonize_names", "typed", "clean", "dedupe", "derive", "silver", "rejection_audit",
           "SILVER_DERIVED", "TIMESTAMP_COLUMNS"]
