"""Gold marts from Silver.

Stored marts carry no global ORDER BY (a range shuffle that gives readers
no guarantee); readers sort. Top-k keeps its order by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripspark.functions import weekend_from_day_name


def hourly_stats(silver: DataFrame, digits: int | None = None) -> DataFrame:
    """A1: trips, average distance and average total per pickup hour."""
    out = silver.groupBy("hour").agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("total_amount").alias("avg_total"),
    )
    return _round(out, ["avg_distance", "avg_total"], digits)


def top_pickup_zones(silver: DataFrame, n: int = 50) -> DataFrame:
    """A2/O2: the ``n`` busiest pickup zones; ties broken by zone id.

    Partial aggregation makes a hot zone cheap; the final top-k is a
    TakeOrderedAndProject over at most one row per zone.
    """
    return (silver.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("trips"))
            .orderBy(F.col("trips").desc(), F.col("PULocationID").asc()).limit(n))


def weekday_vs_weekend(silver: DataFrame, digits: int | None = None) -> DataFrame:
    """A3: trips and average total for weekday vs weekend pickups."""
    day_type = F.when(weekend_from_day_name(F.col("dow")) == 1, "weekend").otherwise("weekday")
    out = silver.groupBy(day_type.alias("day_type")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg("total_amount").alias("avg_total"),
    )
    return _round(out, ["avg_total"], digits)


def vendor_counts(bronze: DataFrame) -> DataFrame:
    """A4: rows per non-null vendor (the key-count job, without RDDs)."""
    return (bronze.select("VendorID").na.drop()
            .groupBy("VendorID").agg(F.count(F.lit(1)).alias("trips")))


def batch_counts(bronze: DataFrame, batch_col: str = "ingest_batch") -> DataFrame:
    """Rows per ingest batch with a running total.

    The running sum is a window over the aggregated result, whose size is
    the number of batches, not the number of rows.
    """
    per_batch = bronze.groupBy(batch_col).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.orderBy(batch_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_batch.withColumn("cumulative_rows", F.sum("rows").over(w))


def _round(df: DataFrame, cols: list[str], digits: int | None) -> DataFrame:
    if digits is None:
        return df
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------- marts brought up to date by month
#: Partial marts: one row per month and key; they add up to the marts.
PARTIAL_KEYS = {"hourly_stats": "hour", "top_pu_zones": "PULocationID", "wday_vs_wend": "day_type"}


def partial_mart(silver: DataFrame, name: str) -> DataFrame:
    """ym, key, trips, and sums and counts of distance and total: what a month
    adds to a mart."""
    if name == "wday_vs_wend":
        silver = silver.withColumn("day_type", F.when(weekend_from_day_name(F.col("dow")) == 1, "weekend").otherwise("weekday"))
    return silver.groupBy(F.col("ym").cast("string").alias("ym"), F.col(PARTIAL_KEYS[name]).alias("key")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_distance").alias("sum_distance"), F.count("trip_distance").alias("n_distance"),
        F.sum("total_amount").alias("sum_total"), F.count("total_amount").alias("n_total"))


def mart_from_partials(partials: DataFrame, name: str, n: int = 50) -> DataFrame:
    """A1-A3 from the stored partial rows of all months."""
    key = PARTIAL_KEYS[name]
    total = partials.groupBy(F.col("key").alias(key)).agg(F.sum("trips").alias("trips"), *[
        (F.sum(f"sum_{c}") / F.sum(f"n_{c}")).alias(f"avg_{c}") for c in ("distance", "total")])
    if name == "hourly_stats":
        return total
    if name == "wday_vs_wend":
        return total.drop("avg_distance")
    return total.select(key, "trips").orderBy(F.desc("trips"), key).limit(n)
