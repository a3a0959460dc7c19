"""Sinks: overwrite and partitioned writes (K2-K4, K6), schema-merging
append (K1), report CSV (K5), capped prediction export (K10), temp view
(K9). Formats are validated before any job starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tripspark.operators.quantiles import smallest_n
from tripspark.operators.sampling import row_key
from tripspark.sources import manifest
from tripspark.sources.readers import FILES_PER_WRITE, listed_files, plain_path, read_files, read_table
from tripspark.schemas import BRONZE_SCHEMA

FORMATS = ("parquet", "csv", "delta")


def check_format(fmt: str) -> str:
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"cannot write {fmt!r}, only {', '.join(FORMATS)}")
    return fmt


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, dynamic_overwrite: bool = False,
                single_file: bool = False, rebalance: bool = False, files: int | None = None) -> str:
    """K2/K3/K4/K6: write ``df`` to ``path``.

    * ``partition_by``: folder per value (e.g. ``ym``); with
      ``dynamic_overwrite`` only the partitions present in ``df`` are
      replaced, so a rerun of one month leaves the others alone;
    * ``rebalance``: a ``REBALANCE`` hint (on the partition columns, if
      any): AQE cuts the data into evenly sized output files and splits a
      hot value over several tasks, instead of every task writing a small
      file per folder (costs one shuffle);
    * ``files``: ``coalesce(files)`` before writing (fewer output files
      without a shuffle; it also narrows the last stage, use with care);
    * ``single_file``: one output file, only for reports whose size is
      bounded by construction (e.g. per-hour slices); large outputs stay
      multi-file;
    * ``csv`` always writes a header.
    """
    fmt = check_format(fmt)
    if rebalance:
        df = df.hint("rebalance", *(partition_by or []))
    if files:
        df = df.coalesce(files)
    if single_file:
        df = df.coalesce(1)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "delta":
        w.format("delta").save(path)
    else:
        w.parquet(path)
    return path


def append(df: DataFrame, path: str) -> str:
    """K1: append files to a plain Parquet table. Columns new to the table
    are allowed; read with ``merge_schema``. (Bronze tables are appended to
    by ``ingest_files``, which never adds a file twice.)"""
    df.write.mode("append").parquet(path)
    return path


def fit_to_table(df: DataFrame, table: T.StructType, source: str) -> DataFrame:
    """Columns that the table knows, in the wider of both types; a column
    whose types have no common one is refused."""
    known = {f.name: f.dataType for f in table.fields}
    cols = []
    for f in df.schema.fields:
        have = known.get(f.name)
        dtype = f.dataType if have is None else manifest.wider(have, f.dataType)
        if dtype is None:
            raise TypeError(f"{source}: column {f.name} has type {f.dataType.simpleString()}, "
                            f"the table holds {have.simpleString()}")
        cols.append(F.col(f"`{f.name}`") if dtype == f.dataType else F.col(f"`{f.name}`").cast(dtype).alias(f.name))
    return df.select(*cols)


def write_files(spark: SparkSession, files: Sequence[tuple[str, int, int]], bronze_path: str, origin: str,
                row_id: str | None = None) -> None:
    """``(path, batch, number)`` files in one write, then into the manifest."""
    df = read_files(spark, files, row_id=row_id)
    df = fit_to_table(df, manifest.table_schema(manifest.layouts(spark, bronze_path)), ", ".join(f for f, _, _ in files[:3]))
    columns = T.StructType([f for f in df.schema.fields if f.name != "ingest_batch"])
    # replaces what a write that died may have left in these batches' folders
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_batch")
     .parquet(manifest.layout_path(bronze_path, columns)))
    manifest.append(spark, bronze_path, list(files), origin, columns)


def ingest_listed(spark: SparkSession, listed: DataFrame, bronze_path: str, files_per_batch: int = 4,
                  row_id: str | None = None, origin: str = manifest.BATCH_JOB) -> list[int]:
    """S1 + K1: add the ``listed`` files (column ``file``) that the Bronze table
    does not hold yet, in batches of ``files_per_batch`` sorted files.

    The table's manifest says which files it holds: these are skipped, so a
    rerun adds nothing whatever its batch size, and new files get numbers
    behind the last finished batch. A write that a failure cut short is not
    in the manifest; its files are ingested again. Up to ``FILES_PER_WRITE``
    files go through one write, in a number of jobs that does not depend on how
    many they are. ``row_id`` names a bigint column to add, unique in the
    table. Returns the batch ids written.
    """
    written: list[int] = []
    most = max(files_per_batch, FILES_PER_WRITE // files_per_batch * files_per_batch)
    while new := manifest.new_files(spark, bronze_path, listed, most):
        batch, number = manifest.next_numbers(spark, bronze_path)
        files = [(f, batch + i // files_per_batch, number + i) for i, f in enumerate(new)]
        write_files(spark, files, bronze_path, origin, row_id)
        written += sorted({b for _, b, _ in files})
        if len(new) < most:
            break
    return written


def ingest_files(spark: SparkSession, paths: Sequence[str], bronze_path: str,
                 files_per_batch: int = 4, row_id: str | None = None) -> list[int]:
    """:func:`ingest_listed` of some paths; no path is an error."""
    if not paths:
        raise FileNotFoundError("no input files found")
    listed = spark.createDataFrame([(plain_path(p),) for p in paths], "file string")
    return ingest_listed(spark, listed, bronze_path, files_per_batch, row_id)


def ingest_folder(spark: SparkSession, pattern: str, bronze_path: str, files_per_batch: int = 4,
                  row_id: str | None = None) -> list[int]:
    """:func:`ingest_listed` of a folder or glob; no file is an error."""
    listed = listed_files(spark, pattern)
    if listed.isEmpty():
        raise FileNotFoundError(f"no input files found in {pattern}")
    return ingest_listed(spark, listed, bronze_path, files_per_batch, row_id)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The Bronze table with all schema versions merged; ``ingest_batch``
    comes from the folder names. Only batches in the manifest are read; in a
    plain Parquet table it may be a column like any other."""
    df = manifest.read(spark, path)
    if df is None:  # a plain Parquet table
        df = read_table(spark, path, merge_schema=True)
        if "ingest_batch" in df.columns:
            df = df.withColumn("ingest_batch", F.col("ingest_batch").cast("bigint"))
    return df


def write_report_csv(df: DataFrame, path: str, order_by: Sequence[str] | None = None) -> str:
    """K5: a small report as a single CSV file with a header, optionally
    sorted (the report is small, so the sort is too)."""
    if order_by:
        df = df.orderBy(*order_by)
    return write_table(df, path, fmt="csv", single_file=True)


def export_predictions(df: DataFrame, path: str, key: str | None = None, n: int = 10000) -> str:
    """The first ``n`` rows by ``key`` as one CSV (the cap is the
    feature: a download-sized extract). Only about ``n`` rows reach the
    single writing task (see ``capped``)."""
    return write_report_csv(capped(df, key, n), path)


def capped(df: DataFrame, key: str | None = None, n: int = 10000) -> DataFrame:
    """A keyed, reproducible replacement for an unordered ``limit``:
    the first ``n`` rows by a numeric ``key`` (large ``n`` goes through
    the threshold search of ``smallest_n``)."""
    key = row_key(df, key)
    return smallest_n(df, n, [F.col(key)], F.col(key))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """K9: expose ``df`` to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


__all__ = ["write_table", "append", "ingest_files", "ingest_folder", "read_bronze",
           "write_report_csv", "export_predictions", "capped", "register_view", "BRONZE_SCHEMA"]
