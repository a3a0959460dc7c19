"""The Bronze manifest: which files are in the table, in which batch, and with
which columns.

It lies beside the data in ``_manifest`` (readers of the table skip names that
start with ``_``) as a Parquet table of one row per ingested file, appended to
once per write, after the data. What is not in it does not count: rows of a
write that died are not read, its files are ingested again. After
``KEEP_PARTS`` appends the rows are rewritten as one file in the next version
folder; the newest finished version counts. One writer at a time is assumed, as
for any plain Parquet table.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tripspark.sources.readers import path_exists

#: ``number`` counts the table's files, ``columns`` is the schema of the write.
SCHEMA = "file string, batch bigint, number bigint, origin string, columns string"
BATCH_JOB = "batch"
KEEP_PARTS = 50


def _folder(table: str, version: int) -> str:
    return f"{table.rstrip('/')}/_manifest/v{version:06d}"


def _children(spark: SparkSession, path: str) -> list[str]:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def _version(spark: SparkSession, table: str) -> int | None:
    """The newest version whose write has finished."""
    names = _children(spark, f"{table.rstrip('/')}/_manifest")
    versions = sorted((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), reverse=True)
    return next((v for v in versions if path_exists(spark, f"{_folder(table, v)}/_SUCCESS")), None)


def rows(spark: SparkSession, table: str) -> DataFrame:
    """One row per ingested file."""
    version = _version(spark, table)
    return spark.createDataFrame([], SCHEMA) if version is None else spark.read.schema(SCHEMA).parquet(_folder(table, version))


def append(spark: SparkSession, table: str, files: list[tuple[str, int, int]], origin: str, schema: T.StructType) -> None:
    """Record ``(file, batch, number)`` of one finished write."""
    version = _version(spark, table) or 0
    new = spark.createDataFrame([(f, b, n, origin, schema.json()) for f, b, n in files], SCHEMA)
    new.coalesce(1).write.mode("append").parquet(_folder(table, version))
    if sum(n.startswith("part-") for n in _children(spark, _folder(table, version))) > KEEP_PARTS:
        rows(spark, table).coalesce(1).write.mode("overwrite").parquet(_folder(table, version + 1))


def new_files(spark: SparkSession, table: str, listed: DataFrame, most: int) -> list[str]:
    """The first ``most`` of the ``listed`` files (by name) that the table does
    not hold."""
    new = listed.select("file").distinct().join(rows(spark, table).select("file"), "file", "left_anti")
    return [r["file"] for r in new.orderBy("file").limit(most).collect()]


def next_numbers(spark: SparkSession, table: str) -> tuple[int, int]:
    """The next batch and file number."""
    r = rows(spark, table).agg((F.max("batch") + 1).alias("b"), (F.max("number") + 1).alias("n")).first()
    return r["b"] or 0, r["n"] or 0


def layouts(spark: SparkSession, table: str) -> list[T.StructType]:
    """The different column sets of the table's writes, oldest first."""
    found = rows(spark, table).groupBy("columns").agg(F.min("batch").alias("b")).orderBy("b").collect()
    return [T.StructType.fromJson(json.loads(r["columns"])) for r in found]


def layout_path(table: str, schema: T.StructType) -> str:
    """Writes with the same columns lie in one folder."""
    return f"{table.rstrip('/')}/layout={hashlib.md5(schema.json().encode()).hexdigest()[:12]}"


def table_schema(found: list[T.StructType]) -> T.StructType:
    """Columns of all writes, each in its widest type, in order of first
    appearance."""
    fields: dict[str, T.StructField] = {}
    for f in (f for s in found for f in s.fields):
        have = fields.get(f.name)
        fields[f.name] = f if have is None else T.StructField(f.name, wider(have.dataType, f.dataType) or have.dataType)
    return T.StructType(list(fields.values()))


_RANK = {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3, T.FloatType: 4, T.DoubleType: 5}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both, or None. Whole and floating numbers meet in
    double."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    ra, rb = _RANK.get(type(a)), _RANK.get(type(b))
    if ra is None or rb is None:
        both = {type(a), type(b)}
        return T.TimestampType() if both <= {T.TimestampType, T.TimestampNTZType, T.DateType} else None
    if (ra < 4) != (rb < 4):
        return T.DoubleType()
    return a if ra > rb else b


def read(spark: SparkSession, table: str) -> DataFrame | None:
    """All finished batches, one scan per set of columns, each column in its
    widest type; None without a manifest."""
    found = layouts(spark, table)
    if not found:
        return None
    want = table_schema(found)
    out = None
    for have in found:
        path = layout_path(table, have)
        mine = rows(spark, table).where(F.col("columns") == F.lit(have.json())).select(F.col("batch").alias("ingest_batch")).distinct()
        part = (spark.read.option("basePath", path).schema(T.StructType([*have.fields, T.StructField("ingest_batch", T.LongType())]))
                .parquet(path).join(mine, "ingest_batch", "left_semi"))  # leaves out folders of writes that died
        names = set(have.fieldNames())
        part = part.selectExpr(*[f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" if f.name in names
                                 else f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in want.fields], "ingest_batch")
        out = part if out is None else out.unionByName(part)
    return out
