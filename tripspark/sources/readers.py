"""Sources: table scans (S2, S3), CSV (S4), format dispatch (S5) and the
multi-file, schema-tolerant Bronze ingest (S1).

File listing goes through the Hadoop FileSystem of the session, so the
same code lists local folders, HDFS or object stores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tripspark.operators.silver import harmonize_names
from tripspark.schemas import BRONZE_ALIASES, BRONZE_SCHEMA

FORMATS = ("parquet", "csv", "delta")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               months: Sequence[str] | None = None, merge_schema: bool = False) -> DataFrame:
    """Scan a table folder. ``months`` filters the ``ym`` partition
    column, which prunes whole folders at planning time."""
    fmt = fmt.lower()
    if fmt == "parquet":
        df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    elif fmt == "delta":
        df = spark.read.format("delta").load(path)  # needs the Delta jar on the classpath
    elif fmt == "csv":
        df = read_csv(spark, path)
    else:
        raise ValueError(f"fmt must be one of {FORMATS}, got {fmt!r}")
    if months:
        df = df.where(F.col("ym").isin(list(months)))
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer_schema: bool = False) -> DataFrame:
    """CSV with a header. An explicit schema avoids the extra pass that
    inference costs; without one, every column is read as text."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
                     multi_line: bool = False, record_col: str = "record", reason_col: str = "reject_reason") -> DataFrame:
    """CSV under a typed schema, with nothing lost or silently nulled.

    One row per record: the declared columns, ``reject_reason`` (null for a
    good record) and ``record`` (the text of a rejected one; with a
    bad value, its fields as CSV again). Reasons, the
    first that holds: ``open quote``, ``short line``, ``long line``,
    ``bad value: <column>`` for the first column whose text does not convert.
    What can be read of a rejected record is kept, the rest is null. Quotes
    inside quoted fields are doubled; one left open swallows the fields after
    it (in the last field it costs nothing and is no fault). An empty field is null and no fault;
    empty lines are no records.

    One scan: fields are read as text (so a record is malformed only by its
    number of fields) and converted by ``try_cast``. ``multi_line`` allows
    line breaks in quoted fields; a file is then read by one task, so large
    inputs should come as many files. Otherwise files are split.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    taken = {f.name.lower() for f in declared.fields} & {record_col.lower(), reason_col.lower(), "_malformed"}
    if taken:
        raise ValueError(f"the schema already has {sorted(taken)}: name record_col and reason_col otherwise")
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in declared.fields] + [T.StructField("_malformed", T.StringType())])
    raw = (spark.read.schema(text).option("header", str(header).lower()).option("multiLine", str(multi_line).lower())
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_malformed")
           .option("columnPruning", "false")  # a pruned read does not count a line's fields
           .option("quote", '"').option("escape", '"').csv(path))
    bad = F.col("_malformed")
    fields = 1 + F.regexp_count(F.regexp_replace(bad, r'"[^"]*"', ""), F.lit(","))
    reason = (F.when(F.regexp_count(bad, F.lit('"')) % 2 == 1, "open quote")
              .when(fields < len(declared.fields), "short line")
              .when(bad.isNotNull(), "long line"))
    value = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in declared.fields}
    for f in declared.fields:
        reason = reason.when(F.col(f"`{f.name}`").isNotNull() & value[f.name].isNull(), f"bad value: {f.name}")
    # the raw text of a record with a bad value, as CSV again
    quoted = [F.when(F.col(f"`{f.name}`").rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(F.col(f"`{f.name}`"), F.lit('"'), F.lit('""')), F.lit('"')))
              .otherwise(F.coalesce(F.col(f"`{f.name}`"), F.lit(""))) for f in declared.fields]
    record = F.when(reason.isNotNull(), F.coalesce(bad, F.concat_ws(",", *quoted)))
    return raw.select(*[value[f.name].alias(f.name) for f in declared.fields], reason.alias(reason_col), record.alias(record_col))


def read_any(spark: SparkSession, path: str, fmt: str | None = None, **kw) -> DataFrame:
    """Explicit ``fmt``, else the table format if the folder has a table
    log, CSV by suffix, otherwise Parquet. No catch-all fallback: a failing
    read reports its own error, and a folder with a log is never read as bare
    Parquet (that would bring back files the log has removed). ``kw`` goes to
    the CSV reader and is refused for other formats."""
    if fmt is None:
        if path_exists(spark, f"{path.rstrip('/')}/_delta_log"):
            fmt = "delta"
        else:
            fmt = "csv" if path.lower().rstrip("/").endswith(".csv") else "parquet"
    if fmt == "csv":
        return read_csv(spark, path, **kw)
    if any(v for k, v in kw.items() if k != "infer_schema"):
        raise ValueError(f"options {sorted(kw)} are for CSV, the input is {fmt}")
    return read_table(spark, path, fmt)


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted data files matching a glob (or under a folder), skipping
    hidden and ``_``-prefixed entries."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hpath.getFileSystem(conf)
    out: list[str] = []

    def walk(status):
        name = status.getPath().getName()
        if name.startswith((".", "_")):
            return
        if status.isDirectory():
            for child in fs.listStatus(status.getPath()):
                walk(child)
        else:
            out.append(plain_path(status.getPath().toString()))

    for st in fs.globStatus(hpath) or []:
        walk(st)
    return sorted(out)


def plan_batches(paths: Sequence[str], files_per_batch: int = 4) -> list[list[str]]:
    """Sorted paths cut into batches of ``files_per_batch``; empty input is
    an error, as there is nothing to ingest."""
    if not paths:
        raise FileNotFoundError("no input files found")
    paths = sorted(paths)
    return [list(paths[i:i + files_per_batch]) for i in range(0, len(paths), files_per_batch)]


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _compatible(src: T.DataType, dst: T.DataType) -> bool:
    if isinstance(dst, _NUMERIC):
        return isinstance(src, _NUMERIC + (T.StringType,))
    if isinstance(dst, T.TimestampType):
        return isinstance(src, (T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType))
    return True


def conform(df: DataFrame, schema: T.StructType = BRONZE_SCHEMA, source: str = "input") -> DataFrame:
    """Cast a file's columns to the declared schema: aliases renamed, every
    declared column present with its declared type (absent -> null),
    columns not declared kept as they are (schema evolution). Types that
    cannot be converted are refused, naming the source.

    When files using both names were read together, the canonical column
    takes the alias's value where it is null.
    """
    df = harmonize_names(df)
    for alias, canonical in BRONZE_ALIASES.items():
        if alias in df.columns and canonical in df.columns:
            df = df.withColumn(canonical, F.coalesce(F.col(canonical), F.col(alias))).drop(alias)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for field in schema.fields:
        if field.name not in dtypes:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        src = dtypes[field.name]
        if not _compatible(src, field.dataType):
            raise TypeError(f"{source}: column {field.name} has type {src.simpleString()}, "
                            f"cannot become {field.dataType.simpleString()}")
        if src == field.dataType:
            cols.append(F.col(field.name))
        elif isinstance(src, T.StringType) and isinstance(field.dataType, T.TimestampType):
            cols.append(F.try_to_timestamp(F.col(field.name)).alias(field.name))
        else:
            cols.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
    declared = {f.name for f in schema.fields}
    extra = [F.col(c) for c in df.columns if c not in declared]
    return df.select(*cols, *extra)


#: Files read and written together; their names are sent to every task.
FILES_PER_WRITE = 10_000
ROW_BITS = 30  # rows of one file


def _merged_read(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """One scan of all files when their schemas merge (same types, columns
    possibly missing); None when Parquet refuses to merge them."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    except Exception as e:  # only the merge conflict falls back; anything else is raised
        if "CANNOT_MERGE_SCHEMAS" in str(e) or "Failed to merge" in str(e):
            return None
        raise


def plain_path(path: str) -> str:
    """One spelling for a file, however it was listed."""
    return "file:///" + path[5:].lstrip("/") if path.startswith("file:") else path


def _mergeable(spark: SparkSession, paths: Sequence[str]) -> list[tuple[DataFrame, Sequence[str]]]:
    """The files in as few scans as their types allow. One job reads all footers
    (``mergeSchema``); only where types conflict the sorted files are halved,
    so files that drift over time take a few more jobs, not one each."""
    whole = _merged_read(spark, paths)
    if whole is not None:
        return [(whole, paths)]
    half = len(paths) // 2
    out: list[tuple[DataFrame, Sequence[str]]] = []
    for df, files in _mergeable(spark, paths[:half]) + _mergeable(spark, paths[half:]):
        same = next((i for i, (have, _) in enumerate(out) if have.schema == df.schema), None)
        if same is None:
            out.append((df, files))
        else:
            files = [*out[same][1], *files]
            out[same] = (spark.read.schema(df.schema).parquet(*files), files)
    return out


def file_name(column: Column) -> Column:
    """A listed or scanned file's path in one spelling (:func:`plain_path`)."""
    return F.regexp_replace(F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:///")


def listed_files(spark: SparkSession, pattern: str) -> DataFrame:
    """``file``: the data files matching a glob or under a folder, hidden and
    ``_``-prefixed entries skipped. No file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    return found.select(F.regexp_replace("path", "^file:/+", "file:///").alias("file"))


def read_files(spark: SparkSession, files: Sequence[tuple[str, int, int]], schema: T.StructType = BRONZE_SCHEMA,
               row_id: str | None = None) -> DataFrame:
    """``(path, ingest_batch, number)`` files, at most ``FILES_PER_WRITE``
    of them, that may disagree in schema, as one frame with ``ingest_batch``.

    Files whose footers merge are one scan, conformed to ``schema``; columns
    that ``schema`` does not declare take the widest type of all scans, and a
    column without a common type is refused by name. ``row_id`` names a bigint
    column to add: the file's number and the row's place in the file.
    """
    from tripspark.sources.manifest import wider

    if len(files) > FILES_PER_WRITE:
        raise ValueError(f"more than {FILES_PER_WRITE} files at once")
    known = F.broadcast(spark.createDataFrame(list(files), "_file string, ingest_batch bigint, _number bigint"))  # FILES_PER_WRITE rows at most
    parts = []
    for df, paths in _mergeable(spark, [f for f, _, _ in files]):
        tagged = df.select("*", file_name(F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.row_index").alias("_row")).join(known, "_file", "left")
        lost = F.raise_error(F.concat(F.lit("not among the listed files: "), F.col("_file"))).cast("bigint")
        tagged = tagged.withColumn("ingest_batch", F.coalesce("ingest_batch", lost))
        if row_id:
            full = F.raise_error(F.concat(F.lit("too many rows in "), F.col("_file"))).cast("bigint")
            tagged = tagged.withColumn(row_id, F.when(F.col("_row") < 1 << ROW_BITS, F.col("_number") * F.lit(1 << ROW_BITS) + F.col("_row")).otherwise(full))
        parts.append((conform(tagged.drop("_file", "_row", "_number"), schema, source=_some(paths)), paths))
    types: dict[str, T.DataType] = {}
    for part, paths in parts:
        for f in part.schema.fields:
            both = wider(types.get(f.name, f.dataType), f.dataType)
            if both is None:
                raise TypeError(f"{_some(paths)}: column {f.name} has type {f.dataType.simpleString()}, "
                                f"other files have {types[f.name].simpleString()}")
            types[f.name] = both
    out = None
    for part, _ in parts:
        part = part.select(*[F.col(f"`{f.name}`").cast(types[f.name]).alias(f.name) for f in part.schema.fields])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _some(paths: Sequence[str]) -> str:
    return ", ".join(paths[:3]) + (f" and {len(paths) - 3} more" if len(paths) > 3 else "")
