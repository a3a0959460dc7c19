"""Bronze ingest: appends, reruns, streams, drifting columns, row ids."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tripspark.sources import manifest
from tripspark.sources import readers as R
from tripspark.sources import sinks as K
from tripspark.streaming.ingest import run_ingest


def _files(spark, folder: str, n: int, rows: int = 10, first: int = 0, columns: str = "") -> str:
    for m in range(first, first + n):
        spark.range(rows).selectExpr(f"id + {m * rows} AS VendorID", *([columns] if columns else [])).coalesce(1).write.parquet(f"{folder}/m{m:02d}")
    return folder


def _ids(spark, bronze):
    return sorted(r.VendorID for r in K.read_bronze(spark, bronze).collect())


def test_second_ingest_appends(spark, scratch):
    bronze = scratch("bronze")
    assert K.ingest_folder(spark, _files(spark, scratch("y1"), 1), bronze) == [0]
    assert K.ingest_folder(spark, _files(spark, scratch("y2"), 1, first=1), bronze) == [1]
    assert _ids(spark, bronze) == list(range(20))


def test_rerun_with_another_batch_size_adds_nothing(spark, scratch):
    src, bronze = _files(spark, scratch("src"), 5), scratch("bronze")
    K.ingest_folder(spark, src, bronze, files_per_batch=1)
    assert K.ingest_folder(spark, src, bronze, files_per_batch=4) == []
    assert _ids(spark, bronze) == list(range(50))


def test_unfinished_batch_is_not_read_and_is_replaced(spark, scratch):
    src, bronze = _files(spark, scratch("src"), 2), scratch("bronze")
    K.ingest_folder(spark, src, bronze, files_per_batch=1)
    # a third batch whose job died before the manifest was written
    spark.range(5).selectExpr("id + 900 AS VendorID").write.parquet(f"{bronze}/ingest_batch=2")
    assert _ids(spark, bronze) == list(range(20))
    assert K.ingest_folder(spark, _files(spark, src, 1, first=2), bronze) == [2]
    assert _ids(spark, bronze) == list(range(30))


def test_stream_after_batch_and_a_new_checkpoint_keep_history(spark, scratch):
    src, bronze = _files(spark, scratch("src"), 3), scratch("bronze")
    K.ingest_files(spark, R.list_files(spark, src)[:1], bronze)
    for _ in range(2):  # a checkpoint that was lost starts all over
        run_ingest(spark, src, bronze, scratch("ckpt"), files_per_trigger=1)
        assert _ids(spark, bronze) == list(range(30))
    assert {r.ingest_batch for r in K.read_bronze(spark, bronze).collect()} == {0, 1, 2}


def test_recreated_checkpoint_at_the_same_path_loses_no_file(spark, scratch):
    """The stream's own batch numbers start again; the new file is not taken
    for one that is there already."""
    src, bronze, ckpt = _files(spark, scratch("src"), 1), scratch("bronze"), scratch("ckpt")
    run_ingest(spark, src, bronze, ckpt, files_per_trigger=1)
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ckpt)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
    other = _files(spark, scratch("other"), 1, first=1)  # a new folder, so the old file is not even listed
    run_ingest(spark, other, bronze, ckpt, files_per_trigger=1)
    assert _ids(spark, bronze) == list(range(20))


def test_retried_micro_batch_and_lost_manifest_row(spark, scratch):
    src, bronze = _files(spark, scratch("src"), 3), scratch("bronze")
    listed = R.listed_files(spark, src)
    assert K.ingest_listed(spark, listed, bronze, 4) == [0]
    assert K.ingest_listed(spark, listed, bronze, 4) == []  # the batch comes again
    files = [("file:///gone", 1, 3)]
    with pytest.raises(Exception):  # dies before its manifest row
        K.write_files(spark, files, bronze, "x")
    assert _ids(spark, bronze) == list(range(30))


def _jobs(spark, run) -> int:
    """Jobs that ``run`` starts."""
    group = "count-jobs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _many(spark, folder: str, n: int) -> str:
    """n one-row files."""
    spark.range(n).selectExpr("id AS VendorID").repartitionByRange(n, "VendorID").write.option("maxRecordsPerFile", 1).parquet(folder)
    return folder


def test_number_of_jobs_is_bounded_for_any_number_of_files(spark, scratch):
    counts = []
    for n in (40, 600):
        src, bronze = _many(spark, scratch("src"), n), scratch("bronze")
        counts.append(_jobs(spark, lambda: K.ingest_folder(spark, src, bronze, files_per_batch=200)))
        df = K.read_bronze(spark, bronze)
        assert df.count() == n and df.select("VendorID").distinct().count() == n
    assert max(counts) <= 30


def test_writes_are_cut_at_the_limit_and_row_ids_go_on(spark, scratch, monkeypatch):
    monkeypatch.setattr(K, "FILES_PER_WRITE", 4)
    src, bronze = _files(spark, scratch("src"), 9), scratch("bronze")
    assert K.ingest_folder(spark, src, bronze, files_per_batch=2, row_id="row_id") == [0, 1, 2, 3, 4]
    rows = K.read_bronze(spark, bronze).collect()
    assert sorted(r.VendorID for r in rows) == list(range(90)) and len({r.row_id for r in rows}) == 90


def test_manifest_is_compacted(spark, scratch, monkeypatch):
    monkeypatch.setattr(manifest, "KEEP_PARTS", 3)
    src, bronze = scratch("src"), scratch("bronze")
    for i in range(8):
        K.ingest_folder(spark, _files(spark, src, 1, first=i), bronze)
    assert _ids(spark, bronze) == list(range(80))
    assert manifest.rows(spark, bronze).count() == 8
    assert len(manifest.rows(spark, bronze).inputFiles()) <= 4


def test_names_with_odd_characters(spark, scratch):
    src, bronze = scratch("odd"), scratch("bronze")
    for i, name in enumerate(("a b", "x+y", "50%25", "\u00e9t\u00e9")):
        spark.range(5).selectExpr(f"id + {5 * i} AS VendorID").coalesce(1).write.parquet(f"{src}/{name}")
    assert K.ingest_folder(spark, src, bronze, row_id="row_id") == [0]
    assert K.ingest_folder(spark, src, bronze) == []
    run_ingest(spark, src, bronze, scratch("ckpt"))
    rows = K.read_bronze(spark, bronze).collect()
    assert sorted(r.VendorID for r in rows) == list(range(20)) and len({r.row_id for r in rows}) == 20


def test_stream_keeps_undeclared_columns(spark, scratch):
    src = _files(spark, scratch("src"), 1, columns="CAST(id AS DOUBLE) AS tip_amount")
    bronze = run_ingest(spark, src, scratch("bronze"), scratch("ckpt"))
    assert sorted(r.tip_amount for r in K.read_bronze(spark, bronze).collect()) == [float(i) for i in range(10)]


def test_drifting_undeclared_columns_widen_or_are_refused(spark, scratch):
    bronze = scratch("bronze")
    for i, kind in enumerate(("BIGINT", "DOUBLE", "INT")):
        K.ingest_folder(spark, _files(spark, scratch("src"), 1, first=i, columns=f"CAST(id AS {kind}) AS RatecodeID"), bronze)
    df = K.read_bronze(spark, bronze)
    assert df.schema["RatecodeID"].dataType == T.DoubleType() and df.count() == 30
    assert sorted(r.RatecodeID for r in df.collect()) == sorted([float(i) for i in range(10)] * 3)
    bad = _files(spark, scratch("bad"), 1, first=9, columns="array(id) AS RatecodeID")
    with pytest.raises(TypeError, match="RatecodeID.*array"):
        K.ingest_folder(spark, bad, bronze)
    assert K.read_bronze(spark, bronze).count() == 30


def test_row_ids_are_unique_and_stay(spark, scratch):
    bronze, src = scratch("bronze"), _files(spark, scratch("src"), 3)
    K.ingest_folder(spark, src, bronze, files_per_batch=2, row_id="row_id")
    first = {r.VendorID: r.row_id for r in K.read_bronze(spark, bronze).collect()}
    K.ingest_folder(spark, _files(spark, src, 2, first=3), bronze, files_per_batch=2, row_id="row_id")
    after = {r.VendorID: r.row_id for r in K.read_bronze(spark, bronze).collect()}
    assert len(set(after.values())) == 50 and None not in after.values()
    assert all(after[k] == v for k, v in first.items())


def test_widest_types():
    assert manifest.wider(T.IntegerType(), T.LongType()) == T.LongType()
    assert manifest.wider(T.LongType(), T.FloatType()) == T.DoubleType()
    assert manifest.wider(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert manifest.wider(T.StringType(), T.LongType()) is None


def test_folder_with_a_table_log_is_never_bare_parquet(spark, scratch):
    path = scratch("logged")
    spark.range(3).write.parquet(path)
    jvm = spark.sparkContext._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{path}/_delta_log")
    log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(log)
    with pytest.raises(Exception) as e:  # the table format's reader is not on the classpath
        R.read_any(spark, path).count()
    assert "delta" in str(e.value).lower()
    with pytest.raises(ValueError):
        R.read_any(spark, scratch("p"), "parquet", schema="a int")
