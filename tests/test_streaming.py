from __future__ import annotations

from pyspark.sql import functions as F

from tripspark.operators import ml, sampling
from tripspark.operators.scoring import score
from tripspark.plans import catalog
from tripspark.plans.catalog import _write_raw_files, features_df
from tripspark.sources.readers import read_table
from tripspark.sources.sinks import read_bronze
from tripspark.streaming import silver as silver_stream
from tripspark.streaming.ingest import run_ingest
from tripspark.streaming.scoring import run_scoring

SF = "/root/testdata/sf0.001"


def test_stream_ingest_restart_adds_nothing_and_picks_up_new_files(spark, scratch):
    files = _write_raw_files(spark, SF)
    src = files[0].split("/src_month=")[0]
    bronze, ckpt = scratch("bronze"), scratch("ckpt")
    run_ingest(spark, src, bronze, ckpt, files_per_trigger=4)
    first = read_bronze(spark, bronze)
    n1, batches = first.count(), first.select("ingest_batch").distinct().count()
    assert n1 == 1020 and batches == 4
    run_ingest(spark, src, bronze, ckpt, files_per_trigger=4)
    assert read_bronze(spark, bronze).count() == n1
    extra = first.limit(7).drop("ingest_batch").withColumn("event_id", F.col("event_id") + 10**12)
    extra.coalesce(1).write.parquet(f"{src}/src_month=2099-01/src_part=0")
    run_ingest(spark, src, bronze, ckpt, files_per_trigger=4)
    assert read_bronze(spark, bronze).count() == n1 + 7


def test_stream_scoring_equals_batch(spark, scratch):
    feats = features_df(spark, SF)
    tr, _ = sampling.hash_split(feats)
    model = ml.fit_linear(tr)
    mpath = ml.save(model, scratch("model"))
    src = scratch("in")
    feats.write.parquet(src)
    schema = read_table(spark, src).schema
    out = run_scoring(spark, src, schema, mpath, scratch("out"), scratch("ckpt"))
    streamed = read_table(spark, out).select("event_id", "fare_pred")
    batch = score(model, read_table(spark, src)).select("event_id", "fare_pred")
    assert streamed.count() == batch.count() == 909
    assert streamed.exceptAll(batch).count() == 0


def test_silver_stream_batches_do_not_grow_with_the_scan(spark, scratch, monkeypatch):
    src = scratch("events")
    spark.read.parquet(f"{SF}/events.parquet").repartition(6).write.parquet(f"{src}/events.parquet")
    seen, late_rows = [], silver_stream.late_rows

    def counted(query):
        seen.append(sum(p["numInputRows"] > 0 for p in query.recentProgress))
        return late_rows(query)

    monkeypatch.setattr(silver_stream, "late_rows", counted)
    want = catalog.silver_df(spark, src)
    months = want.select("ym").distinct().count()
    for file_rows, most in ((250_000, 1), (40, 2)):  # at 40 rows a file, up to 16 files a micro-batch
        monkeypatch.setattr(catalog, "STREAM_FILE_ROWS", file_rows, raising=False)
        got = catalog.q_silver_stream_dedupe(spark, src).select(*want.columns)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
        assert sum(seen) <= 2 * months * most
        seen.clear()
