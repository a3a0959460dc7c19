"""Incremental Bronze ingest with Structured Streaming.

The batch loop "read 4 files, append" becomes a file stream with
``maxFilesPerTrigger`` and ``trigger(availableNow=True)``: the checkpoint
records which files were taken, so a rerun over the same folder adds no
rows, and new files are picked up by the next run.

The stream only decides which files make a micro-batch; their rows are read
by the same code as in the batch job (``sinks.write_files``), so renamed,
drifting and undeclared columns are handled alike and no column is lost. What
is written is decided by the table's manifest alone: the files of the
micro-batch that it does not list go under the table's next batch number. A
retried micro-batch (foreachBatch is at-least-once), a checkpoint that was lost
or set up anew, and files that the batch job has taken therefore neither lose
nor repeat a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripspark.schemas import BRONZE_SCHEMA
from tripspark.sources.readers import file_name
from tripspark.sources.sinks import ingest_listed


def ingest_stream(spark: SparkSession, source_dir: str, bronze_path: str, checkpoint: str,
                  files_per_trigger: int = 4, available_now: bool = True, row_id: str | None = None) -> StreamingQuery:
    """Start the ingest stream; with ``available_now`` it stops by itself
    once every file present at start is ingested (``awaitTermination``)."""
    source = (spark.readStream.schema(BRONZE_SCHEMA)
              .option("maxFilesPerTrigger", files_per_trigger)
              .option("recursiveFileLookup", "true")
              .parquet(source_dir)
              .select("_metadata.file_path"))  # no data column is read here

    def take(batch: DataFrame, batch_id: int) -> None:
        listed = batch.select(file_name(batch["file_path"]).alias("file"))
        ingest_listed(spark, listed, bronze_path, files_per_trigger, row_id, origin=checkpoint)

    writer = source.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_ingest(spark: SparkSession, source_dir: str, bronze_path: str, checkpoint: str,
               files_per_trigger: int = 4, row_id: str | None = None) -> str:
    """Run the stream over what is there now and wait for it to finish."""
    q = ingest_stream(spark, source_dir, bronze_path, checkpoint, files_per_trigger, row_id=row_id)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return bronze_path
