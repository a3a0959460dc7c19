"""Silver as a stream: cleaned and de-duplicated as files arrive.

``dropDuplicatesWithinWatermark`` keeps the key of a trip as state until the
event time has passed by ``delay``: a copy that arrives within that time is
dropped, and state does not grow with history. The first of a key to arrive
stays; which of several in one micro-batch is up to Spark. Rows later than
``delay`` are dropped and counted (:func:`late_rows`): whether they are copies
can no longer be told. Restarts go on from the checkpoint, and the Parquet file
sink writes each micro-batch exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripspark.operators.silver import clean, derive, harmonize_names, typed
from tripspark.schemas import BRONZE_SCHEMA, SILVER_KEY

EVENT_TIME = "tpep_pickup_datetime"


def silver_stream(bronze: DataFrame, key: Sequence[str] = tuple(SILVER_KEY), delay: str = "45 days") -> DataFrame:
    """Streaming Bronze rows -> Silver rows, each key once."""
    rows = clean(typed(harmonize_names(bronze))).withWatermark(EVENT_TIME, delay)
    return derive(rows.dropDuplicatesWithinWatermark(list(key)))


def start(spark: SparkSession, source_dir: str, silver_path: str, checkpoint: str, schema: T.StructType = BRONZE_SCHEMA,
          delay: str = "45 days", files_per_trigger: int = 16, available_now: bool = True) -> StreamingQuery:
    source = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .option("recursiveFileLookup", "true").parquet(source_dir))
    writer = (silver_stream(source, delay=delay).writeStream.format("parquet").option("path", silver_path)
              .option("checkpointLocation", checkpoint).partitionBy("ym").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's recent micro-batches dropped as too late."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def run_silver(spark: SparkSession, source_dir: str, silver_path: str, checkpoint: str, schema: T.StructType = BRONZE_SCHEMA,
               delay: str = "45 days", files_per_trigger: int = 16) -> int:
    """Run over what is there now; returns the number of late rows."""
    q = start(spark, source_dir, silver_path, checkpoint, schema, delay, files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return late_rows(q)
