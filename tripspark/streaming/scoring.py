"""Micro-batch scoring with Structured Streaming.

Scoring is a projection with the fitted coefficients in the plan, so it
runs directly on the streaming DataFrame; the Parquet file sink with a
checkpoint writes each micro-batch exactly once.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripspark.operators import ml
from tripspark.operators.scoring import features_for_scoring, score


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, model_path: str,
                 output_path: str, checkpoint: str, mode: str = "features",
                 files_per_trigger: int = 16, available_now: bool = True) -> StreamingQuery:
    model = ml.load(model_path)
    source = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source_dir))
    scored = score(model, features_for_scoring(source, mode))
    writer = (scored.writeStream.format("parquet").option("path", output_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_scoring(spark: SparkSession, source_dir: str, schema: T.StructType, model_path: str,
                output_path: str, checkpoint: str, mode: str = "features") -> str:
    q = score_stream(spark, source_dir, schema, model_path, output_path, checkpoint, mode)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return output_path
