"""Helpers shared by the operators: Arrow batch limits, code shipping,
per-process caches, scratch tables."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from tripspark.session import scratch_path

ARROW_CONF = {
    # an Arrow batch is handed to Python whole, so its bytes are bounded
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches and ship the library's code by value, so that
    executors need no copy of the repository."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    prefix = __name__.partition(".")[0]
    for name, module in list(sys.modules.items()):
        if (name == prefix or name.startswith(prefix + ".")) and module is not None:
            cloudpickle.register_pickle_by_value(module)


def process_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process (workers are
    reused between tasks). Only for values that can be rebuilt any time."""
    holder = sys.modules.setdefault("_llm_process_cache", types.ModuleType("_llm_process_cache"))
    return holder.__dict__.setdefault(name, {})


def release_caches() -> None:
    """Free what :func:`process_cache` holds: tasks that do not need it make
    room, as a worker process goes from one stage to the next."""
    holder = sys.modules.get("_llm_process_cache")
    for value in vars(holder).values() if holder else ():
        if isinstance(value, dict):
            value.clear()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, which ``session.clear_scratch``
    removes at the end of a job."""
    return scratch_path(spark, f"llm-{name}")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and
    survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path made by :func:`scratch`."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
