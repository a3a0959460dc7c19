"""Session construction and the shared scratch folder.

Library operators never build a session; tests, the bench and the jobs in
``tripspark.plans`` do, through :func:`build_session`.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_MADE: list[str] = []  # locations handed out by scratch_path


def build_session(master: str | None = None, app_name: str = "tripspark",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and command-line jobs.

    On a cluster, ``master`` stays None and the cluster's own settings win;
    only settings that decide results (UTC session zone) are forced.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # remove checkpoint files once their DataFrame is garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = os.environ.get("TRIPSPARK_DRIVER_MEMORY", "8g")
        conf["spark.ui.enabled"] = "false"  # tests and bench: no web UI
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    When it is unset (local tests), a local folder is set as checkpoint dir;
    on a cluster an unset value is an error, since a machine-local folder is
    not visible to other executors.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="tripspark-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared folder."""
    path = f"{shared_dir(spark)}/tripspark/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back: the
    lineage is cut, readers prune columns, and a lost executor re-reads
    files. :func:`clear_scratch` removes what a session has written."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete everything this process has put under the shared folder with
    :func:`scratch_path`; returns the number of locations. For the end of a
    job: DataFrames that still read them no longer work."""
    jvm = spark.sparkContext._jvm
    n = len(_MADE)
    while _MADE:
        hpath = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
    return n


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop FileSystem, so it
    works for local folders, HDFS and object stores)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def scale_conf(total_bytes: int, partition_bytes: int = 1 << 30, min_partitions: int = 200,
               max_partitions: int = 20_000, scan_bytes: int = 256 << 20) -> dict[str, str]:
    """SQL settings sized for a job over ``total_bytes`` of input.

    Shuffle partitions aim at ``partition_bytes`` and stay in the low tens of
    thousands: the number of shuffle blocks is map tasks times partitions, and
    the driver keeps track of them. Beyond that, partitions grow and AQE splits
    the large ones; it merges the small ones where much has been filtered out.
    """
    n = min(max_partitions, max(min_partitions, -(-total_bytes // partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(max(scan_bytes, min(partition_bytes, total_bytes // max_partitions))),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(scan_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def tune_for(spark: SparkSession, path: str, **kw) -> dict[str, str | None]:
    """Apply ``scale_conf`` for the input at ``path`` to the session; returns
    the settings as they were, for :func:`restore`."""
    conf = scale_conf(input_bytes(spark, path), **kw)
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return before


def restore(spark: SparkSession, before: dict[str, str | None]) -> None:
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
