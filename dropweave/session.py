"""Session settings and staged tables."""

from __future__ import annotations

import atexit
import gc
import math
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
MAX_PARTITIONS = 100_000
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 * 1024 * 1024  # of compressed files

_local_roots: dict[str, str] = {}

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
}


def build_session(app: str = "dropweave", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs count on; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def input_bytes(spark: SparkSession, path: str, glob: str = "*") -> int:
    """Total size of the files under a path, from their listing."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(path))
    return files.agg(F.sum("length")).first()[0] or 0


def size_shuffles(spark: SparkSession, input_bytes: int, most: int = MAX_PARTITIONS) -> int:
    """Start adaptive shuffles with enough partitions for ``input_bytes``.

    Adaptive execution merges small shuffle partitions but cannot add any, so the number
    to start from has to follow the input.  Never goes below the configured number.
    """
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(most, max(floor, math.ceil(input_bytes / TARGET_PARTITION_BYTES)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted


def pin_splits(spark: SparkSession) -> None:
    """Make later scans cut files as they would be cut now.

    The size of splits follows the number of cores unless ``spark.sql.files.minPartitionNum`` is set, and cores come and go
    while a job runs.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(max(1, spark.sparkContext.defaultParallelism)))


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own, because there
    driver and executors are one machine.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = _local_roots.get(app) or _local_root(app)
    return f"{configured.rstrip('/')}/dropweave/{app}"


def _local_root(app: str) -> str:
    """A folder of a local session, deleted when the process ends."""
    root = _local_roots[app] = tempfile.mkdtemp(prefix="dropweave-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def file_bytes(staged: DataFrame) -> int:
    """Size of a staged table's files, as Catalyst knows it."""
    return int(str(staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(staged: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged table for broadcast when its rows and the bytes of its files are within the bounds.

    The count comes from the file footers.  Beyond the bounds the join is left to Catalyst,
    which then shuffles.
    """
    small = file_bytes(staged) <= max_bytes and staged.count() <= max_rows
    return F.broadcast(staged) if small else staged


def stage(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Later stages then start from a table: a lost executor costs a re-read instead of a
    re-run, ids taken from row positions stay what they were, and Catalyst knows the
    table's true size when it decides whether to broadcast it.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what was made of them must be staged itself."""
    for df in staged:
        spark = df.sparkSession
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs, which otherwise stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def clear_staging(spark: SparkSession) -> None:
    """Delete what this application staged.  Call it when no staged DataFrame is in use any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
