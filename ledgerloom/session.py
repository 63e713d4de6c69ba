"""Session settings and lineage cuts shared by every job."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Only settings that change results or skew handling; sizes (shuffle partitions,
# memory, checkpoint folder) belong to the cluster.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when a later operator then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A side of up to 4 MB goes to every executor, and a partition that fits a local hash table
    # is not sorted first. Sizes are those of compressed files; the driver holds such a side
    # as hash table, which takes ten to forty times as much.
    "spark.sql.autoBroadcastJoinThreshold": "4MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128MB",
    # HotSpot never compiles a method beyond 8000 bytes. The cleaning of a wide row as one
    # generated method would be interpreted, so beyond that size it is split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# Below this estimate, moving rows costs more than it saves.
SPREAD_BYTES = 4 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate, from file sizes and the plan; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a few large splits (one compressed file, say) out to all cores before
    costly work per row. Inputs with enough splits, as large tables have, stay as they are, and
    so does everything that is shuffled already: counting its partitions would run it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) < SPREAD_BYTES or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a session on a single machine without one gets a
    folder of its own, which goes when the driver ends."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = _own_folders.get(context.applicationId)
        if shared is None:
            shared = _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="ledgerloom-")
            atexit.register(shutil.rmtree, shared, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared)
    return shared.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps what it has cut off."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


# The paths handed out in each open ``scratch``.
_scratches: list[list[str]] = []


def fresh_path(spark: SparkSession) -> str:
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    if _scratches:
        _scratches[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """For a step whose result is written elsewhere: what is cut off inside goes at the end, when nothing reads it any more."""
    paths: list[str] = []
    _scratches.append(paths)
    try:
        yield
    finally:
        _scratches.pop()
        for path in paths:
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what was cut off there. Frames made of it are lost."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def remove_run_folder(spark: SparkSession) -> None:
    """At the end of a job: delete everything that was cut off. Frames made of it are lost."""
    remove_path(spark, run_folder(spark))


def release(spark: SparkSession) -> None:
    """Between the steps of a long job: Spark deletes the shuffle files and broadcasts of finished frames only when
    the driver collects its garbage, which plans make much of and a heap with room puts off. Spark's event queues hold on
    to the last query until the next one ends, so one without a job comes first."""
    spark.sql("SELECT 1").collect()
    gc.collect()  # frames that Python still holds
    spark._jvm.System.gc()


# Takes about half the disk of Spark's usual codec, and more processor time.
PACKED = "zstd"


def cut(df: DataFrame, path: str | None = None, packed: bool = False) -> DataFrame:
    """Write a frame to the shared folder and go on from there. What follows reads only the
    columns it needs, knows the true size, and does not repeat the work before the cut, also
    not when an executor is lost. ``path`` is for a frame that outlives the ``scratch`` it is
    made in. Inside one, and with ``packed``, the files are made small."""
    spark = df.sparkSession
    path = path or fresh_path(spark)
    (df.write.option("compression", PACKED) if packed or _scratches else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
