"""Session settings the jobs rely on, and the shared scratch area."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# All time is UTC, failed casts are errors unless a try_ function is used, and AQE
# re-plans joins, skewed partitions and small outputs from measured sizes. The JVM never
# compiles a method of over 8000 bytes of bytecode, which a wide projection fused with a
# join exceeds: above that size Spark splits the expressions instead, 3 times faster here.
# The small minimum partition size keeps all cores busy when little data goes to many
# partition directories, where opening files is the work; it has no effect on large data.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8KB",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.files.maxPartitionBytes": "16MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    cores = spark.sparkContext.defaultParallelism
    # A task per directory is too many where a table has thousands of small ones.
    listing = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * cores)}
    for key, value in {**SETTINGS, **listing}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Spark drops the files of a shuffle when the driver happens to collect its garbage; with this, at
# the end of the query that made them. Older versions do not know it.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in here drop their shuffle files when they end, as nothing reads these again."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is made
    only for a local master, where driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sluiceway-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_OWNED: set[str] = set()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder.

    All paths of an application lie in one folder, which its driver removes when it ends.
    """
    owned = f"{scratch_root(spark)}/sluiceway/{spark.sparkContext.applicationId}"
    if owned not in _OWNED:
        path = spark._jvm.org.apache.hadoop.fs.Path(owned)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _OWNED.add(owned)
    return f"{owned}/{label}-{uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage so that several consumers do not recompute it, survives the loss of
    executors, and gives Catalyst the real file size: a following join broadcasts the
    table only if it is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
    shuffles, with AQE splitting skewed keys.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
