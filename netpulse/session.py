"""Session settings and the shared staging area."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "netpulse", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the engine's settings; cluster sizing is left to the submitter."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Shuffle bytes per task.
TASK_BYTES = 200 << 20


def sized_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Partition settings for a job that shuffles about ``shuffle_bytes``.

    Starts with enough partitions for each to fit in a task's memory; adaptive
    execution merges those that turn out small.
    """
    wanted = max(2 * cores, -(-shuffle_bytes // TASK_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(wanted),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
    }


_local_areas: dict[str, str] = {}
_staged: list[str] = []
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    Called by the operators that run Python on executors, so that it does not
    matter where the driver was started or whether the package is installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="netpulse-"), "netpulse.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def staging_root(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a folder of
    its own, because a machine-local folder would be lost with an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_areas:
        _local_areas[app] = tempfile.mkdtemp(prefix="netpulse-")
    return _local_areas[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative MLlib fits a checkpoint folder to cut their lineage in."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(staging_root(spark))


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several later passes need the same expensive frame: the lineage
    is cut, a lost executor costs nothing upstream, and every later pass reads
    only the columns it needs.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession, keep: int = 0) -> int:
    """Delete staged frames, the oldest ``keep`` excepted; whatever reads them must no longer be used."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    released = 0
    while len(_staged) > keep:
        path = hadoop.Path(_staged.pop())
        released += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return released


@contextmanager
def short_lived_stages(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block: for jobs whose results are saved tables."""
    before = len(_staged)
    try:
        yield
    finally:
        release_staged(spark, before)
