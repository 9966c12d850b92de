"""Session settings and the shared staging folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


SHUFFLE_TASK_BYTES = 256 * 1024 * 1024


def sized_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves ``shuffled_bytes``.

    Tasks start at about 256 MB, so that sorts and hash tables fit an executor core; adaptive execution then merges
    small ones and splits skewed ones.
    """
    tasks = max(cores, -(-shuffled_bytes // SHUFFLE_TASK_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_TASK_BYTES),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16MB",
        "spark.sql.files.maxPartitionBytes": str(SHUFFLE_TASK_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * SHUFFLE_TASK_BYTES),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def build_session(app_name: str = "questmart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; where it is unset, a folder of the warehouse, which is shared too."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staging"


def new_stage_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the staging folder and read it back: lineage ends there and columns stay prunable."""
    path = new_stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Folders that a writing task may hold open at once; only rows of folders beyond that are sorted by folder.
OPEN_FOLDERS = 16


@contextmanager
def open_folders(spark: SparkSession, count: int = OPEN_FOLDERS) -> Iterator[None]:
    """Inside, a write into few folders streams its rows. Else each task first sorts all its rows by folder, in memory that
    grows with what the task reads."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(count))
    try:
        yield
    finally:
        spark.conf.set(name, before)
