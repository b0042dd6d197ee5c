"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Stored files hold some 25 times their size in memory: a task that scanned the 128 MB of Spark's default would spill
# what it sorts. Every step writes a table, so its shuffle files are of no use afterwards: left alone, they stay on
# disk until the driver happens to collect its garbage.
STORED_TABLES = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A session for tests and benches on one machine. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "64")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> None:
    """Settings for steps that write tables and read them again, where the session does not say otherwise."""
    for key, value in STORED_TABLES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only where the session names none (tests on one machine) a temporary folder is made and set.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return made


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
