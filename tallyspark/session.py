"""Session settings that the transforms rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "tallyspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times, adaptive execution and dynamic partition overwrite.

    Shuffle partitions stay at Spark's default unless given; adaptive execution
    coalesces them on small inputs and splits skewed ones on large inputs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def local_session(cores: int | None = None, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    n = cores or os.cpu_count() or 2
    return build_session(
        master=f"local[{n}]",
        **({"spark.sql.shuffle.partitions": str(n), "spark.driver.memory": "8g", "spark.driver.host": "127.0.0.1"} | conf),
    )


def partitions(spark: SparkSession) -> int:
    """The number of partitions with which a shuffle begins."""
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions"))


#: What a task gets at most of a shuffle that adaptive execution lays out, as sent.
TASK_BYTES = "16m"


def size_partitions(spark: SparkSession, rows: int, most: int) -> None:
    """Let shuffles begin with, and scans have, so many partitions that a task gets about ``most`` rows of the largest table.

    Tasks then need the same memory however large the tables are. Adaptive execution puts small partitions together, up to
    TASK_BYTES as sent: keys and counts are sent in a tenth of their size in memory, so its own 64 MB would be most of a GB in a task.
    """
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // most))
    for name in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.minPartitionNum"):
        spark.conf.set(name, str(number))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs within leave no shuffle files behind: those of each go when it ends, not when the driver happens to collect garbage.

    A job that writes a table is not run again, so nobody needs its files. Spark makes them again should it be.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store its path names."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    if not path_exists(spark, folder):
        return []
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return [f.getPath().getName() for f in found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(found)]


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder for a job's tables, in the folder that spark.checkpoint.dir names (all machines share it).

    Where the setting is absent on a local master, as in tests on one machine, a temporary folder is taken.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-work-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
