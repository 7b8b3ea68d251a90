"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution is what splits skewed join partitions and merges tiny ones at run
# time; partition counts start high and are coalesced towards the advisory size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", app: str = "vitalmart", **extra) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    partitions = "8" if cores == "*" else str(cores)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": partitions,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        # Call-site capture per column expression triples the time wide plans take to build.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    A cluster names that folder, since executors cannot see each other's local disks; where
    the setting is absent, as in tests, one is made and set for the session.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = tempfile.mkdtemp(prefix="vitalmart-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system Spark knows; nothing happens where none is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
