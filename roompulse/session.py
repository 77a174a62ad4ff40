"""Session settings the plans assume, the shared folder they may write to, and how the session reads patterns."""

from __future__ import annotations

import os
import uuid
from functools import cache
from urllib.parse import urlparse

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Top-k per key is cut in each task before the shuffle for every k in use.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def build_session(app: str = "roompulse", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; the cluster's own settings win for sizes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(checkpoints: str | None, warehouse: str, master: str) -> str:
    """The folder for intermediate tables: the cluster's own, or the warehouse where that is shared or all is one machine."""
    if checkpoints:
        return checkpoints
    if urlparse(warehouse).scheme in ("", "file") and not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return os.path.join(warehouse, "_intermediate")


def _application_folder(spark: SparkSession) -> str:
    conf = spark.conf
    root = shared_root(conf.get("spark.checkpoint.dir", None), conf.get("spark.sql.warehouse.dir"), conf.get("spark.master", "local"))
    return os.path.join(root, "roompulse", conf.get("spark.app.id", "application"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``; where it is unset,
    the warehouse holds it if that is shared.
    """
    return os.path.join(_application_folder(spark), f"{name}-{uuid.uuid4().hex}")


def clear_shared_folders(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; results that still read them must be written before."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@cache
def character_ranges(pattern: str) -> list[tuple[int, int]]:
    """First and last characters of the runs that Spark's own patterns count to a class, as Python's Unicode may be another."""
    points = SparkSession.active().range(1, 0x110000).filter("id NOT BETWEEN 55296 AND 57343")

    def counted(point: Column) -> Column:
        return F.rlike(F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"), F.lit(pattern))

    last = F.when(F.col("id") == 0xE000, 0xD7FF).otherwise(F.col("id") - 1)
    edges = sorted(r["id"] for r in points.filter(counted(F.col("id")) != counted(last)).collect())
    return [(lo, hi - 1) for lo, hi in zip(edges[::2], edges[1::2])]
