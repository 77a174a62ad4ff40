"""``foreachBatch`` sinks that may be retried: every micro-batch owns a folder.

A batch that runs again after a failure overwrites its own folder, so rows are
neither lost nor doubled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH = "batch_id"


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Append each micro-batch to a parquet table."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def route_batches(routes: Mapping[str, Callable[[DataFrame], DataFrame]], root: str) -> Callable[[DataFrame, int], None]:
    """Write one micro-batch to several tables, reading the source once."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for table, rows in routes.items():
                rows(df).write.mode("overwrite").parquet(batch_folder(f"{root}/{table}", batch_id))
        finally:
            df.unpersist()

    return write


def read_batches(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows appended so far."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).drop(BATCH)


def upserted(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of every key among the appended batches.

    The version that counts is the one of the latest batch; the choice is a
    partial aggregate, so versions collapse before they are shuffled.
    """
    log = spark.read.parquet(path)
    values = [c for c in log.columns if c not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*values), F.col(BATCH))
    return log.groupBy(*keys).agg(newest.alias("v")).select(*keys, "v.*")


def _versions(spark: SparkSession, path: str) -> dict[int, object]:
    """The batch folders of a table by number, as the file system lists them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listStatus(folder) if files.exists(folder) else []
    named = ((re.fullmatch(rf"{BATCH}=(\d+)", f.getPath().getName()), f.getPath()) for f in found)
    done = ((m, p) for m, p in named if m and files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
    return {int(m[1]): p for m, p in done}


def merge_batches(path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Keep a table of current values: a micro-batch's rows replace those of their keys.

    Each batch writes the whole table anew from the version before it, so a repeated batch gives the same table.  For
    tables of some rows a key, such as counters; the two newest versions are kept.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            versions = _versions(df.sparkSession, path)
            earlier = sorted(v for v in versions if v < batch_id)
            rows = df
            if earlier:
                if df.isEmpty():
                    return
                old, new = df.sparkSession.read.parquet(batch_folder(path, earlier[-1])).alias("old"), df.select(*keys).alias("new")
                same = reduce(lambda a, b: a & b, (F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys))
                rows = old.join(new, same, "left_anti").unionByName(df)
            rows.write.mode("overwrite").parquet(batch_folder(path, batch_id))
            for version in earlier[:-1]:
                folder = versions[version]
                folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
        finally:
            df.unpersist()

    return write


def merged(spark: SparkSession, path: str) -> DataFrame:
    """The current values of a table of :func:`merge_batches`."""
    return spark.read.parquet(batch_folder(path, max(_versions(spark, path))))
