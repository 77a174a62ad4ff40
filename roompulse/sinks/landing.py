"""Incremental landing: each load takes what lies behind the mark the one before it left.

A load has a name.  Its bounds are written down before its rows, so a load that runs again under its name takes the same
rows and replaces its own folder: nothing is doubled and nothing is lost.  Bounds are read before the plan is built and
stand in it as literals, which reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.sinks.files import write_tsv_gz

MARK_SCHEMA = "load string, number int, low timestamp_ntz, high timestamp_ntz"


class Landing:
    """A landed table below ``root``: its rows by load, and the marks of the loads."""

    def __init__(self, spark: SparkSession, root: str, write: Callable[[DataFrame, str], None] = write_tsv_gz):
        self.spark, self.root, self.write = spark, root, write

    def marks(self) -> list:
        """The loads since the last full one, oldest first: a row each."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/marks")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return []
        rows = self.spark.read.schema(MARK_SCHEMA).parquet(f"{self.root}/marks").orderBy("number").collect()
        full = max((i for i, r in enumerate(rows) if r["low"] is None), default=0)
        return rows[full:]

    def folder(self, number: int) -> str:
        return f"{self.root}/rows/load_number={number}"

    def load(self, source: DataFrame, name: str, ts: str = "created_at", full: bool = False, as_of: datetime | None = None, shape=None) -> tuple:
        """Land the rows behind the last mark (all of them on a full or first load), up to ``as_of`` or the newest there is.

        ``shape`` makes the landed rows of the source's.  Returns the bounds, low (exclusive, None for all) and high.
        """
        marks = self.marks()
        known = next((r for r in marks if r["load"] == name), None)
        if known:
            number, low, high = known["number"], known["low"], known["high"]
        else:
            low = marks[-1]["high"] if marks and not full else None
            number = marks[-1]["number"] + 1 if marks else 0
            behind = source if low is None else source.filter(F.col(ts) > F.lit(low))
            high = as_of or behind.agg(F.max(ts)).first()[0] or low
            mark = self.spark.createDataFrame([(name, number, low, high)], MARK_SCHEMA)
            mark.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/load_number={number}")
        self.write(self.between(source, ts, low, high) if shape is None else shape(self.between(source, ts, low, high)), self.folder(number))
        return low, high

    @staticmethod
    def between(source: DataFrame, ts: str, low: datetime | None, high: datetime | None) -> DataFrame:
        """The rows of one load; both bounds are literals."""
        rows = source if low is None else source.filter(F.col(ts) > F.lit(low))
        return rows.filter(F.col(ts) <= F.lit(high)) if high is not None else rows.filter(F.lit(low is None) & F.col(ts).isNull())

    def read(self, read: Callable[[str], DataFrame]) -> DataFrame:
        """All rows landed since the last full load, with the number of their load."""
        parts = [read(self.folder(r["number"])).withColumn("load_number", F.lit(r["number"])) for r in self.marks()]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
