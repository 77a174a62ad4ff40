"""Window counts that keep their late rows: what comes behind the watermark goes to a side table, with its lateness.

The watermark of a micro-batch is the newest event time of all batches before it, less what is allowed.  A row is late if
its window had closed by then, so counts of closed windows never change, and counted and late rows add up to all rows.
Each batch writes its counts, its late rows and its mark to folders of its own; a batch that runs again replaces them.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roompulse.operators.windows import WINDOW_TEXT
from roompulse.sinks.batches import batch_folder, read_batches
from roompulse.streaming.jobs import run

MARK_SCHEMA = "newest bigint"


def newest_before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """The newest event time, in microseconds, of all batches before this one: each mark holds the one so far."""
    if batch_id == 0:
        return None
    return spark.read.schema(MARK_SCHEMA).parquet(batch_folder(f"{root}/marks", batch_id - 1)).first()[0]


def count_keeping_late(
    rows: DataFrame, root: str, checkpoint: str, minutes: int = 1, late_seconds: int = 5, once: bool = False
) -> StreamingQuery:
    """Rows (room_id, room_name, event_time) counted per room and window; those of closed windows kept aside."""

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        newest = newest_before(spark, root, batch_id)
        at = F.unix_micros("event_time")
        mark = F.lit(None if newest is None else newest - late_seconds * 1_000_000).cast("bigint")
        width = minutes * 60_000_000
        end = (F.floor(at / width) + 1) * width
        judged = df.withColumn("late", F.coalesce(end <= mark, F.lit(False))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            window = F.window("event_time", f"{minutes} minutes").alias("w")
            counts = judged.filter(~F.col("late")).groupBy(window, "room_id").agg(F.max("room_name").alias("room_name"), F.count("*").alias("danmaku_cnt"))
            start = F.date_format("w.start", WINDOW_TEXT).alias("window_start")
            counts.select(start, "room_id", "room_name", "danmaku_cnt").write.mode("overwrite").parquet(batch_folder(f"{root}/counts", batch_id))
            aside = judged.filter("late").drop("late").withColumn("late_seconds", (mark - at) / 1_000_000)
            aside.write.mode("overwrite").parquet(batch_folder(f"{root}/late", batch_id))
            so_far = judged.agg(F.greatest(F.max(at), F.lit(newest).cast("bigint")).alias("newest"))
            so_far.write.mode("overwrite").parquet(batch_folder(f"{root}/marks", batch_id))
        finally:
            judged.unpersist()

    return run(rows, write, checkpoint, "append", once)


def kept_counts(spark: SparkSession, root: str) -> DataFrame:
    """Counts per room and window: the sums of all batches' counts."""
    counts = read_batches(spark, f"{root}/counts")
    return counts.groupBy("window_start", "room_id").agg(F.max("room_name").alias("room_name"), F.sum("danmaku_cnt").alias("danmaku_cnt"))


def kept_late(spark: SparkSession, root: str) -> DataFrame:
    """The late rows, with the seconds they lie behind the watermark of their batch."""
    return read_batches(spark, f"{root}/late")
