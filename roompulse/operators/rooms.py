"""Room reports: state, comparison, trends and sampling rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roompulse.functions.numbers import parse_count, whole_div
from roompulse.functions.times import CLOCK_MINUTE, CLOCK_SECOND, clock, micros_between, minutes
from roompulse.operators.common import only, row_index

# Fixed values shown when a room has no samples yet.
NO_DATA = "无数据"
OFFLINE = "离线"
LIVE_SECONDS = 600
TITLE_SHORT = 30
TITLE_LONG = 50
TREND_POINTS = 80
GAP_SECONDS = 180


def _latest(metrics: DataFrame) -> DataFrame:
    """Newest and oldest sample of every room, with the number of samples."""
    newest = F.max_by(F.struct("online", "like_count", "title", "status", "created_at"), F.col("id"))
    return metrics.groupBy("room_id").agg(
        newest.alias("latest"),
        F.min_by("created_at", "id").alias("first_seen"),
        F.count("*").alias("records"),
    )


def _message_counts(danmaku: DataFrame) -> DataFrame:
    return danmaku.groupBy("room_name").agg(F.count("*").alias("messages"))


def room_overview(rooms: DataFrame, metrics: DataFrame, danmaku: DataFrame, as_of=None) -> DataFrame:
    """Every known room with its latest sample, counts and whether it is live."""
    now = clock(metrics, "created_at", as_of)
    seen = F.col("latest.created_at")
    return (
        rooms.join(_latest(metrics), "room_id", "left")
        .join(_message_counts(danmaku), "room_name", "left")
        .select(
            "room_id",
            "room_name",
            F.coalesce(F.col("latest.online"), F.lit(NO_DATA)).alias("online"),
            F.substring(F.coalesce(F.col("latest.title"), F.lit("")), 1, TITLE_SHORT).alias("title"),
            F.coalesce(micros_between(seen, now) < LIVE_SECONDS * 1_000_000, F.lit(False)).alias("live"),
            F.coalesce("records", F.lit(0)).alias("records"),
            F.coalesce("messages", F.lit(0)).alias("danmaku"),
            F.date_format(seen, CLOCK_SECOND).alias("updated"),
        )
    )


def room_liveness(rooms: DataFrame, metrics: DataFrame, as_of=None, live_seconds: int = LIVE_SECONDS) -> DataFrame:
    """Seconds since each room's last sample; silent for ``live_seconds`` means offline."""
    now = clock(metrics, "created_at", as_of)
    last = metrics.groupBy("room_id").agg(F.max("created_at").alias("last_seen"))
    idle = micros_between(F.col("last_seen"), now)
    return rooms.join(last, "room_id", "left").select(
        "room_id",
        "room_name",
        "last_seen",
        F.floor(idle / 1_000_000).cast("double").alias("idle_seconds"),
        F.coalesce(idle < live_seconds * 1_000_000, F.lit(False)).alias("live"),
    )


def room_stats(rooms: DataFrame, metrics: DataFrame, danmaku: DataFrame) -> DataFrame:
    """Rooms that have samples: latest values, totals and the first time seen."""
    return (
        _latest(metrics)
        .join(rooms, "room_id", "left")
        .join(_message_counts(danmaku), "room_name", "left")
        .select(
            "room_id",
            F.coalesce("room_name", F.lit("")).alias("room_name"),
            F.col("latest.online").alias("online"),
            F.col("latest.like_count").alias("likes"),
            F.substring(F.coalesce(F.col("latest.title"), F.lit("")), 1, TITLE_LONG).alias("title"),
            F.col("latest.status").alias("status"),
            F.col("records").alias("total"),
            F.coalesce("messages", F.lit(0)).alias("danmaku_count"),
            F.date_format("first_seen", "MM/dd HH:mm").alias("start_time"),
            F.date_format(F.col("latest.created_at"), CLOCK_SECOND).alias("timestamp"),
        )
    )


def room_compare(rooms: DataFrame, metrics: DataFrame, danmaku: DataFrame) -> DataFrame:
    """Latest audience, likes and title of all rooms side by side."""
    return (
        rooms.join(_latest(metrics), "room_id", "left")
        .join(_message_counts(danmaku), "room_name", "left")
        .select(
            "room_name",
            F.coalesce(F.col("latest.online"), F.lit(OFFLINE)).alias("online"),
            F.coalesce(F.col("latest.like_count"), F.lit(0)).alias("likes"),
            F.substring(F.coalesce(F.col("latest.title"), F.lit("")), 1, TITLE_SHORT).alias("title"),
            F.coalesce("messages", F.lit(0)).alias("danmaku"),
            F.coalesce(F.date_format(F.col("latest.created_at"), CLOCK_SECOND), F.lit("")).alias("updated"),
        )
    )


def online_trend(
    metrics: DataFrame, mins: int = 120, points: int = TREND_POINTS, room: str | None = None, as_of=None
) -> DataFrame:
    """Audience and likes of each room at about ``points`` evenly spaced samples.

    A room without samples in the last ``mins`` minutes shows all its history.
    The like rate restarts at 0 after a gap of more than three minutes.
    """
    metrics = only(metrics, room_id=room)
    start = clock(metrics, "created_at", as_of) - minutes(mins)
    last = metrics.groupBy("room_id").agg(F.max("created_at").alias("last_seen"))
    chosen = metrics.join(last, "room_id").filter(
        (F.col("created_at") > start) | (F.col("last_seen") <= start)
    )
    narrow = chosen.select("room_id", "id", "online", "like_count", "created_at")
    step = F.greatest(F.lit(1).cast("bigint"), whole_div(F.col("rows_in_key"), F.lit(points)))
    kept = row_index(narrow, ["room_id"], "created_at", "id").filter(F.col("row_ix") % step == 0)
    # At most twice ``points`` rows are left per room.
    w = Window.partitionBy("room_id").orderBy("row_ix")
    before = F.lag("like_count").over(w)
    gap = micros_between(F.lag("created_at").over(w), F.col("created_at")) > GAP_SECONDS * 1_000_000
    rate = F.when((before != 0) & ~gap, F.greatest(F.col("like_count") - before, F.lit(0))).otherwise(0)
    return kept.select(
        "room_id",
        "created_at",
        F.date_format("created_at", CLOCK_MINUTE).alias("time"),
        parse_count(F.col("online")).alias("online"),
        F.col("like_count").alias("likes"),
        rate.alias("like_rate"),
    )


def room_last_minute(rooms: DataFrame, metrics: DataFrame, mins: int = 1, as_of=None) -> DataFrame:
    """Audience and like growth of the last minute; quiet rooms report zeros."""
    start = clock(metrics, "created_at", as_of) - minutes(mins)
    recent = metrics.filter(F.col("created_at") > start).withColumn("n", parse_count(F.col("online")))
    per_room = recent.groupBy("room_id").agg(
        whole_div(F.sum("n"), F.count("*")).alias("online_avg"),
        F.max("n").alias("online_max"),
        F.min("n").alias("online_min"),
        F.greatest(F.max_by("like_count", "id") - F.min_by("like_count", "id"), F.lit(0)).alias("like_rate"),
        F.count("*").alias("records"),
        F.date_format(F.max_by("created_at", "id"), CLOCK_SECOND).alias("time"),
    )
    zero = F.lit(0).cast("bigint")
    return rooms.join(per_room, "room_id", "left").select(
        "room_id",
        *[F.coalesce(c, zero).alias(c) for c in ("online_avg", "online_max", "online_min", "like_rate", "records")],
        "time",
    )


def collect_rate(metrics: DataFrame, mins: int = 60, room: str | None = None, as_of=None) -> DataFrame:
    """Samples per minute over the last hour."""
    metrics = only(metrics, room_id=room)
    start = clock(metrics, "created_at", as_of) - minutes(mins)
    return (
        metrics.filter(F.col("created_at") > start)
        .groupBy("room_id", F.date_format("created_at", CLOCK_MINUTE).alias("t"))
        .agg(F.count("*").alias("c"))
    )
