"""The streaming jobs run over the event table to its end, for comparison with the batch plans.

A table says nothing of the order in which its rows arrived, so a replay deals it out by event time first: slices of at
most about ``SLICE_ROWS`` rows, one file and so one bounded micro-batch each, whatever files the table is stored in.  A
closing row far behind the last one moves the watermark past it, so the last windows and samples come out too.  One run
takes the slices in order; where a restart is to be shown, a second run goes on from the checkpoint of the first.
Results go to a table in the shared folder, one micro-batch at a time, and are read back from there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roompulse.functions.numbers import try_parse_count
from roompulse.operators import windows
from roompulse.schemas import TOPIC_CHAT, TOPIC_GIFT, TOPIC_MESSAGE, TOPIC_ROOM
from roompulse.session import shared_folder
from roompulse.sinks.batches import append_batches, merged, read_batches
from roompulse.sources.files import json_lines, parquet_stream
from roompulse.streaming import jobs
from roompulse.streaming.jobs import run
from roompulse.streaming.lateness import count_keeping_late, kept_counts, kept_late
from roompulse.streaming.state import alert_stream

LATE = "5 seconds"
SLICE_ROWS = 2_000_000
CHATS, GIFTS, SAMPLES = ("click", "view"), ("purchase",), ("signup", "error")


def _event_stream(v, raw: DataFrame) -> DataFrame:
    """The view helper over a stream of events; times get the zone a watermark needs."""
    return v.activity_of(raw).join(v.rooms, "room_id").withColumn("event_time", F.col("created_at").cast("timestamp"))


def _slices(events: DataFrame, slice_rows: int, least: int) -> list[DataFrame]:
    """The events by event time, in parts of about equal size."""
    slices = max(least, -(-events.count() // slice_rows))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    cuts = events.agg(F.percentile_approx(at, shares, max(1_000, 10 * slices))).first()[0] or [] if slices > 1 else []
    low, parts = None, []
    for high in [*sorted(set(cuts)), None]:
        part = events if low is None else events.filter(at >= low)
        parts.append(part if high is None else part.filter(at < high))
        low = high
    return parts


def _closing(events: DataFrame) -> DataFrame:
    """The last event again, a day later."""
    last = events.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(1)
    return last.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))


def _played(parts: Sequence[DataFrame], folder: str, start: Callable[[DataFrame], object], restart: bool = False) -> None:
    """Each part as one file, in this order; one run over all, or two with the second half written in between."""
    source, half = f"{folder}/source", -(-len(parts) // 2)
    for some in (parts[:half], parts[half:]) if restart else (parts,):
        for part in some:
            part.repartition(1).write.mode("append").parquet(source)
        raw = parquet_stream(parts[0].sparkSession, source, parts[0].schema, 1)
        # A slice is one file, which one task reads; what is done with its rows is dealt out.  Rows are counted behind
        # that, as filters, which may parse whole payloads, would else be moved back to the reading task.
        dealt = raw.repartition(raw.sparkSession.sparkContext.defaultParallelism)
        start(dealt.observe("dealt", F.count(F.lit(1)).alias("rows"))).awaitTermination()


def _replayed(
    v, kinds: Sequence[str], job: Callable[[DataFrame], DataFrame], name: str, slice_rows: int = SLICE_ROWS, least: int = 1
) -> DataFrame:
    """``job`` over the events of some kinds, slice by slice in event-time order."""
    folder, schema = shared_folder(v.spark, name), None
    events = v.table("events").filter(F.col("event_type").isin(*kinds) & F.col("ts").isNotNull())

    def start(raw: DataFrame):
        nonlocal schema
        rows = job(_event_stream(v, raw))
        schema = rows.schema
        return run(rows, append_batches(f"{folder}/rows"), f"{folder}/checkpoint", once=True)

    _played([*_slices(events, slice_rows, least), _closing(events)], folder, start)
    return read_batches(v.spark, f"{folder}/rows", schema)


def tumble_counts(v) -> DataFrame:
    """Chats per room and minute."""
    return _replayed(v, CHATS, lambda e: windows.tumble_counts(e.withWatermark("event_time", LATE)), "tumble")


def _online(v) -> Column:
    return F.when(F.col("event_type") == "signup", try_parse_count(v.online_of(F.col("k")))).when(
        F.col("event_type") == "error", (100 + F.col("k")).cast("bigint")
    )


def room_minute_agg(v) -> DataFrame:
    """Audience and chat rate per room and minute."""

    def job(e: DataFrame) -> DataFrame:
        kind = F.when(F.col("event_type").isin(*SAMPLES), "sample").otherwise("chat").alias("kind")
        rows = e.select("room_id", "room_name", "event_time", kind, _online(v).alias("online"))
        rows = rows.filter((F.col("kind") == "chat") | F.col("online").isNotNull())
        return windows.room_minute_agg(rows.withWatermark("event_time", LATE))

    return _replayed(v, (*CHATS, *SAMPLES), job, "minutes")


def online_alerts(v) -> DataFrame:
    """Audience alerts from per-room state."""

    def job(e: DataFrame) -> DataFrame:
        rows = e.select("room_id", "room_name", F.col("event_id").alias("id"), "event_time", _online(v).alias("online"))
        # An unreadable count still moves the watermark; the state function leaves it out.
        return alert_stream(rows, LATE)

    rows = _replayed(v, SAMPLES, job, "alerts")
    return rows.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def room_snapshot(v, minutes: int = 1, idle: bool = False, slice_rows: int = SLICE_ROWS, least: int = 1) -> DataFrame:
    """Room snapshots from per-room state and timers."""
    folder = shared_folder(v.spark, "snapshots")
    events = v.table("events").filter(F.col("event_type").isin(*CHATS, *GIFTS, *SAMPLES) & F.col("ts").isNotNull())

    def start(raw: DataFrame):
        e = _event_stream(v, raw)
        kind = F.when(F.col("event_type").isin(*CHATS), "chat").when(F.col("event_type").isin(*GIFTS), "gift").otherwise("sample")
        gift_name = F.when(kind == "gift", F.concat(F.lit("gift_"), (F.col("k") % 9).cast("string"))).alias("gift_name")
        rows = e.select("room_id", "room_name", F.col("event_id").alias("id"), "event_time", kind.alias("kind"), _online(v).alias("online"), gift_name, "k")
        amount = windows.gift_amount(F.lit(1) + F.col("k") % 5, F.col("price"))
        cents = F.when(F.col("kind") == "gift", (amount * 100).cast("bigint"))
        signals = rows.join(v.gift_prices, "gift_name", "left").withColumn("cents", cents)
        return jobs.watch_rooms(signals, f"{folder}/rows", f"{folder}/checkpoint", minutes, idle, once=True)

    _played([*_slices(events, slice_rows, least), _closing(events)], folder, start)
    return read_batches(v.spark, f"{folder}/rows")


def gift_value(v) -> DataFrame:
    """Gifts and their value per room and minute."""

    def job(e: DataFrame) -> DataFrame:
        name = F.concat(F.lit("gift_"), (F.col("k") % 9).cast("string")).alias("gift_name")
        gifts = e.select("room_id", "event_time", name, (F.lit(1) + F.col("k") % 5).alias("gift_count"))
        return jobs.gift_windows(gifts.withWatermark("event_time", LATE), v.gift_prices)

    rows = _replayed(v, GIFTS, job, "gifts")
    return rows.withColumn("window_start", F.date_format("window_start", windows.WINDOW_TEXT))


def message_type_counts(v, envelopes: Callable) -> DataFrame:
    """Counters by message type after several micro-batches and a restart; ``envelopes`` makes them of the events."""
    folder = shared_folder(v.spark, "types")
    events = v.table("events")

    def start(raw: DataFrame):
        return jobs.count_types(envelopes(v, v.activity_of(raw)), f"{folder}/rows", f"{folder}/checkpoint", once=True)

    _played(_slices(events, SLICE_ROWS, 4), folder, start, restart=True)
    return merged(v.spark, f"{folder}/rows")


def late_rows(v, arrivals: int = 4) -> DataFrame:
    """Chats counted and chats kept aside as late, per room, where rows arrive by the last digits of their id."""
    folder = shared_folder(v.spark, "late")
    chats = v.table("events").filter(F.col("event_type").isin(*CHATS) & F.col("ts").isNotNull())

    def start(raw: DataFrame):
        return count_keeping_late(_event_stream(v, raw), folder, f"{folder}/checkpoint", once=True)

    _played([chats.filter(F.col("event_id") % arrivals == i) for i in range(arrivals)], folder, start, restart=True)
    counted = kept_counts(v.spark, folder).groupBy("room_id").agg(F.sum("danmaku_cnt").alias("counted"))
    late = kept_late(v.spark, folder).groupBy("room_id").agg(F.count("*").alias("late"), F.max("late_seconds").alias("max_late_seconds"))
    rows = chats.groupBy(F.concat(F.lit("room_"), (F.col("event_id") % 5).cast("string")).alias("room_id")).agg(F.count("*").alias("arrived"))
    zero = F.lit(0).cast("bigint")
    both = rows.join(counted, "room_id", "left").join(late, "room_id", "left")
    return both.select("room_id", "arrived", F.coalesce("counted", zero).alias("counted"), F.coalesce("late", zero).alias("late"), "max_late_seconds")


def ingest(v, rows: DataFrame) -> DataFrame:
    """Topic messages as JSON lines, every 50th cut short, spread over the tables; rows in, stored and kept aside by topic."""
    folder = shared_folder(v.spark, "ingest")
    whole = F.to_json(F.struct(*[f.name for f in TOPIC_MESSAGE.fields]))
    lines = rows.select("topic", F.when(F.col("id") % 50 == 0, F.substring(whole, 1, 20)).otherwise(whole).alias("value"), (F.col("id") % 2).alias("half"))
    for half in (0, 1):
        # The second half arrives after the first run, which the second one resumes from.
        for topic in (TOPIC_CHAT, TOPIC_GIFT, TOPIC_ROOM):
            lines.filter((F.col("topic") == topic) & (F.col("half") == half)).select("value").write.mode("append").text(f"{folder}/source/{topic}")
        raw = json_lines(v.spark, f"{folder}/source", None)
        jobs.store_messages(raw, v.rooms, f"{folder}/tables", f"{folder}/checkpoint", once=True).awaitTermination()
    tables = {t: read_batches(v.spark, f"{folder}/tables/{t}") for t in ("danmaku", "room_stats", "live_metrics", "quarantine")}
    said = tables["danmaku"].select(F.when(F.col("msg_type") == "chat", TOPIC_CHAT).otherwise(TOPIC_GIFT).alias("topic"), F.lit("stored").alias("kind"))
    seen = [tables[t].select(F.lit(TOPIC_ROOM).alias("topic"), F.lit("stored").alias("kind")) for t in ("room_stats", "live_metrics")]
    aside = tables["quarantine"].select("topic", F.lit("quarantined").alias("kind"))
    every = lines.select("topic", F.lit("arrived").alias("kind"))
    stacked = every.unionByName(said).unionByName(seen[0]).unionByName(seen[1]).unionByName(aside)
    return stacked.groupBy("topic").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("arrived", "stored", "quarantined")])
