"""Ready streaming queries: counts, aggregates, alerts, routing.

Each takes a stream of ``topic`` and ``value`` (see ``sources``) and returns a
started query.  Progress is kept in the checkpoint, so a query resumes where it
stopped; ``once=True`` handles what is there and ends, as for a replay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roompulse.functions.numbers import try_parse_count
from roompulse.operators.messages import audience_rows, message_rows, message_type_counts, metric_rows, named_rooms, publish, route_messages
from roompulse.operators.windows import gift_amount, room_minute_agg, room_signals, room_snapshot, tumble_counts
from roompulse.schemas import TOPIC_CHAT, TOPIC_GIFT, TOPIC_ROOM
from roompulse.sinks.batches import append_batches, merge_batches, read_batches, route_batches
from roompulse.sources.topics import landing, messages
from roompulse.streaming.snapshots import snapshot_stream, with_timers
from roompulse.streaming.state import alert_stream

FLUSH_EVERY = "10 seconds"


def run(
    rows: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", once: bool = False
) -> StreamingQuery:
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    trigger = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=FLUSH_EVERY)
    return trigger.start()


def count_chats(raw: DataFrame, sink, checkpoint: str, minutes: int = 1, mode: str = "append", once=False) -> StreamingQuery:
    """Chats per room and event-time minute.

    ``append`` emits a window once it is closed; ``update`` emits each change, for
    a sink that upserts by (window start, room).
    """
    chats = messages(raw).filter(F.col("topic") == TOPIC_CHAT)
    return run(tumble_counts(chats, minutes), sink, checkpoint, mode, once)


def signal_stream(raw: DataFrame) -> DataFrame:
    """Chats and readable audience samples of the topics, as the aggregates expect them."""
    rows = messages(raw)
    kind = F.when(F.col("topic") == TOPIC_CHAT, "chat").when(F.col("topic") == TOPIC_ROOM, "sample")
    return rows.select("room_id", "room_name", "event_time", kind.alias("kind"), try_parse_count(F.col("online")).alias("online")).filter(
        (F.col("kind") == "chat") | F.col("online").isNotNull()
    )


def aggregate_rooms(raw: DataFrame, path: str, checkpoint: str, minutes: int = 1, once=False) -> StreamingQuery:
    """Audience and chat rate per room and window."""
    return run(room_minute_agg(signal_stream(raw), minutes), append_batches(path), checkpoint, "append", once)


def gift_windows(gifts: DataFrame, prices: DataFrame, minutes: int = 1) -> DataFrame:
    """Gifts and their value per room and window, from a stream of gift messages with a watermark."""
    count = F.coalesce("gift_count", F.lit(1))
    priced = gifts.join(prices, "gift_name", "left").withColumn("amount", gift_amount(count, F.col("price")))
    windowed = priced.groupBy(F.window("event_time", f"{minutes} minutes").alias("w"), "room_id").agg(
        F.sum(count).alias("gift_count"), F.sum("amount").cast("double").alias("gift_value")
    )
    return windowed.select(F.col("w.start").alias("window_start"), "room_id", "gift_count", "gift_value")


def value_gifts(raw: DataFrame, prices: DataFrame, path: str, checkpoint: str, minutes: int = 1, once=False) -> StreamingQuery:
    """Gift value per room and window, against the static price list."""
    gifts = messages(raw).filter(F.col("topic") == TOPIC_GIFT)
    return run(gift_windows(gifts, prices, minutes), append_batches(path), checkpoint, "append", once)


def count_types(envelopes: DataFrame, path: str, checkpoint: str, once=False) -> StreamingQuery:
    """Running counters by message type: a table with the current figures of every room."""
    counts = message_type_counts(route_messages(envelopes))
    return run(counts, merge_batches(path, ["room_id"]), checkpoint, "update", once)


def watch_rooms(signals: DataFrame, path: str, checkpoint: str, minutes: int = 1, idle: bool = True, once=False) -> StreamingQuery:
    """Append every room's snapshot at the end of each window, silent windows included unless told otherwise."""
    snapshots = snapshot_stream(signals, minutes, idle=idle)
    return with_timers(signals.sparkSession, lambda: run(snapshots, append_batches(path), checkpoint, "append", once))


def watch_audience(samples: DataFrame, path: str, checkpoint: str, once=False) -> StreamingQuery:
    """Append an alert for every sudden change; ``samples`` has room, name, id, time and online."""
    return run(alert_stream(samples), append_batches(path), checkpoint, "append", once)


def store_messages(raw: DataFrame, rooms: DataFrame, root: str, checkpoint: str, once=False) -> StreamingQuery:
    """Spread the topics over the message, audience and metrics tables; damaged messages go to ``quarantine``."""
    rows = named_rooms(landing(raw), rooms)

    def whole(table: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        return lambda df: table(df.filter(F.col("damaged").isNull()))

    routes = {"danmaku": whole(message_rows), "room_stats": whole(audience_rows), "live_metrics": whole(metric_rows)}
    routes["quarantine"] = lambda df: df.filter(F.col("damaged").isNotNull()).select("topic", "damaged", "timestamp")
    return run(rows, route_batches(routes, root), checkpoint, "append", once)


def stored_signals(spark: SparkSession, root: str, prices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signals and audience samples from the tables of :func:`store_messages`.

    Equal times of one room are ordered by a hash, as stored rows carry no id.
    """
    said = read_batches(spark, f"{root}/danmaku").withColumnRenamed("event_time", "created_at")
    full = read_batches(spark, f"{root}/live_metrics").withColumn("n", try_parse_count(F.col("online")))
    socket = read_batches(spark, f"{root}/room_stats").withColumn("n", F.col("online_count"))
    seen = [
        table.select(
            "room_id", "room_name", F.xxhash64("room_id", "timestamp", "n").alias("id"), "event_time", F.col("n").alias("online")
        )
        for table in (full, socket)
    ]
    samples = seen[0].unionByName(seen[1]).filter(F.col("online").isNotNull())
    return room_signals(said, samples, prices), samples


def snapshot_rooms(spark: SparkSession, root: str, prices: DataFrame, minutes: int = 1) -> DataFrame:
    """Room snapshots of everything stored so far, window by window."""
    signals, samples = stored_signals(spark, root, prices)
    return room_snapshot(signals, samples, minutes)


def demultiplex(envelopes: DataFrame, rooms: DataFrame, root: str, checkpoint: str, once=False) -> StreamingQuery:
    """Route decoded envelopes by type, and publish the kinds other jobs consume; damaged payloads go to ``quarantine``."""
    named = envelopes.join(rooms, "room_id", "left")
    routed = route_messages(named, keep_damaged=True)

    def whole(df: DataFrame) -> DataFrame:
        return df.filter(F.col("damaged").isNull()).drop("damaged")

    routes = {"messages": whole, "published": lambda df: publish(whole(df))}
    routes["quarantine"] = lambda df: df.filter(F.col("damaged").isNotNull()).select("room_id", "kind", "damaged", "timestamp")
    return run(routed, route_batches(routes, root), checkpoint, "append", once)
