"""Time-window aggregates and alerts over room signals.

The functions work on batch frames; those named as such in their docstring also
serve the streaming jobs unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roompulse.functions.numbers import ratio, try_parse_count, whole_div
from roompulse.operators.common import lookback_window, row_index

# Audience alert rules. The baseline is the mean of up to nine
# samples before the current one, of which at least two are needed.
HISTORY = 9
MIN_HISTORY = 2
BASELINE_ABOVE = 100
DROP_PCT, SPIKE_PCT = 30, 50
DROP, SPIKE = ("online_drop", "HIGH"), ("online_spike", "MEDIUM")
DROP_TEXT, SPIKE_TEXT = "在线骤降", "在线暴涨"

# Revenue estimate per chat.
BUYERS_PER_CHAT = "0.03"
BASKET_VALUE = "150"

# Surge thresholds.
CHAT_SURGE = 100
GMV_INCREASE_PCT = 100

WINDOW_TEXT = "yyyy-MM-dd HH:mm:ss"


def tumble_counts(messages: DataFrame, minutes: int = 1, ts: str = "event_time") -> DataFrame:
    """Messages per room and event-time window, keyed by (window start, room).

    Batch and streaming; a stream adds the watermark beforehand.
    """
    keys = ["w", "room_id"] if messages.isStreaming else ["w", "room_id", "room_name"]
    name = F.max("room_name").alias("room_name")
    rows = messages.withColumn("w", F.window(ts, f"{minutes} minutes"))
    if messages.isStreaming:
        counted = rows.groupBy(*keys).agg(name, F.count("*").alias("danmaku_cnt"))
    else:
        # With the name among the keys the large pass hashes; text in an aggregate would make it sort.
        by_name = rows.groupBy(*keys).agg(F.count("*").alias("n"))
        counted = by_name.groupBy("w", "room_id").agg(name, F.sum("n").alias("danmaku_cnt"))
    return counted.select(
        F.date_format("w.start", WINDOW_TEXT).alias("window_start"),
        F.date_format("w.end", WINDOW_TEXT).alias("window_end"),
        "room_id",
        "room_name",
        "danmaku_cnt",
    )


def audience_samples(metrics: DataFrame, room_stats: DataFrame) -> DataFrame:
    """Samples of both kinds as (room, time, id, online); unreadable counts are left out."""
    full = metrics.select(
        "room_id", "room_name", "id", F.col("created_at").alias("event_time"), try_parse_count(F.col("online")).alias("online")
    )
    socket = room_stats.select(
        "room_id", "room_name", "id", F.col("created_at").alias("event_time"),
        F.col("online_count").cast("bigint").alias("online"),
    )
    return full.unionByName(socket).filter(F.col("online").isNotNull())


def gift_amount(count: Column, price: Column) -> Column:
    """Value of a gift message; an unlisted gift is worth 1.  Decimal, so sums are exact."""
    return F.coalesce(price.cast("decimal(12,2)"), F.lit(1).cast("decimal(12,2)")) * count.cast("decimal(10,0)")


def priced_gifts(danmaku: DataFrame, prices: DataFrame) -> DataFrame:
    """Gift messages with their value. Batch, and stream against the static price list."""
    gifts = danmaku.filter(F.col("msg_type") == "gift")
    count = F.coalesce("gift_count", F.lit(1))
    return gifts.join(prices, "gift_name", "left").withColumn("amount", gift_amount(count, F.col("price")))


def gift_value(danmaku: DataFrame, prices: DataFrame) -> DataFrame:
    """Gifts and their value per room."""
    return (
        priced_gifts(danmaku, prices)
        .groupBy("room_id", "room_name")
        .agg(F.sum("gift_count").alias("gift_count"), F.sum("amount").cast("double").alias("gift_value"))
    )


def room_signals(danmaku: DataFrame, samples: DataFrame, prices: DataFrame) -> DataFrame:
    """Chats, gifts and samples as one narrow frame, so one grouping serves them all; the messages are read once."""
    is_gift = F.col("msg_type") == "gift"
    amount = F.when(is_gift, gift_amount(F.coalesce("gift_count", F.lit(1)), F.col("price")))
    said = danmaku.filter(F.col("msg_type").isin("chat", "gift")).join(prices, "gift_name", "left")
    told = said.select("room_id", "room_name", F.col("created_at").alias("event_time"), F.col("msg_type").alias("kind"), amount.alias("amount"))
    seen = samples.select("room_id", "room_name", "event_time", F.lit("sample").alias("kind"), "online")
    return told.unionByName(seen, allowMissingColumns=True)


def room_minute_agg(signals: DataFrame, minutes: int = 1, ts: str = "event_time") -> DataFrame:
    """Audience average, maximum and minimum with the chat rate per room and window.

    Only samples above 0 count.  Batch and streaming.
    """
    zero = F.lit(0).cast("bigint")
    online = F.when(F.col("online") > 0, F.col("online"))
    numbers = (
        F.sum(online).alias("online_sum"),
        F.count(online).alias("samples"),
        F.max(online).alias("online_max"),
        F.min(online).alias("online_min"),
        F.count_if(F.col("kind") == "chat").alias("chats"),
    )
    name = F.max("room_name").alias("room_name")
    rows = signals.filter(F.col("kind").isin("chat", "sample")).withColumn("w", F.window(ts, f"{minutes} minutes"))
    if signals.isStreaming:
        counted = rows.groupBy("w", "room_id").agg(name, *numbers)
    else:
        counted = (
            rows.groupBy("w", "room_id", "room_name")
            .agg(*numbers)
            .groupBy("w", "room_id")
            .agg(
                name,
                F.max("online_max").alias("online_max"),
                F.min("online_min").alias("online_min"),
                *[F.sum(c).alias(c) for c in ("online_sum", "samples", "chats")],
            )
        )
    return counted.select(
        F.date_format("w.start", WINDOW_TEXT).alias("window_start"),
        "room_id",
        "room_name",
        F.coalesce(whole_div(F.col("online_sum"), F.col("samples")), zero).alias("online_avg"),
        F.coalesce("online_max", zero).alias("online_max"),
        F.coalesce("online_min", zero).alias("online_min"),
        whole_div(F.col("chats"), F.lit(minutes)).alias("danmaku_rate"),
        "samples",
    )


def is_drop(current: Column, total: Column, n: Column) -> Column:
    return (total > n * BASELINE_ABOVE) & (current * n * 100 < total * (100 - DROP_PCT))


def is_spike(current: Column, total: Column, n: Column) -> Column:
    return (total > n * BASELINE_ABOVE) & (current * n * 100 > total * (100 + SPIKE_PCT))


def with_history(samples: DataFrame, reach: int = HISTORY, **blocks: int) -> DataFrame:
    """Each sample with sum and count of the samples before it, the one before, and its position.

    A long room is cut into blocks that look back into each other, so no task
    orders more than one block.
    """
    indexed = row_index(samples, ["room_id"], "event_time", "id")
    spread, w, keep = lookback_window(indexed, ["room_id"], "row_ix", reach, **blocks)
    before = w.rowsBetween(-reach, -1)
    return (
        spread.withColumn("before_sum", F.sum("online").over(before))
        .withColumn("before_n", F.count("online").over(before))
        .withColumn("previous", F.lag("online").over(w))
        .filter(keep)
        .drop("__home", "__block")
    )


def online_alerts(samples: DataFrame, **blocks: int) -> DataFrame:
    """Sudden drops and spikes of the audience against the samples just before."""
    seen = with_history(samples, **blocks).filter(F.col("before_n") >= MIN_HISTORY)
    current, total, n = F.col("online"), F.col("before_sum"), F.col("before_n")
    found = F.when(is_drop(current, total, n), F.struct(F.lit(DROP[0]).alias("alert_type"), F.lit(DROP[1]).alias("severity"))).when(
        is_spike(current, total, n), F.struct(F.lit(SPIKE[0]).alias("alert_type"), F.lit(SPIKE[1]).alias("severity"))
    )
    return seen.withColumn("a", found).filter(F.col("a").isNotNull()).select(
        "room_id", "room_name", "id", "event_time", "a.alert_type", "a.severity", "online", ratio(total, n, 0).alias("baseline")
    )


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts with the text that is shown for them: room, kind, baseline and current audience."""
    kind = F.when(F.col("alert_type") == DROP[0], F.lit(DROP_TEXT)).otherwise(F.lit(SPIKE_TEXT))
    figures = F.concat(F.col("baseline").cast("bigint").cast("string"), F.lit("→"), F.col("online").cast("string"))
    return alerts.withColumn("message", F.concat(F.col("room_name"), F.lit(" "), kind, F.lit(": "), figures))


def room_snapshot(signals: DataFrame, samples: DataFrame, minutes: int = 1, **blocks: int) -> DataFrame:
    """State of every active room at the end of each window.

    Audience figures look at the last ten samples and carry over windows without
    one; chats and gifts count within the window.
    """
    seen = with_history(samples, **blocks)
    current, n, total = F.col("online"), F.col("before_n"), F.col("before_sum")
    alerting = (n >= MIN_HISTORY) & (is_drop(current, total, n) | is_spike(current, total, n))
    trend = F.when(F.col("previous").isNull(), "stable").when(current > F.col("previous"), "up").otherwise("down")
    average = ratio(F.coalesce(total, F.lit(0)) + current, n + 1, 0)
    w = F.window("event_time", f"{minutes} minutes").getField("start").alias("start")
    state = F.struct(
        current.alias("online"), average.cast("bigint").alias("average"), trend.alias("trend")
    )
    sampled = seen.groupBy("room_id", w).agg(
        F.max_by(state, F.col("row_ix")).alias("state"), F.count_if(alerting).alias("alerts")
    )
    counted = (
        signals.groupBy("room_id", "room_name", w)
        .agg(F.count_if(F.col("kind") == "chat").alias("chats"), F.sum("amount").alias("gifts"))
        .groupBy("room_id", "start")
        .agg(
            F.max("room_name").alias("room_name"),
            F.sum("chats").alias("chats"),
            F.coalesce(F.sum("gifts"), F.lit(0).cast("decimal(22,2)")).alias("gifts"),
        )
    )
    so_far = Window.partitionBy("room_id").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    joined = (
        counted.join(sampled, ["room_id", "start"], "left")
        .withColumn("state", F.last("state", ignorenulls=True).over(so_far))
        .withColumn("alerts", F.coalesce(F.sum("alerts").over(so_far), F.lit(0)))
    )
    per_chat = F.lit(BUYERS_PER_CHAT).cast("decimal(6,2)") * F.lit(BASKET_VALUE).cast("decimal(6,0)")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        F.date_format("start", WINDOW_TEXT).alias("window_start"),
        "room_id",
        "room_name",
        F.coalesce(F.col("state.online"), zero).alias("online_current"),
        F.coalesce(F.col("state.average"), zero).alias("online_avg"),
        F.coalesce(F.col("state.trend"), F.lit("stable")).alias("online_trend"),
        F.col("chats").alias("danmaku_rate"),
        F.col("gifts").cast("double").alias("gift_value"),
        (F.col("chats").cast("decimal(18,0)") * per_chat + F.col("gifts")).cast("double").alias("gmv_estimate"),
        F.col("alerts").alias("alert_count"),
    )


def surge_alerts(
    snapshot: DataFrame, chat_surge: int = CHAT_SURGE, gmv_increase_pct: int = GMV_INCREASE_PCT
) -> DataFrame:
    """Windows with more chats than ``chat_surge``, or a revenue estimate up by more than the given percent.

    An extension: the thresholds are part of the data model but no rule used them.
    """
    w = Window.partitionBy("room_id").orderBy("window_start")
    before = F.col("gmv_before")
    grown = (before > 0) & (F.col("gmv_estimate") * 100 > before * (100 + gmv_increase_pct))
    kinds = F.array_compact(
        F.array(
            F.when(F.col("danmaku_rate") > chat_surge, F.lit("danmaku_surge")),
            F.when(grown, F.lit("gmv_increase")),
        )
    )
    return snapshot.withColumn("gmv_before", F.lag("gmv_estimate").over(w)).select(
        "room_id", "room_name", "window_start", "danmaku_rate", "gmv_estimate", F.explode(kinds).alias("alert_type")
    )
