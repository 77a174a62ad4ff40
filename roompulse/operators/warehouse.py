"""Warehouse layers: landed rows, cleaned rows, minute summaries and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roompulse.functions.numbers import parse_count, ratio, whole_div
from roompulse.functions.times import clock, iso_text, minute_text, minutes, parse_iso
from roompulse.operators.audience import chats_per_user
from roompulse.operators.messages import named_rooms
from roompulse.operators.windows import priced_gifts
from roompulse.sinks.files import stored

# Numbered tier labels of the report table, by lowest number of chats.
NUMBERED_TIERS = (
    (100, "5-超级粉(100+)"),
    (50, "4-铁杆粉(50-99)"),
    (10, "3-忠实粉丝(10-49)"),
    (3, "2-活跃观众(3-9)"),
    (0, "1-路人(1-2)"),
)


def last_hour(df: DataFrame, as_of=None, mins: int = 60) -> DataFrame:
    """Rows of the last hour, for an incremental load."""
    return df.filter(F.col("created_at") > clock(df, "created_at", as_of) - minutes(mins))


def ods_room_info(metrics: DataFrame) -> DataFrame:
    """Room samples as landed, with the audience as a number and the time as text."""
    return metrics.select(
        "room_id", "room_name", "title", "streamer", parse_count(F.col("online")).alias("online"), "like_count", "status",
        "has_cart", "has_commerce", iso_text(F.col("created_at")).alias("ts"),
    )


def ods_danmaku(danmaku: DataFrame) -> DataFrame:
    """Chat and gift messages as landed."""
    return danmaku.select(
        "room_id", "room_name", "username", "text", "msg_type", "gift_name",
        F.col("gift_count").cast("bigint").alias("gift_count"), iso_text(F.col("created_at")).alias("ts"),
    )


def ods_gifts(danmaku: DataFrame, prices: DataFrame) -> DataFrame:
    """Gift messages as landed, with the price of one."""
    gifts = danmaku.filter(F.col("msg_type") == "gift").join(prices, "gift_name", "left")
    return gifts.select(
        "room_id", F.col("user_id").try_cast("bigint").alias("uid"), "username", "gift_name",
        F.coalesce("gift_count", F.lit(1)).cast("int").alias("gift_count"), F.coalesce("price", F.lit(1.0)).alias("price"),
        iso_text(F.col("created_at")).alias("ts"),
    )


def ods_orders(orders: DataFrame, rooms: DataFrame) -> DataFrame:
    """Orders as landed, with the price of one piece."""
    cents = ratio((F.col("total_amount") * 100).cast("bigint"), F.col("quantity"), 0)
    return orders.join(rooms, "room_name").select(
        "room_id", "product_name", (cents / 100.0).alias("price"), "quantity",
        F.regexp_extract("customer_id", "([0-9]+)$", 1).try_cast("bigint").alias("user_id"), iso_text(F.col("order_time")).alias("ts"),
    )


def dwd_danmaku(danmaku: DataFrame, rooms: DataFrame) -> DataFrame:
    """Cleaned messages: one per id, with a room name and a minute to group by.

    Ids seen more than once are found first, on the ids alone, and stored, so that
    the joins know how few they are.  Only their rows are shuffled to pick one; all
    others keep their place, whole text included.
    """
    repeated = danmaku.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("id")
    repeated = stored(repeated, "repeated-ids")
    single = danmaku.join(repeated, "id", "left_anti")
    copies = danmaku.join(repeated, "id", "left_semi")
    values = [c for c in danmaku.columns if c not in ("id", "created_at")]
    newest = F.max(F.struct("created_at", *values)).alias("m")
    one = copies.groupBy("id").agg(newest).select("id", "m.*").select(*danmaku.columns)
    rows = named_rooms(single.unionByName(one), rooms)
    return rows.withColumn("minute", minute_text(F.col("created_at")))


def dws_room_minute(room_info: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages, gifts, audience and like growth per room and minute of the landed rows.

    Both inputs are stacked and grouped once, in place of a full join of two groupings.
    """
    samples = room_info.select("ts", "room_id", "room_name", "online", "like_count")
    said = messages.select(
        "ts", "room_id", "room_name", F.lit(1).alias("message"),
        F.when(F.col("msg_type") == "gift", F.coalesce("gift_count", F.lit(1))).otherwise(0).alias("gifts"),
    )
    both = samples.unionByName(said, allowMissingColumns=True).withColumn("at", parse_iso(F.col("ts")))
    zero = F.lit(0).cast("bigint")
    return (
        both.filter(F.col("at").isNotNull())
        .groupBy(minute_text(F.col("at")).alias("window_time"), "room_id", "room_name")
        .agg(
            F.count("message").alias("danmaku_cnt"),
            F.coalesce(F.sum("gifts"), zero).alias("gift_cnt"),
            F.coalesce(whole_div(F.sum("online"), F.count("online")), zero).alias("online_avg"),
            F.coalesce(F.max("like_count") - F.min("like_count"), zero).alias("like_rate"),
        )
    )


def ads_user_segments(danmaku: DataFrame, day: str) -> DataFrame:
    """Users per numbered tier and room, dated; only tiers with users appear."""
    label = None
    for bound, name in NUMBERED_TIERS:
        label = F.when(F.col("cnt") >= bound, name) if label is None else label.when(F.col("cnt") >= bound, name)
    tiered = chats_per_user(danmaku).select("room_name", label.alias("segment"))
    return (
        tiered.groupBy("room_name", "segment").agg(F.count("*").alias("user_count")).withColumn("dt", F.lit(day))
    )


def ads_product_ranking(orders: DataFrame) -> DataFrame:
    """Quantity and amount per product name, best first."""
    sums = orders.groupBy("product_name").agg(
        F.sum("quantity").alias("total_qty"), F.sum("total_amount").cast("double").alias("total_amount")
    )
    return sums.orderBy(F.col("total_amount").desc(), "product_name")


def dws_live_minute(danmaku: DataFrame, orders: DataFrame, prices: DataFrame, rooms: DataFrame) -> DataFrame:
    """Chats, gift and order amounts, orders, active users and revenue per room and minute."""
    gifts = priced_gifts(danmaku, prices).select(
        "room_id", F.col("created_at").alias("at"), "username", F.col("amount").alias("gift")
    )
    chats = danmaku.filter(F.col("msg_type") == "chat").select(
        "room_id", F.col("created_at").alias("at"), "username", F.lit(1).alias("chat")
    )
    sold = orders.join(rooms, "room_name").select("room_id", F.col("order_time").alias("at"), F.col("total_amount").alias("sale"))
    rows = chats.unionByName(gifts, allowMissingColumns=True).unionByName(sold, allowMissingColumns=True)
    none = F.lit(0).cast("decimal(22,2)")
    per_minute = rows.groupBy(minute_text(F.col("at")).alias("window_time"), "room_id").agg(
        F.count("chat").alias("danmaku_cnt"),
        F.coalesce(F.sum("gift"), none).alias("gift_amount"),
        F.coalesce(F.sum("sale"), none).alias("order_amount"),
        F.count("sale").alias("order_cnt"),
        F.count_distinct("username").alias("active_users"),
    )
    return per_minute.select(
        "window_time",
        "room_id",
        "danmaku_cnt",
        F.col("gift_amount").cast("double").alias("gift_amount"),
        F.col("order_amount").cast("double").alias("order_amount"),
        "order_cnt",
        "active_users",
        (F.col("gift_amount") + F.col("order_amount")).cast("double").alias("gmv"),
    )
