"""Raw messages to table rows: tolerant decoding, defaults, naming, flattening and routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roompulse.functions.times import parse_iso
from roompulse.schemas import PAYLOAD, RESPONSE, ROOM_RECORD, TOPIC_CHAT, TOPIC_GIFT, TOPIC_ROOM

# Status code of a running broadcast and the two labels.
STATUS_LIVE = 2
LIVE, NOT_LIVE = "直播中", "未开播"

# Message types that are routed, and what each is called here.
METHODS = {
    "WebcastChatMessage": "chat",
    "WebcastGiftMessage": "gift",
    "WebcastLikeMessage": "like",
    "WebcastMemberMessage": "member",
    "WebcastSocialMessage": "social",
    "WebcastRoomUserSeqMessage": "stats",
    "WebcastFansclubMessage": "fansclub",
    "WebcastControlMessage": "control",
    "WebcastEmojiChatMessage": "emoji",
    "WebcastRoomStatsMessage": "room_stats",
    "WebcastRoomMessage": "room",
    "WebcastRoomRankMessage": "rank",
    "WebcastRoomStreamAdaptationMessage": "stream",
}
# Kinds published to a topic, and the status that ends a broadcast.
PUBLISHED = {"chat": TOPIC_CHAT, "gift": TOPIC_GIFT, "stats": TOPIC_ROOM}
STATUS_ENDED = 3
COUNTED_KINDS = ("chat", "gift", "member", "stats")


def decode_json(df: DataFrame, value: str, schema: StructType) -> DataFrame:
    """Parse a JSON text column into ``body``; ``bad`` holds the text where it is not JSON.

    Missing fields become null; a damaged text never fails the job.
    """
    with_bad = StructType([*schema.fields, StructField("_bad", StringType(), True)])
    parsed = F.from_json(F.col(value), with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    body = df.withColumn("__p", parsed)
    fields = F.struct(*[F.col(f"__p.{f.name}").alias(f.name) for f in schema.fields])
    return body.withColumn("body", fields).withColumn("bad", F.col("__p._bad")).drop("__p")


def json_quarantine(df: DataFrame, value: str, schema: StructType) -> DataFrame:
    """All rows, parsed once: ``body``, and the flag ``bad`` on those to be kept aside because they are not JSON."""
    decoded = decode_json(df, value, schema)
    return decoded.withColumn("bad", F.col("bad").isNotNull() | F.col(value).isNull())


def encode_json(df: DataFrame, *columns: str) -> Column:
    """Compact JSON of the given columns (all by default); nulls are left out, text stays unescaped."""
    return F.to_json(F.struct(*[F.col(c) for c in (columns or df.columns)]))


def whole(name: str) -> Column:
    """A text column with null as empty."""
    return F.coalesce(name, F.lit("")).alias(name)


def named_rooms(df: DataFrame, rooms: DataFrame) -> DataFrame:
    """``room_name`` from the row, else from the room list, else the room id."""
    known = rooms.select("room_id", F.col("room_name").alias("__known"))
    own = F.nullif(F.col("room_name"), F.lit(""))
    filled = F.coalesce(own, F.col("__known"), F.col("room_id"))
    return df.join(known, "room_id", "left").withColumn("room_name", filled).drop("__known")


def message_rows(messages: DataFrame) -> DataFrame:
    """Chat and gift messages as rows of one table; columns a topic lacks stay null."""
    chat = messages.filter(F.col("topic") == TOPIC_CHAT).select(
        "room_id", whole("room_name"), whole("username"), F.coalesce("user_id", F.lit("")).alias("user_id"), whole("text"),
        F.lit("chat").alias("msg_type"), "timestamp",
    )
    gift = messages.filter(F.col("topic") == TOPIC_GIFT).select(
        "room_id", whole("room_name"), whole("username"), F.coalesce("gift_name", F.lit("")).alias("gift_name"),
        F.coalesce("gift_count", F.lit(1)).alias("gift_count"), F.lit("gift").alias("msg_type"), "timestamp",
    )
    return chat.unionByName(gift, allowMissingColumns=True).withColumn("event_time", parse_iso(F.col("timestamp")))


def is_socket(messages: DataFrame) -> Column:
    return F.coalesce(F.col("source"), F.lit("api")) == "websocket"


def metric_rows(messages: DataFrame) -> DataFrame:
    """Full room samples as table rows, flags as 0/1."""

    def flag(name: str) -> Column:
        return F.coalesce(name, F.lit(False)).cast("int").alias(name)

    sampled = messages.filter((F.col("topic") == TOPIC_ROOM) & ~is_socket(messages))
    return sampled.select(
        "room_id", whole("room_name"), whole("title"), whole("streamer"), F.coalesce("online", F.lit("")).alias("online"),
        F.coalesce("like_count", F.lit(0)).alias("like_count"), F.coalesce("status", F.lit("")).alias("status"),
        flag("has_cart"), F.coalesce("cart_total", F.lit(0)).alias("cart_total"), flag("has_commerce"), "timestamp",
    ).withColumn("event_time", parse_iso(F.col("timestamp")))


def audience_rows(messages: DataFrame) -> DataFrame:
    """Audience samples of the socket as table rows."""
    sampled = messages.filter((F.col("topic") == TOPIC_ROOM) & is_socket(messages))
    return sampled.select(
        "room_id", whole("room_name"), F.coalesce(F.col("online").try_cast("bigint"), F.lit(0)).alias("online_count"),
        F.coalesce("total_users", F.lit("")).alias("total_users"), "timestamp",
    ).withColumn("event_time", parse_iso(F.col("timestamp")))


def flatten_room_record(records: DataFrame) -> DataFrame:
    """Nested room records (column ``body``) as flat rows with defaults for what is missing."""
    b = {f.name: F.col(f"body.{f.name}") for f in ROOM_RECORD.fields}

    def text(col: Column) -> Column:
        return F.coalesce(col, F.lit(""))

    def number(col: Column) -> Column:
        return F.coalesce(col, F.lit(0))

    def flag(col: Column) -> Column:
        return F.coalesce(col, F.lit(False))

    return records.select(
        b["room_id"].alias("room_id"),
        b["room_name"].alias("room_name"),
        text(b["title"]).alias("title"),
        text(b["owner"]["nickname"]).alias("streamer"),
        text(b["user_count_str"]).alias("online"),
        number(b["like_count"]).alias("like_count"),
        F.when(b["status"] == STATUS_LIVE, LIVE).otherwise(NOT_LIVE).alias("status"),
        number(b["status"]).alias("status_code"),
        flag(b["room_cart"]["contain_cart"]).alias("has_cart"),
        number(b["room_cart"]["total"]).alias("cart_total"),
        text(b["stats"]["total_user_str"]).alias("total_users"),
        flag(b["room_auth"]["Danmaku"]).alias("can_danmaku"),
        flag(b["room_auth"]["Gift"]).alias("can_gift"),
        flag(b["has_commerce_goods"]).alias("has_commerce"),
        b["timestamp"].alias("timestamp"),
    )


def message_kind(method: Column) -> Column:
    """Short name of a message type, null for types that are not routed."""
    kind = None
    for name, short in METHODS.items():
        kind = F.when(method == name, short) if kind is None else kind.when(method == name, short)
    return kind


def route_messages(envelopes: DataFrame, keep_damaged: bool = False) -> DataFrame:
    """Decoded envelopes as one row per known message, with the fields of its type.

    Unknown types are dropped first.  One schema covers all payloads, so each is
    parsed once and no branch rescans the input.  Payloads that are not JSON are
    left out, or kept with their text as ``damaged``.
    """
    known = envelopes.withColumn("kind", message_kind(F.col("method"))).filter(F.col("kind").isNotNull())
    decoded = decode_json(known, "payload", PAYLOAD)
    damaged = F.when(F.col("bad").isNotNull() | F.col("payload").isNull(), F.coalesce("payload", F.lit("")))
    if not keep_damaged:
        decoded = decoded.filter(F.col("bad").isNull())
    kind = F.col("kind")
    b = {f.name: F.col(f"body.{f.name}") for f in PAYLOAD.fields}
    has_user = kind.isin("chat", "gift", "like", "member", "social", "emoji")
    content = (
        F.when(kind.isin("chat", "fansclub"), b["content"])
        .when(kind == "emoji", b["default_content"])
        .when(kind == "room_stats", b["display_long"])
        .when(kind == "stats", b["total_pv_for_anchor"])
    )
    amount = (
        F.when(kind == "gift", b["combo_count"])
        .when(kind == "like", b["count"])
        .when(kind == "stats", b["total"])
        .when(kind == "control", b["status"])
        .when(kind == "emoji", b["emoji_id"])
        .when(kind == "room", b["common"]["room_id"])
        .when(kind == "rank", F.size(b["ranks_list"]).cast("bigint"))
        .when(kind == "stream", b["adaptation_type"])
    )
    keep = [c for c in envelopes.columns if c not in ("method", "payload")]
    topic = None
    for name, target in PUBLISHED.items():
        topic = F.when(kind == name, target) if topic is None else topic.when(kind == name, target)
    return decoded.select(
        *keep,
        "kind",
        F.when(has_user, b["user"]["id"]).alias("user_id"),
        F.when(has_user, b["user"]["nick_name"]).alias("username"),
        F.when(kind == "member", F.when(b["user"]["gender"] == 1, "男").otherwise("女")).alias("gender"),
        content.alias("content"),
        F.when(kind == "gift", b["gift"]["name"]).alias("gift_name"),
        amount.alias("amount"),
        ((kind == "control") & (b["status"] == STATUS_ENDED)).alias("ends_room"),
        topic.alias("topic"),
        *([damaged.alias("damaged")] if keep_damaged else []),
    )


def publish(routed: DataFrame, *keep: str) -> DataFrame:
    """Topic, key and JSON value of the routed messages other jobs consume, and columns to keep."""
    kind = F.col("kind")
    chat = F.struct("username", F.col("user_id").cast("string").alias("user_id"), F.col("content").alias("text"),
                    "timestamp", "room_name", "room_id")
    gift = F.struct("username", "gift_name", F.col("amount").alias("gift_count"), "timestamp", "room_name", "room_id")
    stats = F.struct(F.col("amount").cast("string").alias("online"), F.col("content").alias("total_users"),
                     F.lit("websocket").alias("source"), "timestamp", "room_name", "room_id")
    value = F.when(kind == "chat", F.to_json(chat)).when(kind == "gift", F.to_json(gift)).otherwise(F.to_json(stats))
    return routed.filter(F.col("topic").isNotNull()).select(*keep, "topic", F.col("room_id").alias("key"), value.alias("value"))


def rank_entries(envelopes: DataFrame) -> DataFrame:
    """Ranking lists as one row per place."""
    ranks = envelopes.filter(message_kind(F.col("method")) == "rank")
    decoded = decode_json(ranks, "payload", PAYLOAD)
    keep = [c for c in envelopes.columns if c not in ("method", "payload")]
    return decoded.select(*keep, F.posexplode("body.ranks_list").alias("place", "entry")).select(
        *keep,
        (F.col("place") + 1).alias("place"),
        F.col("entry.user.id").alias("user_id"),
        F.col("entry.user.nick_name").alias("username"),
        F.col("entry.score_str").alias("score"),
    )


def route_params(responses: DataFrame, names: Sequence[str], value: str = "response") -> DataFrame:
    """Routing parameters of server responses (id, room_id, JSON), merged over the responses of each room.

    The map of a response is exploded into one row a parameter; of the ``names`` asked for come the uses, the distinct
    values, and the value that stands after all responses, which is that of the highest id.
    """
    decoded = decode_json(responses, value, RESPONSE).filter(F.col("bad").isNull())
    entries = decoded.select("id", "room_id", F.explode("body.routeParams").alias("param", "setting"))
    wanted = entries.filter(F.col("param").isin(*names))
    # Equal settings collapse first, so a parameter that hardly changes is a few rows.
    settings = wanted.groupBy("room_id", "param", "setting").agg(F.count("*").alias("n"), F.max("id").alias("last_id"))
    return settings.groupBy("room_id", "param").agg(
        F.sum("n").alias("uses"), F.count("*").alias("settings"), F.max_by("setting", F.struct("last_id", "setting")).alias("setting"), F.max("last_id").alias("last_id")
    )


def message_type_counts(routed: DataFrame) -> DataFrame:
    """Messages per room of the counted types and in total."""
    return routed.groupBy("room_id").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in COUNTED_KINDS],
        F.count_if(F.col("kind").isin(*COUNTED_KINDS)).alias("total"),
    )
