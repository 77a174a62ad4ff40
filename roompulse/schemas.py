"""Declared shapes of messages and tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# Topic names.
TOPIC_CHAT = "live_danmaku"
TOPIC_GIFT = "live_gifts"
TOPIC_ROOM = "live_room_info"


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


S, L, I, B, D = StringType(), LongType(), IntegerType(), BooleanType(), DoubleType()

CHAT_MESSAGE = _struct(room_id=S, room_name=S, username=S, user_id=S, text=S, timestamp=S)
GIFT_MESSAGE = _struct(room_id=S, room_name=S, username=S, gift_name=S, gift_count=L, timestamp=S)
ROOM_MESSAGE = _struct(
    room_id=S, room_name=S, title=S, streamer=S, online=S, like_count=L, status=S, status_code=L,
    has_cart=B, cart_total=L, has_commerce=B, can_danmaku=B, can_gift=B, total_users=S, source=S, timestamp=S,
)
# Any message of the three topics; fields a topic lacks stay null.
TOPIC_MESSAGE = _struct(
    room_id=S, room_name=S, username=S, user_id=S, text=S, gift_name=S, gift_count=L,
    title=S, streamer=S, online=S, like_count=L, status=S, has_cart=B, cart_total=L, has_commerce=B,
    total_users=S, source=S, timestamp=S,
)

# Nested room record as collected, before it is flattened.
ROOM_RECORD = _struct(
    room_id=S,
    room_name=S,
    title=S,
    owner=_struct(nickname=S),
    user_count_str=S,
    like_count=L,
    status=L,
    room_cart=_struct(contain_cart=B, total=L),
    stats=_struct(total_user_str=S),
    room_auth=_struct(Danmaku=B, Gift=B),
    has_commerce_goods=B,
    timestamp=S,
)

USER = _struct(id=L, nick_name=S, gender=I)
RANK_ENTRY = _struct(user=USER, score_str=S, profile_hidden=B)
# One payload schema covers every routed message type, so a payload is parsed once.
PAYLOAD = _struct(
    user=USER,
    content=S,
    gift=_struct(id=L, name=S),
    combo_count=L,
    count=L,
    total=L,
    total_pv_for_anchor=S,
    status=L,
    emoji_id=L,
    default_content=S,
    common=_struct(room_id=L, method=S),
    display_long=S,
    ranks_list=ArrayType(RANK_ENTRY),
    adaptation_type=L,
)
# What a server response says beside its messages.
RESPONSE = _struct(cursor=S, fetchInterval=L, routeParams=MapType(S, S), pushServer=S)
ENVELOPE = _struct(method=S, room_id=S, payload=S, timestamp=S)

ODS_ROOM_INFO = _struct(
    room_id=S, room_name=S, title=S, streamer=S, online=L, like_count=L, status=S, has_cart=B, has_commerce=B, ts=S,
)
ODS_DANMAKU = _struct(
    room_id=S, room_name=S, username=S, text=S, msg_type=S, gift_name=S, gift_count=L, ts=S,
)
ODS_GIFTS = _struct(room_id=S, uid=L, username=S, gift_name=S, gift_count=I, price=D, ts=S)
ODS_ORDERS = _struct(room_id=S, product_name=S, price=D, quantity=I, user_id=L, ts=S)
