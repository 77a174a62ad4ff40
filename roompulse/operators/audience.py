"""Audience reports: tiers, activity, funnel, RFM, retention, journeys and message lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roompulse.functions.numbers import percent, ratio, whole_div
from roompulse.functions.texts import like_pattern
from roompulse.functions.times import CLOCK_MINUTE, clock, micros_between, minute_of, minutes
from roompulse.operators.common import newest_rows, only, top_per_key, upper_medians

# Tiers by number of chats, lowest bound and label.
TIERS = (
    (100, "超级粉(100+)"),
    (50, "铁杆粉(50-99)"),
    (10, "忠实粉丝(10-49)"),
    (3, "活跃观众(3-9)"),
    (0, "路人(1-2)"),
)

# Funnel step names.
FUNNEL_STEPS = (
    "独立观众",
    "发弹幕互动",
    "活跃互动(≥5条)",
    "高活跃(≥10条)",
    "送礼用户",
    "核心用户(高活跃+送礼)",
)

# RFM groups by (recent, frequent).
RFM_CORE = "核心粉丝(R低F高)"
RFM_NEW = "新晋活跃(R低F低)"
RFM_ASLEEP = "沉睡用户(R高F高)"
RFM_AT_RISK = "流失风险(R高F低)"
RFM_GROUPS = (RFM_CORE, RFM_NEW, RFM_ASLEEP, RFM_AT_RISK)

ACTIVE_CHATS = 10
SOME_CHATS = 3
RETENTION_DAYS = 14
TENTH_HOUR_MICROS = 360_000_000


def is_chat() -> Column:
    return F.col("msg_type") == "chat"


def is_gift() -> Column:
    return F.col("msg_type") == "gift"


def by_chats() -> tuple[Column, Column]:
    """Busiest users first, names settling ties."""
    return F.col("cnt").desc(), F.col("username").asc_nulls_last()


def tier(chats: Column) -> Column:
    label = None
    for bound, name in TIERS[:-1]:
        label = F.when(chats >= bound, name) if label is None else label.when(chats >= bound, name)
    return label.otherwise(TIERS[-1][1])


def chats_per_user(danmaku: DataFrame, room: str | None = None) -> DataFrame:
    """Chats by room and user; messages without a name form one group of their own."""
    chats = only(danmaku, room_name=room).filter(is_chat())
    return chats.groupBy("room_name", "username").agg(F.count("*").alias("cnt"))


def _spread(per_room: DataFrame, labels: list[tuple[str, Column]], name: str, value: str) -> DataFrame:
    """One row per label from columns computed side by side."""
    entries = F.array(*[F.struct(F.lit(label).alias(name), col.alias(value)) for label, col in labels])
    return per_room.select("room_name", F.inline(entries))


def user_segmentation(danmaku: DataFrame, room: str | None = None) -> DataFrame:
    """Users per tier and room; empty tiers are reported with 0."""
    tiered = chats_per_user(danmaku, room).select("room_name", tier(F.col("cnt")).alias("tier"))
    counted = tiered.groupBy("room_name").agg(
        *[F.count_if(F.col("tier") == label).alias(f"t{i}") for i, (_, label) in enumerate(TIERS)]
    )
    return _spread(counted, [(label, F.col(f"t{i}")) for i, (_, label) in enumerate(TIERS)], "tier", "users")


def user_segment_samples(danmaku: DataFrame, k: int = 3, room: str | None = None) -> DataFrame:
    """The ``k`` busiest users of every tier."""
    tiered = chats_per_user(danmaku, room).withColumn("tier", tier(F.col("cnt")))
    return top_per_key(tiered, ["room_name", "tier"], by_chats(), k)


def _user_activity(danmaku: DataFrame, room: str | None = None) -> DataFrame:
    """One row per room and user with both counts, from a single pass over the messages."""
    return (
        only(danmaku, room_name=room)
        .groupBy("room_name", "username")
        .agg(F.count_if(is_chat()).alias("chats"), F.count_if(is_gift()).alias("gifts"))
    )


def activity_levels(danmaku: DataFrame, room: str | None = None) -> DataFrame:
    """High, mid and low activity users per room with the shares of the first two."""
    named = F.count_if(F.col("username").isNotNull())
    per_room = (
        _user_activity(danmaku, room)
        .groupBy("room_name")
        .agg(
            F.greatest(named, F.lit(1)).alias("total_users"),
            F.count_if(F.col("chats") >= ACTIVE_CHATS).alias("high_active"),
            F.count_if(F.col("chats").between(SOME_CHATS, ACTIVE_CHATS - 1)).alias("mid_active"),
        )
    )
    low = F.col("total_users") - F.col("high_active") - F.col("mid_active")
    return per_room.select(
        "*",
        F.greatest(low, F.lit(0)).alias("low_active"),
        percent(F.col("high_active"), F.col("total_users")).alias("high_rate"),
        percent(F.col("mid_active"), F.col("total_users")).alias("mid_rate"),
    )


def funnel_full(danmaku: DataFrame, room: str | None = None) -> DataFrame:
    """Six steps from any message to active gift givers, each as a share of the first.

    The two lists of active and of giving users meet in the per-user counts, so no
    join is needed.
    """
    named = F.col("username").isNotNull()
    chats, gifts = F.col("chats"), F.col("gifts")
    per_room = (
        _user_activity(danmaku, room)
        .groupBy("room_name")
        .agg(
            F.greatest(F.count_if(named), F.lit(1)).alias("s0"),
            F.count_if(named & (chats > 0)).alias("s1"),
            F.count_if(chats >= 5).alias("s2"),
            F.count_if(chats >= ACTIVE_CHATS).alias("s3"),
            F.count_if(named & (gifts > 0)).alias("s4"),
            F.count_if(named & (chats >= ACTIVE_CHATS) & (gifts > 0)).alias("s5"),
        )
    )
    steps = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(name).alias("name"),
                F.col(f"s{i}").alias("value"),
                percent(F.col(f"s{i}"), F.col("s0")).alias("rate"),
            )
            for i, name in enumerate(FUNNEL_STEPS)
        ]
    )
    return per_room.select("room_name", F.inline(steps))


def rfm_users(
    danmaku: DataFrame, min_messages: int = 3, room: str | None = None, as_of=None, cap: int | None = None
) -> DataFrame:
    """Recency, frequency and engagement of every user with enough chats, and their group.

    ``cap`` keeps only the busiest users of each room; by default all take part.
    """
    now = clock(danmaku, "created_at", as_of)
    chats = only(danmaku, room_name=room).filter(is_chat() & F.col("username").isNotNull())
    users = (
        chats.groupBy("room_name", "username", F.to_date("created_at").alias("day"))
        .agg(F.count("*").alias("n"), F.max("created_at").alias("last"))
        .groupBy("room_name", "username")
        .agg(
            F.sum("n").alias("frequency"),
            F.max("last").alias("last_time"),
            F.count("*").alias("active_days"),
        )
        .filter(F.col("frequency") >= min_messages)
    )
    if cap:
        order = (F.col("frequency").desc(), F.col("username").asc())
        users = top_per_key(users, ["room_name"], order, cap).drop("rank")
    idle = F.greatest(micros_between(F.col("last_time"), now), F.lit(0).cast("bigint"))
    tenths = whole_div(idle + TENTH_HOUR_MICROS // 2, F.lit(TENTH_HOUR_MICROS))
    users = users.select(
        "room_name",
        "username",
        tenths.alias("idle_tenths"),
        "frequency",
        ratio(F.col("frequency"), F.col("active_days"), 1).alias("engagement"),
        "active_days",
    )
    medians = upper_medians(users, ["room_name"], {"idle_tenths": "r_tenths", "frequency": "f_median"})
    is_recent = F.col("idle_tenths") <= F.col("r_tenths")
    is_often = F.col("frequency") >= F.col("f_median")
    segment = (
        F.when(is_recent & is_often, RFM_CORE)
        .when(is_recent, RFM_NEW)
        .when(is_often, RFM_ASLEEP)
        .otherwise(RFM_AT_RISK)
    )
    return users.join(medians, "room_name").select(
        "room_name",
        "username",
        (F.col("idle_tenths") / 10.0).alias("recency"),
        "frequency",
        "engagement",
        "active_days",
        segment.alias("segment"),
        (F.col("r_tenths") / 10.0).alias("r_median"),
        "f_median",
    )


def rfm_segments(users: DataFrame) -> DataFrame:
    """Size of the four groups of :func:`rfm_users` per room, with the medians that split them."""
    per_room = users.groupBy("room_name").agg(
        F.count("*").alias("total_users"),
        F.max("r_median").alias("r_median"),
        F.max("f_median").alias("f_median"),
        *[F.count_if(F.col("segment") == name).alias(f"g{i}") for i, name in enumerate(RFM_GROUPS)],
    )
    groups = F.array(
        *[F.struct(F.lit(n).alias("segment"), F.col(f"g{i}").alias("users")) for i, n in enumerate(RFM_GROUPS)]
    )
    return per_room.select("room_name", "total_users", "r_median", "f_median", F.inline(groups))


def rfm_top(users: DataFrame, k: int = 3, by_segment: bool = True) -> DataFrame:
    """Busiest users of each RFM group, or of each room."""
    keys = ["room_name", "segment"] if by_segment else ["room_name"]
    order = (F.col("frequency").desc(), F.col("username").asc())
    return top_per_key(users, keys, order, k)


def _cohorts(danmaku: DataFrame, days: int, room: str | None) -> DataFrame:
    """Users by room, first chat day and days since then (0 to ``days``)."""
    chats = only(danmaku, room_name=room).filter(is_chat() & F.col("username").isNotNull())
    active = chats.select("room_name", "username", F.to_date("created_at").alias("day")).distinct()
    first = F.min("day").over(Window.partitionBy("room_name", "username"))
    aged = active.withColumn("first_day", first).withColumn("age", F.date_diff("day", "first_day"))
    return aged.filter(F.col("age") <= days).groupBy("room_name", "first_day", "age").agg(F.count("*").alias("users"))


def retention_daily(danmaku: DataFrame, days: int = RETENTION_DAYS, room: str | None = None, as_of=None) -> DataFrame:
    """Share of users chatting again exactly 1..``days`` days after their first chat.

    ``rate`` divides by all users; ``rate_observable`` only by those whose day
    lies within the data.
    """
    end = F.to_date(clock(danmaku, "created_at", as_of))
    cohorts = _cohorts(danmaku, days, room)
    ages = cohorts.withColumn(
        "entry",
        F.when(F.col("age") > 0, F.array(F.col("age"))).otherwise(F.sequence(F.lit(1), F.lit(days))),
    ).select("room_name", "first_day", "age", "users", F.explode("entry").alias("day"))
    is_cohort = F.col("age") == 0
    seen = is_cohort & (F.date_add(F.col("first_day"), F.col("day")) <= end)
    counted = ages.groupBy("room_name", "day").agg(
        F.coalesce(F.sum(F.when(~is_cohort, F.col("users"))), F.lit(0)).alias("retained"),
        F.coalesce(F.sum(F.when(is_cohort, F.col("users"))), F.lit(0)).alias("total_users"),
        F.coalesce(F.sum(F.when(seen, F.col("users"))), F.lit(0)).alias("observable"),
    )
    return counted.select(
        "*",
        percent(F.col("retained"), F.col("total_users")).alias("rate"),
        percent(F.col("retained"), F.col("observable")).alias("rate_observable"),
    )


def retention_summary(daily: DataFrame) -> DataFrame:
    """Day 1, 3 and 7 rates per room from :func:`retention_daily`."""
    picks = [F.max(F.when(F.col("day") == d, F.col("rate"))).alias(f"day{d}") for d in (1, 3, 7)]
    return daily.groupBy("room_name").agg(F.max("total_users").alias("total_users"), *picks)


def user_journey(
    danmaku: DataFrame,
    users: int = 5,
    min_chats: int = 10,
    events: int = 20,
    shown: int = 10,
    seed: str = "journey",
    room: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """First events of a seeded random sample of active users, one job for all rooms.

    ``counted`` may give the same messages without their texts, to count chats on.
    """
    danmaku = only(danmaku, room_name=room)
    active = chats_per_user(danmaku if counted is None else counted, room).filter((F.col("cnt") >= min_chats) & F.col("username").isNotNull())
    draw = F.md5(F.concat(F.lit(seed), F.col("username")))
    sample = top_per_key(active, ["room_name"], (draw.asc(), F.col("username").asc()), users)
    chosen = sample.select("room_name", "username")
    mine = danmaku.join(chosen, ["room_name", "username"], "left_semi")
    key = ["room_name", "username"]
    early = top_per_key(mine, key, (F.col("id").asc(),), events, "seq")
    whole = Window.partitionBy(*key)
    detail = F.when(
        is_gift(), F.concat(F.col("gift_name"), F.lit(" x"), F.col("gift_count").cast("string"))
    ).otherwise(F.substring("text", 1, 30))
    return early.select(
        *key,
        "seq",
        F.col("msg_type").alias("type"),
        detail.alias("detail"),
        F.col("created_at").alias("time"),
        F.count("*").over(whole).alias("total_messages"),
        F.min_by("created_at", "id").over(whole).alias("first"),
        F.max_by("created_at", "id").over(whole).alias("last"),
    ).filter(F.col("seq") <= shown)


def top_users(danmaku: DataFrame, n: int = 15, room: str | None = None) -> DataFrame:
    return top_per_key(chats_per_user(danmaku, room), ["room_name"], by_chats(), n)


def hourly_activity(danmaku: DataFrame, room: str | None = None) -> DataFrame:
    chats = only(danmaku, room_name=room).filter(is_chat())
    return chats.groupBy("room_name", F.hour("created_at").alias("hour")).agg(F.count("*").alias("cnt"))


def danmaku_trend(
    danmaku: DataFrame, mins: int = 60, by_clock: bool = True, room: str | None = None, as_of=None
) -> DataFrame:
    """Messages per minute in the last ``mins`` minutes, or in all history for a silent room.

    Both counts come from one pass; the choice is made on the small result.  With
    ``by_clock`` minutes of different days share a bucket, as ``HH:mm``.
    """
    danmaku = only(danmaku, room_name=room)
    start = clock(danmaku, "created_at", as_of) - minutes(mins)
    recent = F.col("created_at") > start
    t = F.date_format("created_at", CLOCK_MINUTE) if by_clock else minute_of(F.col("created_at"))
    per_minute = danmaku.groupBy("room_name", t.alias("t")).agg(
        F.count("*").alias("n_all"), F.count_if(recent).alias("n_recent")
    )
    has_recent = F.max("n_recent").over(Window.partitionBy("room_name")) > 0
    c = F.when(has_recent, F.col("n_recent")).otherwise(F.col("n_all"))
    return per_minute.select("room_name", "t", c.alias("c")).filter(F.col("c") > 0)


def danmaku_recent(danmaku: DataFrame, n: int = 20, room: str | None = None, complete=None) -> DataFrame:
    """The ``n`` newest messages of every room; ``complete`` may add columns, such as the text, to the chosen rows."""
    rows = newest_rows(only(danmaku, room_name=room), ["room_name"], "id", n)
    return (complete(rows) if complete else rows).select(
        "room_name", "rank", "username", "text", "gift_name", "gift_count", "msg_type", "created_at"
    )


def danmaku_search(danmaku: DataFrame, needle: str, n: int = 50, room: str | None = None) -> DataFrame:
    """The ``n`` newest messages whose text contains ``needle``, ignoring case."""
    found = only(danmaku, room_name=room).filter(F.ilike("text", F.lit(like_pattern(needle))))
    return (
        found.orderBy(F.col("id").desc())
        .limit(n)
        .select("id", "room_name", "username", "text", "gift_name", "created_at")
    )


def export_latest(danmaku: DataFrame, n: int = 10_000, room: str | None = None, complete=None) -> DataFrame:
    """The ``n`` newest messages per room with every column, ready for a CSV sink; ``complete`` as for the newest."""
    rows = newest_rows(only(danmaku, room_name=room), ["room_name"], "id", n).select(*danmaku.columns)
    return complete(rows) if complete else rows
