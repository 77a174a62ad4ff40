"""Every query by name: operators applied to the views of one data folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StructType

from roompulse.functions.numbers import parse_count, try_parse_count
from roompulse.functions.times import iso_text, parse_iso
from roompulse.operators import audience, commerce, forecast, messages, recommend, rooms, sketches, text, warehouse, windows
from roompulse.operators.common import top_per_key, upper_medians
from roompulse.plans.views import Views
from roompulse.schemas import CHAT_MESSAGE, ODS_DANMAKU, ODS_GIFTS, ODS_ORDERS, ROOM_RECORD, TOPIC_CHAT, TOPIC_GIFT, TOPIC_MESSAGE, TOPIC_ROOM
from roompulse.session import shared_folder
from roompulse.sinks.files import overwrite_orc, save_table, stored, write_tsv
from roompulse.sinks.landing import Landing
from roompulse.sinks.topics import as_messages, read_once, write_messages
from roompulse.sources.evolution import read_generations
from roompulse.sources.files import read_orc, read_tsv
from roompulse.streaming import replay

# The data spans 30 days of events and six years of orders, thin in time, so
# look-back windows are wider than a live room would use.
SPAN_DAYS = 365
BUSY_CHATS = 10


def portable(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, which every client shows alike."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            c = c.cast("string").alias(field.name)
        elif isinstance(field.dataType, DecimalType):
            c = c.cast("double").alias(field.name)
        columns.append(c)
    return df.select(*columns)


# --- inputs in the shape of messages, derived from the views -------------------


def chat_json(v: Views) -> DataFrame:
    """Chat messages as JSON text, every 50th cut short so that it is damaged."""
    chats = v.danmaku.filter(F.col("msg_type") == "chat")
    fields = F.struct(
        "room_id", "room_name", "username", "user_id", "text", iso_text(F.col("created_at")).alias("timestamp")
    )
    whole = F.to_json(fields)
    damaged = F.substring(whole, 1, 20)
    return chats.select("id", F.when(F.col("id") % 50 == 0, damaged).otherwise(whole).alias("value"))


def topic_messages(v: Views) -> DataFrame:
    """All three topics as one frame of decoded messages, some fields missing."""
    d = v.danmaku.withColumn("timestamp", iso_text(F.col("created_at")))
    chat = d.filter(F.col("msg_type") == "chat").select(
        F.lit(TOPIC_CHAT).alias("topic"), "room_id", "username", "user_id", "text", "timestamp", "id"
    )
    gift = d.filter(F.col("msg_type") == "gift").select(
        F.lit(TOPIC_GIFT).alias("topic"), "room_id", "room_name", "username", "gift_name",
        F.when(F.col("id") % 2 == 0, F.col("gift_count").cast("bigint")).alias("gift_count"), "timestamp", "id",
    )
    m = v.live_metrics
    full = m.select(
        F.lit(TOPIC_ROOM).alias("topic"), "room_id", "title", "online",
        F.when(F.col("id") % 3 != 0, F.col("like_count")).alias("like_count"), "status",
        F.when(F.col("has_cart"), F.lit(True)).alias("has_cart"), F.col("cart_total").cast("bigint").alias("cart_total"),
        "has_commerce", iso_text(F.col("created_at")).alias("timestamp"), "id",
    )
    socket = v.room_stats.select(
        F.lit(TOPIC_ROOM).alias("topic"), F.lit("websocket").alias("source"), "room_id", "room_name",
        F.col("online_count").cast("string").alias("online"), "total_users", iso_text(F.col("created_at")).alias("timestamp"), "id",
    )
    rows = chat
    for other in (gift, full, socket):
        rows = rows.unionByName(other, allowMissingColumns=True)
    body = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TOPIC_MESSAGE.fields]
    return messages.named_rooms(rows.select("topic", "id", *body), v.rooms)


def room_records(v: Views) -> DataFrame:
    """Nested room records as JSON, with parts left out."""
    k = F.col("k")
    signups = v.activity.filter(F.col("event_type") == "signup").join(v.rooms, "room_id")
    record = F.struct(
        "room_id",
        "room_name",
        F.when(k % 4 != 0, F.concat(F.lit("title "), k.cast("string"))).alias("title"),
        F.struct(F.when(k % 3 != 0, F.lit("streamer")).alias("nickname")).alias("owner"),
        (100 + k).cast("string").alias("user_count_str"),
        (F.col("event_id") * 3).alias("like_count"),
        F.when(k % 7 == 0, 4).otherwise(2).alias("status"),
        F.when(k % 2 == 0, F.struct(F.lit(True).alias("contain_cart"), k.alias("total"))).alias("room_cart"),
        F.struct(F.concat(k.cast("string"), F.lit("万")).alias("total_user_str")).alias("stats"),
        F.struct((k % 5 == 0).alias("Danmaku")).alias("room_auth"),
        (k % 3 == 0).alias("has_commerce_goods"),
        iso_text(F.col("created_at")).alias("timestamp"),
    )
    return messages.decode_json(signups.select(F.col("event_id").alias("id"), F.to_json(record).alias("value")), "value", ROOM_RECORD)


def envelopes(v: Views, activity: DataFrame | None = None) -> DataFrame:
    """Every event as a decoded envelope: thirteen known types and two unknown ones in turn."""
    names = [*messages.METHODS, "WebcastLiveShoppingMessage", "WebcastProductChangeMessage"]
    k = F.col("k")
    user = F.struct(F.col("user_id").alias("id"), F.col("username").alias("nick_name"), (k % 2).alias("gender"))
    rank = F.struct(user.alias("user"), k.cast("string").alias("score_str"))
    payload = F.struct(
        user.alias("user"),
        F.concat(F.lit("say "), k.cast("string")).alias("content"),
        F.struct((k % 9).alias("id"), F.concat(F.lit("gift_"), (k % 9).cast("string")).alias("name")).alias("gift"),
        (1 + k % 5).alias("combo_count"),
        k.alias("count"),
        (100 + k).alias("total"),
        F.concat(k.cast("string"), F.lit(".5万")).alias("total_pv_for_anchor"),
        (1 + k % 3).alias("status"),
        (500 + k).alias("emoji_id"),
        F.lit("[smile]").alias("default_content"),
        F.struct((F.col("event_id") % 5).alias("room_id")).alias("common"),
        F.concat(k.cast("string"), F.lit(" watching")).alias("display_long"),
        F.when(k % 2 == 0, F.array(rank, rank)).otherwise(F.array(rank)).alias("ranks_list"),
        (k % 4).alias("adaptation_type"),
    )
    method = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % len(names) + 1).cast("int"))
    e = (v.activity if activity is None else activity).join(v.rooms, "room_id")
    return e.select(
        F.col("event_id").alias("id"), method.alias("method"), "room_id", "room_name", F.to_json(payload).alias("payload"),
        iso_text(F.col("created_at")).alias("timestamp"),
    )


# --- the queries -----------------------------------------------------------------


def _samples(v: Views) -> DataFrame:
    return windows.audience_samples(v.live_metrics, v.room_stats)


def _signals(v: Views) -> DataFrame:
    return windows.room_signals(v.signals, _samples(v), v.gift_prices)


def _snapshot(v: Views, minutes: int = 1) -> DataFrame:
    """Snapshots look at the samples several times over, so these, a small part of the events, are stored first."""
    samples = stored(_samples(v), "samples")
    return windows.room_snapshot(windows.room_signals(v.signals, samples, v.gift_prices), samples, minutes)


def _timed(v: Views) -> DataFrame:
    return v.signals.filter(F.col("msg_type") == "chat").withColumn("event_time", F.col("created_at"))


def _scores(v: Views) -> DataFrame:
    return text.sentiment_score(text.chat_lines(v.danmaku), v.sentiment_model)


def _sentiment_users(v: Views) -> DataFrame:
    return text.sentiment_users(v.danmaku, v.sentiment_model)


def _growth(v: Views) -> DataFrame:
    return commerce.product_growth(v.orders, SPAN_DAYS)


def _line(v: Views) -> DataFrame:
    return forecast.sales_line(forecast.daily_sales(v.sales))


def _json_quarantine(v: Views) -> DataFrame:
    decoded = messages.json_quarantine(chat_json(v), "value", CHAT_MESSAGE)
    fields = [F.when(~F.col("bad"), F.col(f"body.{name}")).alias(name) for name in ("room_id", "username", "timestamp")]
    return decoded.select("id", *fields, "bad")


def _fn_iso_parse(v: Views) -> DataFrame:
    """ISO texts with and without a fraction, and some that are no time at all."""
    ts = F.col("created_at")
    k = F.col("k")
    written = F.when(k % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).when(k % 3 == 1, iso_text(ts)).otherwise("soon")
    parsed = parse_iso(written).cast("timestamp_ntz")
    return v.activity.select("event_id", written.alias("written"), parsed.alias("parsed"))


def _fn_parse_count(v: Views) -> DataFrame:
    return v.live_metrics.select(
        "id", "online", parse_count(F.col("online")).alias("n"), try_parse_count(F.col("online")).isNull().alias("unreadable")
    )


def _ingest(rows: Callable[[DataFrame], DataFrame]) -> Callable[[Views], DataFrame]:
    return lambda v: rows(topic_messages(v)).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def _stream_idle(v: Views) -> DataFrame:
    """Hourly snapshots with the silent hours of each room, up to the last hour in which any room had a signal."""
    rows = replay.room_snapshot(v, 60, idle=True)
    last = rows.filter("active").agg(F.max("window_start")).scalar()
    return rows.filter(F.col("window_start") <= last)


def _json_encode(v: Views) -> DataFrame:
    stats = v.room_stats.select("id", "room_id", "room_name", "online_count", "total_users")
    return stats.select("id", messages.encode_json(stats.drop("id")).alias("value"))


def _sampled_users(v: Views) -> DataFrame:
    """A seeded random handful of users per room."""
    users = audience.chats_per_user(v.signals).filter(F.col("username").isNotNull())
    draw: Column = F.md5(F.concat(F.lit("sample"), F.col("username")))
    return top_per_key(users, ["room_name"], (draw.asc(), F.col("username").asc()), 5)


def _tsv_round_trip(v: Views) -> DataFrame:
    """Messages landed as text and read back; texts of messages hold line breaks."""
    path = shared_folder(v.spark, "tsv")
    write_tsv(warehouse.ods_danmaku(v.danmaku), path)
    return read_tsv(v.spark, path, ODS_DANMAKU, line_breaks=True)


def _landed(v: Views, rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows landed as text and read back in the declared shape."""
    path = shared_folder(v.spark, "ods")
    write_tsv(rows, path)
    return read_tsv(v.spark, path, schema)


def _orc_overwrite(v: Views) -> DataFrame:
    """Room samples written twice over, by partition and day, and read back."""
    path, rows = shared_folder(v.spark, "orc"), warehouse.ods_room_info(v.live_metrics)
    overwrite_orc(rows.limit(10).withColumn("part", F.lit(0)), path, "part")
    overwrite_orc(rows.withColumn("part", F.pmod(F.col("like_count"), F.lit(2)).cast("int")), path, "part")
    return read_orc(v.spark, path).drop("part")


def _ctas_product_ranking(v: Views) -> DataFrame:
    table = f"ranking_{uuid.uuid4().hex}"
    save_table(warehouse.ads_product_ranking(v.orders), table)
    return v.spark.table(table)


# Ends of the first load and of the first increment.
LOADED_UP_TO = (dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 22))


def _ods_landed(v: Views) -> DataFrame:
    """A full load, two increments behind its mark, the first of them run twice; read back with the number of the load."""
    landing = Landing(v.spark, shared_folder(v.spark, "landed"))
    full, first = LOADED_UP_TO
    landing.load(v.danmaku, "full", full=True, as_of=full, shape=warehouse.ods_danmaku)
    for _ in range(2):
        landing.load(v.danmaku, "first", as_of=first, shape=warehouse.ods_danmaku)
    landing.load(v.danmaku, "second", shape=warehouse.ods_danmaku)
    return landing.read(lambda path: read_tsv(v.spark, path, ODS_DANMAKU, line_breaks=True))


def _active_users_sketch(v: Views) -> DataFrame:
    """Estimated distinct users of hours and days beside the exact ones, and whether they are as near as stated."""
    estimated = sketches.active_users(v.signals)
    exact = [
        v.signals.groupBy(F.lit(unit).alias("unit"), "room_name", F.date_trunc(unit, "created_at").cast("timestamp_ntz").alias("start")).agg(
            F.count_distinct("username").alias("users")
        )
        for unit in ("hour", "day")
    ]
    both = exact[0].unionByName(exact[1]).filter(F.col("users") > 0).join(estimated, ["unit", "room_name", "start"], "full")
    return both.select("unit", "room_name", "start", "users", sketches.within(F.col("estimate"), F.col("users")).alias("near"))


def _rfm_medians_sketch(v: Views) -> DataFrame:
    """Medians of sketches by room and last day, merged across days, against the exact upper medians: are their places near the middle?"""
    names = ["tenths", "frequency"]
    users = audience.rfm_users(v.signals).select("room_name", half_tenths().alias("tenths"), "frequency", (F.col("recency") / 24).cast("int").alias("day"))
    by_day = sketches.quantile_sketches(users, ["room_name", "day"], names)
    found = sketches.medians(sketches.merged_quantiles(by_day, ["room_name"], names), ["room_name"], names)
    errors = sketches.rank_error(users, ["room_name"], found, names)
    exact = upper_medians(users, ["room_name"], {"tenths": "r_median", "frequency": "f_median"})
    near = [(F.col(n) <= sketches.RANK_ERROR).alias(f"{short}_near") for n, short in zip(names, "rf")]
    return exact.join(errors, "room_name").select("room_name", (F.col("r_median") / 10.0).alias("r_median"), "f_median", *near)


def half_tenths() -> Column:
    """Recency, which is in tenths of an hour, as a whole number."""
    return F.round(F.col("recency") * 10).cast("bigint")


def responses(v: Views) -> DataFrame:
    """Server responses as JSON, one an event: a map of routing parameters, some of them missing or changing over time."""
    k = F.col("k")
    params = F.map_concat(
        F.create_map(F.lit("room_id"), F.col("room_id"), F.lit("cursor"), F.concat(F.lit("c"), F.col("event_id").cast("string"))),
        F.when(k % 3 == 0, F.create_map(F.lit("region"), F.concat(F.lit("zone-"), (k % 4).cast("string")))).otherwise(F.create_map().cast("map<string,string>")),
        F.when(k % 5 == 0, F.create_map(F.lit("host"), F.concat(F.lit("push-"), (k % 7).cast("string")))).otherwise(F.create_map().cast("map<string,string>")),
    )
    e = v.activity.join(v.rooms, "room_id")
    return e.select(F.col("event_id").alias("id"), "room_id", F.to_json(F.struct(params.alias("routeParams"), k.alias("fetchInterval"))).alias("response"))


def _evolved_metrics(v: Views) -> DataFrame:
    """Room samples written by three generations of a writer: fewer columns and narrow numbers first, all of them last."""
    m = v.live_metrics.select("id", "room_id", "like_count", "cart_total", "has_cart", "status", "created_at")
    root, third = shared_folder(v.spark, "generations"), F.col("id") % 3
    narrow = m.filter(third == 0).select("id", "room_id", F.col("like_count").cast("int").alias("like_count"), "created_at")
    grown = m.filter(third == 1).select("id", "room_id", "like_count", F.col("cart_total").cast("smallint").alias("cart_total"), "created_at")
    paths = []
    for number, rows in enumerate((narrow, grown, m.filter(third == 2))):
        paths.append(f"{root}/generation={number}")
        rows.write.parquet(paths[-1])
    return read_generations(v.spark, paths)


def _published_round_trip(v: Views) -> DataFrame:
    """Published messages written twice over, as after a failed batch, and read without the repeats."""
    path = shared_folder(v.spark, "published")
    routed = messages.route_messages(envelopes(v))
    rows = as_messages(messages.publish(routed, "id"), F.col("id"))
    write_messages(rows, "parquet", path=path)
    write_messages(rows.filter(F.col("key") != "room_3"), "parquet", path=path)
    return read_once(v.spark.read.parquet(path)).select("topic", "key", "value")


def _user_texts(v: Views) -> DataFrame:
    """Every user's chats joined in id order, as the digest and length of each piece."""
    pieces = sketches.user_texts(v.danmaku.filter(F.col("msg_type") == "chat"), 3)
    return pieces.select(
        "room_name", "username", "piece", "first_id", "last_id", "chats", F.md5("texts").alias("texts_md5"), F.char_length("texts").alias("n_chars")
    )


ROOM = "ASIA"

QUERIES: dict[str, Callable[[Views], DataFrame]] = {
    # streams, as batch plans over the same rows
    "danmaku_tumble_1m": lambda v: windows.tumble_counts(_timed(v)),
    "room_minute_agg": lambda v: windows.room_minute_agg(_signals(v)),
    "online_alerts": lambda v: windows.online_alerts(_samples(v)),
    "alert_messages": lambda v: windows.alert_messages(windows.online_alerts(_samples(v))),
    "gift_value": lambda v: windows.gift_value(v.signals, v.gift_prices),
    "room_snapshot": _snapshot,
    "surge_alerts": lambda v: windows.surge_alerts(_snapshot(v, 60), 4, 100),
    "route_messages": lambda v: messages.route_messages(envelopes(v)),
    "published_messages": lambda v: messages.publish(messages.route_messages(envelopes(v))),
    "rank_entries": lambda v: messages.rank_entries(envelopes(v)),
    "message_type_counts": lambda v: messages.message_type_counts(messages.route_messages(envelopes(v))),
    "room_liveness": lambda v: rooms.room_liveness(v.rooms, v.live_metrics),
    # streams, run to the end of the data by the streaming engine
    "stream_danmaku_tumble_1m": replay.tumble_counts,
    "stream_room_minute_agg": replay.room_minute_agg,
    "stream_online_alerts": replay.online_alerts,
    "stream_room_snapshot": lambda v: replay.room_snapshot(v).filter("active").drop("active"),
    "stream_room_snapshot_idle": _stream_idle,
    "stream_message_type_counts": lambda v: replay.message_type_counts(v, envelopes),
    "stream_late_rows": replay.late_rows,
    "stream_gift_value": replay.gift_value,
    "stream_ingest": lambda v: replay.ingest(v, topic_messages(v)),
    # sources and ingestion
    "json_quarantine": _json_quarantine,
    "room_name_fallback": lambda v: topic_messages(v).groupBy("topic", "room_id", "room_name").agg(F.count("*").alias("n")),
    "ingest_danmaku": _ingest(messages.message_rows),
    "ingest_live_metrics": _ingest(messages.metric_rows),
    "ingest_room_stats": _ingest(messages.audience_rows),
    "flatten_room_record": lambda v: messages.flatten_room_record(room_records(v)),
    "json_encode": _json_encode,
    "fn_ngrams": lambda v: text.ngram_counts(v.table("benchmark").select(F.lit("all").alias("room_name"), "text")),
    "fn_iso_parse": _fn_iso_parse,
    "fn_parse_count": _fn_parse_count,
    "route_params": lambda v: messages.route_params(responses(v), ("cursor", "region", "host")),
    "evolved_metrics": _evolved_metrics,
    "published_round_trip": _published_round_trip,
    # rooms
    "room_overview": lambda v: rooms.room_overview(v.rooms, v.live_metrics, v.signals),
    "room_stats": lambda v: rooms.room_stats(v.rooms, v.live_metrics, v.signals),
    "room_compare": lambda v: rooms.room_compare(v.rooms, v.live_metrics, v.signals),
    "online_trend": lambda v: rooms.online_trend(v.live_metrics, 120),
    "online_trend_month": lambda v: rooms.online_trend(v.live_metrics, 60 * 24 * 31),
    "room_last_minute": lambda v: rooms.room_last_minute(v.rooms, v.live_metrics, 1),
    "room_last_day": lambda v: rooms.room_last_minute(v.rooms, v.live_metrics, 60 * 24),
    "collect_rate": lambda v: rooms.collect_rate(v.live_metrics, 60 * 24),
    # audience
    "user_segmentation": lambda v: audience.user_segmentation(v.signals),
    "user_segment_samples": lambda v: audience.user_segment_samples(v.signals),
    "activity_levels": lambda v: audience.activity_levels(v.signals),
    "funnel_full": lambda v: audience.funnel_full(v.signals),
    "rfm_users": lambda v: audience.rfm_users(v.signals),
    "rfm_segments": lambda v: audience.rfm_segments(audience.rfm_users(v.signals)),
    "rfm_top": lambda v: audience.rfm_top(audience.rfm_users(v.signals)),
    "rfm_top_users": lambda v: audience.rfm_top(audience.rfm_users(v.signals), 20, by_segment=False),
    "rfm_medians_sketch": _rfm_medians_sketch,
    "active_users_sketch": _active_users_sketch,
    "user_texts": _user_texts,
    "retention_daily": lambda v: audience.retention_daily(v.signals),
    "retention_summary": lambda v: audience.retention_summary(audience.retention_daily(v.signals)),
    "user_journey": lambda v: audience.user_journey(v.danmaku, counted=v.signals),
    "sampled_users": _sampled_users,
    "top_users": lambda v: audience.top_users(v.signals),
    "hourly_activity": lambda v: audience.hourly_activity(v.signals),
    "danmaku_trend": lambda v: audience.danmaku_trend(v.signals),
    "danmaku_trend_minutes": lambda v: audience.danmaku_trend(v.signals, 60 * 24, by_clock=False),
    "danmaku_recent": lambda v: audience.danmaku_recent(v.signals, complete=v.with_texts),
    "danmaku_search": lambda v: audience.danmaku_search(v.danmaku, "worth"),
    "export_latest": lambda v: audience.export_latest(v.signals, complete=v.with_texts),
    # text
    "sentiment_score": _scores,
    "sentiment_room": lambda v: text.sentiment_room(_scores(v)),
    "sentiment_hist": lambda v: text.sentiment_hist(_scores(v)),
    "sentiment_timeline": lambda v: text.sentiment_timeline(v.danmaku, v.sentiment_model),
    "sentiment_quadrant": lambda v: text.sentiment_quadrant(_sentiment_users(v)),
    "sentiment_quadrant_samples": lambda v: text.sentiment_quadrant_samples(_sentiment_users(v)),
    "keywords_tfidf": lambda v: text.keywords_tfidf(v.danmaku),
    "word_cloud": lambda v: text.word_cloud(v.danmaku),
    "word_cloud_stop_words": lambda v: text.word_cloud(v.danmaku.withColumn("text", F.concat("text", F.lit(" 觉得 直播 这个")))),
    "ngram_words": lambda v: text.ngram_words(v.danmaku),
    "room_activity_matrix": lambda v: text.room_activity_matrix(
        text.sentiment_hist(_scores(v)), audience.activity_levels(v.signals)
    ),
    # commerce
    "product_sold_refresh": lambda v: v.products,
    "product_margin": lambda v: commerce.product_margin(v.catalogue),
    "product_list": lambda v: commerce.product_list(v.products),
    "product_top": lambda v: commerce.product_top(v.products),
    "stock_levels": lambda v: commerce.stock_levels(v.products),
    "inventory_alerts": lambda v: commerce.inventory_alerts(v.products),
    "product_sales_trend": lambda v: commerce.product_sales_trend(v.products, v.sales),
    "orders_recent": lambda v: commerce.orders_recent(v.orders),
    "gmv_daily": lambda v: commerce.gmv_daily(v.sales, SPAN_DAYS),
    "gmv_totals": lambda v: commerce.gmv_totals(v.sales),
    "product_growth": _growth,
    "hot_products": lambda v: commerce.hot_products(_growth(v)),
    "rising_products": lambda v: commerce.rising_products(_growth(v)),
    "gmv_kpis": lambda v: commerce.gmv_kpis(v.products, v.orders, SPAN_DAYS, growth_span=SPAN_DAYS),
    # recommendation and forecast
    "cooccurrence_recs": lambda v: recommend.cooccurrence_recs(v.sales, details=v.catalogue),
    "association_rules": lambda v: recommend.association_rules(v.sales, 2, 0.05, details=v.catalogue),
    "association_rules_strict": lambda v: recommend.association_rules(v.sales, 3, 0.1, n=None, details=v.catalogue),
    "recommendation_summaries": lambda v: recommend.summaries(v.sales, recommend.association_rules(v.sales, 2, 0.05, n=None, details=v.catalogue)),
    "sales_ma7": lambda v: forecast.sales_ma7(forecast.daily_sales(v.sales)),
    "sales_ma7_all_rooms": lambda v: forecast.sales_ma7(forecast.daily_sales(v.sales, ()), ()),
    "sales_forecast": lambda v: forecast.sales_forecast(_line(v)),
    "sales_forecast_products": lambda v: forecast.sales_forecast(
        forecast.sales_line(forecast.daily_sales(v.sales, ["product_id"]), ["product_id"]), ["product_id"]
    ),
    "sales_trend": lambda v: forecast.sales_trend(_line(v)),
    "forecast_series": lambda v: forecast.forecast_series(
        forecast.sales_ma7(forecast.daily_sales(v.sales)), forecast.sales_forecast(_line(v))
    ),
    # warehouse
    "ods_room_info": lambda v: warehouse.ods_room_info(v.live_metrics),
    "ods_landed": _ods_landed,
    "ods_gifts": lambda v: _landed(v, warehouse.ods_gifts(v.signals, v.gift_prices), ODS_GIFTS),
    "ods_orders": lambda v: _landed(v, warehouse.ods_orders(v.orders, v.rooms), ODS_ORDERS),
    "ods_danmaku": lambda v: warehouse.ods_danmaku(v.danmaku),
    "ods_room_info_last_hour": lambda v: warehouse.ods_room_info(warehouse.last_hour(v.live_metrics)),
    "ods_danmaku_last_hour": lambda v: warehouse.ods_danmaku(warehouse.last_hour(v.danmaku)),
    "dwd_danmaku": lambda v: warehouse.dwd_danmaku(v.danmaku, v.rooms),
    "dws_room_minute": lambda v: warehouse.dws_room_minute(
        warehouse.ods_room_info(v.live_metrics), warehouse.ods_danmaku(v.signals.withColumn("text", F.lit(None)))
    ),
    "dws_live_minute": lambda v: warehouse.dws_live_minute(v.signals, v.sales, v.gift_prices, v.rooms),
    "ads_user_segments": lambda v: warehouse.ads_user_segments(v.signals, "2024-01-31"),
    "tsv_round_trip": _tsv_round_trip,
    "orc_overwrite": _orc_overwrite,
    "ctas_product_ranking": _ctas_product_ranking,
    # one room, one product, one category, the newest chats only
    "danmaku_recent_room": lambda v: audience.danmaku_recent(v.signals, room=ROOM, complete=v.with_texts),
    "funnel_full_room": lambda v: audience.funnel_full(v.signals, ROOM),
    "rfm_segments_room": lambda v: audience.rfm_segments(audience.rfm_users(v.signals, room=ROOM)),
    # the optional caps, where a look at the busiest is the feature
    "rfm_segments_capped": lambda v: audience.rfm_segments(audience.rfm_users(v.signals, cap=40)),
    "association_rules_capped": lambda v: recommend.association_rules(v.sales, 2, 0.05, max_pairs=200, details=v.catalogue),
    "product_sales_trend_one": lambda v: commerce.product_sales_trend(v.products, v.sales, 7),
    "product_list_category": lambda v: commerce.product_list(v.products, ROOM, "MEDIUM"),
    "keywords_latest": lambda v: text.keywords_tfidf(v.danmaku, latest=2000),
    "cooccurrence_recs_room": lambda v: recommend.cooccurrence_recs(v.sales, room=ROOM, details=v.catalogue),
    "association_rules_room": lambda v: recommend.association_rules(v.sales, 2, 0.05, room=ROOM, details=v.catalogue),
    "ads_product_ranking": lambda v: warehouse.ads_product_ranking(v.orders),
}


def bound(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = QUERIES[name]
    return lambda spark, folder: portable(build(Views(spark, folder)))
