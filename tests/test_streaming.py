"""Streaming jobs against their batch twins: order, lateness, damage, restarts."""

import datetime as dt
import json

import pytest
from oracle_check import SMALL
from pyspark.sql import functions as F

from roompulse.operators import messages as m
from roompulse.operators import windows
from roompulse.plans.catalog import bound, envelopes, topic_messages
from roompulse.schemas import ENVELOPE, TOPIC_CHAT, TOPIC_GIFT, TOPIC_ROOM
from roompulse.sinks.batches import append_batches, merge_batches, merged, read_batches, upserted
from roompulse.sources.files import json_lines
from roompulse.sources.topics import kafka_options, messages
from roompulse.streaming import jobs, lateness, replay
from roompulse.streaming.state import alert_stream

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def chat(second, room="r1", text="hi", name="R", fraction=True):
    at = T0 + dt.timedelta(seconds=second)
    stamp = at.strftime("%Y-%m-%dT%H:%M:%S.%f") if fraction else at.strftime("%Y-%m-%dT%H:%M:%S")
    return {"room_id": room, "room_name": name, "username": "u", "user_id": "7", "text": text, "timestamp": stamp}


def put(folder, topic, number, rows):
    """One file, and so one micro-batch; texts are written as they are."""
    target = folder / topic
    target.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows]
    path = target / f"part-{number:04d}.json"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    stamp = 1_700_000_000 + number
    import os

    os.utime(path, (stamp, stamp))


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_counts_match_batch_for_closed_windows(spark, tmp_path):
    source = tmp_path / "in"
    rows = [chat(s * 7 % 300, f"r{s % 3}", fraction=s % 4 > 0) for s in range(200)]
    rows.sort(key=lambda r: r["timestamp"])
    for i in range(0, 200, 50):
        part = rows[i : i + 50]
        part[10] = "{damaged"
        put(source, TOPIC_CHAT, i, part)
    put(source, TOPIC_CHAT, 999, [chat(100_000)])
    raw = json_lines(spark, str(source))
    finish(jobs.count_chats(raw, append_batches(str(tmp_path / "out")), str(tmp_path / "cp"), once=True))
    got = read_batches(spark, str(tmp_path / "out"))
    static = spark.read.option("recursiveFileLookup", "true").text(str(source)).select(F.lit(TOPIC_CHAT).alias("topic"), "value")
    batch = windows.tumble_counts(messages(static))
    want = batch.filter(F.col("window_start") < "2024-01-02")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.agg(F.sum("danmaku_cnt")).first()[0] == 196


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    put(source, TOPIC_CHAT, 0, [chat(1), chat(2)])
    put(source, TOPIC_CHAT, 1, [chat(300)])
    put(source, TOPIC_CHAT, 2, [chat(310)])
    put(source, TOPIC_CHAT, 3, [chat(3)])
    put(source, TOPIC_CHAT, 4, [chat(10_000)])
    query = finish(
        jobs.count_chats(json_lines(spark, str(source)), append_batches(str(tmp_path / "out")), str(tmp_path / "cp"), once=True)
    )
    got = {r.window_start: r.danmaku_cnt for r in read_batches(spark, str(tmp_path / "out")).collect()}
    assert got["2024-01-01 12:00:00"] == 2
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1


def test_update_mode_upserts_by_window_and_room(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, TOPIC_CHAT, 0, [chat(1), chat(2), chat(3, "r2")])
    put(source, TOPIC_CHAT, 1, [chat(4, name="Renamed")])
    raw = json_lines(spark, str(source))
    finish(jobs.count_chats(raw, append_batches(out), str(tmp_path / "cp"), mode="update", once=True))
    table = upserted(spark, out, ["window_start", "room_id"])
    got = {r.room_id: (r.danmaku_cnt, r.room_name) for r in table.collect()}
    assert got == {"r1": (3, "Renamed"), "r2": (1, "R")}


def test_query_resumes_where_it_stopped(spark, tmp_path):
    source, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(source, TOPIC_CHAT, 0, [chat(1), chat(2)])
    finish(jobs.count_chats(json_lines(spark, str(source)), append_batches(out), cp, once=True))
    put(source, TOPIC_CHAT, 1, [chat(3)])
    put(source, TOPIC_CHAT, 2, [chat(1000)])
    finish(jobs.count_chats(json_lines(spark, str(source)), append_batches(out), cp, once=True))
    assert [r.danmaku_cnt for r in read_batches(spark, out).collect()] == [3]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    write = append_batches(out)
    df = spark.createDataFrame([("k", 1)], "k string, v int")
    write(df, 0)
    write(df, 0)
    write(df, 1)
    assert read_batches(spark, out).count() == 2


def test_messages_spread_over_three_tables(spark, views, tmp_path):
    source = tmp_path / "in"
    stamp = "2024-01-01T12:00:00.000001"
    put(source, TOPIC_CHAT, 0, [chat(1, name=""), "no json"])
    put(source, TOPIC_GIFT, 0, [{"room_id": "room_1", "username": "u", "gift_name": "gift_5", "timestamp": stamp}])
    put(
        source, TOPIC_ROOM, 0,
        [
            {"room_id": "room_1", "online": "12", "total_users": "3万", "source": "websocket", "timestamp": stamp},
            {"room_id": "room_1", "online": "1.2w", "like_count": 5, "has_cart": True, "timestamp": stamp},
        ],
    )
    root = str(tmp_path / "tables")
    finish(jobs.store_messages(json_lines(spark, str(source)), views.rooms, root, str(tmp_path / "cp"), once=True))
    said = {r.msg_type: r for r in read_batches(spark, f"{root}/danmaku").collect()}
    assert said["chat"].room_name == "r1" and said["chat"].text == "hi"
    assert said["gift"].gift_count == 1 and said["gift"].room_name != "room_1"
    seen = read_batches(spark, f"{root}/room_stats").collect()
    assert [(r.online_count, r.total_users) for r in seen] == [(12, "3万")]
    full = read_batches(spark, f"{root}/live_metrics").collect()
    assert [(r.online, r.like_count, r.has_cart, r.has_commerce) for r in full] == [("1.2w", 5, 1, 0)]


def test_snapshots_of_stored_messages_equal_the_batch_plan(spark, views, tmp_path):
    rows = topic_messages(views)
    value = F.to_json(F.struct(*[c for c in rows.columns if c not in ("topic", "id")]))
    for topic in (TOPIC_CHAT, TOPIC_GIFT, TOPIC_ROOM):
        rows.filter(F.col("topic") == topic).select(value).repartition(2).write.text(str(tmp_path / "in" / topic))
    raw = json_lines(spark, str(tmp_path / "in"), 3)
    root = str(tmp_path / "tables")
    finish(jobs.store_messages(raw, views.rooms, root, str(tmp_path / "cp"), once=True))
    got = jobs.snapshot_rooms(spark, root, views.gift_prices, 60)
    # Half of the gift messages leave the count out, which then is 1.
    count = F.when((F.col("msg_type") == "gift") & (F.col("id") % 2 == 1), F.lit(1)).otherwise(F.col("gift_count"))
    said = views.signals.withColumn("gift_count", count)
    samples = windows.audience_samples(views.live_metrics, views.room_stats)
    want = windows.room_snapshot(windows.room_signals(said, samples, views.gift_prices), samples, 60)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_room_aggregates_and_gifts(spark, views, tmp_path):
    source = tmp_path / "in"
    room = [{"room_id": "r1", "room_name": "R", "online": o, "timestamp": chat(i)["timestamp"]} for i, o in enumerate(["100", "1.2w", "n/a", "0"])]
    gifts = [{"room_id": "r1", "gift_name": g, "gift_count": n, "timestamp": chat(5)["timestamp"]} for g, n in (("gift_0", 3), ("none", 2))]
    put(source, TOPIC_ROOM, 0, room)
    put(source, TOPIC_CHAT, 0, [chat(1), chat(2)])
    put(source, TOPIC_GIFT, 0, gifts)
    for topic in (TOPIC_ROOM, TOPIC_CHAT, TOPIC_GIFT):
        put(source, topic, 5, [{**chat(5000), "online": "1", "gift_name": "x"}])
    raw = json_lines(spark, str(source), 10)
    finish(jobs.aggregate_rooms(raw, str(tmp_path / "agg"), str(tmp_path / "cp1"), once=True))
    put(source, TOPIC_CHAT, 6, [chat(9000)])
    got = read_batches(spark, str(tmp_path / "agg")).filter("room_id = 'r1'").collect()
    if not got:  # the first run saw all files in one batch; the next one closes the window
        finish(jobs.aggregate_rooms(raw, str(tmp_path / "agg"), str(tmp_path / "cp1"), once=True))
        got = read_batches(spark, str(tmp_path / "agg")).filter("window_start = '2024-01-01 12:00:00'").collect()
    one = got[0]
    assert (one.online_avg, one.online_max, one.online_min, one.danmaku_rate, one.samples) == (6050, 12000, 100, 2, 2)
    finish(jobs.value_gifts(raw, views.gift_prices, str(tmp_path / "g"), str(tmp_path / "cp2"), once=True))
    value = read_batches(spark, str(tmp_path / "g")).orderBy("window_start").first()
    assert (value.gift_count, value.gift_value) == (5, 2.3)


def test_alert_state_equals_batch_windows(spark, views, tmp_path):
    samples = windows.audience_samples(views.live_metrics, views.room_stats)
    want = {(r.room_id, r.id, r.alert_type, r.baseline) for r in windows.online_alerts(samples).collect()}
    ordered = samples.withColumn("event_time", F.col("event_time").cast("timestamp"))
    bounds = [r[0] for r in samples.selectExpr("percentile(id, array(0.25, 0.5, 0.75)) AS p").selectExpr("explode(p)").collect()]
    cuts = [-1, *bounds, 10**9]
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        ordered.filter((F.col("id") > low) & (F.col("id") <= high)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"p{i}"))
    closing = ordered.orderBy(F.col("event_time").desc()).limit(1).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 DAY"))
    closing.write.parquet(str(tmp_path / "in" / "p9"))
    stream = (
        spark.readStream.schema(ordered.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    )
    query = finish(jobs.watch_audience(stream, str(tmp_path / "out"), str(tmp_path / "cp"), once=True))
    got = {(r.room_id, r.id, r.alert_type, r.baseline) for r in read_batches(spark, str(tmp_path / "out")).collect()}
    assert len(query.recentProgress) >= 4
    assert want and got == want


@pytest.mark.parametrize("layout", ["folder", "hashed"])
def test_replays_do_not_depend_on_files(spark, tmp_path, layout):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    dealt = events.coalesce(1) if layout == "folder" else events.repartition(4, F.xxhash64("event_id"))
    dealt.write.parquet(str(tmp_path / "events.parquet"))
    spark.read.parquet(f"{SMALL}/region.parquet").write.parquet(str(tmp_path / "region.parquet"))
    for name in ("danmaku_tumble_1m", "room_minute_agg", "online_alerts", "room_snapshot"):
        got, want = bound(f"stream_{name}")(spark, str(tmp_path)), bound(name)(spark, SMALL)
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_landing_loses_nothing(spark, views, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "tables")
    undated, odd = {**chat(1), "timestamp": None}, {**chat(2), "timestamp": "2024-01-01T12:00:00.123+08:00?"}
    put(source, TOPIC_CHAT, 0, [chat(0), undated, odd, "{damaged", "no json"])
    finish(jobs.store_messages(json_lines(spark, str(source)), views.rooms, root, str(tmp_path / "cp"), once=True))
    kept = read_batches(spark, f"{root}/danmaku").collect()
    aside = read_batches(spark, f"{root}/quarantine").collect()
    assert len(kept) == 3 and all(r.event_time is not None for r in kept)
    assert sorted(r.damaged for r in aside) == ["no json", "{damaged"]


def test_envelopes_are_routed_by_type(spark, views, tmp_path):
    rows = envelopes(views)
    damaged = rows.limit(3).select(F.lit("WebcastChatMessage").alias("method"), "room_id", F.lit("{cut").alias("payload"), "timestamp")
    rows.select("method", "room_id", "payload", "timestamp").unionByName(damaged).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ENVELOPE).parquet(str(tmp_path / "in"))
    finish(jobs.demultiplex(stream, views.rooms, str(tmp_path / "out"), str(tmp_path / "cp"), once=True))
    batch = m.route_messages(rows)
    got = read_batches(spark, str(tmp_path / "out/messages"))
    assert sorted(map(tuple, m.message_type_counts(got).collect())) == sorted(map(tuple, m.message_type_counts(batch).collect()))
    assert got.select("kind").distinct().count() == 13
    aside = read_batches(spark, str(tmp_path / "out/quarantine")).collect()
    assert [(r.kind, r.damaged) for r in aside] == [("chat", "{cut")] * 3
    published = read_batches(spark, str(tmp_path / "out/published"))
    assert sorted(r.value for r in published.collect()) == sorted(r.value for r in m.publish(batch).collect())


def test_kafka_source_options():
    live = kafka_options("a:1,b:2")
    assert live["subscribe"] == "live_danmaku,live_gifts,live_room_info" and live["startingOffsets"] == "latest"
    assert kafka_options("a:1", start="earliest", per_batch=5)["maxOffsetsPerTrigger"] == "5"
    with pytest.raises(ValueError):
        kafka_options("a:1", start="middle")


def test_alert_stream_is_keyed_by_room(spark, tmp_path):
    schema = "room_id string, room_name string, id bigint, event_time timestamp, online bigint"
    stream = spark.readStream.schema(schema).parquet(str(tmp_path))
    plan = alert_stream(stream)
    assert plan.isStreaming and "baseline" in plan.columns


@pytest.mark.parametrize("least", [1, 5])
def test_snapshots_by_timers_equal_the_batch_plan(spark, views, least):
    got = replay.room_snapshot(views, 10, least=least).filter("active").drop("active")
    samples = windows.audience_samples(views.live_metrics, views.room_stats)
    want = windows.room_snapshot(windows.room_signals(views.signals, samples, views.gift_prices), samples, 10)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def signal(second, kind, room="r1", online=None, cents=None, number=0):
    return (room, "R", number, T0 + dt.timedelta(seconds=second), kind, online, cents)


SIGNALS = "room_id string, room_name string, id bigint, event_time timestamp, kind string, online bigint, cents bigint"


def feed(spark, folder, number, rows):
    import os

    spark.createDataFrame(rows, SIGNALS).coalesce(1).write.parquet(f"{folder}/p{number}")
    for name in os.listdir(f"{folder}/p{number}"):
        os.utime(f"{folder}/p{number}/{name}", (1_700_000_000 + number,) * 2)


def test_a_silent_room_gets_its_rows_and_state_survives_a_restart(spark, tmp_path):
    source, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")

    def play():
        stream = spark.readStream.schema(SIGNALS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(source)
        finish(jobs.watch_rooms(stream, out, cp, once=True))

    feed(spark, source, 0, [signal(5, "sample", online=200, number=1), signal(8, "chat"), signal(9, "sample", online=220, number=2), signal(3, "chat", "r2")])
    feed(spark, source, 1, [signal(70, "gift", "r2", cents=150), signal(250, "chat", "r2")])
    play()
    feed(spark, source, 2, [signal(260, "sample", online=100, number=3), signal(261, "sample", online=None, number=4)])
    feed(spark, source, 3, [signal(400, "chat", "r2")])
    play()
    rows = {(r.room_id, r.window_start[11:]): r for r in read_batches(spark, out).collect()}
    assert [k[1] for k in sorted(rows) if k[0] == "r1"] == [f"12:0{m}:00" for m in range(6)]
    first, silent, late = (rows["r1", f"12:0{m}:00"] for m in (0, 2, 4))
    assert (first.online_current, first.online_avg, first.online_trend, first.danmaku_rate, first.gmv_estimate, first.active) == (220, 210, "up", 1, 4.5, True)
    assert (silent.online_current, silent.online_avg, silent.danmaku_rate, silent.active, silent.room_name) == (220, 210, 0, False, "R")
    assert (late.online_current, late.online_avg, late.online_trend, late.alert_count) == (100, 173, "down", 1)
    gift = rows["r2", "12:01:00"]
    assert (gift.gift_value, gift.gmv_estimate, gift.online_current, gift.online_trend) == (1.5, 1.5, 0, "stable")


def test_merged_batches_hold_current_values(spark, tmp_path):
    out = str(tmp_path / "out")
    write = merge_batches(out, ["k"])
    for number, rows in enumerate([[("a", 1), (None, 1)], [("b", 2), (None, 5)], [], [("a", 7)], [("a", 7)]]):
        write(spark.createDataFrame(rows, "k string, v int"), number)
    write(spark.createDataFrame([("a", 7)], "k string, v int"), 4)
    assert sorted(map(tuple, merged(spark, out).collect()), key=str) == [("a", 7), ("b", 2), (None, 5)]
    import os

    assert len([x for x in os.listdir(out) if x.startswith("batch_id=")]) <= 3


def test_late_rows_are_kept_with_their_lateness(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    put(source, TOPIC_CHAT, 0, [chat(1), chat(200)])
    put(source, TOPIC_CHAT, 1, [chat(2), chat(190), chat(300, "r2")])
    put(source, TOPIC_CHAT, 2, [chat(3), chat(299)])

    def rows():
        return messages(json_lines(spark, str(source)), late=None)

    finish(lateness.count_keeping_late(rows(), root, str(tmp_path / "cp"), once=True))
    put(source, TOPIC_CHAT, 3, [chat(250)])
    finish(lateness.count_keeping_late(rows(), root, str(tmp_path / "cp"), once=True))
    late = sorted((r.event_time.minute, r.event_time.second, r.late_seconds) for r in lateness.kept_late(spark, root).collect())
    assert late == [(0, 2, 193.0), (0, 3, 292.0)]
    counted = lateness.kept_counts(spark, root).agg(F.sum("danmaku_cnt")).first()[0]
    assert counted + len(late) == 8
