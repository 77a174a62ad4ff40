"""Operators on literal edge tables, and against brute force."""

import datetime as dt
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from roompulse.operators import audience, commerce, forecast, messages, recommend, rooms, text, warehouse, windows
from roompulse.operators.common import lookback_window, newest_rows, row_index, top_per_key, upper_medians
from roompulse.schemas import CHAT_MESSAGE

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
DANMAKU = (
    "id bigint, room_id string, room_name string, username string, user_id string, msg_type string, text string, "
    "gift_name string, gift_count int, created_at timestamp_ntz"
)
METRICS = (
    "id bigint, room_id string, room_name string, title string, streamer string, online string, like_count bigint, "
    "status string, has_cart boolean, cart_total int, has_commerce boolean, created_at timestamp_ntz"
)
ORDERS = (
    "order_id bigint, product_id bigint, product_name string, room_name string, category string, quantity int, "
    "total_amount decimal(12,2), order_time timestamp_ntz, customer_id string"
)


def chats(spark, rows):
    """Rows of (user, text, time) as chat messages of one room."""
    data = [(i, "r1", "R", u, u, "chat", t, None, None, at) for i, (u, t, at) in enumerate(rows)]
    return spark.createDataFrame(data, DANMAKU)


def samples(spark, values, step=60):
    data = [("r1", "R", i, T0 + dt.timedelta(seconds=step * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "room_id string, room_name string, id bigint, event_time timestamp_ntz, online bigint")


def orders(spark, rows):
    """Rows of (customer, product, quantity, day)."""
    data = [
        (i, p, f"P{p}", "R", "c", q, q * 10, T0 + dt.timedelta(days=d), c) for i, (c, p, q, d) in enumerate(rows)
    ]
    from decimal import Decimal

    return spark.createDataFrame([(*r[:6], Decimal(r[6]), *r[7:]) for r in data], ORDERS)


# --- shared plan shapes ---


def test_row_index_spans_hours(spark):
    rows = [("a", i, T0 + dt.timedelta(minutes=17 * (i * 7 % 50))) for i in range(50)] + [("b", 99, T0)]
    df = spark.createDataFrame(rows, "k string, id bigint, ts timestamp_ntz")
    got = {r.id: (r.row_ix, r.rows_in_key) for r in row_index(df, ["k"], "ts", "id").collect()}
    expected = {i: n for n, (_, i, _) in enumerate(sorted(rows[:50], key=lambda r: (r[2], r[1])))}
    assert {i: v[0] for i, v in got.items() if i != 99} == expected
    assert got[99] == (0, 1) and got[0][1] == 50


@pytest.mark.parametrize("block", [4, 7, 100])
def test_blocks_look_back_like_one_window(spark, block):
    df = spark.range(60).select(F.lit("k").alias("k"), F.col("id").alias("ix"), (F.col("id") * 37 % 11).alias("v"))
    spread, w, keep = lookback_window(df, ["k"], "ix", 3, block)
    got = spread.withColumn("s", F.sum("v").over(w.rowsBetween(-3, -1))).filter(keep).select("ix", "s")
    whole = Window.partitionBy("k").orderBy("ix").rowsBetween(-3, -1)
    want = df.select("ix", F.sum("v").over(whole).alias("s"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_top_per_key_beyond_the_native_limit(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), "id")
    got = top_per_key(df, ["k"], (F.col("id").desc(),), 1500)
    assert got.count() == 3000
    assert got.agg(F.min("id")).first()[0] == 2000


def test_upper_medians(spark):
    rows = [("a", x, -x) for x in (1, 2, 3, 4)] + [("b", x, 7) for x in (5, 5, 9)]
    df = spark.createDataFrame(rows, "k string, x int, y int")
    got = upper_medians(df, ["k"], {"x": "m", "y": "n"}).collect()
    assert {r.k: (r.m, r.n) for r in got} == {"a": (3, -2), "b": (5, 7)}


def test_newest_rows_of_repeated_ids(spark):
    df = spark.createDataFrame([("a", i, t) for i, t in ((1, "x"), (2, "y"), (3, "z"), (3, "w"))] + [("b", 9, None)], "k string, id int, t string")
    got = sorted((r.k, r["rank"], r.id, r.t) for r in newest_rows(df, ["k"], "id", 3).collect())
    assert got == [("a", 1, 3, "w"), ("a", 2, 3, "z"), ("a", 3, 2, "y"), ("b", 1, 9, None)]


# --- audience ---


def test_high_tiers(spark):
    rows = [(u, "hi", T0) for u, n in (("u50", 50), ("u99", 99), ("u100", 100), ("u101", 101), ("u2", 2)) for _ in range(n)]
    got = {r.tier: r.users for r in audience.user_segmentation(chats(spark, rows)).collect()}
    assert got == {"超级粉(100+)": 2, "铁杆粉(50-99)": 2, "忠实粉丝(10-49)": 0, "活跃观众(3-9)": 0, "路人(1-2)": 1}
    ads = {r.segment: r.user_count for r in warehouse.ads_user_segments(chats(spark, rows), "d").collect()}
    assert ads == {"5-超级粉(100+)": 2, "4-铁杆粉(50-99)": 2, "1-路人(1-2)": 1}


def test_retention_days(spark):
    plan = {"one": [0, 1], "three": [0, 3], "seven": [2, 9], "fourteen": [0, 14], "never": [0]}
    rows = [(u, "hi", T0 + dt.timedelta(days=d)) for u, days in plan.items() for d in days]
    daily = audience.retention_daily(chats(spark, rows))
    got = {r.day: (r.retained, r.total_users, r.rate) for r in daily.collect()}
    assert [d for d, v in got.items() if v[0]] and {d for d, v in got.items() if v[0]} == {1, 3, 7, 14}
    assert got[1] == (1, 5, 20.0) and len(got) == 14
    observable = {r.day: r.observable for r in daily.collect()}
    assert observable[12] == 5 and observable[13] == 4
    summary = audience.retention_summary(daily).first()
    assert (summary.total_users, summary.day1, summary.day3, summary.day7) == (5, 20.0, 20.0, 20.0)


def test_funnel_steps_shrink(views):
    steps = audience.funnel_full(views.danmaku).collect()
    for room in {r.room_name for r in steps}:
        v = {r.step: r.value for r in steps if r.room_name == room}
        assert v[2] >= v[3] - 1 and v[3] >= v[4] >= v[6] and v[1] >= v[5] >= v[6]


def test_segments_sum_to_users(views):
    users = audience.rfm_users(views.danmaku)
    total = users.count()
    assert audience.rfm_segments(users).agg(F.sum("users")).first()[0] == total
    tiers = audience.user_segmentation(views.danmaku).agg(F.sum("users")).first()[0]
    assert tiers == audience.chats_per_user(views.danmaku).count()


def test_rfm_cap_and_single_user(spark):
    df = chats(spark, [("a", "x", T0)] * 5 + [("b", "x", T0)] * 3 + [("c", "x", T0)] * 2)
    assert {r.username for r in audience.rfm_users(df).collect()} == {"a", "b"}
    assert [r.username for r in audience.rfm_users(df, cap=1).collect()] == ["a"]


def test_trend_falls_back_only_for_silent_rooms(spark):
    day = dt.timedelta(days=1)
    data = [
        (1, "r1", "A", "u", "u", "chat", "x", None, None, T0 - day),
        (2, "r1", "A", "u", "u", "chat", "x", None, None, T0),
        (3, "r2", "B", "u", "u", "chat", "x", None, None, T0 - day),
    ]
    got = audience.danmaku_trend(spark.createDataFrame(data, DANMAKU), by_clock=False).collect()
    assert {(r.room_name, r.t) for r in got} == {("A", T0), ("B", T0 - day)}


def test_trend_as_of_literal(spark):
    df = chats(spark, [("u", "x", T0), ("u", "x", T0 + dt.timedelta(hours=5))])
    got = audience.danmaku_trend(df, by_clock=False, as_of=T0 + dt.timedelta(minutes=1)).collect()
    assert len(got) == 2  # rows after the given moment count as recent


# --- rooms ---


def metrics(spark, rows):
    data = [(i, "r1", "R", "t", "s", o, likes, "x", True, 1, False, at) for i, (o, likes, at) in enumerate(rows)]
    return spark.createDataFrame(data, METRICS)


def test_like_rate_restarts_after_a_gap(spark):
    at = [0, 60, 240, 421, 430]
    likes = [100, 160, 250, 400, 390]
    rows = [("1.2w", n, T0 + dt.timedelta(seconds=s)) for s, n in zip(at, likes)]
    got = rooms.online_trend(metrics(spark, rows)).orderBy("created_at").collect()
    assert [r.like_rate for r in got] == [0, 60, 90, 0, 0]
    assert {r.online for r in got} == {12000}


def test_trend_is_thinned_evenly(spark):
    rows = [("5", i, T0 + dt.timedelta(seconds=i)) for i in range(1000)]
    got = rooms.online_trend(metrics(spark, rows)).orderBy("created_at").collect()
    assert [r.likes for r in got] == list(range(0, 1000, 12))


def test_quiet_rooms_report_zeros(spark):
    known = spark.createDataFrame([("r1", "R"), ("r2", "S")], "room_id string, room_name string")
    m = metrics(spark, [("100", 5, T0), ("200", 9, T0 + dt.timedelta(seconds=30))])
    got = {r.room_id: r for r in rooms.room_last_minute(known, m).collect()}
    assert (got["r1"].online_avg, got["r1"].like_rate, got["r1"].records) == (150, 4, 2)
    assert (got["r2"].online_avg, got["r2"].records, got["r2"].time) == (0, 0, None)
    overview = {r.room_id: r for r in rooms.room_overview(known, m, chats(spark, [("u", "x", T0)])).collect()}
    assert overview["r2"].online == "无数据" and not overview["r2"].live and overview["r1"].live
    alive = {r.room_id: r.live for r in rooms.room_liveness(known, m, as_of=T0 + dt.timedelta(seconds=630)).collect()}
    assert alive == {"r1": False, "r2": False}


# --- alerts ---


def test_alert_thresholds(spark):
    values = [200] * 9 + [139] + [200] * 9 + [140] + [200] * 9 + [301]
    got = windows.online_alerts(samples(spark, values), block_rows=12).orderBy("id").collect()
    assert [(r.id, r.alert_type, r.severity) for r in got] == [(9, "online_drop", "HIGH"), (29, "online_spike", "MEDIUM")]
    assert windows.online_alerts(samples(spark, [90] * 5 + [1])).count() == 0
    assert windows.online_alerts(samples(spark, [500, 10])).count() == 0
    assert windows.online_alerts(samples(spark, [500, 500, 10])).count() == 1


def test_alerts_do_not_depend_on_blocks(views):
    s = windows.audience_samples(views.live_metrics, views.room_stats)
    whole = sorted(windows.online_alerts(s).collect())
    assert whole and whole == sorted(windows.online_alerts(s, block_rows=10).collect())


def test_snapshot_carries_samples_over(spark):
    s = samples(spark, [100, 110, 105], step=10)
    messages_ = chats(spark, [("u", "x", T0 + dt.timedelta(minutes=m)) for m in (0, 5, 5)])
    prices = spark.createDataFrame([("rocket", 500.0)], "gift_name string, price double")
    signals = windows.room_signals(messages_, s, prices)
    got = windows.room_snapshot(signals, s).orderBy("window_start").collect()
    assert [(r.online_current, r.online_avg, r.online_trend, r.danmaku_rate) for r in got] == [
        (105, 105, "down", 1),
        (105, 105, "down", 2),
    ]
    assert [r.gmv_estimate for r in got] == [4.5, 9.0]


def test_surge_alerts(spark):
    rows = [("r", "R", f"2024-01-01 00:0{i}:00", c, g) for i, (c, g) in enumerate([(10, 5.0), (101, 10.0), (100, 21.0)])]
    df = spark.createDataFrame(rows, "room_id string, room_name string, window_start string, danmaku_rate bigint, gmv_estimate double")
    got = {(r.window_start[-5:], r.alert_type) for r in windows.surge_alerts(df).collect()}
    assert got == {("01:00", "danmaku_surge"), ("02:00", "gmv_increase")}


# --- text ---


def test_empty_text_is_neutral(spark):
    model = text.train_sentiment(
        spark.createDataFrame([("good fine", True), ("bad poor", False)], "text string, positive boolean")
    )
    df = chats(spark, [("a", "", T0), ("a", "good good fine", T0), ("b", "bad poor bad", T0), ("b", "unknown", T0)])
    got = {r.id: (r.score, r.label) for r in text.sentiment_score(text.chat_lines(df), model).collect()}
    assert got[0] == (0.5, "中性") and got[3] == (0.5, "中性")
    assert got[1][1] == "正面" and got[2][1] == "负面"
    users = {r.username: (r.cnt, r.quadrant) for r in text.sentiment_users(df, model).collect()}
    assert users == {"a": (2, "路人好感"), "b": (2, "流失风险")}


def test_bins_sum_to_lines(views):
    scores = text.sentiment_score(text.chat_lines(views.danmaku), views.sentiment_model)
    assert text.sentiment_hist(scores).agg(F.sum("cnt")).first()[0] == scores.count()


def test_latest_lines_only(spark):
    df = chats(spark, [("a", w, T0) for w in ("old old", "mid mid", "new new")])
    assert {r.name for r in text.word_cloud(df, latest=2).collect()} == {"mid", "new"}
    assert text.word_cloud(df).count() == 3


def test_stop_words_and_noise_leave(spark):
    df = chats(spark, [("a", "没有 好看好看 12 12 ok ok", T0)])
    names = {r.name for r in text.word_cloud(df).collect()}
    assert names == {"好看", "ok"}


# --- commerce and forecast ---


def test_stock_of_zero_is_ok(spark):
    rows = [(1, "a", "R", "c", 0, 50), (2, "b", "R", "c", 100, 81), (3, "c", "R", "c", 100, 80), (4, "d", "R", "c", 100, 51), (5, "e", "R", "c", 100, 31), (6, "f", "R", "c", 100, 30)]
    df = spark.createDataFrame(rows, "product_id bigint, product_name string, room_name string, category string, stock int, sold int")
    got = {r.product_id: (r.alert_level, r.sell_through_rate) for r in commerce.stock_levels(df).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "OK", 2: "RED", 3: "YELLOW", 4: "YELLOW", 5: "GREEN", 6: "OK"}
    assert got[1][1] == 5000.0


def test_product_filters(views):
    p = views.products
    first = p.first()
    chosen = commerce.product_list(p, first.room_name, first.category).collect()
    assert chosen and {(r.room_name, r.category) for r in chosen} == {(first.room_name, first.category)}


def test_forecasts(spark):
    def of(quantities, **kw):
        daily = forecast.daily_sales(orders(spark, [("u", 1, q, d) for d, q in quantities]), **kw)
        return forecast.sales_line(daily)

    assert of([(0, 1), (1, 2)]).count() == 0
    rising = of([(0, 10), (1, 20), (2, 30)])
    assert [r.predicted_qty for r in forecast.sales_forecast(rising, days_ahead=2).orderBy("dt").collect()] == [40.0, 50.0]
    assert forecast.sales_trend(rising).first().trend == "上升"
    assert forecast.sales_trend(of([(0, 5), (1, 5), (2, 5)])).first().trend == "平稳"
    falling = of([(0, 30), (1, 20), (2, 10)])
    assert forecast.sales_trend(falling).first().trend == "下降"
    assert [r.predicted_qty for r in forecast.sales_forecast(falling, days_ahead=3).orderBy("dt").collect()] == [0.0, 0.0, 0.0]
    assert of([(0, 4), (9, 4), (10, 4)]).first().history_days == 3
    assert of([(0, 4), (9, 4), (10, 4)], fill_gaps=True).first().history_days == 11


# --- recommendation ---


def basket_rows():
    rows = [("big1", p) for p in range(40)] + [("big2", p) for p in range(0, 40, 2)] + [("big3", p) for p in range(0, 40, 3)]
    rows += [(f"u{i}", p) for i in range(60) for p in {i * 7 % 40, i * 11 % 40, i * 13 % 40, (i + 1) % 40}]
    return rows


def brute_pairs(rows):
    by_customer = {}
    for c, p in rows:
        by_customer.setdefault(c, set()).add(p)
    counts = Counter()
    for items in by_customer.values():
        counts.update(combinations(sorted(items), 2))
    return counts, len(by_customer), Counter(p for items in by_customer.values() for p in items)


@pytest.mark.parametrize("block", [512, 8, 5])
def test_recommendations_survive_huge_baskets(spark, block):
    rows = basket_rows()
    df = orders(spark, [(c, p, 1, 0) for c, p in rows])
    counts, _, _ = brute_pairs(rows)
    both = Counter(counts)
    both.update({(b, a): n for (a, b), n in counts.items()})
    want = set()
    for p in range(40):
        ranked = sorted(((-n, q) for (a, q), n in both.items() if a == p))[:5]
        want |= {(p, q, -n) for n, q in ranked}
    got = recommend.cooccurrence_recs(df, block_items=block)
    assert {(r.product_id, r.rec_product_id, r.score) for r in got.collect()} == want


@pytest.mark.parametrize("block,support", [(512, 3), (8, 3), (8, 1), (5, 4)])
def test_rules_survive_huge_baskets(spark, block, support):
    rows = basket_rows()
    df = orders(spark, [(c, p, 1, 0) for c, p in rows])
    counts, users, buyers = brute_pairs(rows)
    want = {(a, b, n) for (a, b), n in counts.items() if n >= support and n / buyers[a] >= 0.1}
    got = recommend.association_rules(df, support, 0.1, n=None, block_items=block).collect()
    assert {(r.antecedent_id, r.consequent_id, r.co_count) for r in got} == want
    one = got[0]
    lift = one.co_count * users / (buyers[one.antecedent_id] * buyers[one.consequent_id])
    assert abs(one.lift - lift) <= 0.0051


def test_rule_options(spark):
    df = orders(spark, [(c, p, 1, 0) for c, p in basket_rows()])
    one_way = recommend.association_rules(df, 3, 0.0, n=None)
    both = recommend.association_rules(df, 3, 0.0, n=None, both_directions=True).collect()
    assert len(both) == 2 * one_way.count()
    lifts = {(r.antecedent_id, r.consequent_id): r.lift for r in both}
    assert all(lifts[(b, a)] == lift for (a, b), lift in lifts.items())
    assert recommend.association_rules(df, 3, 0.0, n=None, max_pairs=7).count() == 7


# --- messages ---


def test_damaged_json_is_kept_aside(spark):
    texts = ['{"room_id":"1","text":"a"}', "{broken", None, "", '{"other":1}', "[1]"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    decoded = messages.json_quarantine(df, "value", CHAT_MESSAGE)
    good, bad = decoded.filter("NOT bad"), decoded.filter("bad")
    kept = {r.n: r.body.room_id for r in good.collect()}
    assert kept[0] == "1" and kept[4] is None
    assert {r.n for r in bad.collect()} >= {1, 2}
    assert good.count() + bad.count() == len(texts)


def test_room_names_fall_back(spark):
    known = spark.createDataFrame([("1", "Known")], "room_id string, room_name string")
    df = spark.createDataFrame([("1", "Own"), ("1", ""), ("1", None), ("2", "")], "room_id string, room_name string")
    got = [r.room_name for r in messages.named_rooms(df, known).collect()]
    assert sorted(got) == ["2", "Known", "Known", "Own"]


def test_long_fields_stay_whole(spark):
    df = spark.createDataFrame(
        [("live_danmaku", "1", "n" * 60, "u" * 120, "7", "字" * 600, "2024-01-01T00:00:00")],
        "topic string, room_id string, room_name string, username string, user_id string, text string, timestamp string",
    ).withColumn("gift_name", F.lit(None).cast("string")).withColumn("gift_count", F.lit(None).cast("bigint"))
    row = messages.message_rows(df).first()
    assert (len(row.room_name), len(row.username), len(row.text)) == (60, 120, 600)


def test_cleaned_messages_are_unique(spark):
    df = chats(spark, [("a", "x", T0), ("b", "y", T0)])
    known = spark.createDataFrame([("r1", "R")], "room_id string, room_name string")
    assert warehouse.dwd_danmaku(df.unionByName(df), known).count() == 2
