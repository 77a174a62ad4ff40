"""The catalogue's queries as plain SQL over the driver tables, for checking results.

Each text names shared views; :func:`oracle` puts the ones it needs in front.
"""

from __future__ import annotations

import re

from roompulse.functions.texts import STOP_WORDS

VIEWS: dict[str, str] = {
    "v_room": "SELECT 'room_' || CAST(r_regionkey AS VARCHAR) AS room_id, r_name AS room_name FROM region",
    "v_events_x": """
SELECT event_id, 'room_' || CAST(event_id % 5 AS VARCHAR) AS room_id,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'user_' || CAST(user_id AS VARCHAR) END AS username,
  user_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, ts AS created_at FROM events""",
    "v_danmaku": """
SELECT e.event_id AS id, e.room_id, r.room_name, e.username, CAST(e.user_id AS VARCHAR) AS user_id,
  CASE WHEN e.event_type = 'purchase' THEN 'gift' ELSE 'chat' END AS msg_type,
  CASE WHEN e.event_type <> 'purchase' THEN d.text END AS text,
  CASE WHEN e.event_type = 'purchase' THEN 'gift_' || CAST(k % 9 AS VARCHAR) END AS gift_name,
  CASE WHEN e.event_type = 'purchase' THEN 1 + k % 5 END AS gift_count, e.created_at
FROM v_events_x e JOIN v_room r ON e.room_id = r.room_id
LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
WHERE e.event_type IN ('click', 'view', 'purchase')""",
    "v_live_metrics": """
SELECT e.event_id AS id, e.room_id, r.room_name, 'title ' || CAST(k AS VARCHAR) AS title, 'streamer' AS streamer,
  CASE k % 5 WHEN 0 THEN CAST(100 + k * 10 AS VARCHAR) WHEN 1 THEN '1,' || CAST(100 + k AS VARCHAR) || '+'
    WHEN 2 THEN '1.' || CAST(k % 10 AS VARCHAR) || 'w' WHEN 3 THEN '2.' || CAST(k % 10 AS VARCHAR) || '万' ELSE 'n/a' END AS online,
  CASE k % 5 WHEN 0 THEN 100 + k * 10 WHEN 1 THEN 1000 + 100 + k WHEN 2 THEN 10000 + (k % 10) * 1000
    WHEN 3 THEN 20000 + (k % 10) * 1000 END AS online_n,
  e.event_id * 3 AS like_count, CASE WHEN k % 7 = 0 THEN '未开播' ELSE '直播中' END AS status,
  k % 2 = 0 AS has_cart, k AS cart_total, k % 3 = 0 AS has_commerce, e.created_at
FROM v_events_x e JOIN v_room r ON e.room_id = r.room_id WHERE e.event_type = 'signup'""",
    "v_room_stats": """
SELECT e.event_id AS id, e.room_id, r.room_name, 100 + k AS online_count,
  CAST(k AS VARCHAR) || '.5万' AS total_users, e.created_at
FROM v_events_x e JOIN v_room r ON e.room_id = r.room_id WHERE e.event_type = 'error'""",
    "v_orders": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS order_id, l.l_partkey AS product_id,
  p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS product_name, r.room_name, p.p_type AS category,
  CAST(l.l_quantity AS INT) AS quantity, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS total_amount,
  o.o_orderdate AS order_time, 'USER_' || CAST(o.o_custkey AS VARCHAR) AS customer_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
JOIN v_room r ON r.room_id = 'room_' || CAST(l.l_partkey % 5 AS VARCHAR)""",
    "v_products": """
SELECT p.p_partkey AS product_id, p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS product_name, p.p_type AS category,
  r.room_name, r.room_id, CAST(p.p_retailprice AS DECIMAL(10,2)) - 200 AS cost_price,
  CAST(p.p_retailprice AS DECIMAL(10,2)) AS original_price,
  CAST(p.p_retailprice AS DECIMAL(10,2)) - 10 * (p.p_size % 15) AS live_price,
  (p.p_size - 1) * 60 AS stock, CAST(coalesce(s.qty, 0) AS INT) AS sold
FROM part p JOIN v_room r ON r.room_id = 'room_' || CAST(p.p_partkey % 5 AS VARCHAR)
LEFT JOIN (SELECT product_id, sum(quantity) AS qty FROM v_orders GROUP BY product_id) s ON s.product_id = p.p_partkey""",
    "v_prices": """
SELECT * FROM (VALUES ('gift_0', 0.1), ('gift_1', 1), ('gift_2', 0.5), ('gift_3', 5), ('gift_4', 50), ('gift_5', 100),
  ('gift_6', 500), ('gift_7', 3000)) AS t(gift_name, price)""",
    "v_gifts": """
SELECT d.*, CAST(coalesce(p.price, 1) AS DECIMAL(12,2)) * d.gift_count AS amount
FROM v_danmaku d LEFT JOIN v_prices p ON p.gift_name = d.gift_name WHERE d.msg_type = 'gift'""",
    "v_chats": "SELECT * FROM v_danmaku WHERE msg_type = 'chat'",
    "v_samples": """
SELECT room_id, room_name, id, created_at, CAST(online_n AS BIGINT) AS online FROM v_live_metrics WHERE online_n IS NOT NULL
UNION ALL SELECT room_id, room_name, id, created_at, CAST(online_count AS BIGINT) FROM v_room_stats""",
    "v_judged": """
SELECT *, coalesce(sum(online) OVER w, 0) AS s, count(online) OVER w AS n, lag(online) OVER o AS previous,
  row_number() OVER o AS ix
FROM v_samples WINDOW o AS (PARTITION BY room_id ORDER BY created_at, id),
  w AS (PARTITION BY room_id ORDER BY created_at, id ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING)""",
    "v_user_chats": "SELECT room_name, username, count(*) AS cnt FROM v_chats GROUP BY room_name, username",
    "v_user_counts": """
SELECT room_name, username, count(*) FILTER (msg_type = 'chat') AS chats, count(*) FILTER (msg_type = 'gift') AS gifts
FROM v_danmaku GROUP BY room_name, username""",
    "v_rfm_base": """
SELECT room_name, username, count(*) AS frequency, count(DISTINCT CAST(created_at AS DATE)) AS active_days,
  (greatest(0, epoch_us((SELECT max(created_at) FROM v_danmaku)) - epoch_us(max(created_at))) + 180000000) // 360000000 AS tenths
FROM v_chats WHERE username IS NOT NULL GROUP BY room_name, username HAVING count(*) >= 3""",
    "v_rfm_ranked": """
SELECT *, row_number() OVER (PARTITION BY room_name ORDER BY tenths) - 1 AS ri,
  row_number() OVER (PARTITION BY room_name ORDER BY frequency) - 1 AS fi, count(*) OVER (PARTITION BY room_name) AS n
FROM v_rfm_base""",
    "v_rfm_medians": """
SELECT room_name, max(tenths) FILTER (ri = n // 2) AS r_med, max(frequency) FILTER (fi = n // 2) AS f_med
FROM v_rfm_ranked GROUP BY room_name""",
    "v_rfm": """
SELECT b.room_name, b.username, b.tenths / 10.0 AS recency, b.frequency,
  ((b.frequency * 20 + b.active_days) // (2 * b.active_days)) / 10.0 AS engagement, b.active_days,
  CASE WHEN b.tenths <= m.r_med AND b.frequency >= m.f_med THEN '核心粉丝(R低F高)' WHEN b.tenths <= m.r_med THEN '新晋活跃(R低F低)'
    WHEN b.frequency >= m.f_med THEN '沉睡用户(R高F高)' ELSE '流失风险(R高F低)' END AS segment,
  m.r_med / 10.0 AS r_median, m.f_med AS f_median
FROM v_rfm_base b JOIN v_rfm_medians m ON m.room_name = b.room_name""",
    "v_first_days": """
SELECT room_name, username, min(CAST(created_at AS DATE)) AS first_day FROM v_chats WHERE username IS NOT NULL GROUP BY ALL""",
    "v_retention": """
SELECT u.room_name, d.day, count(*) FILTER (EXISTS (SELECT 1 FROM v_chats c WHERE c.room_name = u.room_name
    AND c.username = u.username AND CAST(c.created_at AS DATE) = u.first_day + CAST(d.day AS INT))) AS retained,
  count(*) AS total_users,
  count(*) FILTER (u.first_day + CAST(d.day AS INT) <= (SELECT CAST(max(created_at) AS DATE) FROM v_danmaku)) AS observable
FROM v_first_days u CROSS JOIN (SELECT CAST(unnest(range(1, 15)) AS INT) AS day) d GROUP BY u.room_name, d.day""",
    "v_model_counts": r"""
SELECT term, count(*) FILTER (positive) AS pos, count(*) FILTER (NOT positive) AS neg
FROM (SELECT l.quality = 1 AS positive, unnest(regexp_extract_all(d.text, '[\p{L}\p{M}\p{N}]+')) AS term
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id) GROUP BY term""",
    "v_model_totals": "SELECT sum(pos) AS p, sum(neg) AS n, count(*) AS v FROM v_model_counts",
    "v_model": """
SELECT term, CAST(floor((ln((pos + 1) / (p + v)) - ln((neg + 1) / (n + v))) * 1000000.0 + 0.5) AS BIGINT) AS weight
FROM v_model_counts, v_model_totals""",
    "v_prior": """
SELECT CAST(floor(ln((count(*) FILTER (l.quality = 1) + 1) / (count(*) FILTER (l.quality <> 1) + 1)) * 1000000.0 + 0.5) AS BIGINT) AS prior
FROM labels l JOIN documents d ON d.doc_id = l.doc_id""",
    "v_text_weight": r"""
SELECT text, coalesce(sum(m.weight), 0) AS w FROM (
  SELECT text, unnest(regexp_extract_all(text, '[\p{L}\p{M}\p{N}]+')) AS term
  FROM (SELECT DISTINCT text FROM v_chats WHERE text IS NOT NULL)) t LEFT JOIN v_model m ON m.term = t.term GROUP BY text""",
    "v_weighted": """
SELECT c.*, coalesce(t.w, 0) AS w FROM v_chats c LEFT JOIN v_text_weight t ON t.text = c.text WHERE c.text IS NOT NULL""",
    "v_scores": """
SELECT id, room_name, username, created_at, floor(raw * 1000.0 + 0.5) / 1000.0 AS score,
  CAST(floor(raw * 1000.0 + 0.5) AS BIGINT) AS milli,
  CASE WHEN raw > 0.6 THEN '正面' WHEN raw < 0.4 THEN '负面' ELSE '中性' END AS label
FROM (SELECT *, CASE WHEN text = '' THEN 0.5 ELSE
    1.0::DOUBLE / (1.0::DOUBLE + exp(-greatest(least((w + (SELECT prior FROM v_prior)) / 1000000.0::DOUBLE, 50.0), -50.0))) END AS raw
  FROM v_weighted)""",
    "v_user_scores": """
SELECT room_name, username, cnt, floor(raw * 1000.0 + 0.5) / 1000.0 AS sentiment,
  CASE WHEN cnt >= 10 AND raw > 0.6 THEN '忠实粉丝' WHEN cnt >= 10 AND raw < 0.4 THEN '情绪用户'
    WHEN cnt < 10 AND raw >= 0.4 THEN '路人好感' ELSE '流失风险' END AS quadrant
FROM (SELECT room_name, username, count(*) AS cnt, CASE WHEN bool_and(text = '') THEN 0.5 ELSE
    1.0::DOUBLE / (1.0::DOUBLE + exp(-greatest(least((sum(w) + (SELECT prior FROM v_prior)) / 1000000.0::DOUBLE, 50.0), -50.0))) END AS raw
  FROM v_weighted GROUP BY room_name, username HAVING count(*) >= 2)""",
    "v_lines": """
SELECT room_name, text, count(*) AS times FROM v_chats WHERE length(text) >= 2 GROUP BY room_name, text""",
    "v_stop": f"SELECT unnest({sorted(STOP_WORDS)!r}) AS term",
    "v_terms": r"""
SELECT room_name, term, CAST(sum(n * times) AS BIGINT) AS tf, CAST(sum(times) AS BIGINT) AS df_room FROM (
  SELECT room_name, text, times, term, count(*) AS n
  FROM (SELECT room_name, text, times, unnest(regexp_extract_all(text, '[\p{L}\p{M}\p{N}]+')) AS term FROM v_lines)
  WHERE length(term) >= 2 AND NOT regexp_matches(term, '^[0-9]+$') GROUP BY ALL)
WHERE term NOT IN (SELECT term FROM v_stop) GROUP BY room_name, term""",
    "v_daily": """
SELECT room_name, CAST(order_time AS DATE) AS dt, CAST(sum(quantity) AS BIGINT) AS qty, sum(total_amount) AS gmv
FROM v_orders GROUP BY ALL""",
    "v_line": """
SELECT room_name, count(*) AS history_days, max(dt) AS last_day, sum(qty) AS qty_sum, CAST(sum(gmv) AS DOUBLE) AS gmv_sum,
  regr_slope(qty, ix) AS slope, regr_intercept(qty, ix) AS intercept,
  (sum(qty) FILTER (back <= 7) * 20 + count(*) FILTER (back <= 7)) // (2 * count(*) FILTER (back <= 7)) / 10.0 AS ma7
FROM (SELECT *, row_number() OVER (PARTITION BY room_name ORDER BY dt) - 1 AS ix,
  row_number() OVER (PARTITION BY room_name ORDER BY dt DESC) AS back FROM v_daily) GROUP BY room_name HAVING count(*) >= 3""",
    "v_growth": """
SELECT product_id, product_name, category, CAST(recent AS BIGINT) AS recent_sold, CAST(total AS BIGINT) AS total_sold,
  ((recent * 2000 + greatest(old, 1)) // (2 * greatest(old, 1)) - 1000) / 10.0 AS growth_pct
FROM (SELECT product_id, product_name, category, coalesce(sum(quantity) FILTER (order_time > start), 0) AS recent,
    coalesce(sum(quantity) FILTER (order_time <= start), 0) AS old, sum(quantity) AS total
  FROM v_orders, (SELECT max(order_time) - INTERVAL 365 DAY AS start FROM v_orders) GROUP BY ALL) WHERE total > 0""",
    "v_levels": """
SELECT product_id, product_name, room_name, category, stock, sold,
  ((CAST(sold AS BIGINT) * 2000 + greatest(stock, 1)) // (2 * greatest(stock, 1))) / 10.0 AS sell_through_rate,
  CASE WHEN sold / nullif(stock, 0) > 0.8 THEN 'RED' WHEN sold / nullif(stock, 0) > 0.5 THEN 'YELLOW'
    WHEN sold / nullif(stock, 0) > 0.3 THEN 'GREEN' ELSE 'OK' END AS alert_level FROM v_products""",
    "v_bought": "SELECT DISTINCT customer_id, product_id FROM v_orders",
    "v_pairs": """
SELECT a.product_id AS p1, b.product_id AS p2, count(*) AS co FROM v_bought a JOIN v_bought b
ON a.customer_id = b.customer_id AND a.product_id < b.product_id GROUP BY ALL""",
    "v_items": "SELECT product_id, max(product_name) AS product_name, max(category) AS category FROM v_orders GROUP BY product_id",
    "v_rules": """
SELECT p.p1, p.p2, p.co, a.n AS n1, b.n AS n2, u.n AS users, CAST(p.co AS DOUBLE) * u.n / (CAST(a.n AS DOUBLE) * b.n) AS raw
FROM v_pairs p JOIN (SELECT product_id, count(*) AS n FROM v_bought GROUP BY 1) a ON a.product_id = p.p1
JOIN (SELECT product_id, count(*) AS n FROM v_bought GROUP BY 1) b ON b.product_id = p.p2,
(SELECT count(DISTINCT customer_id) AS n FROM v_bought) u""",
    "v_windows": """
SELECT room_id, start, max(room_name) AS room_name, count(*) FILTER (kind = 'chat') AS chats,
  coalesce(sum(amount), 0) AS gifts, count(*) FILTER (kind = 'sample') AS samples,
  max_by(online, ix) FILTER (kind = 'sample') AS online, max_by(average, ix) FILTER (kind = 'sample') AS average,
  max_by(trend, ix) FILTER (kind = 'sample') AS trend, coalesce(sum(alert), 0) AS alerts
FROM (
  SELECT room_id, room_name, time_bucket(to_minutes(width), created_at) AS start, 'chat' AS kind, NULL AS amount, NULL AS online, NULL AS average,
    NULL AS trend, NULL AS ix, 0 AS alert FROM v_chats, v_width
  UNION ALL SELECT room_id, room_name, time_bucket(to_minutes(width), created_at), 'gift', amount, NULL, NULL, NULL, NULL, 0 FROM v_gifts, v_width
  UNION ALL SELECT room_id, room_name, time_bucket(to_minutes(width), created_at), 'sample', NULL, online,
    (2 * (s + online) + n + 1) // (2 * (n + 1)), CASE WHEN previous IS NULL THEN 'stable' WHEN online > previous THEN 'up' ELSE 'down' END,
    ix, CASE WHEN n >= 2 AND s > 100 * n AND (online * n * 10 < s * 7 OR online * n * 10 > s * 15) THEN 1 ELSE 0 END FROM v_judged, v_width
) GROUP BY room_id, start""",
    "v_snapshot": """
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, room_id, room_name,
  CAST(coalesce(last_value(online IGNORE NULLS) OVER w, 0) AS BIGINT) AS online_current,
  CAST(coalesce(last_value(average IGNORE NULLS) OVER w, 0) AS BIGINT) AS online_avg,
  coalesce(last_value(trend IGNORE NULLS) OVER w, 'stable') AS online_trend,
  CAST(chats AS BIGINT) AS danmaku_rate, CAST(gifts AS DOUBLE) AS gift_value,
  CAST(chats * 4.50 + gifts AS DOUBLE) AS gmv_estimate, CAST(sum(alerts) OVER w AS BIGINT) AS alert_count
FROM v_windows WINDOW w AS (PARTITION BY room_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "v_width": "SELECT 1 AS width",
    "v_envelopes": """
SELECT e.event_id AS id, e.room_id, r.room_name, e.user_id, e.username, e.k, strftime(e.created_at, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
  CASE e.event_id % 15 WHEN 0 THEN 'chat' WHEN 1 THEN 'gift' WHEN 2 THEN 'like' WHEN 3 THEN 'member' WHEN 4 THEN 'social'
    WHEN 5 THEN 'stats' WHEN 6 THEN 'fansclub' WHEN 7 THEN 'control' WHEN 8 THEN 'emoji' WHEN 9 THEN 'room_stats'
    WHEN 10 THEN 'room' WHEN 11 THEN 'rank' WHEN 12 THEN 'stream' END AS kind
FROM v_events_x e JOIN v_room r ON r.room_id = e.room_id""",
    "v_latest": """
SELECT m.*, c.records, c.first_seen FROM v_live_metrics m JOIN (SELECT room_id, max(id) AS id, count(*) AS records,
  min_by(created_at, id) AS first_seen FROM v_live_metrics GROUP BY room_id) c ON c.room_id = m.room_id AND c.id = m.id""",
    "v_messages": "SELECT room_name, count(*) AS n FROM v_danmaku GROUP BY room_name",
}

LAST_SAMPLE = "(SELECT max(created_at) FROM v_live_metrics)"

SQL: dict[str, str] = {
    "danmaku_tumble_1m": """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
  room_id, room_name, danmaku_cnt FROM (SELECT time_bucket(INTERVAL 1 MINUTE, created_at) AS w, room_id,
  max(room_name) AS room_name, count(*) AS danmaku_cnt FROM v_chats GROUP BY ALL)""",
    "room_minute_agg": """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, room_id, max(room_name) AS room_name,
  CAST(coalesce(sum(online) // nullif(count(online), 0), 0) AS BIGINT) AS online_avg, coalesce(max(online), 0) AS online_max,
  coalesce(min(online), 0) AS online_min, CAST(sum(chat) AS BIGINT) AS danmaku_rate, count(online) AS samples
FROM (SELECT room_id, room_name, date_trunc('minute', created_at) AS w, 1 AS chat, NULL AS online FROM v_chats
  UNION ALL SELECT room_id, room_name, date_trunc('minute', created_at), 0, CASE WHEN online > 0 THEN online END FROM v_samples)
GROUP BY w, room_id""",
    "online_alerts": """
SELECT room_id, room_name, id, created_at AS event_time,
  CASE WHEN online * n * 10 < s * 7 THEN 'online_drop' ELSE 'online_spike' END AS alert_type,
  CASE WHEN online * n * 10 < s * 7 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, online,
  CAST((2 * s + n) // (2 * n) AS DOUBLE) AS baseline
FROM v_judged WHERE n >= 2 AND s > 100 * n AND (online * n * 10 < s * 7 OR online * n * 10 > s * 15)""",
    "gift_value": """
SELECT room_id, room_name, CAST(sum(gift_count) AS BIGINT) AS gift_count, CAST(sum(amount) AS DOUBLE) AS gift_value
FROM v_gifts GROUP BY ALL""",
    "room_snapshot": "SELECT * FROM v_snapshot",
    "surge_alerts": """
SELECT room_id, room_name, window_start, danmaku_rate, gmv_estimate, alert_type FROM (
  SELECT *, unnest(['danmaku_surge', 'gmv_increase']) AS alert_type,
    lag(gmv_estimate) OVER (PARTITION BY room_id ORDER BY window_start) AS before FROM v_snapshot)
WHERE (alert_type = 'danmaku_surge' AND danmaku_rate > 4)
  OR (alert_type = 'gmv_increase' AND before > 0 AND gmv_estimate * 100 > before * 200)""",
    "route_messages": """
SELECT id, room_id, room_name, timestamp, kind,
  CASE WHEN kind IN ('chat', 'gift', 'like', 'member', 'social', 'emoji') THEN user_id END AS user_id,
  CASE WHEN kind IN ('chat', 'gift', 'like', 'member', 'social', 'emoji') THEN username END AS username,
  CASE WHEN kind = 'member' THEN CASE WHEN k % 2 = 1 THEN '男' ELSE '女' END END AS gender,
  CASE WHEN kind IN ('chat', 'fansclub') THEN 'say ' || k WHEN kind = 'emoji' THEN '[smile]' WHEN kind = 'room_stats' THEN k || ' watching'
    WHEN kind = 'stats' THEN k || '.5万' END AS content,
  CASE WHEN kind = 'gift' THEN 'gift_' || (k % 9) END AS gift_name,
  CAST(CASE kind WHEN 'gift' THEN 1 + k % 5 WHEN 'like' THEN k WHEN 'stats' THEN 100 + k WHEN 'control' THEN 1 + k % 3
    WHEN 'emoji' THEN 500 + k WHEN 'room' THEN id % 5 WHEN 'rank' THEN CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END
    WHEN 'stream' THEN k % 4 END AS BIGINT) AS amount,
  kind = 'control' AND 1 + k % 3 = 3 AS ends_room,
  CASE kind WHEN 'chat' THEN 'live_danmaku' WHEN 'gift' THEN 'live_gifts' WHEN 'stats' THEN 'live_room_info' END AS topic
FROM v_envelopes WHERE kind IS NOT NULL""",
    "published_messages": """
SELECT CASE kind WHEN 'chat' THEN 'live_danmaku' WHEN 'gift' THEN 'live_gifts' ELSE 'live_room_info' END AS topic, room_id AS key,
  '{' || CASE kind
    WHEN 'chat' THEN coalesce('"username":"' || username || '",', '') || '"user_id":"' || user_id || '","text":"say ' || k || '"'
    WHEN 'gift' THEN coalesce('"username":"' || username || '",', '') || '"gift_name":"gift_' || (k % 9) || '","gift_count":' || (1 + k % 5)
    ELSE '"online":"' || (100 + k) || '","total_users":"' || k || '.5万","source":"websocket"' END ||
  ',"timestamp":"' || timestamp || '","room_name":"' || room_name || '","room_id":"' || room_id || '"}' AS value
FROM v_envelopes WHERE kind IN ('chat', 'gift', 'stats')""",
    "rank_entries": """
SELECT id, room_id, room_name, timestamp, CAST(place AS INT) AS place, user_id, username, CAST(k AS VARCHAR) AS score
FROM (SELECT *, unnest(CASE WHEN k % 2 = 0 THEN [1, 2] ELSE [1] END) AS place FROM v_envelopes WHERE kind = 'rank')""",
    "message_type_counts": """
SELECT room_id, count(*) FILTER (kind = 'chat') AS chat, count(*) FILTER (kind = 'gift') AS gift, count(*) FILTER (kind = 'member') AS member,
  count(*) FILTER (kind = 'stats') AS stats, count(*) FILTER (kind IN ('chat', 'gift', 'member', 'stats')) AS total
FROM v_envelopes WHERE kind IS NOT NULL GROUP BY room_id""",
    "room_liveness": f"""
SELECT r.room_id, r.room_name, m.last_seen, CAST(floor((epoch_us({LAST_SAMPLE}) - epoch_us(m.last_seen)) / 1000000) AS DOUBLE) AS idle_seconds,
  coalesce(epoch_us({LAST_SAMPLE}) - epoch_us(m.last_seen) < 600000000, false) AS live
FROM v_room r LEFT JOIN (SELECT room_id, max(created_at) AS last_seen FROM v_live_metrics GROUP BY room_id) m ON m.room_id = r.room_id""",
    "json_quarantine": """
SELECT id, CASE WHEN id % 50 <> 0 THEN room_id END AS room_id, CASE WHEN id % 50 <> 0 THEN username END AS username,
  CASE WHEN id % 50 <> 0 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp, id % 50 = 0 AS bad FROM v_chats""",
    "room_name_fallback": """
SELECT topic, room_id, room_name, count(*) AS n FROM (
  SELECT CASE msg_type WHEN 'chat' THEN 'live_danmaku' ELSE 'live_gifts' END AS topic, room_id, room_name FROM v_danmaku
  UNION ALL SELECT 'live_room_info', room_id, room_name FROM v_live_metrics
  UNION ALL SELECT 'live_room_info', room_id, room_name FROM v_room_stats) GROUP BY ALL""",
    "ingest_danmaku": """
SELECT room_id, room_name, coalesce(username, '') AS username,
  CASE WHEN msg_type = 'chat' THEN user_id END AS user_id, CASE WHEN msg_type = 'chat' THEN coalesce(text, '') END AS text,
  gift_name, CAST(CASE WHEN msg_type = 'gift' THEN CASE WHEN id % 2 = 0 THEN gift_count ELSE 1 END END AS BIGINT) AS gift_count,
  msg_type, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, created_at AS event_time FROM v_danmaku""",
    "ingest_live_metrics": """
SELECT room_id, room_name, title, '' AS streamer, online, CASE WHEN id % 3 <> 0 THEN like_count ELSE 0 END AS like_count, status,
  CAST(has_cart AS INT) AS has_cart, CAST(cart_total AS BIGINT) AS cart_total, CAST(has_commerce AS INT) AS has_commerce,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, created_at AS event_time FROM v_live_metrics""",
    "ingest_room_stats": """
SELECT room_id, room_name, CAST(online_count AS BIGINT) AS online_count, total_users,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, created_at AS event_time FROM v_room_stats""",
    "flatten_room_record": """
SELECT e.room_id, r.room_name, CASE WHEN k % 4 <> 0 THEN 'title ' || k ELSE '' END AS title,
  CASE WHEN k % 3 <> 0 THEN 'streamer' ELSE '' END AS streamer, CAST(100 + k AS VARCHAR) AS online, event_id * 3 AS like_count,
  CASE WHEN k % 7 = 0 THEN '未开播' ELSE '直播中' END AS status, CAST(CASE WHEN k % 7 = 0 THEN 4 ELSE 2 END AS BIGINT) AS status_code,
  k % 2 = 0 AS has_cart, CAST(CASE WHEN k % 2 = 0 THEN k ELSE 0 END AS BIGINT) AS cart_total, k || '万' AS total_users,
  k % 5 = 0 AS can_danmaku, false AS can_gift, k % 3 = 0 AS has_commerce,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
FROM v_events_x e JOIN v_room r ON r.room_id = e.room_id WHERE event_type = 'signup'""",
    "json_encode": """
SELECT id, '{"room_id":"' || room_id || '","room_name":"' || room_name || '","online_count":' || online_count ||
  ',"total_users":"' || total_users || '"}' AS value FROM v_room_stats""",
    "fn_ngrams": """
SELECT 'all' AS room_name, substr(text, i, n) AS word, count(*) AS count
FROM (SELECT text, n, unnest(range(1, length(text) - n + 2)) AS i FROM (SELECT text, unnest([2, 3, 4]) AS n FROM benchmark))
GROUP BY ALL""",
    "fn_iso_parse": """
SELECT event_id, CASE k % 3 WHEN 0 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f')
  ELSE 'soon' END AS written,
  CASE k % 3 WHEN 0 THEN date_trunc('second', created_at) WHEN 1 THEN created_at END AS parsed FROM v_events_x""",
    "fn_parse_count": """
SELECT id, online, CAST(coalesce(online_n, 0) AS BIGINT) AS n, online_n IS NULL AS unreadable FROM v_live_metrics""",
    "room_overview": f"""
SELECT r.room_id, r.room_name, coalesce(l.online, '无数据') AS online, substr(coalesce(l.title, ''), 1, 30) AS title,
  coalesce(epoch_us({LAST_SAMPLE}) - epoch_us(l.created_at) < 600000000, false) AS live, coalesce(l.records, 0) AS records,
  coalesce(m.n, 0) AS danmaku, strftime(l.created_at, '%H:%M:%S') AS updated
FROM v_room r LEFT JOIN v_latest l ON l.room_id = r.room_id LEFT JOIN v_messages m ON m.room_name = r.room_name""",
    "room_stats": """
SELECT l.room_id, coalesce(r.room_name, '') AS room_name, l.online, l.like_count AS likes, substr(l.title, 1, 50) AS title, l.status,
  l.records AS total, coalesce(m.n, 0) AS danmaku_count, strftime(l.first_seen, '%m/%d %H:%M') AS start_time,
  strftime(l.created_at, '%H:%M:%S') AS timestamp
FROM v_latest l LEFT JOIN v_room r ON l.room_id = r.room_id LEFT JOIN v_messages m ON m.room_name = r.room_name""",
    "room_compare": """
SELECT r.room_name, coalesce(l.online, '离线') AS online, coalesce(l.like_count, 0) AS likes, substr(coalesce(l.title, ''), 1, 30) AS title,
  coalesce(m.n, 0) AS danmaku, coalesce(strftime(l.created_at, '%H:%M:%S'), '') AS updated
FROM v_room r LEFT JOIN v_latest l ON l.room_id = r.room_id LEFT JOIN v_messages m ON m.room_name = r.room_name""",
    "room_last_minute": "",
    "collect_rate": f"""
SELECT room_id, strftime(created_at, '%H:%M') AS t, count(*) AS c FROM v_live_metrics
WHERE created_at > {LAST_SAMPLE} - INTERVAL 1440 MINUTE GROUP BY ALL""",
    "user_segmentation": """
SELECT u.room_name, t.tier, count(*) FILTER (u.cnt BETWEEN t.lo AND t.hi) AS users FROM v_user_chats u CROSS JOIN
  (VALUES (100, 1000000000, '超级粉(100+)'), (50, 99, '铁杆粉(50-99)'), (10, 49, '忠实粉丝(10-49)'), (3, 9, '活跃观众(3-9)'), (0, 2, '路人(1-2)')) AS t(lo, hi, tier)
GROUP BY ALL""",
    "user_segment_samples": """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY room_name, tier ORDER BY cnt DESC, username ASC NULLS LAST) AS INT) AS rank FROM (
  SELECT room_name, username, cnt, CASE WHEN cnt >= 100 THEN '超级粉(100+)' WHEN cnt >= 50 THEN '铁杆粉(50-99)' WHEN cnt >= 10 THEN '忠实粉丝(10-49)'
    WHEN cnt >= 3 THEN '活跃观众(3-9)' ELSE '路人(1-2)' END AS tier FROM v_user_chats)) WHERE rank <= 3""",
    "activity_levels": """
SELECT room_name, total_users, high_active, mid_active, greatest(total_users - high_active - mid_active, 0) AS low_active,
  ((high_active * 2000 + total_users) // (2 * total_users)) / 10.0 AS high_rate, ((mid_active * 2000 + total_users) // (2 * total_users)) / 10.0 AS mid_rate
FROM (SELECT room_name, greatest(count(username), 1) AS total_users, count(*) FILTER (chats >= 10) AS high_active,
  count(*) FILTER (chats BETWEEN 3 AND 9) AS mid_active FROM v_user_counts GROUP BY room_name)""",
    "funnel_full": """
SELECT room_name, step, name, value, ((value * 2000 + total) // (2 * total)) / 10.0 AS rate FROM (
  SELECT room_name, s[1] AS total, unnest(s) AS value, unnest([1, 2, 3, 4, 5, 6]) AS step,
    unnest(['独立观众', '发弹幕互动', '活跃互动(≥5条)', '高活跃(≥10条)', '送礼用户', '核心用户(高活跃+送礼)']) AS name
  FROM (SELECT room_name, [greatest(count(username), 1), count(username) FILTER (chats > 0), count(*) FILTER (chats >= 5),
    count(*) FILTER (chats >= 10), count(username) FILTER (gifts > 0), count(username) FILTER (chats >= 10 AND gifts > 0)] AS s
    FROM v_user_counts GROUP BY room_name))""",
    "rfm_users": "SELECT * FROM v_rfm",
    "rfm_segments": """
SELECT u.room_name, u.total_users, u.r_median, u.f_median, g.segment, count(r.username) AS users
FROM (SELECT room_name, count(*) AS total_users, max(r_median) AS r_median, max(f_median) AS f_median FROM v_rfm GROUP BY room_name) u
CROSS JOIN (VALUES ('核心粉丝(R低F高)'), ('新晋活跃(R低F低)'), ('沉睡用户(R高F高)'), ('流失风险(R高F低)')) AS g(segment)
LEFT JOIN v_rfm r ON r.room_name = u.room_name AND r.segment = g.segment GROUP BY ALL""",
    "rfm_top": """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY room_name, segment ORDER BY frequency DESC, username) AS INT) AS rank FROM v_rfm)
WHERE rank <= 3""",
    "rfm_top_users": """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY room_name ORDER BY frequency DESC, username) AS INT) AS rank FROM v_rfm)
WHERE rank <= 20""",
    "retention_daily": """
SELECT *, ((retained * 2000 + total_users) // (2 * total_users)) / 10.0 AS rate,
  ((retained * 2000 + greatest(observable, 1)) // (2 * greatest(observable, 1))) / 10.0 AS rate_observable FROM v_retention""",
    "retention_summary": """
SELECT room_name, max(total_users) AS total_users, max(rate) FILTER (day = 1) AS day1, max(rate) FILTER (day = 3) AS day3,
  max(rate) FILTER (day = 7) AS day7
FROM (SELECT *, ((retained * 2000 + total_users) // (2 * total_users)) / 10.0 AS rate FROM v_retention) GROUP BY room_name""",
    "user_journey": """
SELECT room_name, username, seq, msg_type AS type, CASE WHEN msg_type = 'gift' THEN gift_name || ' x' || gift_count ELSE substr(text, 1, 30) END AS detail,
  created_at AS time, total_messages, first, last FROM (
  SELECT *, count(*) OVER k AS total_messages, first_value(created_at) OVER f AS first, last_value(created_at) OVER f AS last FROM (
    SELECT d.*, CAST(row_number() OVER (PARTITION BY d.room_name, d.username ORDER BY d.id) AS INT) AS seq FROM v_danmaku d JOIN (
      SELECT room_name, username, row_number() OVER (PARTITION BY room_name ORDER BY md5('journey' || username), username) AS draw
      FROM v_user_chats WHERE cnt >= 10 AND username IS NOT NULL) s ON s.room_name = d.room_name AND s.username = d.username AND s.draw <= 5)
  WHERE seq <= 20 WINDOW k AS (PARTITION BY room_name, username),
    f AS (PARTITION BY room_name, username ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) WHERE seq <= 10""",
    "sampled_users": """
SELECT * FROM (SELECT room_name, username, cnt, CAST(row_number() OVER (PARTITION BY room_name ORDER BY md5('sample' || username), username) AS INT) AS rank
FROM v_user_chats WHERE username IS NOT NULL) WHERE rank <= 5""",
    "top_users": """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY room_name ORDER BY cnt DESC, username ASC NULLS LAST) AS INT) AS rank FROM v_user_chats)
WHERE rank <= 15""",
    "hourly_activity": "SELECT room_name, CAST(hour(created_at) AS INT) AS hour, count(*) AS cnt FROM v_chats GROUP BY ALL",
    "danmaku_trend": """
SELECT room_name, t, CASE WHEN any_recent THEN n_recent ELSE n_all END AS c FROM (
  SELECT *, max(n_recent) OVER (PARTITION BY room_name) > 0 AS any_recent FROM (
    SELECT room_name, strftime(created_at, '%H:%M') AS t, count(*) AS n_all,
      count(*) FILTER (created_at > (SELECT max(created_at) FROM v_danmaku) - INTERVAL 60 MINUTE) AS n_recent FROM v_danmaku GROUP BY ALL))
WHERE CASE WHEN any_recent THEN n_recent ELSE n_all END > 0""",
    "danmaku_trend_minutes": """
SELECT room_name, date_trunc('minute', created_at) AS t, count(*) AS c FROM v_danmaku
WHERE created_at > (SELECT max(created_at) FROM v_danmaku) - INTERVAL 1440 MINUTE GROUP BY ALL""",
    "danmaku_recent": """
SELECT room_name, rank, username, text, gift_name, gift_count, msg_type, created_at FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY room_name ORDER BY id DESC) AS INT) AS rank FROM v_danmaku) WHERE rank <= 20""",
    "danmaku_search": """
SELECT id, room_name, username, text, gift_name, created_at FROM v_danmaku WHERE text ILIKE '%worth%' ORDER BY id DESC LIMIT 50""",
    "export_latest": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY room_name ORDER BY id DESC) AS rn FROM v_danmaku) WHERE rn <= 10000""",
    "sentiment_score": "SELECT id, room_name, username, created_at, score, label FROM v_scores",
    "sentiment_room": """
SELECT room_name, total, positive, negative, neutral, ((positive * 2000 + total) // (2 * total)) / 10.0 AS positive_rate,
  ((negative * 2000 + total) // (2 * total)) / 10.0 AS negative_rate, ((neutral * 2000 + total) // (2 * total)) / 10.0 AS neutral_rate,
  ((milli * 2 + total) // (2 * total)) / 1000.0 AS avg_score
FROM (SELECT room_name, count(*) AS total, count(*) FILTER (label = '正面') AS positive, count(*) FILTER (label = '负面') AS negative,
  count(*) FILTER (label = '中性') AS neutral, sum(milli) AS milli FROM v_scores GROUP BY room_name)""",
    "sentiment_hist": """
SELECT s.room_name, b.bin, count(*) FILTER (s.milli >= b.lo AND s.milli < b.hi) AS cnt FROM v_scores s CROSS JOIN
  (VALUES (0, 200, '0.0-0.2(极度负面)'), (200, 400, '0.2-0.4(较为负面)'), (400, 600, '0.4-0.6(中性)'), (600, 800, '0.6-0.8(较为正面)'),
   (800, 1001, '0.8-1.0(非常正面)')) AS b(lo, hi, bin) GROUP BY ALL""",
    "sentiment_timeline": """
SELECT room_name, bucket, strftime(bucket, '%H:%M') AS time, ((sum(milli) * 2 + count(*)) // (2 * count(*))) / 1000.0 AS avg_sentiment, count(*) AS cnt
FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, created_at) AS bucket FROM v_scores)
WHERE created_at >= time_bucket(INTERVAL 5 MINUTE, (SELECT max(created_at) FROM v_danmaku)) - INTERVAL 115 MINUTE GROUP BY room_name, bucket""",
    "sentiment_quadrant": """
SELECT r.room_name, q.quadrant, count(u.quadrant) AS users FROM (SELECT DISTINCT room_name FROM v_user_scores) r
CROSS JOIN (VALUES ('忠实粉丝'), ('情绪用户'), ('路人好感'), ('流失风险')) AS q(quadrant)
LEFT JOIN v_user_scores u ON u.room_name = r.room_name AND u.quadrant = q.quadrant GROUP BY ALL""",
    "sentiment_quadrant_samples": """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY room_name, quadrant ORDER BY cnt DESC, username ASC NULLS LAST) AS INT) AS rank
FROM v_user_scores) WHERE rank <= 3""",
    "keywords_tfidf": """
SELECT room_name, rank, term AS word, tf, df, floor(w * 1000000.0 + 0.5) / 1000000.0 AS weight FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY room_name ORDER BY w DESC, term) AS INT) AS rank FROM (
    SELECT t.room_name, t.term, t.tf, d.df, t.tf * ln((l.n + 1) / (d.df + 1)) / r.n AS w FROM v_terms t
    JOIN (SELECT term, CAST(sum(df_room) AS BIGINT) AS df FROM v_terms GROUP BY term) d ON d.term = t.term
    JOIN (SELECT room_name, sum(tf) AS n FROM v_terms GROUP BY room_name) r ON r.room_name = t.room_name,
    (SELECT sum(times) AS n FROM v_lines) l)) WHERE rank <= 50""",
    "word_cloud": """
SELECT room_name, rank, term AS name, tf AS value FROM (SELECT *, CAST(row_number() OVER (PARTITION BY room_name ORDER BY tf DESC, term) AS INT) AS rank
FROM v_terms) WHERE rank <= 100 AND tf >= 2""",
    "ngram_words": """
SELECT room_name, word, count, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY room_name ORDER BY count DESC, word) AS INT) AS rank FROM (
  SELECT room_name, substr(text, i, n) AS word, CAST(sum(times) AS BIGINT) AS count
  FROM (SELECT room_name, text, times, n, unnest(range(1, length(text) - n + 2)) AS i FROM (SELECT *, unnest([2, 3, 4]) AS n FROM v_lines))
  GROUP BY ALL) WHERE count > 2) WHERE rank <= 30""",
    "room_activity_matrix": """
SELECT a.room_name, coalesce(b.bin_0, 0) AS bin_0, coalesce(b.bin_1, 0) AS bin_1, coalesce(b.bin_2, 0) AS bin_2, coalesce(b.bin_3, 0) AS bin_3,
  coalesce(b.bin_4, 0) AS bin_4, a.high_active, a.mid_active, greatest(a.total - a.high_active - a.mid_active, 0) AS low_active
FROM (SELECT room_name, greatest(count(username), 1) AS total, count(*) FILTER (chats >= 10) AS high_active,
  count(*) FILTER (chats BETWEEN 3 AND 9) AS mid_active FROM v_user_counts GROUP BY room_name) a
LEFT JOIN (SELECT room_name, count(*) FILTER (milli < 200) AS bin_0, count(*) FILTER (milli >= 200 AND milli < 400) AS bin_1,
  count(*) FILTER (milli >= 400 AND milli < 600) AS bin_2, count(*) FILTER (milli >= 600 AND milli < 800) AS bin_3,
  count(*) FILTER (milli >= 800) AS bin_4 FROM v_scores GROUP BY room_name) b ON b.room_name = a.room_name""",
    "product_sold_refresh": """
SELECT product_id, product_name, category, room_name, room_id, CAST(cost_price AS DOUBLE) AS cost_price, CAST(original_price AS DOUBLE) AS original_price,
  CAST(live_price AS DOUBLE) AS live_price, stock, sold FROM v_products""",
    "product_margin": """
SELECT product_id, CAST(cost AS DOUBLE) AS cost_price, CAST(live AS DOUBLE) AS live_price, CAST(listed AS DOUBLE) AS original_price,
  ((CAST((live - cost) * 100 AS BIGINT) * 2000 + CAST(cost * 100 AS BIGINT)) // (2 * CAST(cost * 100 AS BIGINT))) / 10.0 AS margin,
  live * 10 < listed * 9 AS is_hot
FROM (SELECT *, greatest(original_price, live) AS listed FROM (SELECT *, greatest(live_price, cost + 5) AS live FROM (
  SELECT *, greatest(cost_price, 1) AS cost FROM v_products)))""",
    "product_list": """
SELECT product_id, product_name, category, room_name, room_id, CAST(cost_price AS DOUBLE) AS cost_price, CAST(original_price AS DOUBLE) AS original_price,
  CAST(live_price AS DOUBLE) AS live_price, stock, sold FROM v_products ORDER BY sold DESC, product_id LIMIT 100""",
    "product_top": """
SELECT product_id, product_name, category, room_name, room_id, CAST(cost_price AS DOUBLE) AS cost_price, CAST(original_price AS DOUBLE) AS original_price,
  CAST(live_price AS DOUBLE) AS live_price, stock, sold, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY room_name ORDER BY sold DESC, product_id) AS INT) AS rank FROM v_products) WHERE rank <= 10""",
    "stock_levels": "SELECT * FROM v_levels",
    "inventory_alerts": "SELECT * FROM v_levels ORDER BY sell_through_rate DESC, product_id LIMIT 30",
    "product_sales_trend": """
SELECT p.product_id, p.product_name, CAST(p.live_price AS DOUBLE) AS live_price, CAST(d.dt AS VARCHAR) AS dt, CAST(d.qty AS DOUBLE) AS qty,
  CAST(d.gmv AS DOUBLE) AS gmv FROM v_products p LEFT JOIN (SELECT product_id, CAST(order_time AS DATE) AS dt, sum(quantity) AS qty,
  sum(total_amount) AS gmv FROM v_orders GROUP BY ALL) d ON d.product_id = p.product_id""",
    "orders_recent": """
SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM (SELECT * FROM v_orders
ORDER BY order_time DESC, order_id, product_id, quantity, total_amount, customer_id LIMIT 20)""",
    "gmv_daily": """
SELECT room_name, CAST(dt AS VARCHAR) AS dt, count(*) AS orders, CAST(round(sum(total_amount), 0) AS DOUBLE) AS gmv, CAST(sum(quantity) AS BIGINT) AS items
FROM (SELECT *, CAST(order_time AS DATE) AS dt, max(order_time) OVER (PARTITION BY room_name) AS newest,
    max(order_time) OVER () - INTERVAL 365 DAY AS start FROM v_orders)
WHERE order_time > start OR newest <= start GROUP BY room_name, dt""",
    "gmv_totals": "SELECT room_name, CAST(sum(total_amount) AS DOUBLE) AS gmv, count(*) AS orders FROM v_orders GROUP BY ROLLUP (room_name)",
    "product_growth": "SELECT * FROM v_growth",
    "hot_products": "SELECT * FROM v_growth ORDER BY recent_sold DESC, product_id LIMIT 10",
    "rising_products": "SELECT * FROM v_growth ORDER BY growth_pct DESC, product_id LIMIT 10",
    "gmv_kpis": """
SELECT d.*, (SELECT count(*) FROM v_levels WHERE alert_level = 'RED') AS red_products, g.product_name AS top_riser, g.growth_pct AS top_growth_pct
FROM (SELECT CAST(sum(gmv) AS DOUBLE) AS total_gmv, CAST(max(dt) AS VARCHAR) AS latest_day, CAST(max_by(gmv, dt) AS DOUBLE) AS latest_gmv,
  max_by(orders, dt) AS latest_orders FROM (SELECT CAST(order_time AS DATE) AS dt, count(*) AS orders, round(sum(total_amount), 0) AS gmv
  FROM v_orders WHERE order_time > (SELECT max(order_time) FROM v_orders) - INTERVAL 365 DAY GROUP BY 1)) d,
(SELECT * FROM v_growth ORDER BY growth_pct DESC, product_id LIMIT 1) g""",
    "cooccurrence_recs": """
SELECT r.product_id, a.product_name, a.category, r.rank, r.rec AS rec_product_id, b.product_name AS rec_product_name, b.category AS rec_category, r.score
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY product_id ORDER BY score DESC, rec) AS INT) AS rank FROM (
  SELECT p1 AS product_id, p2 AS rec, co AS score FROM v_pairs UNION ALL SELECT p2, p1, co FROM v_pairs)) r
JOIN v_items a ON a.product_id = r.product_id JOIN v_items b ON b.product_id = r.rec WHERE r.rank <= 5""",
    "association_rules": """
SELECT r.p1 AS antecedent_id, r.p2 AS consequent_id, a.product_name AS antecedent, b.product_name AS consequent,
  ((co * 2000 + users) // (2 * users)) / 1000.0 AS support, ((co * 2000 + n1) // (2 * n1)) / 1000.0 AS confidence,
  floor(raw * 100.0 + 0.5) / 100.0 AS lift, co AS co_count
FROM (SELECT * FROM v_rules WHERE co >= 2 AND co >= 0.05 * n1 ORDER BY raw DESC, p1, p2 LIMIT 20) r
JOIN v_items a ON a.product_id = r.p1 JOIN v_items b ON b.product_id = r.p2""",
    "association_rules_strict": """
SELECT r.p1 AS antecedent_id, r.p2 AS consequent_id, a.product_name AS antecedent, b.product_name AS consequent,
  ((co * 2000 + users) // (2 * users)) / 1000.0 AS support, ((co * 2000 + n1) // (2 * n1)) / 1000.0 AS confidence,
  floor(raw * 100.0 + 0.5) / 100.0 AS lift, co AS co_count
FROM (SELECT * FROM v_rules WHERE co >= 3 AND co >= 0.1 * n1) r
JOIN v_items a ON a.product_id = r.p1 JOIN v_items b ON b.product_id = r.p2""",
    "sales_ma7": """
SELECT room_name, CAST(dt AS VARCHAR) AS dt, qty, CAST(gmv AS DOUBLE) AS gmv,
  ((sum(qty) OVER w * 20 + count(*) OVER w) // (2 * count(*) OVER w)) / 10.0 AS ma7
FROM v_daily WINDOW w AS (PARTITION BY room_name ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "sales_ma7_all_rooms": """
SELECT CAST(dt AS VARCHAR) AS dt, CAST(qty AS BIGINT) AS qty, CAST(gmv AS DOUBLE) AS gmv,
  ((sum(qty) OVER w * 20 + count(*) OVER w) // (2 * count(*) OVER w)) / 10.0 AS ma7
FROM (SELECT dt, sum(qty) AS qty, sum(gmv) AS gmv FROM v_daily GROUP BY dt) WINDOW w AS (ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "sales_forecast": "SELECT room_name, CAST(dt AS VARCHAR) AS dt, predicted_qty, predicted_gmv, ma7 FROM v_forecast",
    "sales_forecast_products": """
SELECT product_id, CAST(last_day + day AS VARCHAR) AS dt, floor(floor(greatest(0.0, slope * (n + day - 1) + intercept) * 1000000.0 + 0.5) / 1000000.0 + 0.5) AS predicted_qty,
  floor(floor(greatest(0.0, slope * (n + day - 1) + intercept) * (g / q) * 1000000.0 + 0.5) / 1000000.0 + 0.5) AS predicted_gmv, ma7
FROM (SELECT product_id, count(*) AS n, max(dt) AS last_day, sum(qty) AS q, CAST(sum(gmv) AS DOUBLE) AS g, regr_slope(qty, ix) AS slope,
    regr_intercept(qty, ix) AS intercept, (sum(qty) FILTER (back <= 7) * 20 + count(*) FILTER (back <= 7)) // (2 * count(*) FILTER (back <= 7)) / 10.0 AS ma7
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY dt) - 1 AS ix, row_number() OVER (PARTITION BY product_id ORDER BY dt DESC) AS back
    FROM (SELECT product_id, CAST(order_time AS DATE) AS dt, sum(quantity) AS qty, sum(total_amount) AS gmv FROM v_orders GROUP BY ALL))
  GROUP BY product_id HAVING count(*) >= 3), (SELECT CAST(unnest(range(1, 8)) AS INT) AS day)""",
    "sales_trend": """
SELECT room_name, history_days, CASE WHEN slope > 0.5 THEN '上升' WHEN slope < -0.5 THEN '下降' ELSE '平稳' END AS trend,
  floor(floor(slope * 1000000.0 + 0.5) / 1000000.0 * 100.0 + 0.5) / 100.0 AS slope, ma7 AS ma7_latest, CAST((qty_sum * 2 + history_days) // (2 * history_days) AS DOUBLE) AS avg_daily_qty FROM v_line""",
    "forecast_series": """
SELECT room_name, CAST(dt AS VARCHAR) AS dt, CAST(qty AS DOUBLE) AS qty,
  ((sum(qty) OVER w * 20 + count(*) OVER w) // (2 * count(*) OVER w)) / 10.0 AS ma7, 'history' AS part
FROM v_daily WINDOW w AS (PARTITION BY room_name ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
UNION ALL SELECT room_name, CAST(dt AS VARCHAR), predicted_qty, NULL, 'forecast' FROM v_forecast""",
    "ods_room_info": """
SELECT room_id, room_name, title, streamer, CAST(coalesce(online_n, 0) AS BIGINT) AS online, like_count, status, has_cart, has_commerce,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM v_live_metrics""",
    "ods_danmaku": """
SELECT room_id, room_name, username, text, msg_type, gift_name, CAST(gift_count AS BIGINT) AS gift_count,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM v_danmaku""",
    "ods_room_info_last_hour": f"""
SELECT room_id, room_name, title, streamer, CAST(coalesce(online_n, 0) AS BIGINT) AS online, like_count, status, has_cart, has_commerce,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM v_live_metrics WHERE created_at > {LAST_SAMPLE} - INTERVAL 60 MINUTE""",
    "ods_danmaku_last_hour": """
SELECT room_id, room_name, username, text, msg_type, gift_name, CAST(gift_count AS BIGINT) AS gift_count,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM v_danmaku WHERE created_at > (SELECT max(created_at) FROM v_danmaku) - INTERVAL 60 MINUTE""",
    "dwd_danmaku": "SELECT *, strftime(created_at, '%Y-%m-%d %H:%M:00') AS minute FROM v_danmaku",
    "dws_room_minute": """
SELECT strftime(moment, '%Y-%m-%d %H:%M:00') AS window_time, room_id, room_name, count(message) AS danmaku_cnt, CAST(coalesce(sum(gifts), 0) AS BIGINT) AS gift_cnt,
  CAST(coalesce(sum(online) // nullif(count(online), 0), 0) AS BIGINT) AS online_avg, coalesce(max(likes) - min(likes), 0) AS like_rate
FROM (SELECT date_trunc('minute', created_at) AS moment, room_id, room_name, 1 AS message, CASE WHEN msg_type = 'gift' THEN gift_count ELSE 0 END AS gifts,
    NULL AS online, NULL AS likes FROM v_danmaku
  UNION ALL SELECT date_trunc('minute', created_at), room_id, room_name, NULL, NULL, coalesce(online_n, 0), like_count FROM v_live_metrics) GROUP BY moment, room_id, room_name""",
    "dws_live_minute": """
SELECT strftime(moment, '%Y-%m-%d %H:%M:00') AS window_time, room_id, count(chat) AS danmaku_cnt, CAST(coalesce(sum(gift), 0) AS DOUBLE) AS gift_amount,
  CAST(coalesce(sum(sale), 0) AS DOUBLE) AS order_amount, count(sale) AS order_cnt, count(DISTINCT username) AS active_users,
  CAST(coalesce(sum(gift), 0) + coalesce(sum(sale), 0) AS DOUBLE) AS gmv
FROM (SELECT date_trunc('minute', created_at) AS moment, room_id, username, 1 AS chat, NULL AS gift, NULL AS sale FROM v_chats
  UNION ALL SELECT date_trunc('minute', created_at), room_id, username, NULL, amount, NULL FROM v_gifts
  UNION ALL SELECT date_trunc('minute', o.order_time), r.room_id, NULL, NULL, NULL, o.total_amount FROM v_orders o JOIN v_room r ON r.room_name = o.room_name)
GROUP BY moment, room_id""",
    "ads_user_segments": """
SELECT room_name, segment, count(*) AS user_count, '2024-01-31' AS dt FROM (SELECT room_name, CASE WHEN cnt >= 100 THEN '5-超级粉(100+)'
  WHEN cnt >= 50 THEN '4-铁杆粉(50-99)' WHEN cnt >= 10 THEN '3-忠实粉丝(10-49)' WHEN cnt >= 3 THEN '2-活跃观众(3-9)' ELSE '1-路人(1-2)' END AS segment
  FROM v_user_chats) GROUP BY ALL""",
    "ads_product_ranking": """
SELECT product_name, CAST(sum(quantity) AS BIGINT) AS total_qty, CAST(sum(total_amount) AS DOUBLE) AS total_amount FROM v_orders
GROUP BY product_name ORDER BY total_amount DESC, product_name""",
}

VIEWS["v_forecast"] = """
SELECT room_name, last_day + day AS dt, floor(floor(greatest(0.0, slope * (history_days + day - 1) + intercept) * 1000000.0 + 0.5) / 1000000.0 + 0.5) AS predicted_qty,
  floor(floor(greatest(0.0, slope * (history_days + day - 1) + intercept) * (gmv_sum / qty_sum) * 1000000.0 + 0.5) / 1000000.0 + 0.5) AS predicted_gmv, ma7
FROM v_line, (SELECT CAST(unnest(range(1, 8)) AS INT) AS day)"""


def _last_minutes(mins: int) -> str:
    return f"""
SELECT r.room_id, coalesce(m.online_avg, 0) AS online_avg, coalesce(m.online_max, 0) AS online_max, coalesce(m.online_min, 0) AS online_min,
  coalesce(m.like_rate, 0) AS like_rate, coalesce(m.records, 0) AS records, m.time
FROM v_room r LEFT JOIN (SELECT room_id, CAST(sum(n) // count(*) AS BIGINT) AS online_avg, max(n) AS online_max, min(n) AS online_min,
    greatest(max_by(like_count, id) - min_by(like_count, id), 0) AS like_rate, count(*) AS records,
    strftime(max_by(created_at, id), '%H:%M:%S') AS time
  FROM (SELECT *, CAST(coalesce(online_n, 0) AS BIGINT) AS n FROM v_live_metrics WHERE created_at > {LAST_SAMPLE} - INTERVAL {mins} MINUTE)
  GROUP BY room_id) m ON m.room_id = r.room_id"""


def _trend(mins: int) -> str:
    return f"""
SELECT room_id, created_at, strftime(created_at, '%H:%M') AS time, CAST(coalesce(online_n, 0) AS BIGINT) AS online, like_count AS likes,
  CASE WHEN before <> 0 AND created_at - at_before <= INTERVAL 180 SECOND THEN greatest(like_count - before, 0) ELSE 0 END AS like_rate
FROM (SELECT *, lag(like_count) OVER w AS before, lag(created_at) OVER w AS at_before FROM (
  SELECT *, row_number() OVER (PARTITION BY room_id ORDER BY created_at, id) - 1 AS ix, count(*) OVER (PARTITION BY room_id) AS n FROM (
    SELECT *, max(created_at) OVER (PARTITION BY room_id) AS newest, max(created_at) OVER () - INTERVAL {mins} MINUTE AS start FROM v_live_metrics)
  WHERE created_at > start OR newest <= start) WHERE ix % greatest(1, n // 80) = 0 WINDOW w AS (PARTITION BY room_id ORDER BY ix))"""


SQL["room_last_minute"] = _last_minutes(1)
SQL["room_last_day"] = _last_minutes(60 * 24)
SQL["online_trend"] = _trend(120)
SQL["online_trend_month"] = _trend(60 * 24 * 31)
# One room, one product, one category, and the newest chats only.
for _name in ("danmaku_recent", "funnel_full", "rfm_segments"):
    SQL[f"{_name}_room"] = f"SELECT * FROM ({SQL[_name]}) WHERE room_name = 'ASIA'"
SQL["product_sales_trend_one"] = f"SELECT * FROM ({SQL['product_sales_trend']}) WHERE product_id = 7"
SQL["product_list_category"] = SQL["product_list"].replace("ORDER BY sold", "WHERE category = 'MEDIUM' AND room_name = 'ASIA' ORDER BY sold")
SQL["keywords_latest"] = SQL["keywords_tfidf"]
SQL["rfm_segments_capped"] = SQL["rfm_segments"]
SQL["association_rules_capped"] = SQL["association_rules"]
SQL["cooccurrence_recs_room"] = SQL["cooccurrence_recs"]
SQL["association_rules_room"] = SQL["association_rules"]
SQL["tsv_round_trip"] = SQL["ods_danmaku"]
SQL["orc_overwrite"] = SQL["ods_room_info"]
SQL["ctas_product_ranking"] = SQL["ads_product_ranking"]
ASIA_ORDERS = VIEWS["v_orders"] + " WHERE r.room_name = 'ASIA'"
REPLACED: dict[str, dict[str, str]] = {
    "surge_alerts": {"v_width": "SELECT 60 AS width"},
    "stream_room_snapshot_idle": {"v_width": "SELECT 60 AS width"},
    "word_cloud_stop_words": {
        "v_lines": """
SELECT room_name, text || ' 觉得 直播 这个' AS text, count(*) AS times FROM v_chats WHERE text IS NOT NULL GROUP BY room_name, text"""
    },
    "cooccurrence_recs_room": {"v_orders": ASIA_ORDERS},
    "rfm_segments_capped": {"v_rfm_base": VIEWS["v_rfm_base"] + " QUALIFY row_number() OVER (PARTITION BY room_name ORDER BY frequency DESC, username) <= 40"},
    "association_rules_capped": {"v_pairs": VIEWS["v_pairs"] + " HAVING count(*) >= 2 ORDER BY co DESC, p1, p2 LIMIT 200"},
    "association_rules_room": {"v_orders": ASIA_ORDERS},
    "keywords_latest": {
        "v_lines": """
SELECT room_name, text, count(*) AS times FROM (SELECT * FROM v_chats WHERE text IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY room_name ORDER BY id DESC) <= 2000) WHERE length(text) >= 2 GROUP BY room_name, text"""
    },
}
for _name in ("danmaku_tumble_1m", "room_minute_agg", "online_alerts", "room_snapshot", "message_type_counts"):
    SQL[f"stream_{_name}"] = SQL[_name]
SQL["stream_room_snapshot_idle"] = """
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, room_id, last_value(room_name IGNORE NULLS) OVER w AS room_name,
  CAST(coalesce(last_value(online IGNORE NULLS) OVER w, 0) AS BIGINT) AS online_current,
  CAST(coalesce(last_value(average IGNORE NULLS) OVER w, 0) AS BIGINT) AS online_avg,
  coalesce(last_value(trend IGNORE NULLS) OVER w, 'stable') AS online_trend,
  CAST(coalesce(chats, 0) AS BIGINT) AS danmaku_rate, CAST(coalesce(gifts, 0) AS DOUBLE) AS gift_value,
  CAST(coalesce(chats * 4.50 + gifts, 0) AS DOUBLE) AS gmv_estimate, CAST(coalesce(sum(alerts) OVER w, 0) AS BIGINT) AS alert_count,
  chats IS NOT NULL AS active
FROM (SELECT room_id, unnest(generate_series(min(start), (SELECT max(start) FROM v_windows), to_minutes((SELECT width FROM v_width)))) AS start
  FROM v_windows GROUP BY room_id) LEFT JOIN v_windows USING (room_id, start)
WINDOW w AS (PARTITION BY room_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
SQL["ods_landed"] = f"""
SELECT *, CASE WHEN ts <= '2024-01-15T00:00:00.000000' THEN 0 WHEN ts <= '2024-01-22T00:00:00.000000' THEN 1 ELSE 2 END AS load_number FROM ({SQL['ods_danmaku']})"""
SQL["alert_messages"] = f"""
SELECT *, room_name || CASE alert_type WHEN 'online_drop' THEN ' 在线骤降: ' ELSE ' 在线暴涨: ' END || CAST(baseline AS BIGINT) || '→' || online AS message
FROM ({SQL['online_alerts']})"""
SQL["word_cloud_stop_words"] = SQL["word_cloud"]
SQL["recommendation_summaries"] = """
SELECT 'collaborative_filtering' AS method, count(DISTINCT product_id) AS total_products, count(DISTINCT customer_id) AS total_users,
  CAST(NULL AS BIGINT) AS total_rules FROM v_bought
UNION ALL SELECT 'association_rules', NULL, NULL, (SELECT count(*) FROM v_rules WHERE co >= 2 AND co >= 0.05 * n1)"""
SQL["ods_gifts"] = """
SELECT d.room_id, CAST(d.user_id AS BIGINT) AS uid, d.username, d.gift_name, CAST(d.gift_count AS INT) AS gift_count,
  CAST(coalesce(p.price, 1) AS DOUBLE) AS price, strftime(d.created_at, '%Y-%m-%dT%H:%M:%S.%f') AS ts
FROM v_danmaku d LEFT JOIN v_prices p ON p.gift_name = d.gift_name WHERE d.msg_type = 'gift'"""
SQL["ods_orders"] = """
SELECT r.room_id, o.product_name, (2 * CAST(o.total_amount * 100 AS BIGINT) + o.quantity) // (2 * o.quantity) / 100.0 AS price, o.quantity,
  CAST(replace(o.customer_id, 'USER_', '') AS BIGINT) AS user_id, strftime(o.order_time, '%Y-%m-%dT%H:%M:%S.%f') AS ts
FROM v_orders o JOIN v_room r ON r.room_name = o.room_name"""
SQL["active_users_sketch"] = """
SELECT unit, room_name, start, users, true AS near FROM (
  SELECT 'hour' AS unit, room_name, date_trunc('hour', created_at) AS start, count(DISTINCT username) AS users FROM v_danmaku GROUP BY ALL
  UNION ALL SELECT 'day', room_name, date_trunc('day', created_at), count(DISTINCT username) FROM v_danmaku GROUP BY ALL) WHERE users > 0"""
SQL["rfm_medians_sketch"] = "SELECT room_name, r_med / 10.0 AS r_median, f_med AS f_median, true AS r_near, true AS f_near FROM v_rfm_medians"
SQL["route_params"] = """
SELECT room_id, param, count(*) AS uses, count(DISTINCT setting) AS settings, max_by(setting, id) AS setting, max(id) AS last_id FROM (
  SELECT event_id AS id, e.room_id, 'cursor' AS param, 'c' || event_id AS setting FROM v_events_x e JOIN v_room r ON r.room_id = e.room_id
  UNION ALL SELECT event_id, e.room_id, 'region', 'zone-' || (k % 4) FROM v_events_x e JOIN v_room r ON r.room_id = e.room_id WHERE k % 3 = 0
  UNION ALL SELECT event_id, e.room_id, 'host', 'push-' || (k % 7) FROM v_events_x e JOIN v_room r ON r.room_id = e.room_id WHERE k % 5 = 0)
GROUP BY room_id, param"""
SQL["evolved_metrics"] = """
SELECT id, room_id, like_count, created_at, CASE WHEN id % 3 > 0 THEN cart_total END AS cart_total,
  CASE WHEN id % 3 = 2 THEN has_cart END AS has_cart, CASE WHEN id % 3 = 2 THEN status END AS status FROM v_live_metrics"""
SQL["published_round_trip"] = SQL["published_messages"]
SQL["user_texts"] = """
SELECT room_name, username, piece, min(id) AS first_id, max(id) AS last_id, count(*) AS chats,
  md5(string_agg(text, chr(10) ORDER BY id)) AS texts_md5, CAST(length(string_agg(text, chr(10) ORDER BY id)) AS INT) AS n_chars
FROM (SELECT *, (row_number() OVER (PARTITION BY room_name, username ORDER BY id) - 1) // 3 AS piece FROM v_chats WHERE text IS NOT NULL)
GROUP BY room_name, username, piece"""
SQL["stream_gift_value"] = """
SELECT strftime(time_bucket(INTERVAL 1 MINUTE, created_at), '%Y-%m-%d %H:%M:%S') AS window_start, room_id,
  CAST(sum(gift_count) AS BIGINT) AS gift_count, CAST(sum(amount) AS DOUBLE) AS gift_value FROM v_gifts GROUP BY ALL"""
SQL["stream_late_rows"] = """
SELECT room_id, count(*) AS arrived, count(*) FILTER (NOT late) AS counted, count(*) FILTER (late) AS late,
  CAST(max(epoch_us(mark) - epoch_us(created_at)) FILTER (late) AS DOUBLE) / 1000000 AS max_late_seconds
FROM (SELECT c.*, mark, coalesce(time_bucket(INTERVAL 1 MINUTE, c.created_at) + INTERVAL 1 MINUTE <= mark, false) AS late
  FROM v_chats c LEFT JOIN (SELECT arrival + 1 AS arrival, max(max(created_at)) OVER (ORDER BY arrival) - INTERVAL 5 SECOND AS mark
    FROM (SELECT *, id % 4 AS arrival FROM v_chats) GROUP BY arrival) m ON m.arrival = c.id % 4) GROUP BY room_id"""
SQL["stream_ingest"] = """
SELECT topic, count(*) AS arrived, count(*) FILTER (id % 50 <> 0) AS stored, count(*) FILTER (id % 50 = 0) AS quarantined FROM (
  SELECT CASE msg_type WHEN 'chat' THEN 'live_danmaku' ELSE 'live_gifts' END AS topic, id FROM v_danmaku
  UNION ALL SELECT 'live_room_info', id FROM v_live_metrics UNION ALL SELECT 'live_room_info', id FROM v_room_stats) GROUP BY topic"""


def _needed(text: str, views: dict[str, str]) -> list[str]:
    """Names of the views a text uses, each after the ones it builds on."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bv_\w+", body)):
            if name not in order:
                visit(views[name])
                order.append(name)

    visit(text)
    return order


def with_views(text: str, **replaced: str) -> str:
    views = {**VIEWS, **replaced}
    ctes = ",\n".join(f"{name} AS ({views[name].strip()})" for name in _needed(text, views))
    return f"WITH {ctes}\n{text.strip()}" if ctes else text.strip()


def oracle() -> dict[str, str]:
    return {name: with_views(text, **REPLACED.get(name, {})) for name, text in SQL.items()}
