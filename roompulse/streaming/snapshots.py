"""Room snapshots with per-room state: list state for what waits, and event-time timers that close windows.

A timer fires for a room whether or not it has new input, so a silent room is reported on as well.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roompulse.operators.windows import BASELINE_ABOVE, BASKET_VALUE, BUYERS_PER_CHAT, DROP_PCT, HISTORY, MIN_HISTORY, SPIKE_PCT

SNAPSHOT_SCHEMA = (
    "window_start string, room_id string, room_name string, online_current bigint, online_avg bigint, online_trend string, "
    "danmaku_rate bigint, gift_value double, gmv_estimate double, alert_count bigint, active boolean"
)
#: Revenue estimate of one chat, in hundredths.
CENTS_PER_CHAT = round(100 * float(BUYERS_PER_CHAT) * float(BASKET_VALUE))
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RoomSnapshots(StatefulProcessor):
    """Figures of a room at the end of each window of ``width`` seconds.

    Signals wait in the state until the watermark passes the end of their window; chats and gifts wait as sums.  Both
    wait in arrays, an entry for each frame, as every entry of the state costs a call.  What goes on for good is the nine
    samples before the next one, the last sample's figures and the number of alerts.
    """

    def __init__(self, width: int, idle: bool):
        self.width, self.idle = width, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getListState("samples", "at array<bigint>, id array<bigint>, online array<bigint>")
        self.sums = handle.getListState("sums", "start array<bigint>, chats array<bigint>, cents array<bigint>, name array<string>")
        self.room = handle.getValueState(
            "room", "recent array<bigint>, online bigint, average bigint, trend string, alerts bigint, name string, next bigint"
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            at = frame["event_time"].to_numpy("datetime64[us]").astype(np.int64)
            seen = (frame["kind"] == "sample").to_numpy()
            if seen.any():
                self.samples.appendValue((at[seen].tolist(), frame["id"][seen].tolist(), frame["online"][seen].astype("int64").tolist()))
            start = at // (self.width * 1_000_000) * self.width
            told = pd.DataFrame({"start": start, "chats": (frame["kind"] == "chat").to_numpy(np.int64), "cents": frame["cents"].fillna(0).to_numpy(np.int64), "name": frame["room_name"]})
            sums = told.groupby("start").agg({"chats": "sum", "cents": "sum", "name": "max"}).reset_index()
            self.sums.appendValue(tuple(sums[c].tolist() for c in sums.columns))
            self.handle.registerTimer((int(start.min()) + self.width) * 1000)
        yield from ()

    @staticmethod
    def _waiting(state) -> list[tuple]:
        return [row for entry in state.get() for row in zip(*entry)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() // 1000 // self.width * self.width
        recent, online, average, trend, alerts, name, following = self.room.get() or ([], 0, 0, "stable", 0, "", None)
        sums = pd.DataFrame(self._waiting(self.sums), columns=["start", "chats", "cents", "name"])
        due = sums[sums["start"] < closed].groupby("start").agg({"chats": "sum", "cents": "sum", "name": "max"}).sort_index()
        starts = due.index.to_numpy(np.int64)
        if self.idle and (following is not None or len(starts)):
            starts = np.arange(starts[0] if following is None else following, closed, self.width)
        if not len(starts):
            return
        waiting = np.array(self._waiting(self.samples), np.int64).reshape(-1, 3)
        passed = waiting[waiting[:, 0] < closed * 1_000_000]
        passed = passed[np.lexsort((passed[:, 1], passed[:, 0]))]

        values = np.concatenate([np.array(recent, np.int64), passed[:, 2]])
        totals = np.concatenate([[0], np.cumsum(values)])
        place = np.arange(len(recent), len(values))
        since = np.maximum(place - HISTORY, 0)
        n, total, current = place - since, totals[place] - totals[since], values[place]
        judged = (n >= MIN_HISTORY) & (total > n * BASELINE_ABOVE)
        odd = judged & ((current * n * 100 < total * (100 - DROP_PCT)) | (current * n * 100 > total * (100 + SPIKE_PCT)))
        averages = (2 * (total + current) + n + 1) // (2 * (n + 1))
        before = values[np.maximum(place - 1, 0)]
        trends = np.where(place == 0, "stable", np.where(current > before, "up", "down"))

        # What held before the first of these samples stands in front; each window then looks up its last sample.
        last = np.searchsorted(passed[:, 0], (starts + self.width) * 1_000_000, "left")
        own = {
            "online": np.concatenate([[online], current]),
            "average": np.concatenate([[average], averages]),
            "trend": np.concatenate([[trend], trends.astype(object)]),
            "alerts": alerts + np.concatenate([[0], np.cumsum(odd)]),
        }
        held = due.reindex(starts)
        names = held["name"].ffill().fillna(name)
        chats, cents = held["chats"].fillna(0).to_numpy(np.int64), held["cents"].fillna(0).to_numpy(np.int64)
        yield pd.DataFrame(
            {
                "window_start": pd.to_datetime(starts, unit="s").strftime("%Y-%m-%d %H:%M:%S"),
                "room_id": key[0],
                "room_name": names.to_numpy(),
                "online_current": own["online"][last],
                "online_avg": own["average"][last],
                "online_trend": own["trend"][last],
                "danmaku_rate": chats,
                "gift_value": cents / 100.0,
                "gmv_estimate": (chats * CENTS_PER_CHAT + cents) / 100.0,
                "alert_count": own["alerts"][last],
                "active": held["chats"].notna().to_numpy(),
            }
        )

        self.room.update(
            (values[-HISTORY:].tolist(), int(own["online"][-1]), int(own["average"][-1]), str(own["trend"][-1]), int(own["alerts"][-1]), str(names.iloc[-1]), int(closed))
        )
        later, left = sums[sums["start"] >= closed], waiting[waiting[:, 0] >= closed * 1_000_000]
        for state, columns in ((self.sums, [later[c].tolist() for c in later.columns]), (self.samples, left.T.tolist())):
            if columns[0]:
                state.put([tuple(columns)])
            else:
                state.clear()
        if len(later):
            self.handle.registerTimer((int(later["start"].min()) + self.width) * 1000)
        if self.idle:
            self.handle.registerTimer((int(closed) + self.width) * 1000)


def snapshot_stream(signals: DataFrame, minutes: int = 1, late: str = "5 seconds", idle: bool = False) -> DataFrame:
    """Snapshots from a stream of signals (room, name, id, event time, kind, online, value in hundredths).

    ``idle`` adds the windows in which a room had no signal; ``active`` tells them apart.
    """
    narrow = signals.select("room_id", "room_name", "id", "event_time", "kind", "online", "cents").withWatermark("event_time", late)
    readable = narrow.filter("kind <> 'sample' OR online IS NOT NULL")
    return readable.groupBy("room_id").transformWithStateInPandas(RoomSnapshots(60 * minutes, idle), SNAPSHOT_SCHEMA, "Append", "EventTime")


def with_timers(spark: SparkSession, start):
    """Starts a query whose state needs timers: they are kept in the state store that has column families."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        return start()
    finally:
        spark.conf.set(STATE_STORE, before)


# Executors get the processor itself, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
