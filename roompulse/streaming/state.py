"""Audience alerts with per-room state: the last samples survive micro-batches and restarts."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roompulse.operators.windows import BASELINE_ABOVE, DROP, DROP_PCT, HISTORY, MIN_HISTORY, SPIKE, SPIKE_PCT

ALERT_SCHEMA = (
    "room_id string, room_name string, id bigint, event_time timestamp, alert_type string, severity string, "
    "online bigint, baseline double"
)
STATE_SCHEMA = (
    "recent array<bigint>, times array<bigint>, ids array<bigint>, onlines array<bigint>, names array<string>"
)
COLUMNS = ["event_time", "id", "online", "room_name"]


def _alerts(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Samples that the watermark has passed, in time order, against the sums of the (up to) nine before each.

    Later samples wait in the state, so neither the order of arrival nor the cut
    into micro-batches changes an alert.
    """
    recent, waiting = [], []
    if state.exists:
        recent, *held = state.get
        waiting.append(pd.DataFrame({"event_time": pd.to_datetime(list(held[0]), unit="us"), "id": held[1], "online": held[2], "room_name": held[3]}))
    if not state.hasTimedOut:
        waiting += [f[COLUMNS][f["online"].notna()] for f in frames]
    waiting = [f for f in waiting if len(f)]
    rows = pd.concat(waiting).sort_values(["event_time", "id"], kind="stable") if waiting else pd.DataFrame(columns=COLUMNS)
    micros = rows["event_time"].to_numpy("datetime64[us]").astype(np.int64)
    passed = micros <= state.getCurrentWatermarkMs() * 1000
    later, rows = rows[~passed], rows[passed]

    recent = np.array(recent, dtype=np.int64)
    values = np.concatenate([recent, rows["online"].to_numpy(dtype=np.int64)])
    left = micros[~passed]
    state.update((values[-HISTORY:].tolist(), left.tolist(), later["id"].astype("int64").tolist(), later["online"].astype("int64").tolist(), later["room_name"].tolist()))
    if len(left):
        state.setTimeoutTimestamp(max(int(left[0]) // 1000, state.getCurrentWatermarkMs() + 1))

    sums = np.concatenate([[0], np.cumsum(values)])
    at = np.arange(len(recent), len(values))
    since = np.maximum(at - HISTORY, 0)
    n, total, current = at - since, sums[at] - sums[since], values[at]
    judged = (n >= MIN_HISTORY) & (total > n * BASELINE_ABOVE)
    drop = judged & (current * n * 100 < total * (100 - DROP_PCT))
    spike = judged & (current * n * 100 > total * (100 + SPIKE_PCT))
    found = drop | spike
    if found.any():
        yield pd.DataFrame(
            {
                "room_id": key[0],
                "room_name": rows["room_name"].to_numpy()[found],
                "id": rows["id"].to_numpy(dtype=np.int64)[found],
                "event_time": rows["event_time"].to_numpy("datetime64[us]")[found],
                "alert_type": np.where(drop[found], DROP[0], SPIKE[0]),
                "severity": np.where(drop[found], DROP[1], SPIKE[1]),
                "online": current[found],
                "baseline": np.floor((2 * total[found] + n[found]) / (2 * n[found])),
            }
        )


def alert_stream(samples: DataFrame, late: str = "5 seconds") -> DataFrame:
    """Alerts once the watermark has passed a sample.

    Only samples reach the state function, so a busy chat does not load it; a
    room's state is nine numbers and the samples of the last ``late``.
    """
    narrow = samples.select("room_id", "room_name", "id", "event_time", "online").withWatermark("event_time", late)
    return narrow.groupBy("room_id").applyInPandasWithState(
        _alerts, ALERT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout
    )


# Executors get the state function itself, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
