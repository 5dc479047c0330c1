"""Per-vehicle state for the stream (T6), self-contained so it can be pickled by value."""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_SCHEMA = T.StructType([
    T.StructField("voltage", T.DoubleType()),
    T.StructField("soc", T.DoubleType()),
    T.StructField("micros", T.LongType()),
])


class PreviousWindowProcessor(StatefulProcessor):
    """Previous voltage/SOC per vehicle across micro-batches.

    ``first_row="null"`` leaves the first window's previous values NULL (the
    batch definition); ``"current"`` uses the window itself with zero change
    (the reference stream's behaviour). Windows not newer than the stored one
    are ignored for the state (monotone state), but still emitted. A vehicle's
    windows of one micro-batch are sorted together; the source's intake bound
    (``max_offsets_per_trigger``, ``max_files_per_trigger``) limits them. Times
    are compared as ``micros`` since the epoch: pandas shows instants in the
    session's zone, whose clock may run twice through an hour.

    With ``ttl_ms`` a previous window that started more than ``ttl_ms`` before
    counts as none, whichever micro-batches the two came in, and a vehicle's
    state is deleted by an event-time timer once the watermark passes the end of
    its last window (start + ``window_ms``) by ``ttl_ms``: no window that could
    still use it can come after that.
    """

    def __init__(self, first_row: str, columns: list[str], ttl_ms: int | None = None, window_ms: int = 0):
        if first_row not in ("null", "current"):
            raise ValueError("first_row must be 'null' or 'current'")
        self.first_row = first_row
        self.columns = list(columns)
        self.ttl_ms = ttl_ms
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE_SCHEMA)

    def _expiry(self, micros: int) -> int:
        return micros // 1000 + self.window_ms + self.ttl_ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("micros", kind="stable")
        v = pdf["hv_battery_voltage"].astype("float64")
        s = pdf["hv_soc"].astype("float64")
        prev_v, prev_s, micros = v.shift(1), s.shift(1), pdf["micros"].astype("int64")
        prev_t = micros.shift(1, fill_value=micros.iloc[0])
        last_t = None
        if self.last.exists():
            lv, ls, last_t = self.last.get()
            prev_v.iloc[0], prev_s.iloc[0], prev_t.iloc[0] = lv, ls, last_t
        if self.ttl_ms is not None:
            fresh = (micros - prev_t) <= 1000 * self.ttl_ms
            prev_v, prev_s = prev_v.where(fresh), prev_s.where(fresh)
        if self.first_row == "current":
            prev_v, prev_s = prev_v.fillna(v), prev_s.fillna(s)
        pdf["voltage_per_soc"] = v / s.where(s > 0)
        pdf["previous_voltage"] = prev_v
        pdf["previous_soc"] = prev_s
        pdf["voltage_change"] = v - prev_v
        pdf["soc_change"] = s - prev_s
        newest = int(micros.iloc[-1])
        if last_t is None or newest > last_t:
            self.last.update((float(v.iloc[-1]), float(s.iloc[-1]), newest))
            if self.ttl_ms is not None:
                if last_t is not None:
                    self.handle.deleteTimer(self._expiry(last_t))
                self.handle.registerTimer(self._expiry(newest))
        yield pdf[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The watermark passed the vehicle's last window by ``ttl_ms``: forget the vehicle."""
        if self.last.exists() and self._expiry(self.last.get()[2]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter([])

    def close(self) -> None:
        pass
