"""Tumbling event-time windows that pivot long readings into one wide row.

The same function serves batch and streaming: it only uses ``groupBy`` +
``F.window`` + ``avg(CASE ...)``, which Spark plans as a partial aggregate
before the exchange (map-side combine) and which Structured Streaming accepts
with a watermark. ``.pivot`` is avoided on purpose: it is not allowed on
streams and needs the value list anyway.

Scale: the grouping key is ``(vehicle_id, window)``, so even a vehicle that
holds a third of all readings spreads over as many groups as it has windows;
a group holds one window's readings, bounded by the sensor rate.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic import config
from voltaic.functions.exprs import in_band


def window_pivot(
    readings: DataFrame,
    signals: Mapping[int, str] = config.SIGNALS_WIDE,
    window: str = config.WINDOW,
    *,
    time_col: str = "time",
    key: str = "vehicle_id",
    with_end: bool = True,
    start_time: str | None = None,
) -> DataFrame:
    """A1/A2: ``avg(value)`` per signal code per ``(key, tumbling window)``.

    A signal with no reading in the window is NULL (never 0). Rows with a NULL
    time, code or key-less rows still group (NULL key) exactly like Spark's
    ``groupBy``; rows with NULL time drop out of ``window`` silently.
    """
    codes = list(signals)
    win = F.window(time_col, window) if start_time is None else F.window(time_col, window, window, start_time)
    aggs = [F.avg(F.when(F.col("value_id") == F.lit(code), F.col("value"))).alias(name)
            for code, name in signals.items()]
    grouped = (
        readings.filter(F.col("value_id").isin(codes))
        .groupBy(F.col(key), win.alias("time_window"))
        .agg(*aggs)
    )
    cols = [F.col(key), F.col("time_window.start").alias("time")]
    if with_end:
        cols.append(F.col("time_window.end").alias("window_end"))
    return grouped.select(*cols, *[F.col(n) for n in signals.values()])


def temperature_columns(df: DataFrame) -> DataFrame:
    """Mean and spread of min/max battery temperature plus availability flag."""
    tmin, tmax = F.col("hv_temp_min"), F.col("hv_temp_max")
    return (
        df.withColumn("battery_temp_avg", (tmin + tmax) / 2)
        .withColumn("battery_temp_delta", tmax - tmin)
        .withColumn("temperature_available",
                    F.when(tmin.isNotNull() & tmax.isNotNull(), F.lit(1)).otherwise(F.lit(0)))
    )


def window_wide(readings: DataFrame, window: str = config.WINDOW, **kw) -> DataFrame:
    """The processed window table: seven signals, temperature columns, and
    only windows with both SOC and voltage (F6)."""
    out = temperature_columns(window_pivot(readings, config.SIGNALS_WIDE, window, **kw))
    return out.filter(F.col("hv_soc").isNotNull() & F.col("hv_battery_voltage").isNotNull())


def window_pivot_ml(readings: DataFrame, window: str = config.WINDOW, **kw) -> DataFrame:
    """A2: five signals, start time only."""
    kw.setdefault("with_end", False)
    return window_pivot(readings, config.SIGNALS_ML, window, **kw)


def valid_band(df: DataFrame, col: str = "hv_battery_voltage",
               band: tuple[float, float] = config.VOLTAGE_BAND) -> DataFrame:
    """inclusive band filter; NULL and NaN drop."""
    return df.filter(in_band(col, *band))
