"""Per-vehicle reporting tables.

These are the data behind a dashboard: every one is a DataFrame query; none
pulls rows to the driver. Per-vehicle aggregates use partial aggregation, so
a vehicle with a third of all rows is combined map-side before the exchange.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic import config

# --- fixed values: display names of the proxy label ---
LABEL_NAMES = {0: "Normal proxy label", 1: "Elevated-risk proxy label"}
TEMPERATURE_COLUMNS = ["hv_temp_min", "hv_temp_max", "battery_temp_avg"]
RECENT_COLUMNS = ["time", "vehicle_id", "vehicle_speed", "ambient_air_temp", "hv_soc",
                  "hv_battery_voltage", "hv_temp_min", "hv_temp_max"]


def present_columns(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """which candidate columns exist and hold at least one non-NULL value.

    Presence comes from the schema; data presence from one ``count(col)``
    aggregate over the existing candidates. Output ``(column, non_null)``.
    """
    existing = [c for c in candidates if c in df.columns]
    if not existing:
        return df.sparkSession.createDataFrame([], "column string, non_null long")
    wide = df.agg(*[F.count(c).alias(c) for c in existing])
    return wide.unpivot([], existing, "column", "non_null").filter(F.col("non_null") > 0)


def fill_missing(df: DataFrame, cols: Sequence[str] = config.STREAM_FILL_COLUMNS, value: float = 0.0) -> DataFrame:
    """NULL (and NaN) -> ``value`` on the named columns."""
    return df.fillna(value, subset=list(cols))


def vehicle_slice(df: DataFrame, vehicle: str, start: str | dt.date | None = None,
                  end: str | dt.date | None = None, time_col: str = "time") -> DataFrame:
    """One vehicle, inclusive date range on a timestamp.

    ``time >= start AND time < end + 1 day`` equals comparing ``to_date(time)``
    but stays pushable to Parquet. Without a range the whole vehicle is kept
    (the default range is its own first to last date).
    """
    out = df.filter(F.col("vehicle_id") == F.lit(vehicle))
    if start is not None:
        out = out.filter(F.col(time_col) >= F.to_timestamp_ntz(F.lit(str(start))))
    if end is not None:
        end_next = (dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)).isoformat()
        out = out.filter(F.col(time_col) < F.to_timestamp_ntz(F.lit(end_next)))
    return out


def vehicle_dates(df: DataFrame, time_col: str = "time") -> DataFrame:
    """First and last date per vehicle (the default slice range)."""
    return df.groupBy("vehicle_id").agg(F.to_date(F.min(time_col)).alias("first_date"),
                                        F.to_date(F.max(time_col)).alias("last_date"))


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """lenient numeric parse (``try_cast`` to double); bad text -> NULL."""
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def latest_reading(df: DataFrame, cols: Sequence[str] = ("hv_battery_voltage", "hv_soc"),
                   time_col: str = "time", unique_time: bool = False) -> DataFrame:
    """The last row per vehicle by time (``max_by``, a partial aggregate).

    With ``unique_time`` (one row per vehicle and time, as in window tables)
    each column takes its own ``max_by``, which Spark hash-aggregates; otherwise
    one ``max_by`` of a struct keeps the columns of a single row even on ties.
    """
    if unique_time:
        return df.groupBy("vehicle_id").agg(
            F.max(time_col).alias(time_col), *[F.max_by(c, time_col).alias(c) for c in cols])
    packed = F.max_by(F.struct(F.col(time_col).alias(time_col), *[F.col(c) for c in cols]), F.col(time_col))
    return df.groupBy("vehicle_id").agg(packed.alias("_l")).select(
        "vehicle_id", *[F.col(f"_l.{c}").alias(c) for c in (time_col, *cols)])


def vehicle_kpis(df: DataFrame) -> DataFrame:
    """Mean speed, mean ambient temperature and window count per vehicle."""
    return df.groupBy("vehicle_id").agg(
        F.avg("vehicle_speed").alias("avg_speed"),
        F.avg("ambient_air_temp").alias("avg_ambient_temp"),
        F.count(F.lit(1)).alias("windows"),
    )


def vehicle_risk(df: DataFrame, label: str = config.LABEL) -> DataFrame:
    """Risk windows and their share (percent of non-NULL labels) per vehicle."""
    n = F.count(label)
    risk = F.count_if(F.col(label) == 1)
    return df.groupBy("vehicle_id").agg(
        risk.alias("risk_count"),
        n.alias("labelled"),
        F.when(n > 0, 100.0 * risk / n).alias("risk_percentage"),
    )


def label_names(df: DataFrame, label: str = config.LABEL) -> DataFrame:
    """Named label distribution, most frequent first (tiebreak by name)."""
    expr = None
    for k, v in LABEL_NAMES.items():
        expr = F.when(F.col(label) == k, F.lit(v)) if expr is None else expr.when(F.col(label) == k, F.lit(v))
    return (df.filter(F.col(label).isNotNull()).groupBy(expr.alias("label"))
            .agg(F.count(F.lit(1)).alias("windows")).orderBy(F.desc("windows"), "label"))


def unpivot_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "signal",
                 value: str = "value") -> DataFrame:
    """Wide -> long (``unpivot``); NULL values are kept as rows like ``melt``."""
    return df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(
        list(ids), list(values), name, value)


def recent_rows(df: DataFrame, n: int = 100, cols: Sequence[str] = RECENT_COLUMNS,
                time_col: str = "time", tiebreak: Sequence[str] = ("vehicle_id",)) -> DataFrame:
    """The ``n`` most recent rows (top-k, planned as TakeOrderedAndProject)."""
    keep = [c for c in cols if c in df.columns]
    return df.select(*keep).orderBy(F.desc(time_col), *tiebreak).limit(n)


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """K8: an ordered preview (``show`` as a testable DataFrame)."""
    return df.orderBy(*order).limit(n)


def change_scatter(df: DataFrame, label: str = config.LABEL) -> DataFrame:
    """The change pairs behind the scatter, per vehicle and label."""
    return df.select("vehicle_id", "time", "soc_change", "voltage_change", F.col(label))


def change_bins(df: DataFrame, soc_step: float = 1.0, volt_step: float = 5.0, label: str = config.LABEL) -> DataFrame:
    """M16 at scale: a binned 2-D count of (SOC change, voltage change) by label."""
    return df.groupBy(
        F.col(label),
        (F.floor(F.col("soc_change") / soc_step) * soc_step).alias("soc_bin"),
        (F.floor(F.col("voltage_change") / volt_step) * volt_step).alias("voltage_bin"),
    ).agg(F.count(F.lit(1)).alias("count"))
