"""Tables dealt out by range, with an index of each file's smallest and largest keys.

A dashboard asks for one vehicle and a few days (F15, F16). In a table as
written by a job, every file may hold them. ``write_clustered`` deals the rows
out by ranges of ``(vehicle, time)`` and sorts each file, so a slice lies in
few files, and writes an index table - one row per file, made by Spark from the
files themselves. ``read_slice`` picks the files by that index and scans only
those; within them, row groups are skipped by Parquet's own minima and maxima.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.functions.exprs import lit_for

INDEX = "_file_index"


def write_clustered(df: DataFrame, path: str, *, keys: Sequence[str] = ("vehicle_id", "time"), files: int = 64) -> str:
    """K1: overwrite a Parquet table of about ``files`` files, each a range of ``keys``, with its index.

    A hot vehicle's rows are split between files by its further keys. Rows whose
    keys are NULL are kept; they come first. Choose ``files`` for 256 MB to 1 GB each.
    """
    dealt = df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    dealt.write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    # Minima and maxima per file, as one aggregate over the key columns only.
    stats = [f(c).alias(f"{n}_{c}") for c in keys for n, f in (("min", F.min), ("max", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in keys]
    index = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *stats, *nulls)
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}{INDEX}")
    return path


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """``file, rows`` and for each key ``min_, max_, nulls_``."""
    return spark.read.parquet(f"{path}{INDEX}")


def may_hold(index: DataFrame, key: str, low=None, high=None) -> Column:
    """Whether a file may hold rows with ``low <= key <= high`` (None: open)."""
    found = F.lit(True)
    if low is not None:
        found &= F.col(f"max_{key}") >= lit_for(index, f"max_{key}", low)
    if high is not None:
        found &= F.col(f"min_{key}") <= lit_for(index, f"min_{key}", high)
    return F.coalesce(found, F.lit(False))


def read_slice(
    spark: SparkSession, path: str, *, vehicle: str | None = None, start: dt.date | str | None = None,
    end: dt.date | str | None = None, vehicle_col: str = "vehicle_id", time_col: str = "time",
) -> DataFrame:
    """Rows of a vehicle between two days (both included; None: all), from the files that may hold them.

    The names of those files pass the driver; Spark's file index holds them anyway.
    """
    index = file_index(spark, path)
    first = None if start is None else dt.datetime.combine(dt.date.fromisoformat(str(start)), dt.time())
    last = None if end is None else dt.datetime.combine(dt.date.fromisoformat(str(end)), dt.time()) + dt.timedelta(days=1)
    wanted = index.filter(may_hold(index, vehicle_col, vehicle, vehicle) & may_hold(index, time_col, first, last))
    files = [r["file"] for r in wanted.select("file").collect()]
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    if vehicle is not None:
        rows = rows.filter(F.col(vehicle_col) == vehicle)
    if first is not None:
        rows = rows.filter(F.col(time_col) >= lit_for(rows, time_col, first))
    if last is not None:
        rows = rows.filter(F.col(time_col) < lit_for(rows, time_col, last))
    return rows
