"""Window tables kept up to date from a folder of readings that grows by deliveries.

A manifest - a small table beside the output - says which files of the input
are already in the windows and which days of windows each of them touches. An
update lists the input, finds the files that are new, changed or gone since,
recomputes the windows of the days they touch from all readings of those days,
and replaces just these days' partitions (dynamic partition overwrite). Files of
other days are not opened for writing.

An update can be repeated or killed at any point: the windows of a day are
always made from the readings there are, never added to, and the manifest is
written last. Until it is, the next update does the same days again.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic import config
from voltaic.operators.features import duration_seconds
from voltaic.operators.windows import window_wide
from voltaic.sources.files import list_files

#: The partition column of the output: the day in which a window starts.
DAY = "window_day"
MANIFEST = "path string, length long, modified timestamp, days array<date>, version string, seen timestamp"


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of every file the manifest knows; ``days`` NULL marks a file that is gone."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(MANIFEST).parquet(path)
        rows.limit(1).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], MANIFEST)
    newest = rows.groupBy("path").agg(F.max_by(F.struct("length", "modified", "days"), "seen").alias("last"))
    return newest.select("path", "last.*").filter(F.col("days").isNotNull())


def pending_files(spark: SparkSession, source: str, manifest: str) -> DataFrame:
    """Files that an update has to look at: ``path, length, modified, change`` (new, changed, gone), ``old_days``."""
    now = list_files(spark, source, "*.parquet")
    known = _manifest(spark, manifest).withColumnsRenamed({"length": "old_length", "modified": "old_modified", "days": "old_days"})
    both = now.join(known, "path", "full")
    change = (F.when(F.col("old_length").isNull(), "new").when(F.col("length").isNull(), "gone")
              .when((F.col("length") != F.col("old_length")) | (F.col("modified") != F.col("old_modified")), "changed"))
    return both.withColumn("change", change).filter("change IS NOT NULL").select(
        "path", "length", "modified", "change", F.coalesce("old_days", F.array().cast("array<date>")).alias("old_days"))


def window_day(time: Column, window: str) -> Column:
    """The day in which the window of a time starts."""
    return F.window(time, window).start.cast("date")


def update_windows(
    spark: SparkSession,
    source: str,
    target: str,
    manifest: str,
    *,
    window: str = config.WINDOW,
    time_col: str = "time",
    build: Callable[[DataFrame, str], DataFrame] = window_wide,
) -> dict[str, int]:
    """K1/K5/A1: bring the window table at ``target`` up to date with the readings at ``source``.

    ``build(readings, window)`` makes the windows (default ``window_wide``; its
    result has a row per vehicle and ``time``, the window's start). The table is
    partitioned by ``window_day``. Returns the numbers of files by change and of
    days rewritten. Names of the pending files and the touched days pass the
    driver: the size of a delivery, not of the table.
    """
    pending = pending_files(spark, source, manifest).collect()
    counts = {k: sum(r["change"] == k for r in pending) for k in ("new", "changed", "gone")}
    if not pending:
        return counts | {"days": 0}
    fresh = [r for r in pending if r["change"] != "gone"]
    days_of: dict[str, list] = {}
    if fresh:
        readings = spark.read.option("recursiveFileLookup", "true").parquet(*[r["path"] for r in fresh])
        day = window_day(F.col(time_col), window)
        held = readings.select(F.col("_metadata.file_path").alias("path"), day.alias("day")).distinct()
        for r in held.groupBy("path").agg(F.collect_set("day").alias("days")).collect():
            days_of[_plain(r["path"])] = r["days"]
    touched = sorted({d for r in pending for d in r["old_days"]} | {d for days in days_of.values() for d in days})

    if touched:
        _rewrite(spark, source, target, touched, window, time_col, build)
    seen = F.current_timestamp()
    version = uuid.uuid4().hex
    entries = [
        (r["path"], r["length"], r["modified"], None if r["change"] == "gone" else days_of.get(_plain(r["path"]), []), version)
        for r in pending
    ]
    rows = spark.createDataFrame(entries, MANIFEST.replace(", seen timestamp", ""))
    rows.withColumn("seen", seen).coalesce(1).write.mode("append").parquet(manifest)
    return counts | {"days": len(touched)}


def _plain(path: str) -> str:
    """A file's name without the number of slashes and escapes that its spelling has."""
    from urllib.parse import unquote

    scheme, _, rest = path.partition(":")
    return f"{scheme}:{'/' + unquote(rest).lstrip('/') if scheme == 'file' else unquote(rest)}"


def _rewrite(spark, source, target, days, window, time_col, build) -> None:
    """Windows of the given days from all readings there are."""
    import datetime as dt

    span = dt.timedelta(seconds=duration_seconds(window))
    whole = spark.read.option("recursiveFileLookup", "true").parquet(source)
    time = F.col(time_col)
    lit = lambda d: F.lit(d.isoformat(sep=" ")).cast("timestamp_ntz")
    low, high = dt.datetime.combine(days[0], dt.time()), dt.datetime.combine(days[-1], dt.time())
    # The range is pushed to the scan; a day's windows may end after it.
    near = whole.filter((time >= lit(low)) & (time < lit(high + dt.timedelta(days=1) + span)))
    own = near.filter(window_day(time, window).isin(days))
    made = build(own, window).withColumn(DAY, F.col("time").cast("date"))
    # A day that holds no windows any more: its partition goes.
    left = {r[0] for r in made.select(DAY).distinct().collect()} if _exists(spark, target) else set(days)
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(target)
    for day in days:
        if day not in left:
            _drop(spark, f"{target}/{DAY}={day.isoformat()}")


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    store, target = _fs(spark, path)
    return store.exists(target)


def _drop(spark: SparkSession, path: str) -> None:
    store, target = _fs(spark, path)
    if store.exists(target):
        store.delete(target, True)


def read_windows(spark: SparkSession, target: str) -> DataFrame:
    """The window table without its partition column; filters on ``window_day`` belong before this."""
    return spark.read.parquet(target).drop(DAY)
