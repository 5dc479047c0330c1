"""Raw nanosecond sources: repair, normalization and per-source accounting.

The raw files store ``time`` as Parquet TIMESTAMP(NANOS), which Spark refuses
unless ``spark.sql.legacy.parquet.nanosAsLong`` is on; then it reads as BIGINT
nanoseconds. Everything after the scan is one projection: repair (X1) and the
unit cast (X2) are column expressions, so the work is a map-only job that
parallelizes over files and row groups instead of a Python row loop.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic import config
from voltaic.functions.timefix import is_repaired, nanos_to_micros, ntz_to_micros, repair_time
from voltaic.sources.readings import LINE_NUMBER_CODES
from voltaic.functions.exprs import code_case


def ntz_to_nanos(col) -> F.Column:
    """TIMESTAMP_NTZ -> nanoseconds since the epoch (UTC wall clock), BIGINT."""
    return ntz_to_micros(col) * F.lit(1000)


def scan_nanos(spark: SparkSession, *paths: str, time_col: str = "time") -> DataFrame:
    """Read files whose time is TIMESTAMP(NANOS) (or already BIGINT ns).

    Turns on ``spark.sql.legacy.parquet.nanosAsLong`` for the session (needed
    at both analysis and execution); the column comes back as BIGINT ns.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(*paths)
    return df.withColumnRenamed(time_col, "time_ns") if time_col != "time_ns" else df


def write_nanos(raw: DataFrame, folder: str, *, time_col: str = "time_ns", as_col: str = "time") -> list[str]:
    """Write a table as Parquet files whose ``as_col`` is TIMESTAMP(NANOS), a type Spark cannot write, one file a
    task through Arrow; returns the files' paths.

    ``folder`` is in storage that all tasks share. A file gets a name of its own attempt and counts only
    once its task reports it, so a lost or repeated task leaves at most a file that nobody reads.
    """
    names = [as_col if c == time_col else c for c in raw.columns]

    def write(batches):
        import uuid

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        uri = "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder
        system, path = fs.FileSystem.from_uri(uri)
        system.create_dir(path, recursive=True)
        name, writer, rows = f"part-{uuid.uuid4().hex}.parquet", None, 0
        for batch in batches:
            columns = [c.cast(pa.int64()).cast(pa.timestamp("ns")) if n == as_col else c
                       for n, c in zip(names, batch.columns, strict=True)]
            table = pa.Table.from_arrays(columns, names=names)
            writer = writer or pq.ParquetWriter(f"{path}/{name}", table.schema, filesystem=system, version="2.6")
            writer.write_table(table)
            rows += len(table)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows], pa.int64())], names=["name", "rows"])

    return [f"{folder}/{r['name']}" for r in raw.mapInArrow(write, "name string, rows long").collect()]


def repair_readings(raw: DataFrame, *, limit_ns: int = config.REPAIR_LIMIT_NS,
                    years: int = config.REPAIR_YEARS) -> DataFrame:
    """X1 on a raw table with ``time_ns``: repaired ``time`` plus a ``corrected`` flag."""
    return raw.withColumn("time", repair_time("time_ns", limit_ns, years)) \
        .withColumn("corrected", is_repaired("time_ns", limit_ns)).drop("time_ns")


def normalize_sources(
    raw: DataFrame,
    repaired: Iterable[str] = (),
    *,
    source_col: str = "source",
    mode: str = "strict",
    limit_ns: int = config.REPAIR_LIMIT_NS,
    years: int = config.REPAIR_YEARS,
) -> DataFrame:
    """One table from many sources; only the listed sources are repaired.

    Other sources get the plain ns -> µs cast (``mode="strict"`` raises when
    sub-µs digits would be lost). ``corrected`` marks rows the repair shifted.
    A row without a source raises: whether to repair it cannot be known.
    """
    listed = list(repaired)
    is_listed = F.col(source_col).isin(listed) if listed else F.lit(False)
    fix = is_listed & is_repaired("time_ns", limit_ns)
    unknown = F.raise_error(F.lit("a reading has no source")).cast("timestamp_ntz")
    time = F.when(F.col(source_col).isNull(), unknown).when(is_listed, repair_time("time_ns", limit_ns, years)).otherwise(nanos_to_micros("time_ns", mode))
    cols = [c for c in raw.columns if c != "time_ns"]
    return raw.select(*[F.col(c) for c in cols if c != "time"], time.alias("time"), fix.alias("corrected"))


def sources_from_files(spark: SparkSession, files: Mapping[str, str]) -> DataFrame:
    """S6 from a ``{source: path}`` map: each path (a file or a folder of part files) is
    scanned as its source, so equal file names in different folders stay apart.
    Two sources with one path are refused; a missing path raises."""
    paths = [p.rstrip("/") for p in files.values()]
    if len(set(paths)) < len(paths):
        raise ValueError("two sources name the same path")
    scans = [scan_nanos(spark, p).withColumn("source", F.lit(name)) for name, p in files.items()]
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan, allowMissingColumns=True)
    return out


def lineitem_raw_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for raw ns files: one source per ``l_returnflag``; source ``R``'s
    clock runs 64 years ahead (as the broken source in the reference did)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    src = F.concat(F.lit("SRC_"), F.col("l_returnflag"))
    t = F.col("l_shipdate").cast("timestamp_ntz")
    shifted = F.when(F.col("l_returnflag") == "R", F.timestamp_add("YEAR", F.lit(config.REPAIR_YEARS), t)).otherwise(t)
    return li.select(
        src.alias("source"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("vehicle_id"),
        (ntz_to_nanos(shifted) + F.col("l_orderkey") * F.lit(1_001_000)).alias("time_ns"),
        code_case("l_linenumber", dict(enumerate(LINE_NUMBER_CODES, start=1))).cast("int").alias("value_id"),
        F.col("l_quantity").cast("double").alias("value"),
    )
