"""Long-format reading sources: the reading schema, scans and test-data adapters.

A reading is one row ``(vehicle_id STRING, time TIMESTAMP_NTZ, value_id INT,
value DOUBLE)``. Every function returns a lazy DataFrame; column pruning and
filter pushdown reach the Parquet scan because only built-in expressions sit
between the scan and the consumer.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.functions.exprs import code_case
from voltaic.functions.timefix import to_millis

READING_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType(), True),
    T.StructField("time", T.TimestampNTZType(), True),
    T.StructField("value_id", T.IntegerType(), True),
    T.StructField("value", T.DoubleType(), True),
])
READING_COLUMNS = [f.name for f in READING_SCHEMA.fields]

# --- fixed values: test-data stand-ins (event type -> signal code) ---
EVENT_TYPE_CODES = {"click": 4, "error": 15, "purchase": 56, "signup": 900, "view": 1200}
# line numbers 1..7 of lineitem carry these seven codes, in this order
LINE_NUMBER_CODES = [4, 15, 56, 900, 1200, 1208, 1209]
EVENT_VEHICLES = 7


def as_readings(df: DataFrame) -> DataFrame:
    """Project and cast any frame with the four reading columns to the reading schema."""
    return df.select(
        F.col("vehicle_id").cast("string").alias("vehicle_id"),
        F.col("time").cast("timestamp_ntz").alias("time"),
        F.col("value_id").cast("int").alias("value_id"),
        F.col("value").cast("double").alias("value"),
    )


def scan_readings(spark: SparkSession, *paths: str) -> DataFrame:
    """Directory / multi-file Parquet scan as one reading table."""
    return as_readings(spark.read.parquet(*paths))


def events_as_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as readings: seven vehicles ``'V' || user_id % 7``, codes by event type."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select(
        F.concat(F.lit("V"), (F.col("user_id") % EVENT_VEHICLES).cast("string")).alias("vehicle_id"),
        F.col("ts").alias("time"),
        code_case("event_type", EVENT_TYPE_CODES).cast("int").alias("value_id"),
        F.col("value").cast("double").alias("value"),
    )


def lineitem_as_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as readings: vehicle ``'S' || l_suppkey``, day times, seven codes."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    codes = dict(enumerate(LINE_NUMBER_CODES, start=1))
    return li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("vehicle_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("time"),
        code_case("l_linenumber", codes).cast("int").alias("value_id"),
        F.col("l_quantity").cast("double").alias("value"),
    )


def lineitem_as_priced_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as monthly readings with two value columns: NULL vehicles (even suppliers) and NULLs in both."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    codes = dict(enumerate(LINE_NUMBER_CODES, start=1))
    return li.select(
        F.when(F.col("l_suppkey") % 2 == 1, F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("vehicle_id"),
        F.trunc("l_shipdate", "month").cast("timestamp_ntz").alias("time"),
        code_case("l_linenumber", codes).cast("int").alias("value_id"),
        F.when(F.col("l_orderkey") % 3 > 0, F.col("l_quantity").cast("double")).alias("value"),
        F.when(F.col("l_partkey") % 4 > 0, F.col("l_extendedprice").cast("double")).alias("price"),
    )


def extract_signals(readings: DataFrame, codes: Iterable[int], *, millis: str | None = None) -> DataFrame:
    """Keep the listed signal codes (F1/S4); optionally cast time to ms.

    ``millis`` is ``None`` (keep µs), ``"strict"`` (raise if digits are lost)
    or ``"truncate"``. The ``IN`` list is pushed to the Parquet reader.
    """
    out = readings.select(*READING_COLUMNS).filter(F.col("value_id").isin(list(codes)))
    if millis is not None:
        out = out.withColumn("time", to_millis("time", millis))
    return out


def single_signal(readings: DataFrame, code: int, name: str) -> DataFrame:
    """One signal as ``(time, <name>)`` (F2)."""
    return readings.filter(F.col("value_id") == code).select("time", F.col("value").alias(name))


def scan_profile(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Row count and time range in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(time_col).alias("min_time"),
        F.max(time_col).alias("max_time"),
    )
