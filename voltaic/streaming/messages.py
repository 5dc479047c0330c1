"""Telemetry messages: JSON encode/decode, Kafka and text sources and sinks.

A message is one JSON object ``{"vehicle_id", "time", "value_id", "value"}``
with ``time`` an ISO-8601 wall clock without zone. The same parse serves
Kafka (``value`` binary) and text files (``value`` string), so tests run the
exact stream logic on files when no broker is present.

Times: streams need TIMESTAMP (watermarks reject TIMESTAMP_NTZ). Parsed
wall clocks are turned into instants as if UTC by pure arithmetic, and back,
so windows and outputs do not depend on the session time zone.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.functions.timefix import instant_to_ntz, ntz_to_micros

MESSAGE_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType(), True),
    T.StructField("time", T.StringType(), True),
    T.StructField("value_id", T.IntegerType(), True),
    T.StructField("value", T.DoubleType(), True),
])

#: Default intake of a micro-batch.
MAX_OFFSETS_PER_TRIGGER = 1_000_000
MAX_FILES_PER_TRIGGER = 1_000


def ntz_to_instant(c: Column) -> Column:
    """TIMESTAMP_NTZ wall clock -> TIMESTAMP instant, reading the clock as UTC."""
    return F.timestamp_micros(ntz_to_micros(c))


def kafka_source(spark: SparkSession, servers: str, topic: str, *, starting: str = "earliest",
                 fail_on_data_loss: bool = True, stream: bool = True,
                 max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Kafka topic as a stream (or a bounded batch read with ``stream=False``).

    Needs the ``spark-sql-kafka-0-10`` package for the installed Spark on the
    classpath. Progress is kept in the query checkpoint, not a consumer group.
    ``max_offsets_per_trigger`` bounds a micro-batch, also the first of a backlog,
    and with it what the per-vehicle state operator sorts at a time; ``None`` lifts it.
    """
    reader = spark.readStream if stream else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    r = r.option("failOnDataLoss", str(bool(fail_on_data_loss)).lower())
    if stream and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def text_source(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                stream: bool = True) -> DataFrame:
    """JSON-lines files as a message stream with a ``value`` column (test stand-in for Kafka)."""
    if not stream:
        return spark.read.text(path)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def parse_messages(messages: DataFrame) -> DataFrame:
    """``value`` -> ``vehicle_id, event_time, value_id, value``.

    Malformed JSON gives NULL fields; a fractional code gives a NULL code; an
    unparseable time gives a NULL ``event_time`` (``try_cast``: ANSI mode would
    make ``to_timestamp`` raise instead).
    """
    data = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA).alias("data")
    wall = F.col("time").try_cast("timestamp_ntz")
    return (messages.select(data).select("data.*")
            .select("vehicle_id", ntz_to_instant(wall).alias("event_time"), "value_id", "value"))


def valid_messages(parsed: DataFrame, codes) -> DataFrame:
    """Keep listed codes with a time and a value (the stream's input filter)."""
    return parsed.filter(F.col("value_id").isin(list(codes)) & F.col("event_time").isNotNull()
                         & F.col("value").isNotNull())


def iso_time(c: Column) -> Column:
    """Python ``isoformat()`` of a TIMESTAMP_NTZ: the fraction only when non-zero."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return F.when(frac == "000000", whole).otherwise(F.concat(whole, F.lit("."), frac))


def encode_messages(readings: DataFrame) -> DataFrame:
    """Readings -> ``key`` (vehicle) and ``value`` (JSON text) for a Kafka/text sink."""
    body = F.struct(
        F.col("vehicle_id"),
        iso_time(F.col("time")).alias("time"),
        F.col("value_id").cast("int").alias("value_id"),
        F.col("value").cast("double").alias("value"),
    )
    return readings.select(F.col("vehicle_id").alias("key"), F.to_json(body).alias("value"))


def publish_messages(readings: DataFrame, *, limit: int | None = None,
                     order: tuple[str, ...] = ("time", "vehicle_id", "value_id", "value")) -> DataFrame:
    """K3: the messages to publish; ``limit`` takes the first ``n`` in an explicit order."""
    src = readings.orderBy(*order).limit(limit) if limit is not None else readings
    return encode_messages(src)


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """K3 sink: batch write of ``key``/``value`` to a topic (needs the Kafka package)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_text(messages: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K3 test sink: the JSON values as text files (one message per line)."""
    messages.select("value").write.mode(mode).text(path)
    return path


def first_copies(parsed: DataFrame, key: tuple[str, ...] = ("vehicle_id", "event_time", "value_id", "value")) -> DataFrame:
    """A11 on streams: drop messages sent again (a sink that delivers at least once does that).

    ``parsed`` carries a watermark on ``event_time``. The first message of a key
    stays; its key is remembered until the watermark passes its time by the
    watermark's delay and deleted then, so the state holds the messages of that
    time only. A copy that comes later still is a late message, which windows drop.
    """
    return parsed.dropDuplicatesWithinWatermark(list(key))


def message_quality(messages: DataFrame) -> DataFrame:
    """Counts of bad records in one pass: malformed JSON (no field parsed),
    unparseable times, NULL or fractional codes and NULL values."""
    data = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    m = messages.select(data.alias("m")).select("m.*")
    wall = F.col("time").try_cast("timestamp_ntz")
    malformed = (F.col("vehicle_id").isNull() & F.col("time").isNull() & F.col("value_id").isNull()
                 & F.col("value").isNull())
    return m.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(malformed).alias("malformed"),
        F.count_if(~malformed & F.col("time").isNotNull() & wall.isNull()).alias("bad_time"),
        F.count_if(~malformed & F.col("value_id").isNull()).alias("no_code"),
        F.count_if(~malformed & F.col("value").isNull()).alias("no_value"),
    )
