"""Streaming windows, per-vehicle previous-value state and scoring.

Plan: messages -> parse -> watermark -> the *same* ``window_pivot`` as batch
-> (append mode: each window once, when the watermark closes it) -> validity
filter -> ``transformWithStateInPandas`` keyed by vehicle, which keeps one
row of state per vehicle in the state store (RocksDB) -> scoring.

Compared with collecting every micro-batch to the driver and keeping a
Python dict there, the state lives on executors, survives restarts through
the checkpoint, and scales with the number of vehicles.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic import config
from voltaic.functions.exprs import in_band
from voltaic.operators.features import duration_seconds
from voltaic.operators.windows import window_pivot
from voltaic.streaming.messages import first_copies, instant_to_ntz, parse_messages, valid_messages

WINDOW_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("time", T.TimestampType()),
    *[T.StructField(n, T.DoubleType()) for n in config.SIGNALS_ML.values()],
])
FEATURE_SCHEMA = T.StructType([
    *WINDOW_SCHEMA.fields,
    T.StructField("voltage_per_soc", T.DoubleType()),
    T.StructField("previous_voltage", T.DoubleType()),
    T.StructField("previous_soc", T.DoubleType()),
    T.StructField("voltage_change", T.DoubleType()),
    T.StructField("soc_change", T.DoubleType()),
])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    """``transformWithStateInPandas`` needs the RocksDB state store; select it
    for queries started from now on unless a RocksDB provider is already set."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key, "") or ""):
        spark.conf.set(key, ROCKSDB)


def stream_windows(messages: DataFrame, *, window: str = config.WINDOW, watermark: str = config.WATERMARK,
                   signals=config.SIGNALS_ML, redelivered: bool = False) -> DataFrame:
    """Parsed messages -> watermarked tumbling-window pivot (append-safe).

    ``redelivered``: messages may come more than once (within the watermark's
    delay); only the first copy counts.
    """
    parsed = valid_messages(parse_messages(messages), list(signals)).withWatermark("event_time", watermark)
    if redelivered:
        parsed = first_copies(parsed)
    return window_pivot(parsed, signals, window, time_col="event_time", with_end=False)


def valid_windows(windows: DataFrame, band=config.VOLTAGE_BAND) -> DataFrame:
    """SOC and voltage present, SOC > 0, voltage in band."""
    return windows.filter(F.col("hv_soc").isNotNull() & F.col("hv_battery_voltage").isNotNull()
                          & (F.col("hv_soc") > 0) & in_band("hv_battery_voltage", *band))


def stream_features(windows: DataFrame, *, band=config.VOLTAGE_BAND, first_row: str = "null",
                    state_ttl: str | None = None, window: str = config.WINDOW) -> DataFrame:
    """Validity filter, then the stateful previous-window features per vehicle.

    ``state_ttl`` (an interval such as ``"1 day"``, event time) lets a previous
    window that started longer before count as none, and deletes a vehicle's
    state when the watermark passes its last ``window`` by that time. Default:
    kept for ever.
    """
    from pyspark import cloudpickle

    from voltaic.streaming import state

    use_rocksdb(windows.sparkSession)
    # the processor runs in a driver-side Python runner too, which does not see
    # files added with addPyFile: ship its self-contained module by value
    cloudpickle.register_pickle_by_value(state)
    valid = valid_windows(windows, band).select(
        *[f.name for f in WINDOW_SCHEMA.fields], F.unix_micros("time").alias("micros"))
    return valid.groupBy("vehicle_id").transformWithStateInPandas(
        statefulProcessor=state.PreviousWindowProcessor(
            first_row, [f.name for f in FEATURE_SCHEMA.fields],
            None if state_ttl is None else 1000 * duration_seconds(state_ttl), 1000 * duration_seconds(window)),
        outputStructType=FEATURE_SCHEMA,
        outputMode="Append",
        timeMode="None" if state_ttl is None else "EventTime",
    )


def to_ntz_times(df: DataFrame, cols=("time",)) -> DataFrame:
    """Outputs that face batch tables carry TIMESTAMP_NTZ wall clocks."""
    return df.select(*[instant_to_ntz(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def score_stream(features: DataFrame, model, fill=config.STREAM_FILL_COLUMNS, *, missing: str = "fill",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Score and keep the reported columns (and those named in ``keep``). Rows with missing features get 0.0
    for them (``missing="fill"``) or are left out like in batch training (``"drop"``)."""
    from voltaic.functions.exprs import probability_of
    if missing not in ("fill", "drop"):
        raise ValueError("missing must be 'fill' or 'drop'")
    ready = features.fillna(0.0, subset=list(fill)) if missing == "fill" else features.dropna(subset=list(fill))
    scored = model.transform(ready)
    return scored.select("vehicle_id", "time", "hv_soc", "hv_battery_voltage", "voltage_change", "soc_change",
                         "prediction", probability_of("probability").alias("risk_probability"), *keep)


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, *, available_now: bool = True,
                   processing_time: str | None = None, output_mode: str = "append"):
    """K5: write a stream to Parquet with a checkpoint; ``availableNow`` processes
    what is there and stops (tests, catch-up jobs); ``processing_time`` keeps running."""
    w = (stream.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode(output_mode))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def run_to_console(stream: DataFrame, *, num_rows: int = 20, truncate: bool = False,
                   output_mode: str = "append", processing_time: str | None = None):
    """K4: print each micro-batch (demonstration sink; returns the running query)."""
    w = (stream.writeStream.format("console").outputMode(output_mode)
         .option("numRows", num_rows).option("truncate", str(truncate).lower()))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def foreach_batch_to_parquet(stream: DataFrame, path: str, checkpoint: str, *,
                             output_mode: str = "append", available_now: bool = True,
                             processing_time: str | None = None):
    """K5: ``foreachBatch`` that writes each micro-batch to ``path/batch_id=<id>``
    with overwrite, so a batch replayed after a failure replaces its own output
    instead of duplicating it (idempotent by ``batch_id``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = (stream.writeStream.foreachBatch(write).outputMode(output_mode)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
