"""What a stream has done so far, as tables: its progress by micro-batch and its state.

Both are read from the checkpoint by batch jobs, while the stream runs or after
it stopped; nothing of the stream is started or changed.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.functions.timefix import micros_to_ntz

_OFFSETS = "batchWatermarkMs long, batchTimestampMs long"
_COMMIT = "nextBatchWatermarkMs long"


def _log(spark: SparkSession, path: str) -> DataFrame:
    """A log folder, one file per micro-batch: its number and its lines."""
    # Hidden checksum files and temporary names are not numbers.
    files = spark.read.option("pathGlobFilter", "[0-9]*").text(path, wholetext=True)
    files = files.select(F.col("_metadata.file_name").alias("name"), F.split("value", "\n").alias("lines"))
    return files.filter(F.col("name").rlike("^[0-9]+$")).select(F.col("name").cast("long").alias("batch_id"), "lines")


def _instant(millis) -> F.Column:
    return F.when(millis > 0, micros_to_ntz(millis * 1000))


def progress(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per planned micro-batch of a stream.

    ``batch_id``; ``planned`` (when its offsets were written); ``watermark`` it ran
    with and ``next_watermark`` after it (NULL before any event time);
    ``offsets``, a JSON text per source, up to which it reads; ``committed``,
    whether it is done. A batch planned but not committed is run again, with
    the same offsets, at a restart.
    """
    planned = _log(spark, f"{checkpoint}/offsets").select(
        "batch_id", F.from_json(F.get("lines", F.lit(1)), _OFFSETS).alias("m"),
        F.filter(F.slice("lines", 3, F.greatest(F.size("lines") - 2, F.lit(0))), lambda x: x != "").alias("offsets"),
    )
    done = _log(spark, f"{checkpoint}/commits").select(
        "batch_id", F.from_json(F.get("lines", F.lit(1)), _COMMIT).alias("c"), F.lit(True).alias("committed"))
    return planned.join(done, "batch_id", "left").select(
        "batch_id", _instant(F.col("m.batchTimestampMs")).alias("planned"),
        _instant(F.col("m.batchWatermarkMs")).alias("watermark"),
        _instant(F.col("c.nextBatchWatermarkMs")).alias("next_watermark"),
        "offsets", F.coalesce("committed", F.lit(False)).alias("committed"),
    )


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a stream: ``operatorId``, ``operatorName``, stores, partitions, batches kept."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_table(spark: SparkSession, checkpoint: str, variable: str = "last", *,
                operator: str = "transformWithState", batch_id: int | None = None) -> DataFrame:
    """A state variable of the stream's operator ``operator`` (the start of its name): ``key`` and ``value`` columns.

    Read as of the last committed batch, or ``batch_id``. An operator that does not occur raises.
    """
    found = state_operators(spark, checkpoint).filter(F.col("operatorName").startswith(operator))
    row = found.select("operatorId").distinct().orderBy("operatorId").first()
    if row is None:
        raise ValueError(f"no operator {operator!r} in the state of {checkpoint}")
    reader = spark.read.format("statestore").option("operatorId", row["operatorId"]).option("stateVarName", variable)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    table = reader.load(checkpoint)
    return table.select("key.*", "value.*")


def last_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """T6's state: the last valid window of every vehicle that the stream still remembers."""
    state = state_table(spark, checkpoint)
    return state.select(
        F.col(state.columns[0]).alias("vehicle_id"), micros_to_ntz(F.col("micros")).alias("time"),
        F.col("voltage").alias("hv_battery_voltage"), F.col("soc").alias("hv_soc"),
    )
