"""Score tables for the evaluation operators.

A real score table comes from ``PipelineModel.transform``; for oracle checks
one is derived from ``events``: the probability is the ``k`` field of
``props`` divided by 100, the label is ``value > 100`` and the prediction is
``probability >= 0.5``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("double") / 100
    p = F.when(F.col("event_id") % 17 != 0, k)  # some rows without a score
    return e.select(
        F.concat(F.lit("V"), (F.col("user_id") % 7).cast("string")).alias("vehicle_id"),
        F.col("ts").alias("time"),
        "event_id",
        (F.col("value") > 100).cast("int").alias("maintenance_risk"),
        p.alias("risk_probability"),
        F.coalesce(p >= 0.5, F.lit(False)).cast("double").alias("prediction"),
    )
