"""Mergeable quantile sketches per vehicle and day (A7, M2 over any range without the readings).

A KLL sketch holds a few hundred values and answers any quantile within a rank
error that does not depend on how many readings it has seen, in which order, or
in how many parts. One sketch per vehicle and day is stored; a range of days, a
fleet or a month is the merge of its sketches, so a report over a year reads a
few kilobytes per vehicle and day instead of every reading.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic import config

#: Accuracy parameter of a sketch (8 to 65535).
K = 1024


def rank_error(k: int = K) -> float:
    """Bound of the normalised rank error of one query at 99 % confidence: 2.296 / k**0.9723,
    the published fit for double-sided queries of this sketch."""
    return 2.296 / k**0.9723


def daily_sketches(
    readings: DataFrame, *, codes: Sequence[int] | None = None, k: int = K, key: str = "vehicle_id", time_col: str = "time",
) -> DataFrame:
    """``key, value_id, day, readings, low, high, sketch`` of all non-NULL values (NaN left out).

    A partial aggregate: a task sends one sketch per vehicle, signal and day, so a
    vehicle with a third of all readings moves no more than any other.
    """
    value = F.col("value").cast("double")
    rows = readings.filter(value.isNotNull() & ~F.isnan(value))
    if codes is not None:
        rows = rows.filter(F.col("value_id").isin(list(codes)))
    return rows.groupBy(key, "value_id", F.col(time_col).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("readings"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"),
    )


def merged(sketches: DataFrame, by: Sequence[str], *, start=None, end=None, k: int = K) -> DataFrame:
    """Sketches of coarser groups ``by`` over the days from ``start`` to ``end`` (both included; None: all)."""
    if start is not None:
        sketches = sketches.filter(F.col("day") >= F.lit(str(start)).cast("date"))
    if end is not None:
        sketches = sketches.filter(F.col("day") <= F.lit(str(end)).cast("date"))
    return sketches.groupBy(*by).agg(
        F.sum("readings").alias("readings"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
    )


def quantiles(sketches: DataFrame, fractions: Sequence[float] = config.PERCENTILES) -> DataFrame:
    """One row per group and fraction: ``quantile, estimate`` (an observed value); 0 and 1 are exact."""
    asked = F.array(*[F.lit(float(f)) for f in fractions])
    found = F.kll_sketch_get_quantile_double("sketch", asked)
    pairs = F.explode(F.arrays_zip(asked.alias("quantile"), found.alias("estimate"))).alias("q")
    kept = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*kept, pairs).select(*kept, "q.quantile", "q.estimate")


def within_bound(estimates: DataFrame, readings: DataFrame, by: Sequence[str], *, error: float) -> DataFrame:
    """``estimates`` with the true share of readings below and up to each estimate, and whether the
    quantile lies within ``error`` of that span. One join on ``by`` of readings with their group's few quantiles."""
    few = estimates.groupBy(*by).agg(F.collect_list(F.struct("quantile", "estimate")).alias("asked"))
    value = F.col("value").cast("double")
    counted = readings.filter(value.isNotNull() & ~F.isnan(value)).groupBy(*by, value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    spread = counted.join(few, list(by)).select(*by, "v", "n", F.explode("asked").alias("a"))
    ranks = spread.groupBy(*by, F.col("a.quantile").alias("quantile")).agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col("v") < F.col("a.estimate"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("a.estimate"), F.col("n")).otherwise(0)).alias("upto"),
    )
    off = F.greatest(F.lit(0.0), F.col("below") / F.col("all") - F.col("quantile"), F.col("quantile") - F.col("upto") / F.col("all"))
    ranks = ranks.withColumn("rank_error_ok", off <= F.lit(error)).drop("all", "below", "upto")
    return estimates.join(ranks, [*by, "quantile"])
