"""Profiles of reading and window tables.

Every profile is one aggregate pass (partial aggregation before the exchange);
wide "one number per column" reports are computed as one row and turned long
with ``unpivot``/``stack`` so that no driver loop or per-column job exists.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic import config
from voltaic.functions.exprs import in_band


def class_distribution(df: DataFrame, label: str = config.LABEL, by: Sequence[str] = ()) -> DataFrame:
    """A3: rows per label (optionally per split or other columns), ordered."""
    keys = [*by, label]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys)


def signal_stats(readings: DataFrame, codes: Iterable[int]) -> DataFrame:
    """A4/A5: count, min, max, mean and sample stddev per listed signal code.

    A listed code without rows does not appear (same as ``groupBy``).
    """
    return (
        readings.filter(F.col("value_id").isin(list(codes)))
        .groupBy("value_id")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.avg("value").alias("avg_value"),
            F.stddev("value").alias("std_value"),
        )
        .orderBy("value_id")
    )


def range_stats(windows: DataFrame) -> DataFrame:
    """Time range and SOC/voltage range and mean, one row."""
    return windows.agg(
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        F.min("hv_soc").alias("min_soc"),
        F.max("hv_soc").alias("max_soc"),
        F.avg("hv_soc").alias("avg_soc"),
        F.min("hv_battery_voltage").alias("min_voltage"),
        F.max("hv_battery_voltage").alias("max_voltage"),
        F.avg("hv_battery_voltage").alias("avg_voltage"),
    )


def signal_percentiles(
    values: DataFrame,
    col: str,
    percentiles: Sequence[float] = config.PERCENTILES,
    names: Sequence[str] = config.PERCENTILE_NAMES,
    accuracy: int = 10000,
    exact: bool = False,
) -> DataFrame:
    """Percentiles, one column per percentile.

    Default: ``percentile_approx`` in one pass with Spark's default accuracy,
    as the reference. ``exact``: discrete percentiles (``percentile_disc``)
    through ``ranks.exact_quantiles`` (bounded work per percentile).
    """
    if exact:
        from voltaic.operators.ranks import exact_quantiles

        q = exact_quantiles(values, [col], list(percentiles))
        dtype = dict(values.dtypes)[col]
        return values.sparkSession.createDataFrame(
            [tuple(q[(col, p)] for p in percentiles)], ", ".join(f"{n} {dtype}" for n in names))
    arr = F.percentile_approx(col, list(percentiles), accuracy)
    return values.agg(arr.alias("_p")).select(
        *[F.col("_p")[i].alias(n) for i, n in enumerate(names)]
    )


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``describe`` as a typed long table ``(column, count, mean, stddev, min, max)``:
    one wide aggregate; an empty table gives a row per column with count 0."""
    made = {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, f in made.items()])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}_{i}").alias(n) for n in made]) for i, c in enumerate(cols)
    ])
    return wide.select(F.inline(rows))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None, *, long: bool = False) -> DataFrame:
    """NULL count per column in one pass; wide (one row) or long."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    if not long:
        return wide
    return wide.unpivot([], cols, "column", "null_count")


def vehicles(df: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """A10: sorted distinct non-NULL vehicles."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order`` (ascending, NULLs last), deterministic.

    Done as an aggregate of ``min(struct(order..., rest...))`` rather than a
    ``row_number`` window: the partial aggregate runs before the exchange, so a
    key with a huge group of copies is reduced map-side instead of landing in
    one task whole. (Struct buffers are not fixed-width, so Spark plans a
    sort-based aggregate: it spills instead of holding groups in memory.)
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    if len(order + rest) == 1:  # plain min (skips NULLs too), hash-aggregated
        c = (order + rest)[0]
        return df.groupBy(*keys).agg(F.min(c).alias(c)).select(*df.columns)
    parts = [x for c in order + rest for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    packed = F.min(F.struct(*parts)).alias("_r")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in order + rest]) \
        .select(*df.columns)


def row_accounting(df: DataFrame, source: str = "source", corrected: str | None = "corrected") -> DataFrame:
    """Rows (and corrected rows) per source plus a total row (``source`` NULL)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if corrected is not None:
        aggs.append(F.count_if(F.col(corrected)).alias("corrected_rows"))
    return df.rollup(source).agg(*aggs)


def band_audit(values: DataFrame, col: str, band: tuple[float, float] = config.VOLTAGE_BAND) -> DataFrame:
    """F3/F4/F5 counts in one pass: total, in band, out of band, non-positive."""
    lo, hi = band
    c = F.col(col)
    return values.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(in_band(c, lo, hi)).alias("valid"),
        F.count_if((c < lo) | (c > hi)).alias("out_of_band"),
        F.count_if(c <= 0).alias("non_positive"),
    )


def out_of_band(values: DataFrame, col: str, band: tuple[float, float] = config.VOLTAGE_BAND,
                n: int = 20, order: Sequence[str] = ("time",)) -> DataFrame:
    """the first ``n`` out-of-band rows by time (tiebreak by value)."""
    lo, hi = band
    c = F.col(col)
    return values.filter((c < lo) | (c > hi)).orderBy(*order, col).limit(n)


def signal_names(spark: SparkSession, readings: DataFrame,
                 names: Mapping[int, str] = config.BATTERY_SIGNAL_NAMES) -> DataFrame:
    """code -> name dictionary with the row count per code (0 when absent).

    The per-code counts are an aggregate bounded by the dictionary size, so the
    join is broadcast; the reading table itself is never shuffled for it.
    """
    dictionary = spark.createDataFrame(list(names.items()), "value_id int, name string")
    counts = (readings.filter(F.col("value_id").isin(list(names)))
              .groupBy("value_id").agg(F.count(F.lit(1)).alias("rows")))
    return (dictionary.join(F.broadcast(counts), "value_id", "left")
            .select("value_id", "name", F.coalesce("rows", F.lit(0)).alias("rows"))
            .orderBy("value_id"))


def schema_report(df: DataFrame) -> DataFrame:
    """S14 with data: ``(position, column, type, nullable, non_null)`` per column,
    the non-NULL counts from one aggregate pass."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                              F.lit(f.dataType.simpleString()).alias("type"),
                              F.lit(f.nullable).alias("nullable"), F.col(f"c{i}").alias("non_null"))
                     for i, f in enumerate(fields)])
    return counts.select(F.inline(rows))
