"""Running totals over a global order without a single-partition window.

``Window.orderBy(x)`` with no partition sends every row to one task. Here the
ordered values are cut twice: into at most ``COARSE`` ranges at approximate
quantiles of the whole, and each range into at most ``FINE`` cells at
approximate quantiles of its own. Sums are then taken level by level - the
rows of a cell, the cells of a range, the ranges - and a row's running total
is the sum of three prefixes: of the ranges before its own, of the cells
before its own in that range, and of the rows before it in the cell.

Whatever the number of rows, the driver holds one edge and one total per
range (at most ``COARSE``), the cells' edges travel as one small array per
range, and the cells' prefixes come back by a join on the cell. Exact for any
input; balanced when the quantiles are.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the whole at most, and cells of a range at most.
COARSE, FINE = 1024, 256


def fan_out(rows: int, bucket_rows: int) -> tuple[int, int]:
    """Ranges, and cells of a range, for cells of about ``bucket_rows`` rows; two at least, so every size takes one route."""
    cells = max(1, -(-rows // bucket_rows))
    coarse = min(COARSE, max(2, math.isqrt(cells - 1) + 1, -(-cells // FINE)))
    return coarse, min(FINE, max(2, -(-cells // coarse)))


def _quantiles(value: Column, parts: int) -> Column:
    """Inner edges of ``parts`` ranges, each once, rising."""
    edges = F.percentile_approx(value, [i / parts for i in range(1, parts)], max(10_000, 8 * parts))
    return F.array_sort(F.array_distinct(edges))


def _place(value: Column, edges: Column, most: int) -> Column:
    """How many of up to ``most`` rising edges are below a value: a binary search over the array."""
    place = F.lit(0)
    step = 1 << max(0, most.bit_length() - 1)
    while step:
        # NULL beyond the array's end: not below.
        below = F.coalesce(F.get(edges, place + (step - 1)) < value, F.lit(False))
        place = place + F.when(below, F.lit(step)).otherwise(F.lit(0))
        step //= 2
        yield place
        place = F.col("_place")


def _with_place(df: DataFrame, value: str, edges: str, most: int, out: str) -> DataFrame:
    """``_place`` as a column; a step of the search reads the one before it from a column, so nothing is repeated."""
    for place in _place(F.col(value), F.col(edges), most):
        df = df.withColumn("_place", place)
    return df.withColumnRenamed("_place", out)


def running_totals(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    *,
    descending: bool = True,
    bucket_rows: int = 50_000,
    prefix: str = "cum_",
) -> DataFrame:
    """Add ``cum_<c>``: the sum of ``c`` over all rows at or before this row's
    position in ``order_col`` order. ``order_col`` must be unique per row
    (e.g. the output of a ``groupBy(order_col)``) and numeric; a NULL raises."""
    sum_cols, base = list(sum_cols), df.columns
    value = F.col(order_col).cast("double")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(value.isNull()).alias("nulls")).first()
    if row["nulls"]:
        raise ValueError(f"{row['nulls']} rows have no {order_col}")
    if not row["n"]:
        return df.select("*", *[F.col(c).alias(f"{prefix}{c}") for c in sum_cols])
    coarse, fine = fan_out(row["n"], bucket_rows)
    edges = df.agg(_quantiles(value, coarse).alias("q")).first()["q"] or []
    rows = df.withColumn("_value", value).withColumn("_edges", F.array(*map(F.lit, edges)).cast("array<double>"))
    rows = _with_place(rows, "_value", "_edges", len(edges), "_range").drop("_edges")
    # Each range's own edges: at most COARSE arrays of at most FINE doubles.
    inner = rows.groupBy("_range").agg(_quantiles(F.col("_value"), fine).alias("_edges"))
    rows = _with_place(rows.join(F.broadcast(inner), "_range"), "_value", "_edges", fine - 1, "_cell").drop("_edges", "_value")

    cells = rows.groupBy("_range", "_cell").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    totals = cells.groupBy("_range").agg(*[F.sum(f"_t_{c}").alias(c) for c in sum_cols]).collect()
    starts = _prefixes(totals, sum_cols, len(edges) + 1, descending)
    order = F.desc("_cell") if descending else F.asc("_cell")
    before = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("_range", "_cell", *[
        (F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)) + _looked_up(starts[c], "_range")).alias(f"_o_{c}")
        for c in sum_cols
    ])
    within = (Window.partitionBy("_range", "_cell")
              .orderBy(F.desc(order_col) if descending else F.asc(order_col))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.join(offsets, ["_range", "_cell"]).select(
        *base, *[(F.sum(c).over(within) + F.col(f"_o_{c}")).alias(f"{prefix}{c}") for c in sum_cols])


def _prefixes(totals, sum_cols: list[str], ranges: int, descending: bool) -> dict[str, list]:
    """For each column the sum over the ranges before each range."""
    of = {r["_range"]: r for r in totals}
    out: dict[str, list] = {c: [0] * ranges for c in sum_cols}
    sums = dict.fromkeys(sum_cols, 0)
    for k in (range(ranges - 1, -1, -1) if descending else range(ranges)):
        for c in sum_cols:
            out[c][k] = sums[c]
            if k in of and of[k][c] is not None:
                sums[c] += of[k][c]
    return out


def _looked_up(values: list, place: str) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.col(place))
