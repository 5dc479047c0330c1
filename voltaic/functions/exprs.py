"""Small column-expression builders."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_case(col: Column | str, mapping: Mapping, default=None) -> Column:
    """``CASE col WHEN k THEN v ... END`` built from a mapping (NULL when unmatched)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr if default is None else expr.otherwise(F.lit(default))


def lit_for(df, col: str, value) -> Column:
    """A literal for comparing with ``df[col]``, typed like the column.

    Values collected from TIMESTAMP_NTZ columns come back as naive datetimes;
    ``F.lit`` would make them zone-dependent TIMESTAMPs, so they go through
    their ISO text and a cast instead.
    """
    import datetime as _dt

    from pyspark.sql import types as T

    dtype = df.schema[col].dataType
    if isinstance(value, _dt.datetime) and isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def in_band(col: Column | str, lo: float, hi: float) -> Column:
    """Inclusive band test; NULL and NaN are outside (NaN compares false here)."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= F.lit(lo)) & (c <= F.lit(hi)) & ~F.isnan(c)


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` only where ``den > 0``; NULL otherwise.

    The division sits inside the branch so ANSI mode never sees a zero divisor.
    """
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.when(d > 0, n / d)


def safe_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """``num / den`` when ``den`` is non-zero, else ``default`` (metric formulas)."""
    out = F.when(den != 0, num.cast("double") / den.cast("double"))
    return out if default is None else out.otherwise(F.lit(float(default)))


def probability_of(col: Column | str = "probability", index: int = 1) -> Column:
    """Element ``index`` of an ML probability vector as a double, 0.0 when absent.

    Uses ``vector_to_array`` (JVM side) instead of a row-at-a-time Python UDF.
    """
    from pyspark.ml.functions import vector_to_array

    c = F.col(col) if isinstance(col, str) else col
    arr = vector_to_array(c)
    return F.coalesce(F.try_element_at(arr, F.lit(index + 1)), F.lit(0.0))
