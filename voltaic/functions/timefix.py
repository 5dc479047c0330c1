"""Timestamp repair and unit conversion expressions.

Raw sources carry nanosecond integers (Parquet TIMESTAMP(NANOS) read as
BIGINT with ``spark.sql.legacy.parquet.nanosAsLong``). All results are
zone-less TIMESTAMP_NTZ built by pure arithmetic from the epoch, so they do
not depend on the session or machine time zone.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltaic import config


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ntz() -> Column:
    """1970-01-01 00:00:00 as TIMESTAMP_NTZ."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_micros(c: Column | str) -> Column:
    """TIMESTAMP_NTZ wall clock -> microseconds since the epoch, read as UTC.

    ``NTZ - NTZ`` is a day-time interval computed without any time zone
    (``timestamp_diff`` would cast both sides through the session zone); its
    fields add up to the exact microsecond count.
    """
    iv = _col(c) - epoch_ntz()

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), iv)

    return (part("DAY").cast("long") * F.lit(86_400_000_000)
            + part("HOUR").cast("long") * F.lit(3_600_000_000)
            + part("MINUTE").cast("long") * F.lit(60_000_000)
            + (part("SECOND") * F.lit(1_000_000)).cast("long"))


def micros_to_ntz(micros: Column | str) -> Column:
    """Microseconds since the epoch -> TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_add("MICROSECOND", _col(micros), epoch_ntz())


def instant_to_ntz(c: Column) -> Column:
    """TIMESTAMP instant -> its UTC wall clock as TIMESTAMP_NTZ."""
    return micros_to_ntz(F.unix_micros(c))


def _micros(ns: Column) -> Column:
    """Nanoseconds to whole microseconds, rounded down, in integers only (a double holds no
    present-day nanosecond count exactly)."""
    unit = F.lit(1000).cast("long")
    return F.call_function("div", ns - F.pmod(ns, unit), unit)


def _strict(value: Column, lossy: Column, message: str) -> Column:
    return F.when(lossy, F.raise_error(F.lit(message)).cast("timestamp_ntz")).otherwise(value)


def nanos_to_micros(ns: Column | str, mode: str = "strict") -> Column:
    """Nanosecond integer -> TIMESTAMP_NTZ at microsecond precision.

    ``mode="strict"`` raises when sub-microsecond digits would be lost (a safe
    cast); ``"truncate"`` floors them away.
    """
    c = _col(ns)
    out = micros_to_ntz(_micros(c.cast("long")))
    if mode == "truncate":
        return out
    if mode != "strict":
        raise ValueError("mode must be 'strict' or 'truncate'")
    return _strict(out, F.coalesce(F.pmod(c, F.lit(1000)) != 0, F.lit(False)),
                   "nanosecond digits would be lost in the cast to microseconds")


def to_millis(ts: Column | str, mode: str = "strict") -> Column:
    """TIMESTAMP_NTZ -> millisecond precision; strict mode raises if digits are lost."""
    c = _col(ts)
    out = F.date_trunc("millisecond", c).cast("timestamp_ntz")
    if mode == "truncate":
        return out
    if mode != "strict":
        raise ValueError("mode must be 'strict' or 'truncate'")
    return _strict(out, F.coalesce(out != c, F.lit(False)),
                   "microsecond digits would be lost in the cast to milliseconds")


def is_repaired(ns: Column | str, limit_ns: int = config.REPAIR_LIMIT_NS) -> Column:
    """True when the reading lies after the repair limit (strict ``>``)."""
    return F.coalesce(_col(ns) > F.lit(limit_ns), F.lit(False))


def repair_time(
    ns: Column | str,
    limit_ns: int = config.REPAIR_LIMIT_NS,
    years: int = config.REPAIR_YEARS,
) -> Column:
    """Shift readings after ``limit_ns`` back by ``years`` calendar years.

    A Feb 29 without a twin lands on Feb 28 (calendar clamp). NULL stays NULL.
    Output is TIMESTAMP_NTZ, microsecond precision (sub-µs digits truncated).
    """
    base = micros_to_ntz(_micros(_col(ns).cast("long")))
    shifted = F.timestamp_add("YEAR", F.lit(-years), base)
    return F.when(is_repaired(ns, limit_ns), shifted).otherwise(base)
