"""Previous-row features, look-ahead extreme and the proxy risk label.

Definitions (per vehicle, rows ordered by window start):

* ``previous_*`` is the previous *kept* row, whatever the time gap (L1);
* ``*_change`` is current minus previous, NULL on the first row (L2);
* ``future_max_voltage_change`` is ``max(abs(voltage_change))`` over the next
  ``lookahead`` rows, current row excluded; NULL on the last row (L3);
* ``maintenance_risk`` is 1 when that exceeds the threshold, else 0 (L4);
* rows without previous or future are dropped afterwards (L5).

Scale. A plain ``Window.partitionBy(vehicle_id)`` puts each vehicle's whole
series into one task, and one vehicle may hold a third of all rows. Here the
series is cut into time chunks (``chunk``, default one day): the main pass is
partitioned by ``(vehicle_id, chunk)``, so a group holds at most
``chunk / window`` rows. Only rows near a chunk edge (the first and the last
``lookahead`` rows of each chunk, a bounded number per chunk) need
neighbours from other chunks; they are recomputed in a second, small window
over just those edge rows. That pass is exact: the row before a chunk's first
row is the previous chunk's last row, and the ``lookahead`` rows after a
chunk's tail are each among the first ``lookahead`` rows of their own chunk,
so all of them are edge rows. The result equals the per-vehicle window row for
row (tested), with no sampling or caps.

Bounds: a main-pass group holds at most ``chunk / window`` rows; the edge pass
holds at most ``2 * lookahead`` rows per chunk of a vehicle, i.e. at most
``2 * lookahead * span / chunk`` rows per vehicle (43,800 for ten years of
one-day chunks), a number set by the time span, not by the data volume. A
dense hot vehicle has full chunks, so its edge rows are a tiny share
(``tools/skew_probe.py`` measures it).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltaic import config
from voltaic.functions.exprs import guarded_ratio, in_band
from voltaic.functions.timefix import ntz_to_micros
from voltaic.operators.windows import window_pivot_ml

# windows per (vehicle, chunk) group in the main pass: one day of 10 s windows
CHUNK_ROWS = 8640

#: Time of the last row that a row's label looks at.
LABEL_END = "label_end"

ML_COLUMNS = [
    "vehicle_id", "time", "vehicle_speed", "ambient_air_temp", "hv_aux_power",
    "hv_soc", "hv_battery_voltage", "voltage_per_soc", "previous_voltage",
    "previous_soc", "voltage_change", "soc_change", "future_max_voltage_change",
    "maintenance_risk",
]


def ratio_feature(df: DataFrame) -> DataFrame:
    """``voltage_per_soc`` only where SOC > 0."""
    return df.withColumn("voltage_per_soc", guarded_ratio("hv_battery_voltage", "hv_soc"))


def _sequence_cols(w, lookahead: int, time_col: str | None = None):
    v, s = F.col("hv_battery_voltage"), F.col("hv_soc")
    cols = [
        ("previous_voltage", F.lag(v, 1).over(w)),
        ("previous_soc", F.lag(s, 1).over(w)),
        ("voltage_change", v - F.col("previous_voltage")),
        ("soc_change", s - F.col("previous_soc")),
        ("future_max_voltage_change",
         F.max(F.abs(F.col("voltage_change"))).over(w.rowsBetween(1, lookahead))),
    ]
    if time_col:
        cols.append((LABEL_END, F.max(time_col).over(w.rowsBetween(1, lookahead))))
    return cols


def _apply(df: DataFrame, cols) -> DataFrame:
    for name, expr in cols:
        df = df.withColumn(name, expr)
    return df


def duration_seconds(text: str) -> int:
    """Seconds in an interval string such as ``"10 seconds"``, ``"6 hours"`` or
    ``"1 hour 30 minutes"`` (the forms ``F.window`` accepts for fixed lengths)."""
    units = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    parts = text.strip().lower().replace("interval", "").split()
    if not parts or len(parts) % 2:
        raise ValueError(f"cannot read the interval {text!r}")
    total = 0.0
    for n, unit in zip(parts[::2], parts[1::2]):
        unit = unit.rstrip("s")
        if unit not in units:
            raise ValueError(f"unsupported interval unit in {text!r}")
        total += float(n) * units[unit]
    return max(1, int(total))


def auto_chunk(window: str, rows_per_chunk: int = CHUNK_ROWS) -> str:
    """A chunk length holding at most ``rows_per_chunk`` windows per vehicle."""
    return f"{duration_seconds(window) * rows_per_chunk} seconds"


def sequence_features(
    df: DataFrame,
    *,
    key: str = "vehicle_id",
    time_col: str = "time",
    lookahead: int = config.LOOKAHEAD_ROWS,
    chunk: str | None = "1 day",
    label_end: bool = False,
) -> DataFrame:
    """L1-L3 on a table with one row per ``(key, time)``.

    ``label_end`` adds the column of that name: the time of the last row of the
    row's own look-ahead frame, up to which its label looks (NULL without one).
    ``chunk=None`` uses one window per vehicle (simple; fine for many small
    vehicles). A duration string splits each vehicle's series into time
    chunks as described in the module docstring.
    """
    if lookahead < 1:
        raise ValueError("lookahead must be >= 1")
    ends = time_col if label_end else None
    if chunk is None:
        return _apply(df, _sequence_cols(Window.partitionBy(key).orderBy(time_col), lookahead, ends))

    base_cols = df.columns
    wc = Window.partitionBy(key, "_chunk").orderBy(time_col)
    inner = _apply(
        df.withColumn("_chunk", F.window(time_col, chunk).start)
        .withColumn("_rn", F.row_number().over(wc))
        .withColumn("_cnt", F.count(F.lit(1)).over(
            wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))),
        _sequence_cols(wc, lookahead, ends),
    )
    first = F.col("_rn") == 1
    tail = F.col("_rn") > F.col("_cnt") - lookahead
    edge = (F.col("_rn") <= lookahead) | tail
    out_cols = base_cols + [n for n, _ in _sequence_cols(wc, lookahead, ends)]

    # edge rows: few per chunk; one window per vehicle over them is small
    wv = Window.partitionBy(key).orderBy(time_col)
    v, s = F.col("hv_battery_voltage"), F.col("hv_soc")
    edges = (
        inner.filter(edge)
        .withColumn("_pv", F.lag(v, 1).over(wv))
        .withColumn("_ps", F.lag(s, 1).over(wv))
        .withColumn("_vc", v - F.col("_pv"))
        .withColumn("_fut", F.max(F.abs(F.col("_vc"))).over(wv.rowsBetween(1, lookahead)))
    )
    if label_end:
        edges = edges.withColumn("_end", F.max(time_col).over(wv.rowsBetween(1, lookahead)))
    fixed = edges.select(
        *[c for c in base_cols],
        F.when(first, F.col("_pv")).otherwise(F.col("previous_voltage")).alias("previous_voltage"),
        F.when(first, F.col("_ps")).otherwise(F.col("previous_soc")).alias("previous_soc"),
        F.when(first, F.col("_vc")).otherwise(F.col("voltage_change")).alias("voltage_change"),
        F.when(first, s - F.col("_ps")).otherwise(F.col("soc_change")).alias("soc_change"),
        F.when(tail, F.col("_fut")).otherwise(F.col("future_max_voltage_change"))
        .alias("future_max_voltage_change"),
        *([F.when(tail, F.col("_end")).otherwise(F.col(LABEL_END)).alias(LABEL_END)] if label_end else []),
    )
    interior = inner.filter(~edge).select(*out_cols)
    return interior.unionByName(fixed.select(*out_cols))


def _floor_div(c, by: int):
    """Whole quotient towards minus infinity, in whole numbers."""
    return F.call_function("div", c - F.pmod(c, F.lit(by)), F.lit(by))


def horizon_max(
    df: DataFrame,
    horizon: str,
    *,
    value: str | None = None,
    key: str = "vehicle_id",
    time_col: str = "time",
    chunk: str | None = "auto",
    out: str = "horizon_max_voltage_change",
) -> DataFrame:
    """L3 by time: the largest ``value`` among a vehicle's rows later than this
    row by at most ``horizon`` (default: absolute ``voltage_change``).

    Unlike a frame of rows it does not reach across gaps: rows further away than
    the horizon do not count, and without a row in reach the result is NULL. Rows
    of equal time do not see each other.

    A series is cut into chunks of ``chunk`` length (``"auto"``: eight horizons;
    None: no cuts). Each row goes to its own chunk and, as halo, to the chunks
    that hold rows at most a horizon before it, so a frame is whole in its
    row's chunk; halo rows are left out of the result. That makes
    ``1 + horizon / chunk`` copies of a row on average, whatever the gaps, and
    groups bounded by the rows of one vehicle in ``chunk + horizon``.
    """
    reach = 1_000_000 * duration_seconds(horizon)
    length = 8 * reach if chunk == "auto" else None if chunk is None else 1_000_000 * duration_seconds(chunk)
    base = df.columns
    seen = F.abs(F.col("voltage_change")) if value is None else F.col(value)
    rows = df.withColumn("_micros", ntz_to_micros(F.col(time_col))).withColumn("_seen", seen)
    by = [key]
    if length is not None:
        rows = rows.withColumn("_own", _floor_div(F.col("_micros"), length))
        rows = rows.withColumn("_first", _floor_div(F.col("_micros") - F.lit(reach), length))
        # A row without a time stays in one copy.
        rows = rows.withColumn("_chunk", F.explode_outer(F.sequence("_first", "_own")))
        by.append("_chunk")
    w = Window.partitionBy(*by).orderBy("_micros").rangeBetween(1, reach)
    found = F.max("_seen").over(w)
    rows = rows.withColumn(out, F.when(F.col("_micros").isNotNull(), found))
    if length is not None:
        rows = rows.filter(F.col("_chunk").eqNullSafe(F.col("_own")))
    return rows.select(*base, out)


def risk_label(df: DataFrame, threshold: float = config.RISK_THRESHOLD_VOLTS) -> DataFrame:
    """L4: 1 when the look-ahead extreme is strictly above ``threshold``; NULL -> 0."""
    return df.withColumn(
        config.LABEL,
        F.when(F.col("future_max_voltage_change") > F.lit(threshold), F.lit(1)).otherwise(F.lit(0)),
    )


def trim_edges(df: DataFrame) -> DataFrame:
    """Drop rows lacking a previous or a future value (after L1/L3)."""
    return df.filter(
        F.col("previous_voltage").isNotNull()
        & F.col("previous_soc").isNotNull()
        & F.col("future_max_voltage_change").isNotNull()
    )


def ml_features(
    windows: DataFrame,
    *,
    band: tuple[float, float] = config.VOLTAGE_BAND,
    threshold: float = config.RISK_THRESHOLD_VOLTS,
    lookahead: int = config.LOOKAHEAD_ROWS,
    chunk: str | None = "1 day",
    label_end: bool = False,
) -> DataFrame:
    """Window table (A2 output) -> ML table: F3, F6, F10, L1-L5 (and ``label_end``, see ``sequence_features``)."""
    valid = windows.filter(in_band("hv_battery_voltage", *band) & F.col("hv_soc").isNotNull())
    seq = sequence_features(ratio_feature(valid), lookahead=lookahead, chunk=chunk, label_end=label_end)
    return trim_edges(risk_label(seq, threshold)).select(*ML_COLUMNS, *([LABEL_END] if label_end else []))


def ml_dataset(
    readings: DataFrame,
    *,
    window: str = config.WINDOW,
    band: tuple[float, float] = config.VOLTAGE_BAND,
    threshold: float = config.RISK_THRESHOLD_VOLTS,
    lookahead: int = config.LOOKAHEAD_ROWS,
    chunk: str | None = "auto",
    label_end: bool = False,
) -> DataFrame:
    """Readings -> ML table (A2 -> F3 -> F10 -> L1..L5).

    The reference's trailing ``dropDuplicates([vehicle_id, time])`` is a no-op
    here: the window aggregate already makes ``(vehicle_id, time)`` unique.
    """
    if chunk == "auto":
        chunk = auto_chunk(window)
    return ml_features(window_pivot_ml(readings, window), band=band, threshold=threshold,
                       lookahead=lookahead, chunk=chunk, label_end=label_end)
