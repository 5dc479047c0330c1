import datetime as dt
import math
import random

from pyspark.sql import functions as F

from voltaic.operators.features import ml_dataset, ml_features, sequence_features
from voltaic.operators.windows import window_pivot, window_wide
from voltaic.sources.readings import READING_SCHEMA

T0 = dt.datetime(2024, 3, 1)


def readings(spark, data):
    return spark.createDataFrame(data, READING_SCHEMA)


def test_pivot_edges(spark):
    data = [
        ("A", T0, 1200, 400.0),
        ("A", T0 + dt.timedelta(seconds=9, microseconds=999999), 1200, 420.0),
        ("A", T0 + dt.timedelta(seconds=10), 1200, 430.0),   # belongs to the second window
        ("A", None, 1200, 1.0),                               # NULL time: dropped by window
        ("A", T0, None, 5.0),                                 # NULL code: not in the list
        ("A", T0, 900, None),                                 # NULL value: ignored by avg
        ("A", T0, 4, float("nan")),                           # NaN propagates into the mean
        ("A", T0, 7777, 3.0),                                 # unknown code
    ]
    out = window_pivot(readings(spark, data)).orderBy("time").collect()
    assert len(out) == 2
    first, second = out
    assert first.hv_battery_voltage == 410.0 and first.hv_soc is None
    assert math.isnan(first.vehicle_speed)
    assert first.window_end == T0 + dt.timedelta(seconds=10)
    assert second.time == T0 + dt.timedelta(seconds=10) and second.hv_battery_voltage == 430.0
    assert first.hv_temp_min is None


def test_window_wide_temperature_columns(spark):
    data = [("A", T0, 900, 50.0), ("A", T0, 1200, 400.0), ("A", T0, 1208, 20.0), ("A", T0, 1209, 30.0),
            ("B", T0, 900, 50.0), ("B", T0, 1200, 400.0), ("B", T0, 1208, 20.0),
            ("C", T0, 900, 50.0)]
    got = {r.vehicle_id: r for r in window_wide(readings(spark, data)).collect()}
    assert set(got) == {"A", "B"}
    assert got["A"].battery_temp_avg == 25.0 and got["A"].battery_temp_delta == 10.0
    assert got["A"].temperature_available == 1
    assert got["B"].battery_temp_avg is None and got["B"].temperature_available == 0


def test_band_edges(spark):
    volts = [299.99, 300.0, 500.0, 500.01, float("nan"), None]
    socs = [50.0, 0.0, -1.0, None]
    data = []
    for i, v in enumerate(volts):
        for j, s in enumerate(socs):
            t = T0 + dt.timedelta(seconds=10 * (i * len(socs) + j))
            if v is not None:
                data.append(("A", t, 1200, v))
            if s is not None:
                data.append(("A", t, 900, s))
    win = window_pivot(readings(spark, data), with_end=False)
    ml = ml_features(win, chunk=None).collect()
    kept = {(r.hv_battery_voltage, r.hv_soc) for r in ml}
    assert all(300 <= v <= 500 for v, _ in kept)
    assert all(s is not None for _, s in kept)
    ratios = {(r.hv_soc, r.voltage_per_soc) for r in ml}
    assert all((s > 0) == (q is not None) for s, q in ratios)


def _series(spark, lengths, seed=7, gap_every=5):
    rnd = random.Random(seed)
    data = []
    for vi, n in enumerate(lengths):
        t = T0
        for k in range(n):
            t += dt.timedelta(seconds=10 * (1 + (gap_every * 97 if k % gap_every == 0 else 0)))
            data.append((f"V{vi}", t, 1200, 300.0 + rnd.choice([0, 5, 20, 20.0001, 35, 80]) * rnd.choice([-1, 1]) + 100))
            data.append((f"V{vi}", t, 900, 10 + rnd.random() * 80))
    return window_pivot(readings(spark, data), with_end=False)


def test_chunked_equals_per_vehicle_window(spark):
    win = _series(spark, [1, 2, 8, 40, 130], gap_every=7).cache()
    base = ml_features(win, chunk=None)
    for chunk in ["30 seconds", "2 minutes", "1 hour", "1 day"]:
        got = ml_features(win, chunk=chunk)
        assert got.exceptAll(base).count() == 0 and base.exceptAll(got).count() == 0, chunk
    seq_a = sequence_features(win, chunk=None)
    seq_b = sequence_features(win, chunk="40 seconds")
    assert seq_a.exceptAll(seq_b).count() == 0 and seq_b.exceptAll(seq_a).count() == 0


def test_lookahead_edges(spark):
    # voltages chosen so the change is exactly 20 once (not a risk: strict >)
    volts = [400, 420, 420, 441, 441, 441, 441, 441, 441]
    data = []
    for k, v in enumerate(volts):
        t = T0 + dt.timedelta(seconds=10 * k)
        data += [("A", t, 1200, float(v)), ("A", t, 900, 50.0)]
    data += [("ONE", T0, 1200, 400.0), ("ONE", T0, 900, 50.0)]
    out = ml_dataset(readings(spark, data), chunk="20 seconds").orderBy("time").collect()
    assert all(r.vehicle_id == "A" for r in out)
    labels = [r.maintenance_risk for r in out]
    futs = [r.future_max_voltage_change for r in out]
    assert futs[0] == 21.0 and labels[0] == 1          # row 2 looks at 420->441 = 21
    assert len(out) == len(volts) - 2                   # first and last row trimmed
    assert labels[-1] == 0


def test_ml_dataset_plan_has_no_python_and_prunes(spark):
    win = _series(spark, [5])
    plan = ml_features(win)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    from voltaic.sources.readings import events_as_readings
    df = ml_dataset(events_as_readings(spark, "/root/testdata/sf0.001"), window="6 hours", chunk=None)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in text.split("ReadSchema")[-1].split("\n")[0]
    assert F is not None
