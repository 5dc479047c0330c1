"""Incremental windows, clustered tables, sketches, node tables, footers, purge, horizon and running totals."""
import datetime as dt
import hashlib
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from voltaic.operators import cumulative, sketches
from voltaic.operators.features import horizon_max, sequence_features
from voltaic.operators.split import purged_split
from voltaic.operators.windows import window_wide
from voltaic.sources import clustered
from voltaic.sources import files as fs
from voltaic.sources import incremental as inc

DAY0 = dt.datetime(2024, 3, 1)
CODES = (4, 15, 56, 900, 1200, 1208, 1209)


def readings(spark, days, vehicles=("A", "B"), step=3600, bump=0.0):
    rows = [(v, DAY0 + dt.timedelta(days=d, seconds=s), c, float(c % 7 + d + bump))
            for v in vehicles for d in days for s in range(0, 86400, step) for c in CODES]
    return spark.createDataFrame(rows, "vehicle_id string, time timestamp_ntz, value_id int, value double")


def contents(folder):
    out = {}
    for where, _, names in os.walk(folder):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(where, n), "rb") as f:
                    out[os.path.relpath(os.path.join(where, n), folder)] = hashlib.md5(f.read()).hexdigest()
    return out


def as_set(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_incremental_windows(spark, tmp_path):
    src, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))

    def update():
        done = inc.update_windows(spark, src, out, log, window="1 hour")
        whole = spark.read.parquet(src)
        assert as_set(inc.read_windows(spark, out)) == as_set(window_wide(whole, "1 hour"))
        return done

    readings(spark, range(4)).coalesce(1).write.parquet(src)
    assert update() == {"new": 1, "changed": 0, "gone": 0, "days": 4}
    before = contents(out)
    assert update()["days"] == 0 and contents(out) == before
    # a second delivery: a new day and late readings of day 1
    readings(spark, [1, 4], ("C",)).coalesce(1).write.mode("append").parquet(src)
    assert update() == {"new": 1, "changed": 0, "gone": 0, "days": 2}
    after = contents(out)
    touched = [k for k in before if "2024-03-02" in k]
    assert touched and all(after[k] == before[k] for k in before if k not in touched)
    # killed before the manifest was written: the same days are done again, with the same result
    kept = sorted(os.listdir(log))
    readings(spark, [2], ("D",)).coalesce(1).write.mode("append").parquet(src)
    assert update()["days"] == 1
    for name in set(os.listdir(log)) - set(kept):
        os.remove(os.path.join(log, name))
    assert update() == {"new": 1, "changed": 0, "gone": 0, "days": 1}
    # a file is taken away: the windows that only it held go, and so does a day without windows
    first = next(f for f in os.listdir(src) if f.endswith(".parquet") and
                 pq.read_table(os.path.join(src, f)).column("vehicle_id").to_pylist()[0] == "C")
    os.remove(os.path.join(src, first))
    assert update() == {"new": 0, "changed": 0, "gone": 1, "days": 2}
    assert not any("2024-03-05" in k for k in contents(out))


def test_incremental_update_of_an_empty_folder(spark, tmp_path):
    src = str(tmp_path / "in")
    readings(spark, []).write.parquet(src)
    for _ in range(2):
        assert inc.update_windows(spark, src, str(tmp_path / "out"), str(tmp_path / "log"), window="1 hour")["days"] == 0


def files_read(df):
    """Files that the scan opened, from the plan's own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    stack, found = [plan], 0
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
        if node.metrics().contains("numFiles"):
            found += node.metrics().apply("numFiles").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return found


def test_clustered_slice_opens_few_files(spark, tmp_path):
    df = readings(spark, range(20), [f"V{i}" for i in range(12)], step=21600).union(
        spark.createDataFrame([(None, None, 4, 1.0)], "vehicle_id string, time timestamp_ntz, value_id int, value double"))
    path = clustered.write_clustered(df, str(tmp_path / "t"), files=40)
    index = clustered.file_index(spark, path).collect()
    assert sum(r["rows"] for r in index) == df.count() and len(index) > 30
    assert sum(r["nulls_vehicle_id"] for r in index) == 1
    got = clustered.read_slice(spark, path, vehicle="V7", start="2024-03-05", end="2024-03-06")
    want = df.filter("vehicle_id = 'V7' AND time >= '2024-03-05' AND time < '2024-03-07'")
    assert as_set(got) == as_set(want) and got.count() == 2 * 4 * 7
    assert 1 <= files_read(got) <= 4
    assert as_set(clustered.read_slice(spark, path)) == as_set(df)
    assert clustered.read_slice(spark, path, vehicle="none").count() == 0


def test_merged_sketches_hold_the_bound(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.5 else f"v{rng.randrange(5)}", DAY0 + dt.timedelta(hours=rng.randrange(240)), 1200,
             rng.choice([float("nan"), None, 7.0, rng.gauss(0, 1), rng.expovariate(1)])) for _ in range(30_000)]
    df = spark.createDataFrame(rows, "vehicle_id string, time timestamp_ntz, value_id int, value double")
    daily = sketches.daily_sketches(df, k=200)
    found = sketches.quantiles(sketches.merged(daily, ["vehicle_id"], k=200), [0.0, 0.01, 0.5, 0.99, 1.0])
    held = sketches.within_bound(found, df, ["vehicle_id"], error=sketches.rank_error(200)).collect()
    assert len(held) == 30 and all(r["rank_error_ok"] for r in held)
    tight = sketches.within_bound(found.withColumn("estimate", F.col("estimate") + 1), df, ["vehicle_id"], error=0.01)
    assert not all(r["rank_error_ok"] for r in tight.collect())
    part = sketches.merged(daily, ["vehicle_id"], start="2024-03-03", end="2024-03-04", k=200)
    true = df.filter("to_date(time) BETWEEN '2024-03-03' AND '2024-03-04' AND value IS NOT NULL AND NOT isnan(value)")
    assert {r[0]: r[1] for r in part.select("vehicle_id", "readings").collect()} == {
        r[0]: r[1] for r in true.groupBy("vehicle_id").count().collect()}


@pytest.mark.parametrize("rows,bucket", [(0, 10), (1, 10), (999, 10), (5000, 7), (300, 1000)])
def test_two_level_running_totals(spark, rows, bucket):
    rng = random.Random(rows)
    values = sorted({rng.choice([rng.gauss(0, 1), rng.random() * 1e-9, 1e300 * rng.random()]) for _ in range(rows)})
    data = [(v, rng.randrange(5)) for v in values]
    df = spark.createDataFrame(data, "s double, x long")
    for descending in (True, False):
        got = {r["s"]: r["cum_x"] for r in cumulative.running_totals(df, "s", ["x"], descending=descending,
                                                                     bucket_rows=bucket).collect()}
        total, want = 0, {}
        for s, x in (reversed(data) if descending else data):
            total += x
            want[s] = total
        assert got == want


def test_running_totals_have_no_global_window(spark):
    """No exchange of rows or buckets to one task, and as many driver values whatever the number of rows."""
    df = spark.range(2000).select((F.col("id") * 0.5).alias("s"), F.lit(1).alias("x"))
    plan = cumulative.running_totals(df, "s", ["x"], bucket_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    for n in (10, 10**6, 10**9, 10**15):
        coarse, fine = cumulative.fan_out(n, 50_000)
        assert 1 <= coarse <= cumulative.COARSE and 1 <= fine <= cumulative.FINE
    coarse, fine = cumulative.fan_out(10**10, 50_000)
    assert coarse * fine >= 10**10 / 50_000


def test_purged_split_keeps_labels_on_their_side(spark):
    rng = random.Random(2)
    rows = [(v, DAY0 + dt.timedelta(minutes=m), 50.0, rng.uniform(300, 500))
            for v, every in (("slow", 97), ("fast", 3), ("hot", 1)) for m in range(0, 3000, every)]
    df = spark.createDataFrame(rows, "vehicle_id string, time timestamp_ntz, hv_soc double, hv_battery_voltage double")
    seq = sequence_features(df, lookahead=6, chunk="1 hour", label_end=True)
    times = {}
    for v, t, *_ in rows:
        times.setdefault(v, []).append(t)
    for r in seq.collect():
        later = [t for t in sorted(times[r["vehicle_id"]]) if t > r["time"]][:6]
        assert r["label_end"] == (later[-1] if later else None)
    got = purged_split(seq, order=("time", "vehicle_id")).collect()
    order = sorted((t, v) for v, ts in times.items() for t in ts)
    ends = {"train": order[int(len(order) * 0.6) - 1], "validation": order[int(len(order) * 0.8) - 1]}
    kept = {(r["time"], r["vehicle_id"]) for r in got}
    for r in got:
        if r["split"] in ends and r["label_end"] is not None:
            assert (r["label_end"], r["vehicle_id"]) <= ends[r["split"]]
    gone = [r for r in seq.collect() if (r["time"], r["vehicle_id"]) not in kept]
    assert {r["vehicle_id"] for r in gone} == {"slow", "fast", "hot"}
    for r in gone:
        here = (r["time"], r["vehicle_id"])
        part = "train" if here <= ends["train"] else "validation"
        assert here <= ends[part] < (r["label_end"], r["vehicle_id"])


@pytest.mark.parametrize("chunk", [None, "auto", "10 minutes", "1 hour"])
def test_horizon_against_brute_force(spark, chunk):
    rng = random.Random(9)
    rows = []
    for v in ("a", "b"):
        t = dt.datetime(1969, 12, 31, 20)
        for _ in range(150):
            t += dt.timedelta(seconds=rng.choice([1, 60, 60, 1800, 1801, 90_000]), microseconds=rng.randrange(2))
            rows.append((v, t, rng.choice([None, rng.gauss(0, 5)])))
    rows += [("a", None, 1.0), (None, DAY0, 2.0), rows[3]]
    df = spark.createDataFrame(rows, "vehicle_id string, time timestamp_ntz, voltage_change double")
    got = horizon_max(df, "30 minutes", chunk=chunk).collect()
    assert len(got) == len(rows)
    for r in got:
        reach = [abs(x) for v, t, x in rows if v == r["vehicle_id"] and x is not None and t is not None and r["time"] is not None
                 and r["time"] < t <= r["time"] + dt.timedelta(minutes=30)]
        assert r["horizon_max_voltage_change"] == (max(reach) if reach else None)


def test_folder_with_every_kind_of_time(spark, tmp_path):
    """Wall clocks, instants, nanoseconds and texts with and without an offset, under a zone with daylight saving time."""
    folder = tmp_path / "f"
    folder.mkdir()
    ns = 1_709_999_999_123_456_789
    utc = dt.timezone.utc
    tables = {
        "wall": pa.array([dt.datetime(2024, 3, 10, 2, 30)], pa.timestamp("us")),
        "instant": pa.array([dt.datetime(2024, 3, 10, 7, 30, tzinfo=utc)], pa.timestamp("us", "UTC")),
        "nanos": pa.array([ns], pa.timestamp("ns")),
        "nanos_utc": pa.array([-1], pa.timestamp("ns", "UTC")),
        "text": pa.array(["2024-03-10 02:30:00", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.5+02:00", "noon", None, "2024-01-05"]),
    }
    for name, time in tables.items():
        n = len(time)
        table = pa.table({"id": [f"{name}{i}" for i in range(n)], "time": time, **({"extra": [1.5] * n} if name == "wall" else {})})
        pq.write_table(table, folder / f"{name}.parquet", coerce_timestamps=None, version="2.6")
    pq.write_table(pa.table({"id": ["none"], "x": [3]}), folder / "none.parquet")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = fs.load_folder(spark, str(folder))
        assert dict(df.dtypes)["time"] == "timestamp_ntz" and set(df.columns) == {"id", "time", "extra", "x"}
        got = {r["id"]: r["time"] for r in df.collect()}
        one = fs.load_folder(spark, str(folder / "instant.parquet"))
        assert dict(one.dtypes)["time"] == "timestamp_ntz" and one.first()["time"] == dt.datetime(2024, 3, 10, 7, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {
        "wall0": dt.datetime(2024, 3, 10, 2, 30), "instant0": dt.datetime(2024, 3, 10, 7, 30),
        "nanos0": dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=ns // 1000),
        "nanos_utc0": dt.datetime(1969, 12, 31, 23, 59, 59, 999999), "none": None,
        "text0": dt.datetime(2024, 3, 10, 2, 30), "text1": dt.datetime(2024, 1, 1), "text2": dt.datetime(2023, 12, 31, 22, 0, 0, 500000),
        "text3": None, "text4": None, "text5": dt.datetime(2024, 1, 5),
    }


def test_footers_of_many_files_take_one_job(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(60):
        time = pa.array([DAY0], pa.timestamp("us")) if i % 2 else pa.array([DAY0.isoformat()])
        pq.write_table(pa.table({"time": time, "v": [i]}), folder / f"part {i:03d}.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        rows = fs.read_footers(spark, str(folder)).collect()
        jobs = tracker.getJobIdsForGroup("footers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(rows) == 60 and {r["kind"] for r in rows} == {"wall", "text"}
    assert len(jobs) <= 2  # the footers, and the parallel listing that Spark starts for many paths
    got = fs.load_folder(spark, str(folder))
    assert sorted(r["v"] for r in got.collect()) == list(range(60)) and got.select("time").distinct().count() == 1
