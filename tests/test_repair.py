import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from voltaic.functions.timefix import nanos_to_micros, repair_time, to_millis
from voltaic.sources.raw import normalize_sources, repair_readings, scan_nanos

LIMIT = 1704067200000000000


def _ns(ts: dt.datetime) -> int:
    return int((ts - dt.datetime(1970, 1, 1)).total_seconds()) * 10**9


def test_repair_edges(spark):
    data = [
        (1, LIMIT),                                   # equal to the limit: unchanged
        (2, LIMIT + 1000),                            # just after: shifted 64 years back
        (3, _ns(dt.datetime(2088, 2, 29, 12, 0))),    # leap day with a twin
        (4, _ns(dt.datetime(2164, 2, 29, 0, 0))),     # 2100 is no leap year: Feb 28
        (5, None),
        (6, _ns(dt.datetime(2020, 5, 1)) + 123),      # sub-microsecond digits below the limit
    ]
    df = spark.createDataFrame(data, "id int, ns long")
    out = {r.id: r.t for r in df.select("id", repair_time("ns").alias("t")).collect()}
    assert out[1] == dt.datetime(2024, 1, 1)
    assert out[2] == dt.datetime(1960, 1, 1, 0, 0, 0, 1)
    assert out[3] == dt.datetime(2024, 2, 29, 12, 0)
    assert out[4] == dt.datetime(2100, 2, 28)
    assert out[5] is None
    assert out[6] == dt.datetime(2020, 5, 1)


def test_strict_cast_raises_on_lost_digits(spark):
    df = spark.createDataFrame([(_ns(dt.datetime(2020, 1, 1)) + 1,)], "ns long")
    with pytest.raises(Exception, match="nanosecond digits"):
        df.select(nanos_to_micros("ns", "strict")).collect()
    got = df.select(nanos_to_micros("ns", "truncate").alias("t")).first().t
    assert got == dt.datetime(2020, 1, 1)


def test_millis_strict(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 0, 0, 1500),)], "t timestamp_ntz")
    with pytest.raises(Exception, match="microsecond digits"):
        df.select(to_millis("t", "strict")).collect()
    assert df.select(to_millis("t", "truncate").alias("m")).first().m == dt.datetime(2020, 1, 1, 0, 0, 0, 1000)


def test_scan_real_nanosecond_parquet(spark, tmp_path):
    times = [dt.datetime(2088, 1, 2, 3, 4, 5), dt.datetime(2023, 6, 1)]
    table = pa.table({
        "vehicle_id": ["CUP1", "CUP1"],
        "time": pa.array([_ns(t) for t in times], pa.int64()).cast(pa.timestamp("ns")),
        "value_id": pa.array([1200, 900], pa.int32()),
        "value": [400.0, 55.0],
    })
    path = str(tmp_path / "cup1.parquet")
    pq.write_table(table, path)
    raw = scan_nanos(spark, path)
    assert dict(raw.dtypes)["time_ns"] == "bigint"
    out = repair_readings(raw).orderBy("value_id").collect()
    assert out[0].time == dt.datetime(2023, 6, 1) and not out[0].corrected
    assert out[1].time == dt.datetime(2024, 1, 2, 3, 4, 5) and out[1].corrected


def test_normalize_only_listed_sources(spark):
    ns = _ns(dt.datetime(2090, 1, 1))
    raw = spark.createDataFrame([("A", "v", ns, 1, 1.0), ("B", "v", ns, 1, 1.0)],
                                "source string, vehicle_id string, time_ns long, value_id int, value double")
    got = {r.source: (r.time, r.corrected) for r in normalize_sources(raw, ["A"]).collect()}
    assert got["A"] == (dt.datetime(2026, 1, 1), True)
    assert got["B"] == (dt.datetime(2090, 1, 1), False)
    assert F is not None


def test_sources_from_file_names(spark, tmp_path):
    from voltaic.sources.raw import sources_from_files

    paths = {}
    for name, t in (("CUP1", dt.datetime(2088, 3, 1)), ("ID1", dt.datetime(2023, 3, 1))):
        table = pa.table({"vehicle_id": [name], "time": pa.array([_ns(t)], pa.int64()).cast(pa.timestamp("ns")),
                          "value_id": pa.array([1200], pa.int32()), "value": [400.0]})
        paths[name] = str(tmp_path / f"{name}_raw.parquet")
        pq.write_table(table, paths[name])
    norm = normalize_sources(sources_from_files(spark, paths), ["CUP1"])
    got = {r.source: (r.time, r.corrected) for r in norm.collect()}
    assert got == {"CUP1": (dt.datetime(2024, 3, 1), True), "ID1": (dt.datetime(2023, 3, 1), False)}


def test_results_do_not_depend_on_the_session_zone(spark):
    """Repair, unit casts and the stream's wall-clock/instant round trip give
    the same answers under a zone with daylight saving time."""
    from voltaic.functions.timefix import micros_to_ntz, ntz_to_micros
    from voltaic.streaming.messages import instant_to_ntz, ntz_to_instant

    walls = [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 11, 3, 1, 30), dt.datetime(1969, 12, 31, 23, 59, 59, 1)]
    df = spark.createDataFrame([(w,) for w in walls], "w timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            out = df.select(
                ntz_to_micros("w").alias("us"),
                micros_to_ntz(ntz_to_micros("w")).alias("back"),
                instant_to_ntz(ntz_to_instant(F.col("w"))).alias("round_trip"),
                repair_time(F.lit(LIMIT + 10**9)).alias("repaired"),
            ).collect()
            results.append([tuple(r) for r in out])
        assert results[0] == results[1]
        assert [r[1] for r in results[0]] == walls and [r[2] for r in results[0]] == walls
        assert results[0][2][0] == -999999
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_nanoseconds_are_exact(spark):
    """Random nanoseconds from 1900 to 2200 against Python integers; strict mode keeps or raises."""
    import random

    import pytest

    from voltaic.functions.timefix import nanos_to_micros, repair_time

    rnd = random.Random(8)
    ns = [rnd.randrange(-2_208_988_800, 7_258_118_400) * 10**9 + rnd.randrange(10**9) for _ in range(4000)]
    ns += [n // 1_000_000 * 1_000_000 for n in ns] + [n // 10**10 * 10**10 - 1 for n in ns[:200]]
    epoch = dt.datetime(1970, 1, 1)
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    for out in (nanos_to_micros("n", "truncate"), repair_time("n", limit_ns=2**63 - 1)):
        for r in df.select("n", out.alias("t")).collect():
            assert r.t == epoch + dt.timedelta(microseconds=r.n // 1000)
    whole = df.filter(F.pmod("n", F.lit(1000)) == 0)
    assert all(r.t == epoch + dt.timedelta(microseconds=r.n // 1000)
               for r in whole.select("n", nanos_to_micros("n").alias("t")).collect())
    with pytest.raises(Exception, match="nanosecond digits"):
        df.select(nanos_to_micros("n")).collect()


def test_sources_by_folder_and_equal_names(spark, tmp_path):
    import pytest

    from voltaic.sources.files import load_folder
    from voltaic.sources.raw import sources_from_files

    for name, year in (("A", 2088), ("B", 2023)):
        (tmp_path / name).mkdir()
        for part in ("readings.parquet", "more.parquet"):
            table = pa.table({"vehicle_id": [name], "value_id": pa.array([1200], pa.int32()), "value": [400.0],
                              "time": pa.array([_ns(dt.datetime(year, 3, 1))], pa.int64()).cast(pa.timestamp("ns"))})
            pq.write_table(table, tmp_path / name / part)
    for paths in ({n: str(tmp_path / n) for n in "AB"}, {n: str(tmp_path / n / "readings.parquet") for n in "AB"}):
        rows = normalize_sources(sources_from_files(spark, paths), ["A"]).collect()
        assert len(rows) in (2, 4)
        assert all(r.source == r.vehicle_id and r.corrected == (r.source == "A") for r in rows)
        assert {r.time.year for r in rows} == {2024, 2023}
    with pytest.raises(ValueError):
        sources_from_files(spark, {"A": str(tmp_path / "A"), "B": str(tmp_path / "A") + "/"})
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources_from_files(spark, {"A": str(tmp_path / "nowhere")})
    with pytest.raises(Exception, match="no source"):
        normalize_sources(sources_from_files(spark, {"A": str(tmp_path / "A")}).withColumn(
            "source", F.lit(None).cast("string"))).collect()
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
    assert [r.time for r in load_folder(spark, str(tmp_path / "A")).collect()] == [dt.datetime(2088, 3, 1)] * 2
    assert load_folder(spark, str(tmp_path / "nowhere")).count() == 0


def test_dedup_and_describe_edges(spark):
    from voltaic.operators.profile import dedup, describe_columns

    rows = [("k", None, None), ("k", 5.0, 1.0), ("k", 7.0, 0.0), ("n", None, 2.0)]
    df = spark.createDataFrame(rows, "key string, v double, w double")
    one = {r.key: r.v for r in dedup(df.select("key", "v"), ["key"], ["v"]).collect()}
    two = {r.key: (r.v, r.w) for r in dedup(df, ["key"], ["v"]).collect()}
    assert one == {"k": 5.0, "n": None} and two == {"k": (5.0, 1.0), "n": (None, 2.0)}
    empty = describe_columns(df.limit(0), ["v", "w"]).collect()
    assert [(r.column, r["count"], r["mean"]) for r in empty] == [("v", 0, None), ("w", 0, None)]
