import datetime as dt

from voltaic.operators import report as rp


def test_vehicle_slice_is_inclusive_by_date(spark):
    times = [dt.datetime(2024, 1, 4, 23, 59, 59, 999999), dt.datetime(2024, 1, 5),
             dt.datetime(2024, 1, 10, 23, 59, 59, 999999), dt.datetime(2024, 1, 11)]
    df = spark.createDataFrame([("V3", t) for t in times] + [("V1", times[1])], "vehicle_id string, time timestamp_ntz")
    got = sorted(r.time for r in rp.vehicle_slice(df, "V3", "2024-01-05", "2024-01-10").collect())
    assert got == times[1:3]
    assert rp.vehicle_slice(df, "V3").count() == 4


def test_present_columns_and_latest(spark):
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), None, 1.0), ("A", dt.datetime(2024, 1, 2), None, 2.0)],
                               "vehicle_id string, time timestamp_ntz, hv_temp_min double, hv_soc double")
    present = {r.column for r in rp.present_columns(df, ["hv_temp_min", "hv_soc", "missing"]).collect()}
    assert present == {"hv_soc"}
    for unique in (False, True):
        latest = rp.latest_reading(df, ["hv_soc"], unique_time=unique).first()
        assert latest.hv_soc == 2.0 and latest.time == dt.datetime(2024, 1, 2)


def test_label_names_and_risk_share(spark):
    df = spark.createDataFrame([("A", 1), ("A", 0), ("A", 0), ("B", None)], "vehicle_id string, maintenance_risk int")
    names = [(r.label, r.windows) for r in rp.label_names(df).collect()]
    assert names == [("Normal proxy label", 2), ("Elevated-risk proxy label", 1)]
    risk = {r.vehicle_id: (r.risk_count, r.labelled, r.risk_percentage) for r in rp.vehicle_risk(df).collect()}
    assert risk["A"][0] == 1 and abs(risk["A"][2] - 100 / 3) < 1e-12
    assert risk["B"] == (0, 0, None)


def test_dedup_keeps_first_by_stated_order(spark):
    from voltaic.operators.profile import dedup

    df = spark.createDataFrame([("A", 1, 5.0, "x"), ("A", 1, 2.0, "y"), ("A", 1, 2.0, "b"), ("B", 2, 9.0, "z")],
                               "vehicle_id string, k int, value double, tag string")
    got = {(r.vehicle_id, r.k): (r.value, r.tag) for r in dedup(df, ["vehicle_id", "k"], ["value"]).collect()}
    assert got == {("A", 1): (2.0, "b"), ("B", 2): (9.0, "z")}   # ties on value broken by the rest
    one = dedup(df.drop("tag"), ["vehicle_id", "k"], ["value"])
    assert one.columns == ["vehicle_id", "k", "value"]
    assert {(r.vehicle_id, r.value) for r in one.collect()} == {("A", 2.0), ("B", 9.0)}
