import datetime as dt
import json
import os
import uuid

from pyspark.sql import functions as F

from voltaic.session import scratch_path
from voltaic.streaming import features as sf
from voltaic.streaming import messages as ms


def _write(folder, name, msgs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(m if isinstance(m, str) else json.dumps(m) for m in msgs) + "\n")


def _msg(t, code, value, vehicle="V"):
    return {"vehicle_id": vehicle, "time": t, "value_id": code, "value": value}


def test_parse_edges(spark, tmp_path):
    _write(str(tmp_path), "a.json", [
        _msg("2024-01-01T00:00:01", 1200, 400.0),           # no fraction
        _msg("2024-01-01T00:00:02.500000", 900, 50.0),      # fraction
        "{not json",                                        # malformed
        '{"vehicle_id": "V", "time": "2024-01-01T00:00:03", "value_id": 4.5, "value": 1.0}',  # fractional code
        _msg("yesterday", 4, 1.0),                          # bad time
    ])
    out = sf.to_ntz_times(ms.parse_messages(ms.text_source(spark, str(tmp_path), stream=False)),
                          ("event_time",)).collect()
    assert out[0].event_time == dt.datetime(2024, 1, 1, 0, 0, 1)
    assert out[1].event_time == dt.datetime(2024, 1, 1, 0, 0, 2, 500000)
    assert out[2].vehicle_id is None and out[2].event_time is None
    assert out[3].value_id is None
    assert out[4].event_time is None and out[4].value_id == 4


def test_encode_matches_isoformat(spark):
    df = spark.createDataFrame([("V", dt.datetime(2024, 1, 1, 0, 0, 1), 1200, 400.0),
                                ("V", dt.datetime(2024, 1, 1, 0, 0, 1, 250), 900, 5.0)],
                               "vehicle_id string, time timestamp_ntz, value_id int, value double")
    got = [json.loads(r.value)["time"] for r in ms.encode_messages(df).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 1).isoformat(), dt.datetime(2024, 1, 1, 0, 0, 1, 250).isoformat()]


def test_late_rows_and_state(spark):
    base = scratch_path(spark, "test-stream-" + uuid.uuid4().hex[:8])
    src, out, ck = f"{base}/in", f"{base}/out", f"{base}/ck"

    def run():
        feats = sf.stream_features(sf.stream_windows(ms.text_source(spark, src)), band=(300, 500))
        return sf.run_to_parquet(sf.to_ntz_times(feats), out, ck)

    def window(sec, v, soc=50.0):
        t = (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=sec)).isoformat()
        return [_msg(t, 1200, v), _msg(t, 900, soc)]

    _write(src, "1.json", window(0, 400) + window(10, 410) + window(100, 420))
    run()
    first = {r.time.second + 60 * r.time.minute: r for r in spark.read.parquet(out).collect()}
    # watermark = 100 s - 30 s: windows [0,10) and [10,20) closed, [100,110) open
    assert sorted(first) == [0, 10]
    assert first[10].previous_voltage == 400.0 and first[0].previous_voltage is None
    # a late window inside 30 s of the max (85 s) and one far older (5 s)
    _write(src, "2.json", window(85, 999) + window(5, 300) + window(200, 430))
    q = run()
    got = {r.time.second + 60 * r.time.minute: r for r in spark.read.parquet(out).collect()}
    # [80,90) arrived late but within the watermark; its voltage 999 is out of
    # band, so the state still holds 410 when [100,110) closes
    assert 80 not in got and got[100].previous_voltage == 410.0 and 200 not in got
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators") or [])
    assert dropped >= 1   # the 5 s window (counted after the partial aggregate)
    assert 0 in got and got[0].hv_battery_voltage == 400.0
    assert F is not None


def test_model_invariants_and_roundtrip(spark, tmp_path):
    import __spark_entry__ as E  # noqa: F401
    from voltaic.operators import model as md
    from voltaic.plans.catalog import ev_complete
    from voltaic.operators.split import split_by_rank

    data = split_by_rank(ev_complete(spark, "/root/testdata/sf0.01"))
    train = data.filter("split = 'train'")
    test = data.filter("split = 'test'")
    model = md.train_rf(train, numTrees=5, maxDepth=4)
    imp = md.feature_importance(spark, model).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9
    scored = md.score_rows(model, test)
    probs = [r.risk_probability for r in scored.collect()]
    assert probs and all(0.0 <= p <= 1.0 for p in probs)
    path = md.save_model(model, str(tmp_path / "m"))
    again = md.score_rows(md.load_model(path), test)
    assert again.exceptAll(scored).count() == 0
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan


def test_message_quality_counts(spark, tmp_path):
    _write(str(tmp_path), "q.json", [
        _msg("2024-01-01T00:00:01", 1200, 400.0),
        "{oops",
        _msg("not a time", 4, 1.0),
        '{"vehicle_id": "V", "time": "2024-01-01T00:00:03", "value_id": 4.5, "value": 1.0}',
        '{"vehicle_id": "V", "time": "2024-01-01T00:00:03", "value_id": 4}',
    ])
    r = ms.message_quality(ms.text_source(spark, str(tmp_path), stream=False)).first()
    assert (r.messages, r.malformed, r.bad_time, r.no_code, r.no_value) == (5, 1, 1, 1, 1)


def test_publish_limit_takes_first_in_order(spark):
    df = spark.createDataFrame([("V", dt.datetime(2024, 1, 1, 0, 0, s), 1200, float(s)) for s in (5, 1, 3, 2)],
                               "vehicle_id string, time timestamp_ntz, value_id int, value double")
    got = [json.loads(r.value)["value"] for r in ms.publish_messages(df, limit=2).collect()]
    assert sorted(got) == [1.0, 2.0]


def test_saved_model_carries_feature_order(spark, tmp_path):
    from voltaic import config
    from voltaic.operators import model as md
    from voltaic.operators.split import split_by_time
    from voltaic.plans.catalog import ev_ml

    data = split_by_time(ev_ml(spark, "/root/testdata/sf0.01"), [0.6, 0.8], exact=True)
    m = md.train_rf(data.filter("split = 'train'"), config.FEATURES_SOC_FIRST, impute=True, numTrees=3, maxDepth=3)
    again = md.load_model(md.save_model(m, str(tmp_path / "m")))
    assert md.model_features(again) == config.FEATURES_SOC_FIRST
    assert [r.feature for r in md.feature_importance(spark, again).collect()] != []


def test_state_of_silent_vehicles_is_deleted(spark):
    """Event-time expiry: a gap beyond the time counts as none, a silent vehicle's state goes, and the stream ends by itself."""
    from voltaic.streaming import progress as pg

    base = scratch_path(spark, "test-expiry-" + uuid.uuid4().hex[:8])
    src, out, ck = f"{base}/in", f"{base}/out", f"{base}/ck"

    def run():
        feats = sf.stream_features(sf.stream_windows(ms.text_source(spark, src)), band=(300, 500), state_ttl="60 seconds")
        return sf.run_to_parquet(sf.to_ntz_times(feats), out, ck)

    def window(vehicle, sec, v):
        t = (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=sec)).isoformat()
        return [_msg(t, 1200, v, vehicle), _msg(t, 900, 50.0, vehicle)]

    plain = src.replace("file:", "")
    _write(plain, "1.json", window("A", 0, 400) + window("B", 0, 410) + window("A", 60, 420) + window("B", 61, 1) + window("A", 110, 1))
    run()
    kept = {r["vehicle_id"]: r["time"] for r in pg.last_windows(spark, ck).collect()}
    assert kept == {"A": dt.datetime(2024, 1, 1, 0, 1)}  # 60 s after the windows ended: B at 70 s, A at 130 s; the watermark is at 80 s
    _write(plain, "2.json", window("B", 220, 430) + window("A", 230, 440) + window("A", 240, 450) + window("B", 400, 1))
    run()
    got = {(r["vehicle_id"], r["time"].minute * 60 + r["time"].second): r["previous_voltage"] for r in spark.read.parquet(out).collect()}
    assert got == {("A", 0): None, ("B", 0): None, ("A", 60): 400.0, ("B", 220): None, ("A", 230): None, ("A", 240): 440.0}
    assert pg.last_windows(spark, ck).count() == 0  # the watermark is at 370 s

    table = pg.progress(spark, ck).orderBy("batch_id").collect()
    assert [r["batch_id"] for r in table] == list(range(len(table))) and all(r["committed"] for r in table)
    assert table[-1]["next_watermark"] == dt.datetime(2024, 1, 1, 0, 6, 10)
    os.remove(f"{ck.replace('file:', '')}/commits/{len(table) - 1}")
    assert [r["committed"] for r in pg.progress(spark, ck).orderBy("batch_id").collect()] == [True] * (len(table) - 1) + [False]


def test_redelivered_messages_count_once(spark):
    """Copies in the same and in a later micro-batch, within the watermark's delay."""
    base = scratch_path(spark, "test-redelivery-" + uuid.uuid4().hex[:8])
    src, out, ck = f"{base}/in", f"{base}/out", f"{base}/ck"
    plain = src.replace("file:", "")
    t = [(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)).isoformat() for s in (1, 2, 12, 100)]

    def run():
        win = sf.stream_windows(ms.text_source(spark, src), redelivered=True)
        sf.run_to_parquet(sf.to_ntz_times(win), out, ck)

    _write(plain, "1.json", [_msg(t[0], 1200, 400.0), _msg(t[0], 1200, 400.0), _msg(t[1], 1200, 401.0)])
    run()
    _write(plain, "2.json", [_msg(t[0], 1200, 400.0), _msg(t[1], 1200, 402.0), _msg(t[2], 1200, 500.0)])
    run()
    _write(plain, "3.json", [_msg(t[2], 1200, 500.0), _msg(t[3], 1200, 1.0)])
    run()
    got = {r["time"].second: r["hv_battery_voltage"] for r in spark.read.parquet(out).collect()}
    assert got == {0: (400.0 + 401.0 + 402.0) / 3, 10: 500.0}


def test_console_sink_takes_every_batch(spark, tmp_path):
    """K4: the demonstration sink runs, takes what is there and stops when told."""
    _write(str(tmp_path), "1.json", [_msg("2024-01-01T00:00:01", 1200, 400.0), _msg("2024-01-01T00:00:02", 900, 50.0)])
    query = sf.run_to_console(ms.parse_messages(ms.text_source(spark, str(tmp_path))), num_rows=5)
    try:
        query.processAllAvailable()
        assert query.lastProgress["numInputRows"] == 2 and "ConsoleTable" in query.lastProgress["sink"]["description"]
    finally:
        query.stop()


def test_missing_features_fill_or_drop(spark):
    """Rows with missing features are scored with zeros or left out."""
    from voltaic import config
    from voltaic.operators import model as md
    from voltaic.plans.catalog import ev_complete

    train = ev_complete(spark, "/root/testdata/sf0.01")
    model = md.train_rf(train, numTrees=3, maxDepth=3)
    rows = train.limit(4).withColumn("previous_soc", F.when(F.col("time") != train.limit(4).agg(F.min("time")).first()[0],
                                                              F.col("previous_soc")))
    gaps = rows.filter("previous_soc IS NULL").count()
    assert gaps and sf.score_stream(rows, model).count() == 4
    assert sf.score_stream(rows, model, missing="drop").count() == 4 - gaps
    assert config.LABEL in rows.columns
