"""The stage jobs end to end on readings derived from the test tables."""
import uuid

from voltaic import jobs
from voltaic.session import scratch_path
from voltaic.sources.files import write_dataset
from voltaic.sources.readings import events_as_readings
from voltaic.streaming import features as sf
from voltaic.streaming import messages as ms


def test_batch_jobs_and_stream_scoring(spark):
    base = scratch_path(spark, "test-jobs-" + uuid.uuid4().hex[:8])
    readings = write_dataset(events_as_readings(spark, "/root/testdata/sf0.01"), f"{base}/readings")
    processed = jobs.preprocess(spark, readings, f"{base}/processed", window="6 hours")
    assert processed.count() == 690
    dist = {r.maintenance_risk: r["count"] for r in
            jobs.build_ml_dataset(spark, readings, f"{base}/ml", window="6 hours", band=(5.0, 150.0),
                                  threshold=60.0).collect()}
    assert dist == {0: 354, 1: 287}
    out = jobs.train_valid_test(spark, f"{base}/ml", f"{base}/model", numTrees=5, maxDepth=4)
    assert {r.split: r["count"] for r in out["split_counts"].groupBy("split").sum("count")
            .withColumnRenamed("sum(count)", "count").collect()} == {"train": 287, "validation": 96, "test": 96}
    sweep = jobs.evaluate_threshold(spark, f"{base}/ml", f"{base}/model", csv_path=f"{base}/metrics")
    assert sweep.count() == 4
    t = jobs.train_time_split(spark, f"{base}/ml", f"{base}/model2", numTrees=5, maxDepth=4, exact=True)
    assert t["test_at_best"].count() == 1
    e = jobs.train_evaluate_80(spark, f"{base}/ml", f"{base}/model3", numTrees=5, maxDepth=4, exact=True)
    cells = e["test_cells"].first()
    assert sum(cells) == e["split_counts"].filter("split = 'test'").groupBy().sum("count").first()[0]
    assert e["threshold_analysis"].count() == 9 and e["test_auc"].count() == 1
    # streaming scoring job: start, process what is there, stop
    src = ms.write_text(ms.publish_messages(events_as_readings(spark, "/root/testdata/sf0.001")), f"{base}/in")
    q = jobs.stream_scoring(spark, ms.text_source(spark, src), f"{base}/model", f"{base}/scores",
                            f"{base}/ck", window="6 hours", band=(5.0, 150.0), processing_time="1 second")
    q.processAllAvailable()
    q.stop()
    scores = spark.read.parquet(f"{base}/scores").collect()
    assert len(scores) > 0 and all(0.0 <= r.risk_probability <= 1.0 for r in scores)
    assert {r.prediction for r in scores} <= {0.0, 1.0}
    idem = sf.foreach_batch_to_parquet(
        sf.stream_windows(ms.text_source(spark, src), window="6 hours"), f"{base}/fb", f"{base}/fbck")
    assert idem is not None and spark.read.parquet(f"{base}/fb").count() > 0


def test_normalize_job_writes_one_folder_per_source(spark, tmp_path):
    import datetime as dt
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    def ns(t):
        return int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 10**9

    paths = {}
    for name, times in (("CUP1", [dt.datetime(2088, 1, 1), dt.datetime(2088, 1, 2)]), ("ID2", [dt.datetime(2023, 1, 1)])):
        table = pa.table({"vehicle_id": [name] * len(times),
                          "time": pa.array([ns(t) for t in times], pa.int64()).cast(pa.timestamp("ns")),
                          "value_id": pa.array([1200] * len(times), pa.int32()), "value": [400.0] * len(times)})
        paths[name] = str(tmp_path / f"{name}.parquet")
        pq.write_table(table, paths[name])
    out = str(tmp_path / "normalized")
    acct = {r.source: (r.rows, r.corrected_rows) for r in jobs.normalize(spark, paths, out, repaired=["CUP1"]).collect()}
    assert acct == {"CUP1": (2, 2), "ID2": (1, 0), None: (3, 2)}
    assert sorted(d for d in os.listdir(out) if d.startswith("source=")) == ["source=CUP1", "source=ID2"]
    times = sorted(r.time for r in spark.read.parquet(out).collect())
    assert times == [dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]


def test_report_jobs(spark):
    base = scratch_path(spark, "test-reports-" + uuid.uuid4().hex[:8])
    readings = write_dataset(events_as_readings(spark, "/root/testdata/sf0.001"), f"{base}/readings")
    sig = jobs.signal_report(spark, readings)
    assert {r.value_id for r in sig["stats"].collect()} == {900, 1200}
    assert sig["names"].count() == 6
    volt = jobs.voltage_report(spark, readings, band=(5.0, 150.0))
    assert volt["percentiles"].count() == 1 and volt["extremes"].count() <= 20
    jobs.preprocess(spark, readings, f"{base}/processed", window="6 hours")
    feat = jobs.feature_report(spark, f"{base}/processed")
    assert feat["describe"].count() == 7 and feat["preview"].count() <= 20


def test_embargo_leaves_rows_after_each_cutoff(spark):
    from voltaic.operators.split import rank_parts

    df = spark.range(100).selectExpr("id AS time", "'V' AS vehicle_id")
    ids = {gap: {k: sorted(r.time for r in p.collect()) for k, p in rank_parts(df, embargo_rows=gap).items()}
           for gap in (0, 6, 30)}
    assert ids[0] == {"train": list(range(60)), "validation": list(range(60, 80)), "test": list(range(80, 100))}
    assert ids[6] == {"train": list(range(60)), "validation": list(range(66, 80)), "test": list(range(86, 100))}
    assert ids[30] == {"train": list(range(60)), "validation": [], "test": []}


def test_update_and_purged_training_jobs(spark):
    from voltaic.operators.split import purged_split

    base = scratch_path(spark, "test-purge-" + uuid.uuid4().hex[:8])
    readings = write_dataset(events_as_readings(spark, "/root/testdata/sf0.01"), f"{base}/readings")
    found = [jobs.update_windows(spark, readings, f"{base}/processed", f"{base}/log", window="6 hours").first() for _ in range(2)]
    assert found[0].new >= 1 and found[0].days > 20 and (found[1].new, found[1].days) == (0, 0)
    assert spark.read.parquet(f"{base}/processed").count() == 690
    jobs.build_ml_dataset(spark, readings, f"{base}/ml", window="6 hours", band=(5.0, 150.0), threshold=60.0, label_end=True)
    out = jobs.train_valid_test(spark, f"{base}/ml", f"{base}/model", numTrees=3, maxDepth=3, purge=True)
    counts = {r["split"]: r["n"] for r in out["split_counts"].groupBy("split").sum("count").toDF("split", "n").collect()}
    rows = spark.read.parquet(f"{base}/ml").dropna()
    want = {r["split"]: r["count"] for r in purged_split(rows).groupBy("split").count().collect()}
    assert counts == want and counts["train"] < 287 and counts["validation"] < 96 and counts["test"] == 96
    assert jobs.tune_threshold(spark, f"{base}/ml", f"{base}/model", purge=True).count() == 7
