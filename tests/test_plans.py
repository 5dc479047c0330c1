"""Plan-shape checks: shuffles, pushdown, no Python in batch operators."""
import re

from voltaic.operators.features import ml_features
from voltaic.operators.windows import window_pivot_ml
from voltaic.sources.readings import events_as_readings, scan_readings
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)


def test_lag_and_lookahead_share_one_exchange(spark):
    win = window_pivot_ml(events_as_readings(spark, SF_SMALL), "6 hours")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = _exchanges(_plan(ml_features(win, band=(5, 150), chunk=None)))
        chunked = _exchanges(_plan(ml_features(win, band=(5, 150), chunk="1 day")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # aggregate exchange + one exchange for lag and look-ahead together
    assert len(plain) == 2 and all("vehicle_id" in e for e in plain)
    # chunked: aggregate + (vehicle, chunk) for the main pass, reused for the edge rows,
    # + one small exchange by vehicle for the edge rows; never a single partition
    assert "SinglePartition" not in " ".join(chunked)
    assert sum("_chunk" in e for e in chunked) >= 1
    assert len([e for e in chunked if e.startswith("hashpartitioning(vehicle_id") and "_chunk" not in e
                and "window" not in e]) == 1


def test_reading_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "readings")
    events_as_readings(spark, SF_SMALL).write.parquet(path)
    plan = _plan(window_pivot_ml(scan_readings(spark, path)))
    assert re.search(r"PushedFilters: \[[^\]]*In\(value_id", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"vehicle_id", "time", "value_id", "value"}


def test_fixed_seed_same_forest(spark):
    from voltaic.operators import model as md
    from voltaic.operators.split import split_by_rank
    from voltaic.plans.catalog import ev_complete

    train = split_by_rank(ev_complete(spark, "/root/testdata/sf0.01")).filter("split = 'train'")
    a = md.feature_importance(spark, md.train_rf(train, numTrees=5, maxDepth=3)).collect()
    b = md.feature_importance(spark, md.train_rf(train, numTrees=5, maxDepth=3)).collect()
    assert a == b


def test_no_cross_joins_in_registered_queries(spark):
    """No registered batch query plans a cartesian or nested-loop join."""
    from voltaic.plans.catalog import QUERIES

    # the model queries have no training rows in the smallest tables
    skip = {"train_rf", "feature_importance", "score_rows", "scored_keys", "model_roundtrip", "validation_sweep",
            "validation_counts", "train_rf_imputed", "imputed_medians", "evaluate_best_on_test", "forest_nodes"}
    for name, fn in sorted(QUERIES.items()):
        if name in skip or name.startswith("stream_"):
            continue
        plan = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
