import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from voltaic.operators import evaluate as ev
from voltaic.operators.cumulative import running_totals
from voltaic.operators.split import class_counts, rank_cutoffs, split_by_rank

T0 = dt.datetime(2024, 1, 1)


def _table(spark, n, vehicles=3, seed=1):
    rnd = random.Random(seed)
    data = [(f"V{rnd.randrange(vehicles)}", T0 + dt.timedelta(seconds=10 * rnd.randrange(max(n // 2, 1))),
             rnd.randrange(2)) for _ in range(n)]
    df = spark.createDataFrame(data, "vehicle_id string, time timestamp_ntz, maintenance_risk int")
    return df.dropDuplicates(["vehicle_id", "time"])


@pytest.mark.parametrize("n", [0, 1, 2, 7, 101, 997])
def test_split_rank_equals_row_number(spark, n):
    df = _table(spark, n)
    total = df.count()
    got = split_by_rank(df)
    w = Window.orderBy("time", "vehicle_id")
    ref = df.withColumn("rn", F.row_number().over(w)).withColumn(
        "split", F.when(F.col("rn") <= int(total * 0.6), "train")
        .when(F.col("rn") <= int(total * 0.8), "validation").otherwise("test")).drop("rn")
    cols = ["vehicle_id", "time", "maintenance_risk", "split"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, ref.select(cols).collect()))


def test_equal_times_at_cutoff_break_by_vehicle(spark):
    data = [("B", T0, 0), ("A", T0, 1), ("A", T0 + dt.timedelta(seconds=10), 0),
            ("C", T0, 0), ("A", T0 + dt.timedelta(seconds=20), 1)]
    df = spark.createDataFrame(data, "vehicle_id string, time timestamp_ntz, maintenance_risk int")
    n, cuts = rank_cutoffs(df, (0.6, 0.8), accuracy=100)
    # order: (T0,A) (T0,B) (T0,C) (T0+10,A) (T0+20,A); ranks 3 and 4
    assert n == 5 and cuts[0] == (T0, "C")
    assert cuts[1] == (T0 + dt.timedelta(seconds=10), "A")


def test_split_plan_has_no_single_partition(spark):
    df = _table(spark, 200)
    plan = split_by_rank(df, checkpoint=False)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_class_weights_missing_class_counts_one(spark):
    df = spark.createDataFrame([(0,), (0,), (0,)], "maintenance_risk int")
    row = class_counts(df).first()
    assert (row.negatives, row.positives, row.weight_risk) == (3, 1, 3.0)


# --- fixed values: the reference's held-out test metrics (threshold, precision,
# recall, f1, tp, fp, fn), used as a golden table for the metric formulas ---
GOLDEN = [
    (0.50, 0.0294, 0.3945, 0.0548, 316, 10426, 485),
    (0.60, 0.0499, 0.2097, 0.0806, 168, 3198, 633),
    (0.70, 0.0890, 0.0849, 0.0869, 68, 696, 733),
    (0.80, 0.1478, 0.0212, 0.0371, 17, 98, 784),
]


def test_golden_metric_formulas(spark):
    cells = spark.createDataFrame([(t, tp, fp, fn, 0) for t, _, _, _, tp, fp, fn in GOLDEN],
                                  "threshold double, true_positives long, false_positives long, "
                                  "false_negatives long, true_negatives long")
    got = {r.threshold: r for r in ev.with_rates(cells).collect()}
    for t, p, r, f1, *_ in GOLDEN:
        assert round(got[t].precision, 4) == p
        assert round(got[t].recall, 4) == r
        assert round(got[t].f1, 4) == f1


def test_sweep_edges(spark):
    data = [(1, 0.5), (0, 0.5), (0, 0.2)]
    df = spark.createDataFrame(data, "maintenance_risk int, risk_probability double")
    rows = {r.threshold: r for r in ev.threshold_sweep(df, [0.5, 0.9]).collect()}
    assert rows[0.5].true_positives == 1 and rows[0.5].false_positives == 1   # p == t is positive
    assert rows[0.9].true_positives == 0 and rows[0.9].precision == 0.0 and rows[0.9].f1 == 0.0
    none = spark.createDataFrame([(0, 0.7)], "maintenance_risk int, risk_probability double")
    r = ev.threshold_sweep(none, [0.5]).first()
    assert r.recall == 0.0 and r.precision == 0.0
    tie = spark.createDataFrame([(1, 0.9), (0, 0.1)], "maintenance_risk int, risk_probability double")
    best = ev.best_threshold(ev.threshold_sweep(tie, [0.3, 0.2, 0.5])).first()
    assert best.threshold == 0.2 and best.f1 == 1.0


def test_auc_matches_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType

    rnd = random.Random(3)
    data = []
    for _ in range(3000):
        y = rnd.random() < 0.2
        p = min(1.0, max(0.0, rnd.gauss(0.6 if y else 0.4, 0.2)))
        data.append((Vectors.dense([1 - round(p, 3), round(p, 3)]), float(y), round(p, 3)))
    schema = StructType([StructField("raw", VectorUDT()), StructField("label", DoubleType()),
                         StructField("p", DoubleType())])
    df = spark.createDataFrame(data, schema)
    ours = ev.auc(df.withColumn("maintenance_risk", F.col("label").cast("int")), score="p", bucket_rows=100).first()
    for metric, val in (("areaUnderROC", ours.roc_auc), ("areaUnderPR", ours.pr_auc)):
        ml = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", metricName=metric,
                                           numBins=0).evaluate(df)
        assert abs(ml - val) < 1e-12, metric


def test_running_totals_equal_window(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(500)], "s double, x int")
    got = running_totals(df, "s", ["x"], descending=True, bucket_rows=70)
    w = Window.orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("cum_x", F.sum("x").over(w))
    assert got.select("s", "x", "cum_x").exceptAll(ref).count() == 0


def test_multiclass_matches_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rnd = random.Random(5)
    data = [(rnd.randrange(2), float(rnd.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(data, "maintenance_risk int, prediction double")
    ours = ev.multiclass_metrics(df).first()
    dfl = df.withColumn("label", F.col("maintenance_risk").cast("double"))
    for metric, val in (("accuracy", ours.accuracy), ("f1", ours.f1),
                        ("weightedPrecision", ours.weighted_precision), ("weightedRecall", ours.weighted_recall)):
        ml = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                               metricName=metric).evaluate(dfl)
        assert abs(ml - val) < 1e-12, metric


def test_select_ranks_with_narrowing_rounds(spark):
    """Force the narrowing rounds (tiny max_bracket) and compare with a sort."""
    from voltaic.operators.ranks import disc_rank, exact_quantiles, select_ranks

    rnd = random.Random(11)
    vals = [float(rnd.randrange(5000)) for _ in range(20000)] + [None] * 50
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "x double, i long")
    ordered = sorted((v, i) for i, v in enumerate(vals) if v is not None)
    ks = [1, 2, 137, 9999, 10000, 19999, 20000, 0, 20001]
    got = select_ranks(df, [(("x", "i"), k) for k in ks], accuracy=100, max_bracket=300)
    want = [ordered[k - 1] if 0 < k <= len(ordered) else None for k in ks]
    assert got == want
    q = exact_quantiles(df, ["x"], [0.01, 0.5, 0.6, 0.99], accuracy=100, max_bracket=500)
    xs = [v for v, _ in ordered]
    for p in (0.01, 0.5, 0.6, 0.99):
        assert q[("x", p)] == xs[disc_rank(p, len(xs)) - 1]


def test_select_ranks_with_a_hot_value(spark):
    """A third of the rows share one value: ranks inside and around it resolve
    by recursion on the next column, without gathering the tie group."""
    from voltaic.operators.ranks import select_ranks

    rnd = random.Random(13)
    vals = [0.0 if i % 3 == 0 else float(rnd.randrange(1, 3000)) for i in range(9000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "x double, i long")
    ordered = sorted((v, i) for i, v in enumerate(vals))
    ks = [1, 1500, 3000, 3001, 4500, 8999, 9000]
    got = select_ranks(df, [(("x", "i"), k) for k in ks], accuracy=50, max_bracket=200)
    assert got == [ordered[k - 1] for k in ks]


def test_sweep_keeps_the_grid_and_counts_nulls_negative(spark):
    rnd = random.Random(21)
    data = [(rnd.randrange(2), rnd.choice([None, float("nan"), 0.0, 1.0, round(rnd.random(), 2)]))
            for _ in range(3000)]
    df = spark.createDataFrame(data, "maintenance_risk int, risk_probability double")
    grid = [0.9, 0.3, 0.3] + [i / 50 for i in range(51)]
    got = ev.threshold_sweep(df, grid).collect()
    assert [r.threshold for r in got] == grid
    for r in got:  # NaN sorts above every number, as in Spark's comparisons
        hit = [p is not None and (p != p or p >= r.threshold) for _, p in data]
        assert r.true_positives == sum(h and l == 1 for h, (l, _) in zip(hit, data))
        assert r.true_negatives == sum(not h and l == 0 for h, (l, _) in zip(hit, data))


def test_auc_ranks_null_scores_lowest(spark):
    data = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.2), (1, None), (0, None)]
    df = spark.createDataFrame(data, "maintenance_risk int, risk_probability double")
    got = ev.auc(df).first()
    value = [(l, -1.0 if p is None else p) for l, p in data]
    pairs = [(a > b) + 0.5 * (a == b) for x, a in value if x == 1 for y, b in value if y == 0]
    assert abs(got.roc_auc - sum(pairs) / len(pairs)) < 1e-12


def test_running_totals_refuse_nulls(spark):
    import pytest

    with pytest.raises(ValueError):
        running_totals(spark.createDataFrame([(1.0, 1), (None, 1)], "s double, x int"), "s", ["x"])


def test_rank_parts_push_and_agree_with_the_labels(spark, tmp_path):
    from voltaic.operators.split import rank_parts

    df = _table(spark, 300)
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    parts = rank_parts(stored)
    labels = {(r.time, r.vehicle_id): r.split for r in split_by_rank(stored).collect()}
    seen = {(r.time, r.vehicle_id): n for n, p in parts.items() for r in p.collect()}
    assert seen == labels
    for part in parts.values():
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Scan ExistingRDD" not in plan and "(time," in plan.split("PushedFilters:")[1].split("]")[0]


def test_empty_tables_have_no_cutoffs(spark):
    from voltaic.operators.split import split_by_time

    for exact in (False, True):
        assert split_by_time(_table(spark, 10).limit(0), [0.8], exact=exact).count() == 0


def test_rank_search_always_narrows(spark):
    """With the default bracket, 5,000 rows already take the narrowing rounds; no progress raises."""
    import pytest

    from voltaic.operators.ranks import select_ranks

    df = spark.range(5000).select(F.col("id").alias("x"), F.lit(0).alias("i"))
    assert select_ranks(df, [(("x",), 1234)]) == [(1233,)]
    with pytest.raises(RuntimeError):
        select_ranks(df, [(("x",), 1234)], max_rounds=0)


def test_running_totals_adds_buckets_for_large_inputs(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(3000)], "s double, x int")
    got = running_totals(df, "s", ["x"], descending=False, bucket_rows=100)
    vals = {r.s: r.cum_x for r in got.collect()}
    assert all(vals[float(i)] == i + 1 for i in range(3000))
