"""Classification evaluation on score tables.

A score table has an integer label (``maintenance_risk``), a risk probability
(double) and optionally a model ``prediction``. Every metric is one
aggregate pass; a threshold grid becomes extra aggregate expressions in that
same pass (no cross join with the grid and no job per threshold).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic import config
from voltaic.functions.exprs import safe_div
from voltaic.operators.cumulative import running_totals

LABEL = config.LABEL


def confusion_matrix(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Counts per ``(label, prediction)``, ordered."""
    return (df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(label, prediction))


def _cells(lbl, pred, suffix: str = ""):
    return [
        F.count_if((lbl == 1) & pred).alias(f"true_positives{suffix}"),
        F.count_if((lbl == 0) & pred).alias(f"false_positives{suffix}"),
        F.count_if((lbl == 1) & ~pred).alias(f"false_negatives{suffix}"),
        F.count_if((lbl == 0) & ~pred).alias(f"true_negatives{suffix}"),
    ]


def confusion_cells(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Tp, fp, fn, tn in one job."""
    return df.agg(*_cells(F.col(label), F.col(prediction) == 1))


def with_rates(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1, FPR, accuracy from cell counts; 0 when undefined."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")
    p = safe_div(tp, tp + fp)
    r = safe_div(tp, tp + fn)
    return (
        cells.withColumn("precision", p)
        .withColumn("recall", r)
        .withColumn("f1", safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .withColumn("fpr", safe_div(fp, fp + tn))
        .withColumn("accuracy", safe_div(tp + tn, tp + tn + fp + fn))
    )


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float] = config.THRESHOLD_GRID_COARSE,
    *,
    label: str = LABEL,
    probability: str = "risk_probability",
) -> DataFrame:
    """M7: per threshold ``t``, predict ``p >= t`` and report cells and rates.

    One scan and one route for every grid: probabilities are bucketed at the
    distinct thresholds and counted per ``(label, bucket)``, then cumulated over
    that table of at most ``len + 2`` rows. One row per given threshold, in
    the given order, repeats included. A NULL probability is predicted negative.
    """
    from pyspark.ml.feature import Bucketizer
    from pyspark.sql import Window

    grid = sorted({float(t) for t in thresholds})
    g = len(grid)
    splits = [float("-inf"), *grid, float("inf")]
    # NULL probability counts as predicted negative (bucket 0); NaN goes to
    # Bucketizer's extra bucket g + 1, positive for every threshold like p >= t
    scores = df.select(F.col(label).alias("_l"),
                       F.coalesce(F.col(probability).cast("double"), F.lit(float("-inf"))).alias("_p"))
    hist = (Bucketizer(splits=splits, inputCol="_p", outputCol="_b", handleInvalid="keep")
            .transform(scores).groupBy("_b")
            .agg(F.count_if(F.col("_l") == 1).alias("_pos"), F.count_if(F.col("_l") == 0).alias("_neg")))
    # every bucket 0..g+1, with threshold j - 1 attached to bucket j: predicted
    # positive at threshold j - 1 means bucket >= j, a suffix sum. Both tables
    # have at most g + 2 rows, so the join and the unpartitioned window are bounded.
    buckets = df.sparkSession.createDataFrame(
        [(float(b), grid[b - 1] if 1 <= b <= g else None) for b in range(g + 2)], "_b double, threshold double")
    x = buckets.join(F.broadcast(hist), "_b", "left").fillna(0, subset=["_pos", "_neg"])
    suffix = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tp, fp = F.sum("_pos").over(suffix), F.sum("_neg").over(suffix)
    cells = x.select(
        "threshold",
        tp.cast("long").alias("true_positives"),
        fp.cast("long").alias("false_positives"),
        (F.sum("_pos").over(whole) - tp).cast("long").alias("false_negatives"),
        (F.sum("_neg").over(whole) - fp).cast("long").alias("true_negatives"),
    ).filter(F.col("threshold").isNotNull())
    given = df.sparkSession.createDataFrame([(i, float(t)) for i, t in enumerate(thresholds)], "_i int, threshold double")
    return with_rates(given.join(F.broadcast(cells), "threshold")).orderBy("_i").select(
        "threshold", "precision", "recall", "f1", "true_positives", "false_positives",
        "false_negatives", "true_negatives", "fpr",
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """M8: highest F1; ties keep the lowest threshold."""
    return sweep.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def evaluate_at_threshold(df: DataFrame, threshold: float, *, label: str = LABEL,
                          probability: str = "risk_probability") -> DataFrame:
    """M9: cells, precision, recall, F1, accuracy and FPR at one threshold."""
    pred = F.coalesce(F.col(probability) >= F.lit(float(threshold)), F.lit(False))
    cells = df.agg(*_cells(F.col(label), pred))
    return with_rates(cells).select(
        F.lit(float(threshold)).alias("threshold"), "true_positives", "false_positives",
        "false_negatives", "true_negatives", "precision", "recall", "f1", "accuracy", "fpr",
    )


def risk_metrics(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 of class 1 (0 when undefined) from one aggregate."""
    cells = df.agg(*_cells(F.col(label), F.col(prediction) == 1))
    return with_rates(cells).select("precision", "recall", "f1")


def multiclass_metrics(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Accuracy and label-weighted precision, recall and F1.

    Same definitions as MLlib's ``MulticlassMetrics``: weights are true-label
    frequencies; a class never predicted has precision 0. Computed from the
    confusion counts (classes x classes rows), never from raw rows twice.
    """
    cm = df.groupBy(F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p")) \
        .agg(F.count(F.lit(1)).alias("n"))
    by_label = cm.groupBy("l").agg(F.sum("n").alias("n_l"),
                                   F.sum(F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = cm.groupBy(F.col("p").alias("l")).agg(F.sum("n").alias("pred_l"))
    per = by_label.join(F.broadcast(by_pred), "l", "left").fillna(0, subset=["pred_l"])
    per = (per.withColumn("prec", safe_div(F.col("tp"), F.col("pred_l")))
           .withColumn("rec", safe_div(F.col("tp"), F.col("n_l")))
           .withColumn("f", safe_div(2 * F.col("prec") * F.col("rec"), F.col("prec") + F.col("rec"))))
    total = F.sum("n_l")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("f") * F.col("n_l")) / total).alias("f1"),
        (F.sum(F.col("prec") * F.col("n_l")) / total).alias("weighted_precision"),
        (F.sum(F.col("rec") * F.col("n_l")) / total).alias("weighted_recall"),
    )


def auc(df: DataFrame, *, label: str = LABEL, score: str = "risk_probability", bucket_rows: int = 50_000,
        checkpoint: bool = True) -> DataFrame:
    """Exact ROC-AUC and PR-AUC (trapezoid), MLlib's curve conventions.

    Scores are grouped (one row per distinct score) and, with ``checkpoint``,
    written once to the checkpoint folder; running positive and negative
    counts in descending score order come from ``running_totals`` (no
    single-partition window). ROC starts at (0, 0); the PR curve starts at
    (0, precision of the first point). A NULL score ranks lowest, as in
    ``threshold_sweep``, where it is negative at every threshold.
    """
    lowest = F.lit(float("-inf"))
    g = df.groupBy(F.coalesce(F.col(score).cast("double"), lowest).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    if checkpoint:  # read three times below (edges, per-bucket totals, running sums): compute once
        from voltaic.operators.split import materialize

        g = materialize(g)
    cum = running_totals(g, "s", ["pos", "neg"], descending=True, bucket_rows=bucket_rows)
    cp, cn = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    prev_p, prev_n = cp - pos, cn - neg
    prec = cp / (cp + cn)
    prev_prec = F.when(prev_p + prev_n == 0, prec).otherwise(prev_p / (prev_p + prev_n))
    # the totals P and N factor out of every trapezoid, so they come from the
    # same final aggregate: no join with a totals row is needed
    big_p, big_n = F.sum(pos), F.sum(neg)
    return cum.agg(
        safe_div(F.sum(neg * (cp + prev_p)), 2 * big_p * big_n, None).alias("roc_auc"),
        safe_div(F.sum(pos * (prec + prev_prec)), 2 * big_p, None).alias("pr_auc"),
    )
