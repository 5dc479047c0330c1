"""Chronological splits, class weights and median imputation.

``split_by_rank`` reproduces ``row_number() OVER (ORDER BY time, vehicle_id)``
cutoffs exactly without a global window (which plans a single-partition
exchange): the cutoff tuples at ranks ``int(n * f)`` come from
``ranks.select_ranks`` (bounded narrowing by approximate quantiles; tie groups
are never gathered). Only the order columns are stored for that search and
only the cutoff tuples reach the driver. ``split_by_rank`` labels rows by a
CASE over them; ``rank_parts`` returns each part by plain comparisons, which
reach a Parquet scan as pushed filters.

The time-quantile splits keep the reference's ``percentile_approx`` by
default; ``exact=True`` gives discrete quantiles through the same selector.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic import config
from voltaic.functions.exprs import lit_for
from voltaic.operators.ranks import count_nonnull, exact_quantiles, select_ranks

SPLIT_NAMES = ("train", "validation", "test")


def _tuple_le(df: DataFrame, cols: Sequence[str], values: Sequence, first: Column | None = None) -> Column:
    """Lexicographic ``(cols) <= (values)``; ``first`` stands in for the first column."""
    c0, v0 = F.col(cols[0]) if first is None else first, lit_for(df, cols[0], values[0])
    if len(cols) == 1:
        return c0 <= v0
    return (c0 < v0) | ((c0 == v0) & _tuple_le(df, cols[1:], values[1:]))


def rank_cutoffs(
    df: DataFrame,
    fractions: Sequence[float] = config.SPLIT_FRACTIONS,
    order: Sequence[str] = ("time", "vehicle_id"),
    **kw,
) -> tuple[int, list[tuple | None]]:
    """Exact cutoff tuples for ranks ``int(n * f)`` in ``order`` order.

    Returns ``(n, [tuple or None])``; ``None`` means rank 0 (nothing at or
    below). ``order`` must make rows unique (ties are broken arbitrarily
    otherwise, as with ``row_number``). See ``ranks.select_ranks``.
    """
    order = tuple(order)
    n = count_nonnull(df, [order[0]])[order[0]]
    ks = [int(n * f) for f in fractions]
    return n, select_ranks(df, [(order, k) for k in ks], counts={order[0]: n}, **kw)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage once before several passes: a reliable ``checkpoint``
    written to the shared folder named by ``spark.checkpoint.dir`` (survives
    executor loss; never a machine-local checkpoint)."""
    from voltaic.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def split_by_rank(
    df: DataFrame,
    fractions: Sequence[float] = config.SPLIT_FRACTIONS,
    order: Sequence[str] = ("time", "vehicle_id"),
    names: Sequence[str] = SPLIT_NAMES,
    checkpoint: bool = True,
    **kw,
) -> DataFrame:
    """M1: add ``split`` = train / validation / test by exact rank cutoffs.

    The cutoffs need a few passes over the order columns; with ``checkpoint``
    these columns (no others) are written to the checkpoint folder first.
    """
    _, cutoffs = rank_cutoffs(_order_only(df, order, checkpoint), fractions, order, **kw)
    expr = None
    for name, cut in zip(names, cutoffs):
        cond = F.lit(False) if cut is None else _tuple_le(df, list(order), cut)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn("split", expr.otherwise(F.lit(names[len(cutoffs)])))


def _order_only(df: DataFrame, order: Sequence[str], checkpoint: bool) -> DataFrame:
    own = df.select(*order)
    return materialize(own) if checkpoint else own


def rank_parts(
    df: DataFrame,
    fractions: Sequence[float] = config.SPLIT_FRACTIONS,
    order: Sequence[str] = ("time", "vehicle_id"),
    names: Sequence[str] = SPLIT_NAMES,
    checkpoint: bool = False,
    embargo_rows: int = 0,
    label_end: str | None = None,
    **kw,
) -> dict[str, DataFrame]:
    """M1 as one DataFrame per part, each a plain range of ``order``; ``checkpoint``
    is worth it only where ``df`` is not already a stored table. The first
    ``embargo_rows`` rows (in ``order``) after each cutoff belong to no part, so
    that labels which look ahead do not reach across it; with ``label_end`` (see
    ``purged_split``) the rows whose own label does reach across it do not."""
    order = tuple(order)
    stored = _order_only(df, order, checkpoint)
    n = count_nonnull(stored, [order[0]])[order[0]]
    ends = [int(n * f) for f in fractions]
    starts = [min(n, k + embargo_rows) for k in ends]
    ranks = sorted({*ends, *starts})
    found = dict(zip(ranks, select_ranks(stored, [(order, k) for k in ranks], counts={order[0]: n}, **kw), strict=True))
    out = {}
    for i, name in enumerate(names[: len(ends) + 1]):
        part = df
        if i < len(ends):
            high = found[ends[i]]
            part = part.filter(F.lit(False) if high is None else _tuple_le(df, order, high))
            if high is not None:
                part = part.filter(F.col(order[0]) <= lit_for(df, order[0], high[0]))
                if label_end is not None:
                    part = part.filter(F.coalesce(_tuple_le(df, order, high, first=F.col(label_end)), F.lit(True)))
        low = found[starts[i - 1]] if i else None
        if low is not None:
            part = part.filter(~_tuple_le(df, order, low)).filter(F.col(order[0]) >= lit_for(df, order[0], low[0]))
        out[name] = part
    return out


def purged_split(
    df: DataFrame,
    fractions: Sequence[float] = config.SPLIT_FRACTIONS,
    order: Sequence[str] = ("time", "vehicle_id"),
    names: Sequence[str] = SPLIT_NAMES,
    *,
    label_end: str = "label_end",
    checkpoint: bool = True,
    **kw,
) -> DataFrame:
    """M1 without labels that look across a cutoff: ``split`` as ``split_by_rank``
    gives it, without the rows whose look-ahead frame ends after their part does.

    ``label_end`` (see ``sequence_features``) is the first order column's value
    at the end of a row's own frame; the frame's other rows are of the same
    vehicle, so the frame ends at ``(label_end, rest of the order)``. A row of
    the last part always stays, and so does a row without a frame. How many
    rows go depends on each vehicle's own rate of rows, unlike an embargo of a
    number of rows of all vehicles together.
    """
    order = list(order)
    _, cutoffs = rank_cutoffs(_order_only(df, order, checkpoint), fractions, order, **kw)
    split = crosses = None
    for name, cut in zip(names, cutoffs):
        cond = F.lit(False) if cut is None else _tuple_le(df, order, cut)
        over = F.lit(False) if cut is None else ~_tuple_le(df, order, cut, first=F.col(label_end))
        split = F.when(cond, F.lit(name)) if split is None else split.when(cond, F.lit(name))
        crosses = F.when(cond, over) if crosses is None else crosses.when(cond, over)
    purged = F.coalesce(crosses.otherwise(F.lit(False)), F.lit(False))
    return df.withColumn("split", split.otherwise(F.lit(names[len(cutoffs)]))).filter(~purged)


def time_cutoffs(df: DataFrame, fractions: Sequence[float], time_col: str = "time",
                 accuracy: int = 10000, exact: bool = False) -> list:
    """Time quantiles (M2/M3). Default: ``percentile_approx`` in one pass with
    Spark's default accuracy, as the reference. ``exact``: discrete quantiles
    (``percentile_disc``) through ``ranks.exact_quantiles``."""
    if exact:
        q = exact_quantiles(df, [time_col], list(fractions))
        return [q[(time_col, f)] for f in fractions]
    cuts = df.agg(F.percentile_approx(time_col, list(fractions), accuracy).alias("q")).first()["q"]
    return [None] * len(fractions) if cuts is None else list(cuts)


def split_by_time(df: DataFrame, fractions: Sequence[float] = (0.8,), time_col: str = "time",
                  names: Sequence[str] | None = None, accuracy: int = 10000,
                  exact: bool = False, checkpoint: bool | None = None) -> DataFrame:
    """M2 (one fraction, train/test) and M3 (two fractions): ``time <= cutoff`` inclusive.

    ``checkpoint`` (default: on in exact mode, which makes several passes)
    writes the time column to the checkpoint folder first. Without rows (or
    without times) there is no cutoff and every row falls into the last part.
    """
    if names is None:
        names = ("train", "test") if len(fractions) == 1 else SPLIT_NAMES
    searched = _order_only(df, [time_col], checkpoint if checkpoint is not None else exact)
    cuts = time_cutoffs(searched, fractions, time_col, accuracy, exact)
    expr = None
    for name, cut in zip(names, cuts):
        cond = F.lit(False) if cut is None else F.col(time_col) <= lit_for(df, time_col, cut)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn("split", expr.otherwise(F.lit(names[len(cuts)])))


def class_counts(train: DataFrame, label: str = config.LABEL) -> DataFrame:
    """A14 as a table: negatives, positives (missing class counted as 1) and the risk weight."""
    neg = F.count_if(F.col(label) == 0)
    pos = F.count_if(F.col(label) == 1)
    n0 = F.when(neg == 0, F.lit(1)).otherwise(neg)
    n1 = F.when(pos == 0, F.lit(1)).otherwise(pos)
    return train.agg(n0.alias("negatives"), n1.alias("positives"),
                     (n0.cast("double") / n1).alias("weight_risk"))


def class_weights(train: DataFrame, label: str = config.LABEL) -> tuple[float, float]:
    """A14 scalars ``(w0, w1)``: ``w0 = 1``, ``w1 = n0 / n1`` from the training split."""
    row = class_counts(train, label).first()
    return 1.0, float(row["weight_risk"])


def with_class_weight(df: DataFrame, w1: float, w0: float = 1.0, label: str = config.LABEL,
                      out: str = "class_weight") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(w1))).otherwise(F.lit(float(w0))))


def feature_medians(df: DataFrame, cols: Sequence[str], accuracy: int = 10000,
                    exact: bool = False) -> DataFrame:
    """M4 surrogate: the median of every feature, long ``(column, median)``.

    Default: one ``percentile_approx`` pass (the imputer's approximate median).
    ``exact``: the lower median (``percentile_disc(0.5)``) of each column via
    ``ranks.exact_quantiles``; only the medians reach the driver.
    """
    if exact:
        q = exact_quantiles(df, list(cols), [0.5])
        rows = [(c, None if q[(c, 0.5)] is None else float(q[(c, 0.5)])) for c in cols]
        return df.sparkSession.createDataFrame(rows, "column string, median double")
    wide = df.agg(*[F.percentile_approx(F.col(c), 0.5, accuracy).cast("double").alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "median")


def impute_with(df: DataFrame, medians: dict, suffix: str = "_imputed") -> DataFrame:
    """Fill NULL/NaN of each feature with its median into ``<c>_imputed``."""
    return df.select("*", *[
        F.when(F.col(c).isNull() | F.isnan(c), F.lit(float(m))).otherwise(F.col(c)).alias(f"{c}{suffix}")
        for c, m in medians.items()
    ])
