"""Registered queries: ``(spark, sf_dir) -> DataFrame`` and their DuckDB oracles.

Every query reads the test tables (or what Spark derives from them) whole:
no id subsets, samples or row caps. A ``LIMIT`` appears only where it is the
feature (top-k / preview operators).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic import config
from voltaic.functions.exprs import lit_for
from voltaic.operators import evaluate as ev
from voltaic.operators import features as fx
from voltaic.operators import profile as pr
from voltaic.operators import split as sp
from voltaic.operators.windows import valid_band, window_pivot, window_pivot_ml, window_wide
from voltaic.plans import oracle as O
from voltaic.plans import params as P
from voltaic.sources import readings as rd
from voltaic.sources.scores import event_scores

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` is HUGEINT and NULL on no rows; Spark's is BIGINT and 0.
    Rewrite each call as ``count(*) FILTER (WHERE ...)``, which behaves like Spark's."""
    out, i = [], 0
    while True:
        j = sql.find("count_if(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("count_if")
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
            if depth == 0:
                break
        out.append(sql[i:j] + "count(*) FILTER (WHERE " + sql[j + len("count_if("):k - 1] + ")")
        i = k


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _bigint_counts(sql)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round double columns of a report: sums over many doubles differ in the
    last bits between engines (order of addition)."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# ---- shared building blocks ---------------------------------------------------------------

def ev_readings(spark, d):
    return rd.events_as_readings(spark, d)


def li_readings(spark, d):
    return rd.lineitem_as_readings(spark, d)


def ev_windows(spark, d):
    return window_pivot_ml(ev_readings(spark, d), P.EV_WINDOW)


def ev_banded(spark, d):
    return fx.ratio_feature(valid_band(ev_windows(spark, d), band=P.EV_BAND)
                            .filter(F.col("hv_soc").isNotNull()))


def ev_ml(spark, d):
    return fx.ml_dataset(ev_readings(spark, d), window=P.EV_WINDOW, band=P.EV_BAND, threshold=P.EV_RISK)


def ev_complete(spark, d):
    return ev_ml(spark, d).select("vehicle_id", "time", config.LABEL, *config.FEATURES).dropna()


def li_wide(spark, d):
    return window_wide(li_readings(spark, d), P.LI_WINDOW)


# ---- scans and sources -----------------------------------------------------------------------

register("scan_readings", O.EV_READINGS)(lambda s, d: ev_readings(s, d))

register("scan_profile", f"""SELECT count(*) AS row_count, min(time) AS min_time, max(time) AS max_time
FROM ({O.EV_READINGS}) r""")(lambda s, d: rd.scan_profile(ev_readings(s, d)))

register("extract_signals", f"""SELECT vehicle_id, date_trunc('millisecond', time) AS time, value_id, value
FROM ({O.EV_READINGS}) r WHERE value_id IN (900, 1200, 1290, 1293, 1294, 1295)""")(
    lambda s, d: rd.extract_signals(ev_readings(s, d), P.BATTERY_CODES, millis="truncate"))

register("single_signal", f"""SELECT time, value AS battery_voltage FROM ({O.EV_READINGS}) r
WHERE value_id = 1200""")(lambda s, d: rd.single_signal(ev_readings(s, d), 1200, "battery_voltage"))

# ---- windows -----------------------------------------------------------------------------------

register("window_pivot", O.pivot(O.EV_READINGS, config.SIGNALS_WIDE, P.EV_WINDOW, True))(
    lambda s, d: window_pivot(ev_readings(s, d), config.SIGNALS_WIDE, P.EV_WINDOW))

register("window_pivot_ml", O.pivot(O.EV_READINGS, config.SIGNALS_ML, P.EV_WINDOW, False))(
    lambda s, d: ev_windows(s, d))

register("window_wide", O.wide(O.LI_READINGS, P.LI_WINDOW))(lambda s, d: li_wide(s, d))

register("valid_band", f"SELECT * EXCLUDE (voltage_per_soc) FROM ({O.banded()}) b")(
    lambda s, d: valid_band(ev_windows(s, d), band=P.EV_BAND).filter(F.col("hv_soc").isNotNull()))

register("features", O.banded())(lambda s, d: ev_banded(s, d))

# ---- row windows ------------------------------------------------------------------------------

_SEQ = "vehicle_id, time, previous_voltage, previous_soc, voltage_change, soc_change"
# 1-day chunks over 6-hour windows: four windows per chunk, so nearly every row
# depends on a neighbouring chunk and the oracle checks the edge pass on real data

register("lag_features", f"SELECT {_SEQ} FROM ({O.sequenced()}) s")(
    lambda s, d: fx.sequence_features(ev_banded(s, d), chunk="1 day").select(*_SEQ.split(", ")))

register("lookahead_max", f"SELECT {_SEQ}, future_max_voltage_change FROM ({O.sequenced()}) s")(
    lambda s, d: fx.sequence_features(ev_banded(s, d), chunk="1 day")
    .select(*_SEQ.split(", "), "future_max_voltage_change"))

register("risk_label", f"SELECT vehicle_id, time, future_max_voltage_change, maintenance_risk FROM ({O.labelled()}) x")(
    lambda s, d: fx.risk_label(fx.sequence_features(ev_banded(s, d), chunk="1 day"), P.EV_RISK)
    .select("vehicle_id", "time", "future_max_voltage_change", "maintenance_risk"))

register("lookahead_horizon", O.lookahead_horizon(P.EV_HORIZON))(
    lambda s, d: fx.horizon_max(fx.sequence_features(ev_banded(s, d), chunk="1 day"), P.EV_HORIZON, chunk="1 day")
    .select("vehicle_id", "time", "voltage_change", "horizon_max_voltage_change"))

register("ml_dataset", O.ml_dataset())(lambda s, d: ev_ml(s, d))

register("complete_rows", O.complete_rows())(lambda s, d: ev_complete(s, d))

# ---- profiles ----------------------------------------------------------------------------------

register("class_distribution", f"""SELECT maintenance_risk, count(*) AS count FROM ({O.ml_dataset()}) m
GROUP BY 1 ORDER BY 1""")(lambda s, d: pr.class_distribution(ev_ml(s, d)))

register("signal_stats", f"""SELECT value_id, count(*) AS count, min(value) AS min_value, max(value) AS max_value,
  avg(value) AS avg_value, stddev_samp(value) AS std_value
FROM ({O.LI_READINGS}) r WHERE value_id IN (900, 1200, 1290, 1293, 1294, 1295) GROUP BY 1 ORDER BY 1""")(
    lambda s, d: pr.signal_stats(li_readings(s, d), P.BATTERY_CODES))

register("range_stats", f"""SELECT min(time) AS start_time, max(time) AS end_time, min(hv_soc) AS min_soc,
  max(hv_soc) AS max_soc, round(avg(hv_soc), 9) AS avg_soc, min(hv_battery_voltage) AS min_voltage,
  max(hv_battery_voltage) AS max_voltage, round(avg(hv_battery_voltage), 9) AS avg_voltage
FROM ({O.wide(O.LI_READINGS, P.LI_WINDOW)}) w""")(lambda s, d: rounded(pr.range_stats(li_wide(s, d))))

register("signal_percentiles", f"""SELECT {', '.join(
    f"quantile_disc(value, {q}) AS {n}" for q, n in zip(config.PERCENTILES, config.PERCENTILE_NAMES))}
FROM ({O.EV_READINGS}) r WHERE value_id = 1200""")(
    lambda s, d: pr.signal_percentiles(rd.single_signal(ev_readings(s, d), 1200, "value"), "value",
                                       exact=True))

_DESCRIBE = ["vehicle_speed", "ambient_air_temp", "hv_aux_power", "hv_soc", "hv_battery_voltage",
             "battery_temp_avg", "battery_temp_delta"]
register("describe_columns", f"""SELECT "column", count(value) AS count, round(avg(value), 9) AS mean,
  round(stddev_samp(value), 9) AS stddev, min(value) AS min, max(value) AS max
FROM (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _DESCRIBE)}
               FROM ({O.wide(O.LI_READINGS, P.LI_WINDOW)}) w)
      ON {', '.join(_DESCRIBE)} INTO NAME "column" VALUE value) u
GROUP BY 1""")(lambda s, d: rounded(pr.describe_columns(li_wide(s, d), _DESCRIBE)))

_WIDE_COLS = ["vehicle_id", "time", "window_end", *config.SIGNALS_WIDE.values(), "battery_temp_avg",
              "battery_temp_delta", "temperature_available"]
register("null_counts", f"""SELECT {', '.join(f'count_if({c} IS NULL) AS {c}' for c in _WIDE_COLS)}
FROM ({O.wide(O.LI_READINGS, P.LI_WINDOW)}) w""")(lambda s, d: pr.null_counts(li_wide(s, d)))

register("vehicles", f"""SELECT DISTINCT vehicle_id FROM ({O.wide(O.LI_READINGS, P.LI_WINDOW)}) w
WHERE vehicle_id IS NOT NULL ORDER BY 1""")(lambda s, d: pr.vehicles(li_wide(s, d)))

register("dedup_readings", f"""SELECT vehicle_id, time, value_id, min(value) AS value
FROM ({O.LI_READINGS}) r GROUP BY ALL""")(
    lambda s, d: pr.dedup(li_readings(s, d), ["vehicle_id", "time", "value_id"], ["value"]))

register("dedup_readings_nulls", f"""SELECT vehicle_id, time, value_id, value, price FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id, time, value_id
                               ORDER BY value NULLS LAST, price NULLS LAST) AS n
  FROM ({O.LI_PRICED}) r) x WHERE n = 1""")(
    lambda s, d: pr.dedup(rd.lineitem_as_priced_readings(s, d), ["vehicle_id", "time", "value_id"], ["value", "price"]))

register("band_audit", f"""SELECT count(*) AS total,
  count_if(value >= 5 AND value <= 150 AND NOT isnan(value)) AS valid,
  count_if(value < 5 OR value > 150) AS out_of_band, count_if(value <= 0) AS non_positive
FROM ({O.EV_READINGS}) r WHERE value_id = 1200""")(
    lambda s, d: pr.band_audit(rd.single_signal(ev_readings(s, d), 1200, "battery_voltage"),
                               "battery_voltage", P.EV_BAND))

register("out_of_band", f"""SELECT time, value AS battery_voltage FROM ({O.EV_READINGS}) r
WHERE value_id = 1200 AND (value < 5 OR value > 150) ORDER BY time, battery_voltage LIMIT 20""")(
    lambda s, d: pr.out_of_band(rd.single_signal(ev_readings(s, d), 1200, "battery_voltage"),
                                "battery_voltage", P.EV_BAND))

register("signal_names", f"""SELECT d.value_id, d.name, coalesce(c.rows, 0) AS rows
FROM (VALUES {', '.join(f"({k}, '{v}')" for k, v in config.BATTERY_SIGNAL_NAMES.items())}) d(value_id, name)
LEFT JOIN (SELECT value_id, count(*) AS rows FROM ({O.LI_READINGS}) r GROUP BY 1) c USING (value_id)
ORDER BY 1""")(lambda s, d: pr.signal_names(s, li_readings(s, d)))

# ---- evaluation on the score table --------------------------------------------------------------

register("confusion_matrix", f"""SELECT maintenance_risk, prediction, count(*) AS count FROM ({O.SCORES}) s
GROUP BY 1, 2 ORDER BY 1, 2""")(lambda s, d: ev.confusion_matrix(event_scores(s, d)))

_CELLS = """count_if(maintenance_risk = 1 AND {p}) AS true_positives,
  count_if(maintenance_risk = 0 AND {p}) AS false_positives,
  count_if(maintenance_risk = 1 AND NOT ({p})) AS false_negatives,
  count_if(maintenance_risk = 0 AND NOT ({p})) AS true_negatives"""

register("confusion_cells", f"SELECT {_CELLS.format(p='prediction = 1')} FROM ({O.SCORES}) s")(
    lambda s, d: ev.confusion_cells(event_scores(s, d)))


register("threshold_sweep", O.sweep(config.THRESHOLD_GRID_COARSE))(
    lambda s, d: ev.threshold_sweep(event_scores(s, d), config.THRESHOLD_GRID_COARSE))

register("best_threshold", f"""SELECT * FROM ({O.sweep(config.THRESHOLD_GRID_LOW)}) x
ORDER BY f1 DESC, threshold ASC LIMIT 1""")(
    lambda s, d: ev.best_threshold(ev.threshold_sweep(event_scores(s, d), config.THRESHOLD_GRID_LOW)))

register("evaluate_at_threshold", f"""SELECT {P.EVAL_THRESHOLD} :: DOUBLE AS threshold, true_positives,
  false_positives, false_negatives, true_negatives, precision, recall, f1, accuracy, fpr
FROM ({O.rates(f'({O.SCORES}) s', False).replace('{p}', f'coalesce(risk_probability >= {P.EVAL_THRESHOLD}, false)')}) r""")(
    lambda s, d: ev.evaluate_at_threshold(event_scores(s, d), P.EVAL_THRESHOLD))

register("risk_metrics", f"""SELECT precision, recall, f1
FROM ({O.rates(f'({O.SCORES}) s', False).replace('{p}', 'prediction = 1')}) r""")(
    lambda s, d: ev.risk_metrics(event_scores(s, d)))

register("multiclass_metrics", f"""WITH cm AS (SELECT CAST(maintenance_risk AS DOUBLE) AS l, prediction AS p,
  count(*) AS n FROM ({O.SCORES}) s GROUP BY 1, 2),
bl AS (SELECT l, sum(n) AS n_l, sum(CASE WHEN l = p THEN n ELSE 0 END) AS tp FROM cm GROUP BY 1),
bp AS (SELECT p AS l, sum(n) AS pred_l FROM cm GROUP BY 1),
per AS (SELECT bl.l, n_l, tp, coalesce(pred_l, 0) AS pred_l,
  CASE WHEN coalesce(pred_l, 0) <> 0 THEN tp / pred_l ELSE 0.0 END AS prec,
  CASE WHEN n_l <> 0 THEN tp / n_l ELSE 0.0 END AS rec FROM bl LEFT JOIN bp USING (l)),
f AS (SELECT *, CASE WHEN prec + rec <> 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f FROM per)
SELECT sum(tp) / sum(n_l) AS accuracy, sum(f * n_l) / sum(n_l) AS f1,
  sum(prec * n_l) / sum(n_l) AS weighted_precision, sum(rec * n_l) / sum(n_l) AS weighted_recall FROM f""")(
    lambda s, d: ev.multiclass_metrics(event_scores(s, d)))

register("auc", f"""WITH g AS (SELECT coalesce(risk_probability, '-inf'::DOUBLE) AS s, count_if(maintenance_risk = 1) AS pos,
  count_if(maintenance_risk <> 1) AS neg FROM ({O.SCORES}) x GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY s DESC) AS cp, sum(neg) OVER (ORDER BY s DESC) AS cn FROM g),
p AS (SELECT *, cp - pos AS pp, cn - neg AS pn, cp / (cp + cn) AS prec FROM c)
SELECT round(sum(neg * (cp + pp)) / (2 * sum(pos) * sum(neg)), 9) AS roc_auc,
  round(sum(pos * (prec + CASE WHEN pp + pn = 0 THEN prec ELSE pp / (pp + pn) END)) / (2 * sum(pos)), 9) AS pr_auc
FROM p""")(lambda s, d: rounded(ev.auc(event_scores(s, d))))

# ---- splits -------------------------------------------------------------------------------------

register("split_rank", O.split_rank())(
    lambda s, d: sp.split_by_rank(ev_complete(s, d)).select("vehicle_id", "time", config.LABEL, "split"))


register("split_time_80", O.time_split([0.8], ["train", "test"]))(
    lambda s, d: sp.split_by_time(ev_complete(s, d), [0.8], exact=True)
    .select("vehicle_id", "time", config.LABEL, "split"))

register("split_time_3way", O.time_split([0.6, 0.8], ["train", "validation", "test"]))(
    lambda s, d: sp.split_by_time(ev_complete(s, d), [0.6, 0.8], exact=True)
    .select("vehicle_id", "time", config.LABEL, "split"))


def ev_labelled_ends(spark, d):
    ml = fx.ml_dataset(ev_readings(spark, d), window=P.EV_WINDOW, band=P.EV_BAND, threshold=P.EV_RISK, label_end=True)
    return ml.dropna(subset=["vehicle_id", "time", config.LABEL, *config.FEATURES])


register("split_purged", O.split_purged())(
    lambda s, d: sp.purged_split(ev_labelled_ends(s, d)).select("vehicle_id", "time", "label_end", config.LABEL, "split"))


def ev_train(spark, d):
    return sp.split_by_rank(ev_complete(spark, d)).filter(F.col("split") == "train")


register("class_weights", f"""SELECT CASE WHEN neg = 0 THEN 1 ELSE neg END AS negatives,
  CASE WHEN pos = 0 THEN 1 ELSE pos END AS positives,
  CAST(CASE WHEN neg = 0 THEN 1 ELSE neg END AS DOUBLE) / CASE WHEN pos = 0 THEN 1 ELSE pos END AS weight_risk
FROM (SELECT count_if(maintenance_risk = 0) AS neg, count_if(maintenance_risk = 1) AS pos
      FROM ({O.split_rank()}) r WHERE split = 'train') c""")(lambda s, d: sp.class_counts(ev_train(s, d)))

register("impute_median", f"""SELECT "column", CAST(median AS DOUBLE) AS median FROM (
  SELECT {', '.join(f'quantile_disc({c}, 0.5) AS {c}' for c in config.FEATURES)}
  FROM (SELECT c.* FROM ({O.complete_rows()}) c JOIN ({O.split_rank()}) r USING (vehicle_id, time)
        WHERE r.split = 'train') t)
  UNPIVOT INCLUDE NULLS (median FOR "column" IN ({', '.join(config.FEATURES)}))""")(
    lambda s, d: sp.feature_medians(ev_train(s, d), config.FEATURES, exact=True))

# ---- reporting ----------------------------------------------------------------------------------

from voltaic.operators import report as rp  # noqa: E402
from voltaic.operators.windows import temperature_columns  # noqa: E402
from voltaic.session import scratch_path  # noqa: E402
from voltaic.sources import files as fs  # noqa: E402
from voltaic.sources import raw as rw  # noqa: E402


def _scratch(spark, name: str) -> str:
    import uuid
    return scratch_path(spark, f"voltaic-queries/{name}-{uuid.uuid4().hex[:12]}")


def ev_wide(spark, d):
    return window_wide(ev_readings(spark, d), P.EV_WINDOW)


_PRESENT = ["hv_temp_min", "hv_temp_max", "battery_temp_avg", "hv_soc", "hv_battery_voltage", "no_such_column"]
_PRESENT_OK = [c for c in _PRESENT if c != "no_such_column"]
register("present_columns", f"""SELECT "column", non_null FROM (UNPIVOT (
  SELECT {', '.join(f'count({c}) AS {c}' for c in _PRESENT_OK)} FROM (
    SELECT *, (hv_temp_min + hv_temp_max) / 2 AS battery_temp_avg
    FROM ({O.pivot(O.EV_READINGS, config.SIGNALS_WIDE, P.EV_WINDOW, True)}) p) x)
  ON {', '.join(_PRESENT_OK)} INTO NAME "column" VALUE non_null) u WHERE non_null > 0""")(
    lambda s, d: rp.present_columns(
        temperature_columns(window_pivot(ev_readings(s, d), config.SIGNALS_WIDE, P.EV_WINDOW)), _PRESENT))

_ML_KEEP = [c for c in O.ML_COLS.split(", ") if c not in config.STREAM_FILL_COLUMNS]
register("fill_missing", f"""SELECT {', '.join(_ML_KEEP)},
  {', '.join(f'CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0 ELSE {c} END AS {c}' for c in config.STREAM_FILL_COLUMNS)}
FROM ({O.ml_dataset()}) m""")(lambda s, d: rp.fill_missing(ev_ml(s, d)))

register("vehicle_slice", f"""SELECT * FROM ({O.ev_wide()}) w WHERE vehicle_id = '{P.SLICE_VEHICLE}'
  AND CAST(time AS DATE) >= DATE '{P.SLICE_START}' AND CAST(time AS DATE) <= DATE '{P.SLICE_END}'""")(
    lambda s, d: rp.vehicle_slice(ev_wide(s, d), P.SLICE_VEHICLE, P.SLICE_START, P.SLICE_END))

register("vehicle_dates", f"""SELECT vehicle_id, CAST(min(time) AS DATE) AS first_date,
  CAST(max(time) AS DATE) AS last_date FROM ({O.ev_wide()}) w GROUP BY 1""")(
    lambda s, d: rp.vehicle_dates(ev_wide(s, d)))

register("coerce_numeric", """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
  TRY_CAST(event_type AS DOUBLE) AS event_type FROM events""")(
    lambda s, d: rp.coerce_numeric(s.read.parquet(f"{d}/events.parquet").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type"), ["k", "event_type"]))

register("latest_reading", f"""SELECT vehicle_id, max_by(time, time) AS time,
  max_by(hv_battery_voltage, time) AS hv_battery_voltage, max_by(hv_soc, time) AS hv_soc
FROM ({O.ev_wide()}) w GROUP BY 1""")(lambda s, d: rp.latest_reading(ev_wide(s, d), unique_time=True))

register("vehicle_kpis", f"""SELECT vehicle_id, round(avg(vehicle_speed), 9) AS avg_speed,
  round(avg(ambient_air_temp), 9) AS avg_ambient_temp, count(*) AS windows
FROM ({O.ev_wide()}) w GROUP BY 1""")(lambda s, d: rounded(rp.vehicle_kpis(ev_wide(s, d))))

register("vehicle_risk", f"""SELECT vehicle_id, count_if(maintenance_risk = 1) AS risk_count,
  count(maintenance_risk) AS labelled,
  round(CASE WHEN count(maintenance_risk) > 0 THEN 100.0 * count_if(maintenance_risk = 1) / count(maintenance_risk) END, 9)
    AS risk_percentage
FROM ({O.ml_dataset()}) m GROUP BY 1""")(lambda s, d: rounded(rp.vehicle_risk(ev_ml(s, d))))

register("label_names", f"""SELECT CASE maintenance_risk WHEN 0 THEN '{rp.LABEL_NAMES[0]}'
  WHEN 1 THEN '{rp.LABEL_NAMES[1]}' END AS label, count(*) AS windows
FROM ({O.ml_dataset()}) m WHERE maintenance_risk IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1""")(
    lambda s, d: rp.label_names(ev_ml(s, d)))

register("unpivot_signals", f"""SELECT vehicle_id, time, signal, value FROM (
  SELECT vehicle_id, time, hv_temp_min, hv_temp_max, battery_temp_avg FROM ({O.wide(O.LI_READINGS, P.LI_WINDOW)}) w)
  UNPIVOT INCLUDE NULLS (value FOR signal IN (hv_temp_min, hv_temp_max, battery_temp_avg))""")(
    lambda s, d: rp.unpivot_long(li_wide(s, d), ["vehicle_id", "time"], rp.TEMPERATURE_COLUMNS))

register("unpivot_metrics", f"""SELECT threshold, metric, score FROM (UNPIVOT (
  SELECT threshold, precision, recall, f1 FROM ({O.sweep(config.THRESHOLD_GRID_REPORT)}) x)
  ON precision, recall, f1 INTO NAME metric VALUE score) u""")(
    lambda s, d: rp.unpivot_long(ev.threshold_sweep(event_scores(s, d), config.THRESHOLD_GRID_REPORT),
                                 ["threshold"], ["precision", "recall", "f1"], "metric", "score"))

register("recent_rows", f"""SELECT {', '.join(rp.RECENT_COLUMNS)} FROM ({O.ev_wide()}) w
ORDER BY time DESC, vehicle_id LIMIT 100""")(lambda s, d: rp.recent_rows(ev_wide(s, d)))

register("preview", f"SELECT * FROM ({O.ml_dataset()}) m ORDER BY vehicle_id, time LIMIT 20")(
    lambda s, d: rp.preview(ev_ml(s, d), ["vehicle_id", "time"]))

register("change_scatter", f"""SELECT vehicle_id, time, soc_change, voltage_change, maintenance_risk
FROM ({O.ml_dataset()}) m""")(lambda s, d: rp.change_scatter(ev_ml(s, d)))

register("change_bins", f"""SELECT maintenance_risk, floor(soc_change / 1.0) * 1.0 AS soc_bin,
  floor(voltage_change / 5.0) * 5.0 AS voltage_bin, count(*) AS count
FROM ({O.ml_dataset()}) m GROUP BY ALL""")(lambda s, d: rp.change_bins(ev_ml(s, d)))


def _export_csv(spark, d):
    sliced = rp.vehicle_slice(ev_wide(spark, d), P.SLICE_VEHICLE, P.SLICE_START, P.SLICE_END)
    path = fs.export_csv(sliced, _scratch(spark, "export_csv"))
    return fs.read_csv(spark, path, sliced.schema)


register("export_csv", ORACLE["vehicle_slice"])(_export_csv)


#: Left out of the part file that holds rows without temperatures.
_TEMPERATURES = ["hv_temp_min", "hv_temp_max", "battery_temp_avg", "battery_temp_delta"]


def _load_folder(spark, d):
    """The whole table in three kinds of part files: all columns, times as text, no temperature columns."""
    wide = fs.read_dataset(spark, fs.write_dataset(ev_wide(spark, d), _scratch(spark, "load_folder_all")))
    kind = F.pmod(F.xxhash64("vehicle_id", "time"), F.lit(3))
    bare = (kind == 2) & F.coalesce(*_TEMPERATURES).isNull()
    path = fs.write_dataset(wide.filter((kind != 1) & ~bare), _scratch(spark, "load_folder"))
    wide.filter(kind == 1).withColumn("time", F.col("time").cast("string")).write.mode("append").parquet(path)
    wide.filter(bare).drop(*_TEMPERATURES).write.mode("append").parquet(path)
    return fs.load_folder(spark, path)


register("load_folder", O.ev_wide())(_load_folder)


def _dataset_roundtrip(spark, d):
    path = fs.write_dataset(ev_ml(spark, d), _scratch(spark, "dataset_roundtrip"), partition_by=["vehicle_id"])
    return fs.read_dataset(spark, path)


register("dataset_roundtrip", O.ml_dataset())(_dataset_roundtrip)


def _threshold_lookup(spark, d):
    sweep = ev.threshold_sweep(event_scores(spark, d), config.THRESHOLD_GRID_REPORT)
    path = fs.export_csv(sweep.select(*fs.THRESHOLD_METRICS_SCHEMA.fieldNames()), _scratch(spark, "metrics_csv"))
    return fs.threshold_lookup(fs.read_csv(spark, path, fs.THRESHOLD_METRICS_SCHEMA), P.EVAL_THRESHOLD)


register("threshold_lookup", f"""SELECT threshold, precision, recall, f1, true_positives, false_positives,
  false_negatives FROM ({O.sweep(config.THRESHOLD_GRID_REPORT)}) x WHERE round(threshold, 6) = 0.7""")(
    _threshold_lookup)

# ---- repair and normalization -------------------------------------------------------------------

register("repair_time", O.repaired())(lambda s, d: rw.repair_readings(rw.lineitem_raw_sources(s, d)))

def _normalize_sources(spark, d):
    """One raw folder per source, scanned as its source; the normalized output, a folder per source, is read back."""
    raw = rw.lineitem_raw_sources(spark, d).withColumnRenamed("time_ns", "time")
    path = fs.write_dataset(raw, _scratch(spark, "raw_sources"), partition_by=["source"])
    names = spark.read.parquet(path).select("source").distinct()  # from the folders' names: no file is read
    files = {r["source"]: f"{path}/source={r['source']}" for r in names.orderBy("source").collect()}
    norm = rw.normalize_sources(rw.sources_from_files(spark, files), ["SRC_R"])
    out = fs.write_dataset(norm, _scratch(spark, "normalized"), partition_by=["source"])
    return fs.read_dataset(spark, out, norm.schema)


register("normalize_sources", O.repaired(("SRC_R",)))(_normalize_sources)

register("row_accounting", f"""SELECT source, count(*) AS rows, count_if(corrected) AS corrected_rows
FROM ({O.repaired(('SRC_R',))}) n GROUP BY ROLLUP (source)""")(
    lambda s, d: pr.row_accounting(_normalize_sources(s, d)))


def _scan_nanos(spark, d):
    """All raw readings in files whose time is TIMESTAMP(NANOS), read back as whole nanoseconds."""
    return rw.scan_nanos(spark, *rw.write_nanos(rw.lineitem_raw_sources(spark, d), _scratch(spark, "raw_nanos")))


register("scan_nanos", O.LI_RAW)(_scan_nanos)

# ---- model: forest output has no SQL form. Its numbers stand beside the same numbers made a second way,
# from the table of the saved forest's nodes; keys and counts are checked by SQL -------------------------

from voltaic.operators import model as md  # noqa: E402
from voltaic.operators import nodes as nd  # noqa: E402

_KEYS = ["vehicle_id", "time", config.LABEL]


def ev_fitted(spark, d):
    """The split rows, stored once, and the forest fitted on their training part."""
    data = sp.materialize(sp.split_by_rank(ev_complete(spark, d)))
    return data, md.train_rf(data.filter(F.col("split") == "train"))


def _forest(spark, model):
    return nd.saved_forest(spark, model, _scratch(spark, "forest"))


def _scored(spark, model, rows):
    """Rows scored by the fitted pipeline and by its nodes."""
    nodes, depth = _forest(spark, model)
    both = nd.score_with_nodes(rows, nodes, md.model_features(model), depth)
    scored = md.score_rows(model, both, keep=(*_KEYS, "node_probability"))
    return scored.withColumn("same", F.col("risk_probability") == F.col("node_probability"))


def _importances(spark, model):
    nodes, _ = _forest(spark, model)
    again = nd.node_importance(nodes, md.model_features(model)).withColumnRenamed("importance", "node_importance")
    both = md.feature_importance(spark, model).join(again, "feature")
    return both.withColumn("same", F.abs(F.col("importance") - F.col("node_importance")) < 1e-12)


def _train_rf(spark, d):
    """The forest trained on the training part: its rows, its parameters, its size by the model and by its nodes."""
    data, model = ev_fitted(spark, d)
    nodes, _ = _forest(spark, model)
    forest = md.model_summary(spark, model).first()
    counts = data.filter(F.col("split") == "train").agg(
        F.count_if(F.col(config.LABEL) == 0).alias("train_negatives"), F.count_if(F.col(config.LABEL) == 1).alias("train_positives"))
    size = nodes.agg(F.count_distinct("tree").alias("trees"), F.count(F.lit(1)).alias("nodes")).first()
    return counts.select("*", *[F.lit(forest[c]).alias(c) for c in ("num_trees", "max_depth", "num_features", "total_nodes")],
                         F.lit((size["trees"], size["nodes"]) == (forest["num_trees"], forest["total_nodes"])).alias("same"))


register("train_rf")(_train_rf)
register("feature_importance")(lambda s, d: _importances(s, ev_fitted(s, d)[1]))


def _score_rows(spark, d):
    data, model = ev_fitted(spark, d)
    return _scored(spark, model, data.filter(F.col("split") == "test"))


register("score_rows")(_score_rows)

_TEST_KEYS = f"SELECT vehicle_id, time, maintenance_risk FROM ({O.split_rank()}) r WHERE split = 'test'"


def _scored_keys(spark, d):
    """Every test row is scored once, its prediction is the likelier class, and both ways agree."""
    p = F.col("risk_probability")
    ok = p.between(0, 1) & (F.col("prediction") == (p > 0.5).cast("double")) & F.col("same")
    return _score_rows(spark, d).select(*_KEYS, ok.alias("consistent"))


register("scored_keys", f"SELECT *, true AS consistent FROM ({_TEST_KEYS}) k")(_scored_keys)


def _forest_nodes(spark, d):
    """The trained forest as a table."""
    return _forest(spark, ev_fitted(spark, d)[1])[0]


register("forest_nodes")(_forest_nodes)


def _model_roundtrip(spark, d):
    """The saved and reloaded model scores every test row as the fitted one does."""
    data, model = ev_fitted(spark, d)
    path = md.save_model(model, _scratch(spark, "model"))
    test = data.filter(F.col("split") == "test")
    fitted = md.score_rows(model, test)
    again = md.score_rows(md.load_model(path), test).withColumnsRenamed(
        {"prediction": "prediction_2", "risk_probability": "risk_probability_2"})
    same = (F.col("prediction") == F.col("prediction_2")) & (F.col("risk_probability") == F.col("risk_probability_2"))
    return fitted.join(again, _KEYS).select(*_KEYS, same.alias("same"))


register("model_roundtrip", f"SELECT *, true AS same FROM ({_TEST_KEYS}) k")(_model_roundtrip)


def _both_sweeps(scored: DataFrame, grid) -> DataFrame:
    """The sweep over the pipeline's probabilities, and whether the nodes' probabilities give the same."""
    sweep = ev.threshold_sweep(scored, grid)
    again = ev.threshold_sweep(scored.withColumn("risk_probability", F.col("node_probability")), grid)
    cells = [c for c in sweep.columns if c != "threshold"]
    b = again.select("threshold", *[F.col(c).alias(f"{c}_2") for c in cells])
    same = F.lit(True)
    for c in cells:
        same &= F.col(c).eqNullSafe(F.col(f"{c}_2"))
    return sweep.join(b, "threshold").select("threshold", *cells, same.alias("same"))


def _validation_sweep(spark, d):
    data, model = ev_fitted(spark, d)
    return _both_sweeps(_scored(spark, model, data.filter(F.col("split") == "validation")), config.THRESHOLD_GRID_LOW)


register("validation_sweep")(_validation_sweep)

_LOW_GRID = ", ".join(f"({t})" for t in config.THRESHOLD_GRID_LOW)
register("validation_counts", f"""SELECT CAST(t0 AS DOUBLE) AS threshold, count_if(maintenance_risk = 1) AS positives,
  count_if(maintenance_risk = 0) AS negatives
FROM ({O.split_rank()}) r, (VALUES {_LOW_GRID}) v(t0) WHERE split = 'validation' GROUP BY 1""")(
    lambda s, d: _validation_sweep(s, d).select(
        "threshold", (F.col("true_positives") + F.col("false_negatives")).alias("positives"),
        (F.col("false_positives") + F.col("true_negatives")).alias("negatives")))

# ---- streaming --------------------------------------------------------------------------------

from voltaic.streaming import features as sf  # noqa: E402
from voltaic.streaming import messages as ms  # noqa: E402
from voltaic.streaming import progress as pg  # noqa: E402

_PARSED = "vehicle_id, time AS event_time, value_id, value"


def _messages_dir(spark, d, name, readings=None, mode="overwrite", path=None):
    path = path or _scratch(spark, name)
    ms.write_text(ms.publish_messages(readings if readings is not None else ev_readings(spark, d)), path, mode)
    return path


register("publish_messages", f"""SELECT vehicle_id AS key, vehicle_id, time, value_id, value FROM ({O.EV_READINGS}) r""")(
    lambda s, d: ms.publish_messages(ev_readings(s, d)).select(
        "key", F.from_json("value", ms.MESSAGE_SCHEMA).alias("m")).select(
        "key", "m.vehicle_id", F.col("m.time").try_cast("timestamp_ntz").alias("time"), "m.value_id", "m.value"))


#: Readings of four codes are sent a second time, spoilt in a way of their own each.
_SPOILT = "vehicle_id IS NOT NULL AND time IS NOT NULL AND value IS NOT NULL AND value_id IN (4, 15, 56, 900)"


def _spoilt_dir(spark, d, name):
    """The messages of all readings and spoilt copies: no JSON, an unreadable time, a
    fractional code, no value."""
    readings = ev_readings(spark, d)
    path = _messages_dir(spark, d, name, readings)
    code = F.get_json_object("value", "$.value_id").cast("int")
    text = F.col("value")
    spoilt = ms.publish_messages(readings.filter(_SPOILT)).select(
        "key",
        F.when(code == 4, F.concat(F.lit("oops "), text))
        .when(code == 15, F.regexp_replace(text, '"time":"[^"]*"', '"time":"noon"'))
        .when(code == 56, F.regexp_replace(text, '"value_id":56', '"value_id":56.5'))
        .otherwise(F.regexp_replace(text, ',"value":[^}]*', "")).alias("value"))
    ms.write_text(spoilt, path, "append")
    return path


def _stream_parse(spark, d):
    src = _spoilt_dir(spark, d, "stream_parse_in")
    out, ck = _scratch(spark, "stream_parse_out"), _scratch(spark, "stream_parse_ck")
    parsed = ms.parse_messages(ms.text_source(spark, src))
    sf.run_to_parquet(sf.to_ntz_times(parsed, ("event_time",)), out, ck)
    return spark.read.parquet(out).fillna(-1, subset=["value_id"])  # an unreadable code shows as -1


register("stream_parse", f"""SELECT vehicle_id, time AS event_time, coalesce(value_id, -1) AS value_id, value
FROM ({O.EV_READINGS}) r UNION ALL
SELECT CASE WHEN value_id <> 4 THEN vehicle_id END, CASE WHEN value_id NOT IN (4, 15) THEN time END,
  CASE WHEN value_id NOT IN (4, 56) THEN value_id ELSE -1 END, CASE WHEN value_id NOT IN (4, 900) THEN value END
FROM ({O.EV_READINGS}) s WHERE {_SPOILT}""")(_stream_parse)


def _topic_inspect(spark, d):
    src = _messages_dir(spark, d, "topic_inspect_in")
    return sf.to_ntz_times(ms.parse_messages(ms.text_source(spark, src, stream=False)), ("event_time",))


register("topic_inspect", f"SELECT {_PARSED} FROM ({O.EV_READINGS}) r")(_topic_inspect)


def _run_windows(spark, src, tag):
    out, ck = _scratch(spark, f"{tag}_out"), _scratch(spark, f"{tag}_ck")
    win = sf.stream_windows(ms.text_source(spark, src), window=P.EV_WINDOW)
    q = sf.run_to_parquet(sf.to_ntz_times(win), out, ck)
    return out, ck, q


def _stream_windows(spark, d):
    out, _, _ = _run_windows(spark, _messages_dir(spark, d, "stream_windows_in"), "stream_windows")
    return spark.read.parquet(out)


register("stream_windows", O.stream_windows())(_stream_windows)


def _stream_late(spark, d):
    """T4: a second batch of readings shifted 10 days back arrives after the
    watermark passed them; the state store drops every one of them. Spark counts
    the dropped rows after the partial aggregate (one per task, key and window)."""
    src = _messages_dir(spark, d, "stream_late_in")
    out = _scratch(spark, "stream_late_out")
    ck = _scratch(spark, "stream_late_ck")

    def run():
        win = sf.stream_windows(ms.text_source(spark, src), window=P.EV_WINDOW)
        return sf.run_to_parquet(sf.to_ntz_times(win), out, ck)

    run()
    late = ev_readings(spark, d).withColumn("time", F.timestamp_add("DAY", F.lit(-10), F.col("time")))
    _messages_dir(spark, d, "", late, mode="append", path=src)
    q = run()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  for op in p.get("stateOperators") or [])
    return spark.read.parquet(out).withColumn("late_rows_dropped", F.lit(dropped > 0))


register("stream_late", f"SELECT *, true AS late_rows_dropped FROM ({O.stream_windows()}) w")(_stream_late)


def _stream_features(spark, d, halves: bool = False, state_ttl: str | None = None, ck: str | None = None):
    src = _scratch(spark, "stream_features_in")
    out, ck = _scratch(spark, "stream_features_out"), ck or _scratch(spark, "stream_features_ck")
    readings = ev_readings(spark, d)

    def run():
        feats = sf.stream_features(sf.stream_windows(ms.text_source(spark, src), window=P.EV_WINDOW),
                                   band=P.EV_BAND, state_ttl=state_ttl, window=P.EV_WINDOW)
        sf.run_to_parquet(sf.to_ntz_times(feats), out, ck)

    if halves:  # restart from the checkpoint half way: state must carry over
        mid = readings.agg(F.percentile_approx("time", 0.5, 10000).alias("m")).first()["m"]
        cut = lit_for(readings, "time", mid)
        _messages_dir(spark, d, "", readings.filter(F.col("time") <= cut), path=src)
        run()
        _messages_dir(spark, d, "", readings.filter(F.col("time") > cut), mode="append", path=src)
    else:
        _messages_dir(spark, d, "", readings, path=src)
    run()
    return spark.read.parquet(out)


register("stream_features", O.stream_features())(_stream_features)
register("stream_restart", O.stream_features())(lambda s, d: _stream_features(s, d, halves=True))

register("stream_expiry", O.stream_features(ttl=P.EV_STATE_TTL))(
    lambda s, d: _stream_features(s, d, halves=True, state_ttl=P.EV_STATE_TTL))


def _stream_state(spark, d):
    """The state that the feature stream left in its checkpoint: each vehicle's last valid closed window."""
    ck = _scratch(spark, "stream_state_ck")
    _stream_features(spark, d, ck=ck)
    return pg.last_windows(spark, ck)


register("stream_state", f"""SELECT vehicle_id, max(time) AS time, max_by(hv_battery_voltage, time) AS hv_battery_voltage,
  max_by(hv_soc, time) AS hv_soc FROM ({O.stream_features()}) f GROUP BY 1""")(_stream_state)


def _stream_progress(spark, d):
    """Readings in two deliveries: what each micro-batch planned, its watermarks, whether it is done."""
    ck = _scratch(spark, "stream_progress_ck")
    _stream_features(spark, d, halves=True, ck=ck)
    done = pg.progress(spark, ck).filter("committed")
    return done.agg(F.max("next_watermark").alias("watermark"), F.count_if(F.size("offsets") == 1).alias("batches")) \
        .select("watermark", (F.col("batches") >= 2).alias("two_deliveries"))


register("stream_progress", f"""SELECT date_trunc('millisecond', max(time)) - INTERVAL 30 SECOND AS watermark,
  true AS two_deliveries FROM ({O.ev_valid_messages()}) m""")(_stream_progress)


def _stream_redelivery(spark, d):
    """Every message sent twice: the windows of once."""
    src = _messages_dir(spark, d, "stream_redelivery_in")
    _messages_dir(spark, d, "", mode="append", path=src)
    out, ck = _scratch(spark, "stream_redelivery_out"), _scratch(spark, "stream_redelivery_ck")
    win = sf.stream_windows(ms.text_source(spark, src, max_files_per_trigger=None), window=P.EV_WINDOW, redelivered=True)
    sf.run_to_parquet(sf.to_ntz_times(win), out, ck)
    return spark.read.parquet(out)


register("stream_redelivery", O.stream_windows(f"SELECT DISTINCT * FROM ({O.EV_READINGS}) e WHERE value IS NOT NULL"))(
    _stream_redelivery)


def _stream_scores(spark, d):
    """The stream scored by the pipeline and, in the same micro-batches, by the nodes of its saved forest."""
    model = ev_fitted(spark, d)[1]
    nodes, depth = _forest(spark, model)
    src = _messages_dir(spark, d, "stream_scores_in")
    out, ck = _scratch(spark, "stream_scores_out"), _scratch(spark, "stream_scores_ck")
    feats = sf.stream_features(sf.stream_windows(ms.text_source(spark, src), window=P.EV_WINDOW),
                               band=P.EV_BAND, first_row="current")
    filled = feats.fillna(0.0, subset=list(config.STREAM_FILL_COLUMNS))
    filled = nd.score_with_nodes(filled, nodes, md.model_features(model), depth)
    scored = sf.score_stream(filled, model, keep=("node_probability",))
    sf.run_to_parquet(sf.to_ntz_times(scored), out, ck)
    return spark.read.parquet(out).withColumn("same", F.col("risk_probability") == F.col("node_probability"))


register("stream_scores")(_stream_scores)

_SCORED_WINDOWS = f"""SELECT vehicle_id, time, hv_soc, hv_battery_voltage, coalesce(voltage_change, 0.0) AS voltage_change,
  coalesce(soc_change, 0.0) AS soc_change FROM ({O.stream_features()}) f"""
register("stream_scored_windows", f"SELECT *, true AS same FROM ({_SCORED_WINDOWS}) w")(
    lambda s, d: _stream_scores(s, d).drop("prediction", "risk_probability", "node_probability"))

# ---- the ML chain on daily supplier readings (larger input; also used by the bench) ---------------

_LI_DAILY = dict(window="1 day", band=(1.0, 50.0), threshold=20.0)


def li_ml_daily(spark, d):
    return fx.ml_dataset(li_readings(spark, d), **_LI_DAILY)


register("ml_dataset_daily", O.ml_dataset(_LI_DAILY["threshold"], band=_LI_DAILY["band"], readings=O.LI_READINGS,
                                          window=_LI_DAILY["window"]))(li_ml_daily)

# ---- schema report, per-split counts, the imputed pipeline, test evaluation -----------------------

register("schema_report", f"""SELECT * FROM (VALUES
  (0, 'vehicle_id', 'string', true), (1, 'time', 'timestamp_ntz', true),
  (2, 'value_id', 'int', true), (3, 'value', 'double', true)) t(position, "column", type, nullable)
JOIN (UNPIVOT (SELECT count(vehicle_id) AS vehicle_id, count(time) AS time, count(value_id) AS value_id,
  count(value) AS value FROM ({O.EV_READINGS}) r) ON vehicle_id, time, value_id, value
  INTO NAME "column" VALUE non_null) c USING ("column")""")(
    lambda s, d: pr.schema_report(ev_readings(s, d)))

register("split_distribution", f"""SELECT split, maintenance_risk, count(*) AS count FROM ({O.split_rank()}) r
GROUP BY 1, 2 ORDER BY 1, 2""")(
    lambda s, d: pr.class_distribution(sp.split_by_rank(ev_complete(s, d)), by=["split"]))


def _train_imputed(spark, d):
    """The 60/20/20 time-percentile variant: median imputer fitted on training rows,
    SOC-first feature order (the second training script)."""
    data = sp.split_by_time(ev_ml(spark, d), [0.6, 0.8], exact=True)
    features = config.FEATURES_SOC_FIRST
    model = md.train_rf(data.filter(F.col("split") == "train"), features, impute=True, relative_error=0.0)
    medians = model.stages[0].surrogateDF.unpivot([], features, "feature", "surrogate")
    return _importances(spark, model).join(medians, "feature")


register("train_rf_imputed")(_train_imputed)

_MEDIANS = ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in config.FEATURES_SOC_FIRST)
register("imputed_medians", f"""WITH m AS ({O.ml_dataset()}),
t AS (SELECT {_MEDIANS} FROM m WHERE time <= (SELECT quantile_disc(time, 0.6) FROM m))
SELECT feature, surrogate, true AS same
FROM (UNPIVOT t ON {", ".join(config.FEATURES_SOC_FIRST)} INTO NAME feature VALUE surrogate) u""")(
    lambda s, d: _train_imputed(s, d).select("feature", "surrogate", "same"))


def _evaluate_best_on_test(spark, d):
    """M8 + M9: choose the threshold on validation, evaluate it on the test split; both by both ways."""
    data, model = ev_fitted(spark, d)
    parts = {name: _scored(spark, model, data.filter(F.col("split") == name)) for name in ("validation", "test")}

    def best(column: str) -> DataFrame:
        own = {k: v.withColumn("risk_probability", F.col(column)) for k, v in parts.items()}
        chosen = ev.best_threshold(ev.threshold_sweep(own["validation"], config.THRESHOLD_GRID_LOW)).first()
        return ev.evaluate_at_threshold(own["test"], chosen["threshold"])

    return best("risk_probability").withColumn(
        "same", F.lit(best("risk_probability").first() == best("node_probability").first()))


register("evaluate_best_on_test")(_evaluate_best_on_test)


def _message_quality(spark, d):
    return ms.message_quality(ms.text_source(spark, _spoilt_dir(spark, d, "message_quality_in"), stream=False))


register("message_quality", f"""SELECT count(*) + count_if({_SPOILT}) AS messages,
  count_if(vehicle_id IS NULL AND time IS NULL AND value_id IS NULL AND value IS NULL)
    + count_if({_SPOILT} AND value_id = 4) AS malformed,
  count_if({_SPOILT} AND value_id = 15) AS bad_time,
  count_if(value_id IS NULL) + count_if({_SPOILT} AND value_id = 56) AS no_code,
  count_if(value IS NULL) + count_if({_SPOILT} AND value_id = 900) AS no_value FROM ({O.EV_READINGS}) r""")(
    _message_quality)

_FINE_GRID = [round(i / 100, 2) for i in range(101)]
register("threshold_curve", O.sweep(_FINE_GRID))(
    lambda s, d: ev.threshold_sweep(event_scores(s, d), _FINE_GRID))

# ---- tables kept up to date, clustered tables, mergeable sketches ---------------------------------

from voltaic.operators import sketches as sk  # noqa: E402
from voltaic.sources import clustered as cl  # noqa: E402
from voltaic.sources import incremental as inc  # noqa: E402


def _window_incremental(spark, d):
    """The readings in two deliveries, the second with late ones of earlier days; a third update finds nothing to do."""
    readings = li_readings(spark, d)
    cut = lit_for(readings, "time", readings.agg(F.percentile_approx("time", 0.75, 10000).alias("m")).first()["m"])
    first = F.coalesce((F.col("time") <= cut) & (F.pmod(F.xxhash64("vehicle_id", "time"), F.lit(10)) > 0), F.lit(False))
    src, out, log = (_scratch(spark, f"window_incremental_{n}") for n in ("in", "out", "log"))
    for part in (first, ~first):
        readings.filter(part).write.mode("append").parquet(src)
        inc.update_windows(spark, src, out, log, window=P.LI_WINDOW)
    inc.update_windows(spark, src, out, log, window=P.LI_WINDOW)
    return inc.read_windows(spark, out)


register("window_incremental", O.wide(O.LI_READINGS, P.LI_WINDOW))(_window_incremental)


def _clustered_slice(spark, d):
    path = cl.write_clustered(ev_wide(spark, d), _scratch(spark, "clustered"), files=32)
    return cl.read_slice(spark, path, vehicle=P.SLICE_VEHICLE, start=P.SLICE_START, end=P.SLICE_END)


register("clustered_slice", ORACLE["vehicle_slice"])(_clustered_slice)


def _range_quantiles(spark, d):
    """Quantiles of every vehicle and signal from stored daily sketches, held against the true ranks of the readings."""
    readings = ev_readings(spark, d)
    stored = fs.read_dataset(spark, fs.write_dataset(sk.daily_sketches(readings), _scratch(spark, "sketches")))
    by = ["vehicle_id", "value_id"]
    found = sk.quantiles(sk.merged(stored, by), config.PERCENTILES)
    return sk.within_bound(found, readings, by, error=sk.rank_error()).drop("estimate")


register("range_quantiles", f"""SELECT vehicle_id, value_id, readings, low, high, quantile, true AS rank_error_ok
FROM (SELECT vehicle_id, value_id, count(*) AS readings, min(value) AS low, max(value) AS high FROM ({O.EV_READINGS}) r
      WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1, 2) g,
  (SELECT CAST(q0 AS DOUBLE) AS quantile FROM (VALUES {', '.join(f'({q})' for q in config.PERCENTILES)}) v(q0)) q""")(
    _range_quantiles)
