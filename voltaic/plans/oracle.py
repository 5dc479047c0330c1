"""DuckDB SQL oracles, built from small CTE pieces that mirror the operators."""
from __future__ import annotations

from voltaic import config
from voltaic.plans import params as P

EV_READINGS = """SELECT 'V' || CAST(user_id % 7 AS VARCHAR) AS vehicle_id, ts AS time,
  CAST(CASE event_type WHEN 'click' THEN 4 WHEN 'error' THEN 15 WHEN 'purchase' THEN 56
       WHEN 'signup' THEN 900 WHEN 'view' THEN 1200 END AS INTEGER) AS value_id,
  CAST(value AS DOUBLE) AS value
FROM events"""

LI_READINGS = """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS vehicle_id, CAST(l_shipdate AS TIMESTAMP) AS time,
  CAST(CASE l_linenumber WHEN 1 THEN 4 WHEN 2 THEN 15 WHEN 3 THEN 56 WHEN 4 THEN 900
       WHEN 5 THEN 1200 WHEN 6 THEN 1208 WHEN 7 THEN 1209 END AS INTEGER) AS value_id,
  CAST(l_quantity AS DOUBLE) AS value
FROM lineitem"""

LI_PRICED = """SELECT CASE WHEN l_suppkey % 2 = 1 THEN 'S' || CAST(l_suppkey AS VARCHAR) END AS vehicle_id,
  CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS time,
  CAST(CASE l_linenumber WHEN 1 THEN 4 WHEN 2 THEN 15 WHEN 3 THEN 56 WHEN 4 THEN 900
       WHEN 5 THEN 1200 WHEN 6 THEN 1208 WHEN 7 THEN 1209 END AS INTEGER) AS value_id,
  CASE WHEN l_orderkey % 3 > 0 THEN CAST(l_quantity AS DOUBLE) END AS value,
  CASE WHEN l_partkey % 4 > 0 THEN CAST(l_extendedprice AS DOUBLE) END AS price
FROM lineitem"""

SCORES = """SELECT 'V' || CAST(user_id % 7 AS VARCHAR) AS vehicle_id, ts AS time, event_id,
  CAST(value > 100 AS INTEGER) AS maintenance_risk,
  CASE WHEN event_id % 17 <> 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 END AS risk_probability,
  CAST(event_id % 17 <> 0 AND CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 >= 0.5 AS DOUBLE) AS prediction
FROM events"""


def pivot(readings_sql: str, signals: dict, window: str, with_end: bool) -> str:
    aggs = ",\n  ".join(f"avg(CASE WHEN value_id = {k} THEN value END) AS {v}" for k, v in signals.items())
    end = f", time_bucket(INTERVAL '{window}', time, TIMESTAMP '1970-01-01') + INTERVAL '{window}' AS window_end" \
        if with_end else ""
    codes = ", ".join(str(k) for k in signals)
    return f"""SELECT vehicle_id, time_bucket(INTERVAL '{window}', time, TIMESTAMP '1970-01-01') AS time{end},
  {aggs}
FROM ({readings_sql}) r
WHERE value_id IN ({codes}) AND time IS NOT NULL
GROUP BY ALL"""


def wide(readings_sql: str, window: str) -> str:
    return f"""SELECT *, (hv_temp_min + hv_temp_max) / 2 AS battery_temp_avg,
  hv_temp_max - hv_temp_min AS battery_temp_delta,
  CASE WHEN hv_temp_min IS NOT NULL AND hv_temp_max IS NOT NULL THEN 1 ELSE 0 END AS temperature_available
FROM ({pivot(readings_sql, config.SIGNALS_WIDE, window, True)}) p
WHERE hv_soc IS NOT NULL AND hv_battery_voltage IS NOT NULL"""


def banded(band=P.EV_BAND, readings: str = EV_READINGS, window: str = P.EV_WINDOW) -> str:
    lo, hi = band
    return f"""SELECT *, CASE WHEN hv_soc > 0 THEN hv_battery_voltage / hv_soc END AS voltage_per_soc
FROM ({pivot(readings, config.SIGNALS_ML, window, False)}) p
WHERE hv_battery_voltage >= {lo} AND hv_battery_voltage <= {hi} AND NOT isnan(hv_battery_voltage) AND hv_soc IS NOT NULL"""


def sequenced(band=P.EV_BAND, lookahead: int = config.LOOKAHEAD_ROWS, readings: str = EV_READINGS,
              window: str = P.EV_WINDOW) -> str:
    return f"""WITH b AS ({banded(band, readings, window)}),
l AS (SELECT *, lag(hv_battery_voltage) OVER w AS previous_voltage, lag(hv_soc) OVER w AS previous_soc
      FROM b WINDOW w AS (PARTITION BY vehicle_id ORDER BY time)),
c AS (SELECT *, hv_battery_voltage - previous_voltage AS voltage_change, hv_soc - previous_soc AS soc_change FROM l)
SELECT *, max(abs(voltage_change)) OVER (PARTITION BY vehicle_id ORDER BY time
          ROWS BETWEEN 1 FOLLOWING AND {lookahead} FOLLOWING) AS future_max_voltage_change
FROM c"""


def labelled(threshold=P.EV_RISK, **kw) -> str:
    return f"""SELECT *, CASE WHEN future_max_voltage_change > {threshold} THEN 1 ELSE 0 END AS maintenance_risk
FROM ({sequenced(**kw)}) s"""


ML_COLS = ("vehicle_id, time, vehicle_speed, ambient_air_temp, hv_aux_power, hv_soc, hv_battery_voltage, "
           "voltage_per_soc, previous_voltage, previous_soc, voltage_change, soc_change, "
           "future_max_voltage_change, maintenance_risk")


def ml_dataset(threshold=P.EV_RISK, **kw) -> str:
    """The ML table; keyword arguments as ``sequenced`` (band, readings, window)."""
    return f"""SELECT {ML_COLS} FROM ({labelled(threshold, **kw)}) x
WHERE previous_voltage IS NOT NULL AND previous_soc IS NOT NULL AND future_max_voltage_change IS NOT NULL"""


def complete_rows(features=config.FEATURES) -> str:
    cols = ", ".join(features)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in ["vehicle_id", "time", "maintenance_risk", *features])
    return f"SELECT vehicle_id, time, maintenance_risk, {cols} FROM ({ml_dataset()}) m WHERE {nn}"


def ranked() -> str:
    return f"""SELECT *, row_number() OVER (ORDER BY time, vehicle_id) AS rn, count(*) OVER () AS n
FROM ({complete_rows()}) c"""


def split_rank() -> str:
    return f"""SELECT vehicle_id, time, maintenance_risk,
  CASE WHEN rn <= CAST(floor(n * 0.6) AS BIGINT) THEN 'train'
       WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'validation' ELSE 'test' END AS split
FROM ({ranked()}) r"""


def labelled_ends(lookahead: int = config.LOOKAHEAD_ROWS) -> str:
    """Complete rows with the time of the last row that their label looks at."""
    nn = " AND ".join(f"{c} IS NOT NULL" for c in ["vehicle_id", "time", "maintenance_risk", *config.FEATURES])
    return f"""SELECT * FROM (SELECT *, max(time) OVER (PARTITION BY vehicle_id ORDER BY time
    ROWS BETWEEN 1 FOLLOWING AND {lookahead} FOLLOWING) AS label_end FROM ({labelled()}) x) y
WHERE future_max_voltage_change IS NOT NULL AND previous_soc IS NOT NULL AND {nn}"""


def split_purged() -> str:
    """Rows whose frame does not reach past the last row of their part."""
    return f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY time, vehicle_id) AS rn, count(*) OVER () AS n
           FROM ({labelled_ends()}) c),
s AS (SELECT *, CASE WHEN rn <= CAST(floor(n * 0.6) AS BIGINT) THEN 'train'
             WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM r),
e AS (SELECT split, max(rn) AS rn FROM s GROUP BY 1),
c AS (SELECT s.split, s.time AS t, s.vehicle_id AS v FROM s JOIN e USING (split, rn))
SELECT vehicle_id, time, label_end, maintenance_risk, split FROM s JOIN c USING (split)
WHERE split = 'test' OR label_end < t OR (label_end = t AND vehicle_id <= v)"""


def lookahead_horizon(horizon: str) -> str:
    return f"""SELECT vehicle_id, time, voltage_change, max(abs(voltage_change)) OVER (PARTITION BY vehicle_id ORDER BY time
  RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND INTERVAL '{horizon}' FOLLOWING) AS horizon_max_voltage_change
FROM ({sequenced()}) s"""


def ev_wide() -> str:
    return wide(EV_READINGS, P.EV_WINDOW)


LI_RAW = f"""SELECT 'SRC_' || l_returnflag AS source, 'S' || CAST(l_suppkey AS VARCHAR) AS vehicle_id,
  epoch_us(CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS TIMESTAMP) + INTERVAL 64 YEAR
                ELSE CAST(l_shipdate AS TIMESTAMP) END) * 1000 + l_orderkey * 1001000 AS time_ns,
  CAST(CASE l_linenumber WHEN 1 THEN 4 WHEN 2 THEN 15 WHEN 3 THEN 56 WHEN 4 THEN 900
       WHEN 5 THEN 1200 WHEN 6 THEN 1208 WHEN 7 THEN 1209 END AS INTEGER) AS value_id,
  CAST(l_quantity AS DOUBLE) AS value
FROM lineitem"""


def repaired(listed: tuple | None = None) -> str:
    cond = "time_ns > 1704067200000000000"
    if listed is not None:
        names = ", ".join(f"'{s}'" for s in listed)
        cond = f"source IN ({names}) AND {cond}"
    return f"""SELECT source, vehicle_id, value_id, value,
  CASE WHEN {cond} THEN make_timestamp(time_ns // 1000) - INTERVAL 64 YEAR
       ELSE make_timestamp(time_ns // 1000) END AS time,
  coalesce({cond}, false) AS corrected
FROM ({LI_RAW}) r"""


def ev_valid_messages() -> str:
    return f"SELECT * FROM ({EV_READINGS}) r WHERE value_id IN (4, 15, 56, 900, 1200) AND time IS NOT NULL AND value IS NOT NULL"


def stream_windows(readings: str = EV_READINGS) -> str:
    cols = ", ".join(config.SIGNALS_ML.values())
    return f"""SELECT vehicle_id, time, {cols}
FROM ({pivot(readings, config.SIGNALS_ML, P.EV_WINDOW, True)}) w
WHERE window_end <= (SELECT max(time) FROM ({ev_valid_messages()}) m) - INTERVAL 30 SECOND"""


def stream_features(band=P.EV_BAND, ttl: str | None = None) -> str:
    lo, hi = band
    fresh = f"time - previous_time <= INTERVAL '{ttl}'"
    kept = "*" if ttl is None else f"""* EXCLUDE (previous_voltage, previous_soc, previous_time),
  CASE WHEN {fresh} THEN previous_voltage END AS previous_voltage,
  CASE WHEN {fresh} THEN previous_soc END AS previous_soc"""
    return f"""WITH v AS (SELECT * FROM ({stream_windows()}) w
  WHERE hv_soc IS NOT NULL AND hv_battery_voltage IS NOT NULL AND hv_soc > 0
    AND hv_battery_voltage >= {lo} AND hv_battery_voltage <= {hi} AND NOT isnan(hv_battery_voltage)),
l AS (SELECT *, hv_battery_voltage / hv_soc AS voltage_per_soc,
  lag(hv_battery_voltage) OVER w AS previous_voltage, lag(hv_soc) OVER w AS previous_soc{
    "" if ttl is None else ", lag(time) OVER w AS previous_time"}
  FROM v WINDOW w AS (PARTITION BY vehicle_id ORDER BY time)),
p AS (SELECT {kept} FROM l)
SELECT *, hv_battery_voltage - previous_voltage AS voltage_change, hv_soc - previous_soc AS soc_change FROM p"""


def rates(inner: str, with_threshold: bool = True) -> str:
    return f"""SELECT {'threshold, ' if with_threshold else ''}
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)
          + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END) > 0
       THEN 2 * (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)
              * (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)
            / ((CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)
              + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END))
       ELSE 0.0 END AS f1,
  CAST(tp AS BIGINT) AS true_positives, CAST(fp AS BIGINT) AS false_positives,
  CAST(fn AS BIGINT) AS false_negatives, CAST(tn AS BIGINT) AS true_negatives,
  CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END AS fpr,
  CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) / (tp + tn + fp + fn) ELSE 0.0 END AS accuracy
FROM (SELECT {'t.threshold, ' if with_threshold else ''}
  CAST(count_if(maintenance_risk = 1 AND {{p}}) AS DOUBLE) AS tp,
  CAST(count_if(maintenance_risk = 0 AND {{p}}) AS DOUBLE) AS fp,
  CAST(count_if(maintenance_risk = 1 AND NOT coalesce({{p}}, false)) AS DOUBLE) AS fn,
  CAST(count_if(maintenance_risk = 0 AND NOT coalesce({{p}}, false)) AS DOUBLE) AS tn
  FROM {inner} GROUP BY ALL) c"""


def sweep(grid) -> str:
    values = ", ".join(f"({t})" for t in grid)
    inner = f"({SCORES}) s, (SELECT CAST(t0 AS DOUBLE) AS threshold FROM (VALUES {values}) v(t0)) t"
    body = rates(inner).replace("{p}", "coalesce(s.risk_probability >= t.threshold, false)")
    return f"""SELECT threshold, precision, recall, f1, true_positives, false_positives, false_negatives,
  true_negatives, fpr FROM ({body}) r"""


def time_split(fracs, names) -> str:
    qs = ", ".join(f"quantile_disc(time, {f}) AS q{i}" for i, f in enumerate(fracs))
    case = " ".join(f"WHEN time <= q{i} THEN '{n}'" for i, n in enumerate(names[:-1]))
    return f"""SELECT vehicle_id, time, maintenance_risk, CASE {case} ELSE '{names[-1]}' END AS split
FROM ({complete_rows()}) c, (SELECT {qs} FROM ({complete_rows()}) c2) q"""
