"""Fixed values and default parameters.

The signal codes, their names, feature lists and numeric defaults below are
fixed values: results only match the reference when they are exactly these.
"""
from __future__ import annotations

# --- fixed values: signal codes -> column names (batch window table) ---
SIGNALS_WIDE = {
    4: "vehicle_speed",
    15: "ambient_air_temp",
    56: "hv_aux_power",
    900: "hv_soc",
    1200: "hv_battery_voltage",
    1208: "hv_temp_min",
    1209: "hv_temp_max",
}

# --- fixed values: signal codes -> column names (ML window table, stream) ---
SIGNALS_ML = {
    4: "vehicle_speed",
    15: "ambient_air_temp",
    56: "hv_aux_power",
    900: "hv_soc",
    1200: "hv_battery_voltage",
}

# --- fixed values: codes inspected by the battery signal check, with names ---
BATTERY_SIGNAL_NAMES = {
    900: "SOC",
    1200: "HV Battery Voltage",
    1290: "Depth of Discharge",
    1293: "Cell Voltage Max",
    1294: "Cell Voltage Min",
    1295: "Cell Voltage Delta",
}

# --- fixed values: feature columns in the two orders the reference uses ---
FEATURES = [
    "vehicle_speed", "ambient_air_temp", "hv_aux_power", "hv_soc",
    "hv_battery_voltage", "voltage_per_soc", "previous_voltage",
    "previous_soc", "voltage_change", "soc_change",
]
FEATURES_SOC_FIRST = [
    "hv_soc", "hv_battery_voltage", "vehicle_speed", "ambient_air_temp",
    "hv_aux_power", "voltage_per_soc", "previous_voltage", "previous_soc",
    "voltage_change", "soc_change",
]

# --- fixed values: numeric defaults ---
WINDOW = "10 seconds"
VOLTAGE_BAND = (300.0, 500.0)
LOOKAHEAD_ROWS = 6
RISK_THRESHOLD_VOLTS = 20.0
REPAIR_LIMIT_NS = 1704067200000000000  # 2024-01-01T00:00:00Z in ns
REPAIR_YEARS = 64
WATERMARK = "30 seconds"
PERCENTILES = [0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99]
PERCENTILE_NAMES = ["p01", "p05", "p25", "median", "p75", "p95", "p99"]
SPLIT_FRACTIONS = (0.6, 0.8)
RF_PARAMS = {"numTrees": 100, "maxDepth": 8, "seed": 42}
THRESHOLD_GRID_COARSE = [0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90]
THRESHOLD_GRID_REPORT = [0.50, 0.60, 0.70, 0.80]
THRESHOLD_GRID_LOW = [0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50]
DEFAULT_THRESHOLD = 0.50
STREAM_FILL_COLUMNS = [
    "vehicle_speed", "ambient_air_temp", "hv_aux_power", "voltage_per_soc",
    "previous_voltage", "previous_soc", "voltage_change", "soc_change",
]
LABEL = "maintenance_risk"
