"""Rules, thresholds, weights, bands and name maps.

Everything an operator compares against lives here as plain data so that a
caller can swap it (the driver-table bindings in ``plans/bindings.py`` do).
The defaults reproduce the reference pipeline's behaviour.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RangeRule:
    """Closed physical range for one column; ``hard`` breaks quarantine."""

    column: str
    lo: float
    hi: float
    hard: bool


@dataclass(frozen=True)
class StatusGroups:
    """Which operating statuses count as operating / idle / down.

    ``down_token`` is a substring test (the reference counts every status
    containing "down"). Statuses outside all three only count in the total.
    """

    operating: tuple[str, ...]
    idle: tuple[str, ...]
    down_token: str


@dataclass(frozen=True)
class Band:
    """One rung of a first-match ladder: ``value >= lower`` -> ``label``.

    ``exact`` makes the rung an equality test instead.
    """

    lower: float | None
    label: str
    exact: bool = False


# --- fixed values: sensor range rules (column, lo, hi, hard), in rule order ---
SENSOR_RULES: tuple[RangeRule, ...] = (
    RangeRule("engine_temp_c", -40, 150, True),
    RangeRule("oil_pressure_bar", 0, 10, True),
    RangeRule("tire_pressure_psi", 50, 140, False),
    RangeRule("fuel_rate_lph", 0, 700, False),
    RangeRule("payload_tonnes", 0, 450, False),
    RangeRule("speed_kmh", 0, 80, False),
    RangeRule("hydraulic_pressure_bar", 0, 420, True),
    RangeRule("hydraulic_oil_temp_c", -20, 120, True),
    RangeRule("belt_speed_mps", 0, 8, False),
    RangeRule("motor_current_amps", 0, 400, False),
    RangeRule("vibration_x_mms", 0, 50, True),
    RangeRule("vibration_y_mms", 0, 50, True),
    RangeRule("vibration_z_mms", 0, 50, True),
    RangeRule("motor_temp_c", -20, 120, True),
    RangeRule("feed_rate_tph", 0, 8000, False),
    RangeRule("power_draw_kw", 0, 1500, False),
    RangeRule("css_mm", 50, 250, False),
    RangeRule("crusher_vibration_mms", 0, 50, True),
    RangeRule("crusher_oil_temp_c", -20, 120, True),
)

# --- fixed values: reading quality score by number of soft/hard flags ---
# 0 flags -> 1.0, 1 -> 0.7, 2 -> 0.4, 3 or more -> 0.1
QUALITY_BY_FLAGS: tuple[float, ...] = (1.0, 0.7, 0.4)
QUALITY_FLOOR = 0.1

# --- fixed values: operating status groups of the fleet ---
FLEET_STATUS = StatusGroups(
    operating=("loaded", "empty", "digging", "running", "crushing"),
    idle=("idle",),
    down_token="down",
)

# --- fixed values: timestamp pattern of landed sensor messages ---
SENSOR_TS_PATTERNS: tuple[str, ...] = ("yyyy-MM-dd'T'HH:mm:ss",)

# --- fixed values: flotation date patterns, tried in this order ---
FLOTATION_TS_PATTERNS: tuple[str, ...] = (
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "MM/dd/yyyy HH:mm",
)

# --- fixed values: quarantine reasons ---
REASON_BAD_TS = "invalid_timestamp"
REASON_HARD_LIMIT = "out_of_range_hard_limit"
REASON_CONTRACT = "contract_violation"

# --- fixed values: quality band labels (three label sets in the reference) ---
QUALITY_BANDS_SILVER: tuple[Band, ...] = (
    Band(1.0, "perfect", exact=True),
    Band(0.7, "good"),
    Band(0.4, "fair"),
    Band(None, "poor"),
)
QUALITY_BANDS_REPORT: tuple[Band, ...] = (
    Band(1.0, "1.0 (perfect)", exact=True),
    Band(0.7, "0.7+ (good)"),
    Band(0.4, "0.4+ (fair)"),
    Band(None, "< 0.4 (poor)"),
)
QUALITY_BANDS_DASHBOARD: tuple[Band, ...] = (
    Band(1.0, "Perfect (1.0)", exact=True),
    Band(0.7, "Good (0.7+)"),
    Band(0.4, "Fair (0.4+)"),
    Band(None, "Poor (< 0.4)"),
)

# --- fixed values: flotation process-quality bands ---
PROCESS_BANDS: tuple[Band, ...] = (
    Band(90, "Excellent (90+)"),
    Band(75, "Good (75-90)"),
    Band(60, "Acceptable (60-75)"),
    Band(None, "Poor (< 60)"),
)


@dataclass(frozen=True)
class HealthParams:
    """Constants of the daily health score (all from the reference)."""

    # --- fixed values: component defaults and constants ---
    temp_when_no_reading: float = 100.0
    temp_when_no_limit: float = 80.0
    pressure_when_no_reading: float = 80.0
    oil_reference_bar: float = 5.5
    hydraulic_reference_bar: float = 280.0
    vibration_when_no_reading: float = 90.0
    # (threshold, score) rungs, value > threshold -> score
    vibration_ladder: tuple[tuple[float, float], ...] = ((15.0, 10.0), (10.0, 30.0), (7.0, 60.0))
    vibration_slope: float = 5.0
    quality_weight: float = 50.0
    utilization_weight: float = 0.3
    flag_allowance: float = 20.0
    flag_penalty: float = 0.5
    # weights of temperature, pressure, vibration, performance
    weights: tuple[float, float, float, float] = (0.25, 0.25, 0.25, 0.25)
    # status ladder: score < bound -> label, else "normal"
    status_ladder: tuple[tuple[float, str], ...] = ((20.0, "critical"), (50.0, "warning"), (70.0, "watch"))
    status_default: str = "normal"
    trend_band: float = 5.0


HEALTH = HealthParams()

# --- fixed values: severity sort order used by reports ---
SEVERITY_RANK: tuple[str, ...] = ("critical", "warning", "watch", "normal")

# --- fixed values: alert texts ---
ALERT_ACTION_CRITICAL = "Immediate inspection required. Consider taking equipment offline."
ALERT_ACTION_WARNING = "Schedule maintenance within the next shift cycle."
ALERT_ACTION_TREND = "Monitor closely. Plan maintenance if trend continues."


@dataclass(frozen=True)
class AlertRule:
    """When a row raises an alert, and its texts (``operators.alerts.fill``)."""

    alert_type: str
    when: str
    severity: str       # SQL expression
    title: str
    description: str
    action: str         # SQL expression


# --- fixed values: alert rules and their texts ---
HEALTH_ALERT = AlertRule(
    "health_score", "health_status IN ('critical', 'warning')", "health_status",
    "{equipment_id} health score: {health_score:1}",
    "Equipment {equipment_id} at {site_location} has health score {health_score:1} ({health_status}). "
    "Trend: {health_trend}[. Est. days to failure: {days_to_maintenance_estimate}]",
    f"IF(health_status = 'critical', '{ALERT_ACTION_CRITICAL}', '{ALERT_ACTION_WARNING}')")
TREND_ALERT = AlertRule(
    "trend", "health_trend = 'degrading' AND health_status = 'watch'", "'watch'",
    "{equipment_id} degrading trend detected",
    "Equipment {equipment_id} health score dropped from {health_score_prev_day:1} to {health_score:1} over 24 hours.",
    f"'{ALERT_ACTION_TREND}'")
FREQUENCY_ALERT = AlertRule(
    "anomaly_frequency", "daily_anomaly_count > CAST(max_flags AS DOUBLE)", "'warning'",
    "{equipment_id} frequent anomalies",
    "Equipment {equipment_id} flagged {daily_anomaly_count} readings (limit {max_flags}).",
    f"'{ALERT_ACTION_TREND}'")
THRESHOLD_ALERT = AlertRule(
    "threshold", "n_events > 0", "'critical'",
    "{equipment_id} {sensor_name} over its limit",
    "Equipment {equipment_id} had {n_events} critical {sensor_name} readings, the highest {worst_value:1}.",
    f"'{ALERT_ACTION_CRITICAL}'")

# --- fixed values: flotation ---
SILICA_BREACH_PCT = 3.0
# silica <= bound -> score; NULL -> 0.5; above the last bound -> 0.2
SILICA_QUALITY_LADDER: tuple[tuple[float, float], ...] = ((2.0, 1.0), (3.0, 0.8), (4.0, 0.5))
SILICA_QUALITY_NULL = 0.5
SILICA_QUALITY_ELSE = 0.2
SILICA_TARGET_PCT = 2.0
SILICA_EXCESS_PENALTY = 10.0
BREACH_RATE_PENALTY = 0.5
FLOTATION_COLUMNS = 7

# --- fixed values: flotation CSV header -> contract name ---
FLOTATION_HEADER_MAP: dict[str, str] = {
    "% Iron Feed": "iron_feed_pct",
    "% Silica Feed": "silica_feed_pct",
    "Starch Flow": "starch_flow",
    "Amina Flow": "amina_flow",
    "Ore Pulp Flow": "ore_pulp_flow",
    "Ore Pulp pH": "ore_pulp_ph",
    "Ore Pulp Density": "ore_pulp_density",
    "Flotation Column 01 Air Flow": "flotation_col_01_air_flow",
    "Flotation Column 02 Air Flow": "flotation_col_02_air_flow",
    "Flotation Column 03 Air Flow": "flotation_col_03_air_flow",
    "Flotation Column 04 Air Flow": "flotation_col_04_air_flow",
    "Flotation Column 05 Air Flow": "flotation_col_05_air_flow",
    "Flotation Column 06 Air Flow": "flotation_col_06_air_flow",
    "Flotation Column 07 Air Flow": "flotation_col_07_air_flow",
    "Flotation Column 01 Level": "flotation_col_01_level",
    "Flotation Column 02 Level": "flotation_col_02_level",
    "Flotation Column 03 Level": "flotation_col_03_level",
    "Flotation Column 04 Level": "flotation_col_04_level",
    "Flotation Column 05 Level": "flotation_col_05_level",
    "Flotation Column 06 Level": "flotation_col_06_level",
    "Flotation Column 07 Level": "flotation_col_07_level",
    "% Iron Concentrate": "iron_concentrate_pct",
    "% Silica Concentrate": "silica_concentrate_pct",
}

# --- fixed values: maintenance-label CSV header -> contract name ---
LABEL_HEADER_MAP: dict[str, str] = {
    "UDI": "uid",
    "Product ID": "product_id",
    "Type": "type",
    "Air temperature [K]": "air_temperature_k",
    "Process temperature [K]": "process_temperature_k",
    "Rotational speed [rpm]": "rotational_speed_rpm",
    "Torque [Nm]": "torque_nm",
    "Tool wear [min]": "tool_wear_min",
    "Machine failure": "machine_failure",
    "TWF": "twf",
    "HDF": "hdf",
    "PWF": "pwf",
    "OSF": "osf",
    "RNF": "rnf",
}
LABEL_DOUBLE_COLUMNS = ("air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min")
LABEL_INT_COLUMNS = ("machine_failure", "twf", "hdf", "pwf", "osf", "rnf")

# --- fixed values: failure flag -> failure type name, in report order ---
FAILURE_TYPES: dict[str, str] = {
    "twf": "Tool Wear Failure",
    "hdf": "Heat Dissipation Failure",
    "pwf": "Power Failure",
    "osf": "Overstrain Failure",
    "rnf": "Random Failure",
}
FAILURE_PERCENTILE = 0.9
# accuracy high enough that the sketch is exact on calibration-sized groups
PERCENTILE_ACCURACY = 1_000_000

# --- fixed values: bearing vibration files ---
EXPERIMENT_IDS: dict[str, int] = {"1st_test": 1, "2nd_test": 2, "3rd_test": 3}
SAMPLE_RATE_HZ = 20480
BEARINGS_PER_FILE = 4
# bearing health: 100 - rms_penalty*rms - max(0, (crest - knee) * crest_penalty)
RMS_PENALTY = 200.0
CREST_KNEE = 3.0
CREST_PENALTY = 5.0

# --- fixed values: monitoring ---
QUARANTINE_RATE_ALERT_PCT = 1.0
# --- fixed values: advice by kind, in order of priority ---
ADVICE: dict[str, str] = {
    "quarantine": "Quarantine rate is {rate}%. Review quarantined records and investigate sensor calibration issues.",
    "units": "Equipment {equipment_id} showing degrading health trends. Schedule proactive maintenance to prevent unplanned downtime.",
    "alerts": "{n} unacknowledged critical alerts. Immediate attention required.",
}
LATENCY_PERCENTILE = 0.95


@dataclass(frozen=True)
class KpiMeasure:
    """One output column of a period KPI: ``agg`` over a SQL expression."""

    name: str
    agg: str  # avg | max | min | sum | isum | count_if | sum_if_gt
    expr: str
    arg: float | None = None


# --- fixed values: hourly KPI measures of the fleet ---
FLEET_HOURLY_MEASURES: tuple[KpiMeasure, ...] = (
    KpiMeasure("avg_engine_temp_c", "avg", "engine_temp_c"),
    KpiMeasure("max_engine_temp_c", "max", "engine_temp_c"),
    KpiMeasure("avg_oil_pressure_bar", "avg", "oil_pressure_bar"),
    KpiMeasure("avg_payload_tonnes", "avg", "payload_tonnes"),
    KpiMeasure("total_payload_tonnes", "sum_if_gt", "payload_tonnes", 10.0),
    KpiMeasure("avg_speed_kmh", "avg", "speed_kmh"),
    KpiMeasure("avg_hydraulic_pressure_bar", "avg", "hydraulic_pressure_bar"),
    KpiMeasure("avg_cycle_time_sec", "avg", "cycle_time_sec"),
    KpiMeasure("avg_vibration_rms", "avg", "vibration_rms"),
    KpiMeasure("max_vibration_rms", "max", "vibration_rms"),
    KpiMeasure("avg_belt_speed_mps", "avg", "belt_speed_mps"),
    KpiMeasure("avg_feed_rate_tph", "avg", "feed_rate_tph"),
    KpiMeasure("avg_power_draw_kw", "avg", "power_draw_kw"),
    KpiMeasure("avg_css_mm", "avg", "css_mm"),
)

# --- fixed values: daily roll-up of hourly KPIs (name, agg, hourly column) ---
FLEET_DAILY_MEASURES: tuple[KpiMeasure, ...] = (
    KpiMeasure("daily_avg_temp", "avg", "avg_engine_temp_c"),
    KpiMeasure("daily_max_temp", "max", "max_engine_temp_c"),
    KpiMeasure("daily_avg_oil_press", "avg", "avg_oil_pressure_bar"),
    KpiMeasure("daily_avg_hyd_press", "avg", "avg_hydraulic_pressure_bar"),
    KpiMeasure("daily_avg_vib", "avg", "avg_vibration_rms"),
    KpiMeasure("daily_max_vib", "max", "max_vibration_rms"),
    KpiMeasure("daily_utilization", "avg", "utilization_pct"),
    KpiMeasure("daily_anomaly_count", "isum", "anomaly_count"),
    KpiMeasure("daily_avg_quality", "avg", "avg_quality_score"),
)


@dataclass(frozen=True)
class ThresholdSpec:
    """One threshold-breach detector (generic form of the four fleet rules).

    ``ladder`` is ordered from most to least severe; a reading produces an
    event for the first rung whose bound it exceeds. A rung bound is either a
    number or a SQL expression (e.g. ``"max_engine_temp_c * 0.9"``).
    """

    equipment_type: str
    status_sql: str
    sensor_name: str
    value_sql: str
    ladder: tuple[tuple[str, str], ...]
    threshold_sql: str
    description_sql: str
    anomaly_type: str = "threshold_breach"


# --- fixed values: the four fleet threshold rules ---
FLEET_THRESHOLD_SPECS: tuple[ThresholdSpec, ...] = (
    ThresholdSpec(
        equipment_type="haul_truck",
        status_sql="operating_status != 'idle'",
        sensor_name="engine_temp_c",
        value_sql="engine_temp_c",
        ladder=(("max_engine_temp_c", "critical"), ("max_engine_temp_c * 0.9", "warning")),
        threshold_sql="max_engine_temp_c",
        description_sql=(
            "concat('Engine temp ', round(engine_temp_c, 1), 'C exceeds ', "
            "round(max_engine_temp_c * 0.9, 1), 'C threshold')"
        ),
    ),
    ThresholdSpec(
        equipment_type="conveyor",
        status_sql="operating_status = 'running'",
        sensor_name="vibration_rms",
        value_sql="sqrt(pow(vibration_x_mms, 2) + pow(vibration_y_mms, 2) + pow(vibration_z_mms, 2))",
        ladder=(("15", "critical"), ("10", "warning"), ("7.0", "watch")),
        threshold_sql="7.0",
        description_sql="concat('Conveyor vibration RMS ', round(sensor_value, 2), ' mm/s exceeds 7.0 mm/s')",
    ),
    ThresholdSpec(
        equipment_type="crusher",
        status_sql="operating_status = 'crushing'",
        sensor_name="crusher_vibration_mms",
        value_sql="crusher_vibration_mms",
        ladder=(("15", "critical"), ("10", "warning"), ("8.0", "watch")),
        threshold_sql="8.0",
        description_sql="concat('Crusher vibration ', round(sensor_value, 2), ' mm/s exceeds 8.0 mm/s')",
    ),
    ThresholdSpec(
        equipment_type="excavator",
        status_sql="operating_status = 'digging'",
        sensor_name="hydraulic_oil_temp_c",
        value_sql="hydraulic_oil_temp_c",
        ladder=(("95", "critical"), ("85", "warning"), ("80", "watch")),
        threshold_sql="80.0",
        description_sql="concat('Hydraulic oil temp ', round(sensor_value, 1), 'C exceeds 80C threshold')",
    ),
)


@dataclass(frozen=True)
class SilverSpec:
    """Column roles of a raw reading table and the rules applied to it."""

    unit_col: str = "equipment_id"
    type_col: str = "equipment_type"
    raw_ts_col: str = "timestamp"
    status_col: str = "operating_status"
    ts_patterns: tuple[str, ...] = SENSOR_TS_PATTERNS
    rules: tuple[RangeRule, ...] = SENSOR_RULES
    # columns counted for the "more complete row wins" dedup tie-break;
    # None means every rule column
    completeness_cols: tuple[str, ...] | None = None
    ingest_ts_col: str | None = "ingestion_timestamp"
    source_col: str | None = "source_file"
    extra_drop: tuple[str, ...] = field(default=("ingestion_date", "_rescued_data"))
    # "timestamp" (session zone) or "timestamp_ntz" (wall clock, zone-free)
    ts_type: str = "timestamp"


FLEET_SILVER = SilverSpec()
