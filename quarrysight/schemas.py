"""Contract schemas (StructTypes) of the layer tables."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, IntegerType, StringType,
                               StructField, StructType, TimestampType)

D, S, I, B = DoubleType(), StringType(), IntegerType(), BooleanType()

# --- fixed values: sensor block per equipment type, in landing order ---
SENSOR_COLUMNS: tuple[str, ...] = (
    # haul truck
    "engine_temp_c", "oil_pressure_bar", "tire_pressure_psi", "fuel_rate_lph", "payload_tonnes",
    "speed_kmh", "gps_latitude", "gps_longitude",
    # excavator
    "hydraulic_pressure_bar", "boom_angle_deg", "swing_torque_knm", "bucket_fill_factor",
    "hydraulic_oil_temp_c", "cycle_time_sec",
    # conveyor
    "belt_speed_mps", "motor_current_amps", "vibration_x_mms", "vibration_y_mms", "vibration_z_mms",
    "belt_alignment_mm", "motor_temp_c", "tonnage_tph",
    # crusher
    "feed_rate_tph", "power_draw_kw", "css_mm", "crusher_vibration_mms", "crusher_oil_temp_c",
)

INGEST_FIELDS = [
    StructField("ingestion_timestamp", TimestampType()),
    StructField("source_file", S),
    StructField("ingestion_date", DateType()),
    StructField("_rescued_data", S),
]

SENSOR_JSON = StructType(
    [StructField("equipment_id", S), StructField("equipment_type", S), StructField("timestamp", S)]
    + [StructField(c, D) for c in SENSOR_COLUMNS]
    + [StructField("operating_status", S), StructField("engine_hours", D)]
)

RAW_SENSOR_READINGS = StructType(SENSOR_JSON.fields + INGEST_FIELDS)

REGISTRY_CSV = StructType([
    StructField("equipment_id", S, False), StructField("equipment_type", S, False),
    StructField("model", S), StructField("manufacturer", S), StructField("site_location", S),
    StructField("commissioned_date", S), StructField("operating_hours", D), StructField("status", S),
    StructField("max_engine_temp_c", D), StructField("max_oil_pressure_bar", D), StructField("max_payload_tonnes", D),
])

EQUIPMENT_REGISTRY = StructType([
    StructField("equipment_id", S, False), StructField("equipment_type", S, False),
    StructField("model", S), StructField("manufacturer", S), StructField("site_location", S),
    StructField("commissioned_date", DateType()), StructField("last_maintenance_date", DateType()),
    StructField("operating_hours", D), StructField("status", S),
    StructField("max_engine_temp_c", D), StructField("max_oil_pressure_bar", D), StructField("max_payload_tonnes", D),
])

QUARANTINE_RECORDS = StructType([
    StructField("equipment_id", S), StructField("equipment_type", S), StructField("raw_timestamp", S),
    StructField("quarantine_reason", S), StructField("raw_record", S), StructField("quarantined_at", TimestampType()),
])

ANOMALY_EVENTS = StructType([
    StructField("event_id", S, False), StructField("equipment_id", S, False), StructField("equipment_type", S, False),
    StructField("event_timestamp", TimestampType(), False), StructField("anomaly_type", S), StructField("severity", S),
    StructField("sensor_name", S), StructField("sensor_value", D), StructField("threshold_value", D),
    StructField("z_score", D), StructField("description", S), StructField("detected_at", TimestampType()),
])

FLOTATION_COLUMNS: tuple[str, ...] = (
    "iron_feed_pct", "silica_feed_pct", "starch_flow", "amina_flow", "ore_pulp_flow", "ore_pulp_ph", "ore_pulp_density",
    *[f"flotation_col_0{i}_air_flow" for i in range(1, 8)],
    *[f"flotation_col_0{i}_level" for i in range(1, 8)],
    "iron_concentrate_pct", "silica_concentrate_pct",
)
RAW_FLOTATION = StructType([StructField("date", S)] + [StructField(c, D) for c in FLOTATION_COLUMNS] + INGEST_FIELDS)

RAW_LABELS = StructType(
    [StructField("uid", S), StructField("product_id", S), StructField("type", S)]
    + [StructField(c, D) for c in ("air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min")]
    + [StructField(c, I) for c in ("machine_failure", "twf", "hdf", "pwf", "osf", "rnf")]
    + INGEST_FIELDS
)

RAW_BEARING = StructType([
    StructField("experiment_id", I), StructField("bearing_id", I), StructField("measurement_index", I),
    StructField("timestamp", S), StructField("vibration_signal", ArrayType(D)), StructField("sample_rate_hz", I),
] + INGEST_FIELDS)

# declared integer / not-null contract of the gold KPI table (enforced by T3)
HOURLY_KPI_TYPES: dict[str, str] = {
    "total_readings": "int", "operating_readings": "int", "idle_readings": "int", "down_readings": "int",
    "anomaly_count": "int",
}
HOURLY_KPI_NOT_NULL = ("equipment_id", "equipment_type", "kpi_hour")
SILVER_NOT_NULL = ("equipment_id", "equipment_type", "reading_timestamp")
